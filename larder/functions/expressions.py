"""Column expressions shared by the operators. All are built-in Spark
expressions, so they compile into whole-stage code with their neighbours."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """TRIM(x) = '': only spaces are trimmed, so a tab-only value is not blank."""
    return F.trim(col_of(c)) == F.lit("")


def bad_text(c) -> Column:
    c = col_of(c)
    return c.isNull() | is_blank(c)


def bad_number(c, zero_is_bad: bool = True) -> Column:
    c = col_of(c)
    return (c.isNull() | (c == 0)) if zero_is_bad else c.isNull()


def any_of(preds) -> Column:
    return reduce(or_, preds)


def any_null(cols) -> Column:
    return any_of([col_of(c).isNull() for c in cols])


def all_not_null(cols) -> Column:
    return ~any_null(cols)


def flag_sum(pred: Column) -> Column:
    """SUM(CASE WHEN pred THEN 1 ELSE 0 END): NULL on empty input, unlike count_if."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0)))


def cap_upper(c, cap) -> Column:
    """UPDATE … SET x = cap WHERE x > cap. A NULL value stays NULL (no least())."""
    c = col_of(c)
    cap_col = cap if isinstance(cap, Column) else F.lit(cap)
    return F.when(c > cap_col, cap_col).otherwise(c)


def enforce_available(available, demand) -> Column:
    """Business rules, first match wins: negative → 0, above demand → demand."""
    a, d = col_of(available), col_of(demand)
    return (F.when(a < 0, F.lit(0.0))
             .when(a > d, d)
             .otherwise(a))


def rounded(c, precision: int, scale: int) -> Column:
    """Half-up rounding that any engine can repeat: through DECIMAL(28,10) first, so
    that a double tie such as 19.525 counts as the decimal it stands for."""
    return col_of(c).cast(T.DecimalType(28, 10)).cast(T.DecimalType(precision, scale))


def to_measure(c, precision: int = 10, scale: int = 2) -> Column:
    """DECIMAL(p,s) assignment: rounds half up; out-of-range raises under ANSI."""
    return rounded(c, precision, scale)


def exact_mean(c) -> Column:
    """AVG whose result does not depend on the order of the rows: the sum is a
    DECIMAL, and one division follows. NaN counts as NULL: it has no DECIMAL."""
    c = F.when(~F.isnan(col_of(c)), col_of(c)).cast(T.DecimalType(28, 10))
    return F.sum(c).cast("double") / F.count(c)


def date_key(d) -> Column:
    """yyyyMMdd as an int, computed arithmetically (no string round trip)."""
    d = col_of(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast(T.IntegerType())


def month_name(d) -> Column:
    """Full month name ('February'); Spark's monthname() gives 'Feb'."""
    return F.date_format(col_of(d), "MMMM")


def day_name(d) -> Column:
    """Full weekday name ('Monday'); Spark's dayname() gives 'Mon'."""
    return F.date_format(col_of(d), "EEEE")


def month_start(ts) -> Column:
    return F.trunc(col_of(ts).cast(T.DateType()), "month")


def days_between(end, start) -> Column:
    return F.datediff(col_of(end), col_of(start))


def shift_days(d, n) -> Column:
    return F.date_add(col_of(d), n)
