"""Interval join: all pairs of rows whose intervals overlap, per key.

Time is cut into bins of several widths, each twice as wide as the one before. An interval belongs to
the width that is no shorter than itself, of which it meets two bins at most; it is laid
into those, and looks into the bins of all wider widths the other side uses. So a long interval
costs two rows, not one per short bin it spans, and a short one two rows per width in use. Pairs are rechecked
exactly and reported only in the bin in which the later of the two begins: each once.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_LEVELS = 62


def _sided(df: DataFrame, tail: str, lo: str, hi: str, width: int) -> DataFrame:
    """All columns with a suffix, the interval as whole numbers, and its level; empty and NULL intervals go."""
    begin, end = F.col(lo).cast("long"), F.col(hi).cast("long")
    rows = df.select(*[F.col(c).alias(c + tail) for c in df.columns], begin.alias("__lo" + tail), end.alias("__hi" + tail)).where(f"`__lo{tail}` <= `__hi{tail}`")
    # the first level whose bins are as wide as the interval
    spans = (F.col("__hi" + tail) - F.col("__lo" + tail)) / F.lit(float(width))
    return rows.withColumn("__level" + tail, F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(spans, F.lit(1.0)))).cast("int")))


def _bin(value: Column, level: Column, width: int) -> Column:
    size = F.lit(width).cast("long") * F.call_function("shiftleft", F.lit(1).cast("long"), level)
    return F.call_function("div", value - F.pmod(value, size), size)       # rounds down, also below zero


def _laid(rows: DataFrame, tail: str, width: int, levels: Column | None) -> DataFrame:
    """One row per bin of the row's own level, or of the given ones."""
    if levels is not None:
        rows = rows.withColumn("__in" + tail, F.explode(levels))
    else:
        rows = rows.withColumn("__in" + tail, F.col("__level" + tail))
    level = F.col("__in" + tail)
    return rows.withColumn("__bin" + tail, F.explode(F.sequence(_bin(F.col("__lo" + tail), level, width), _bin(F.col("__hi" + tail), level, width))))


def interval_join(left: DataFrame, right: DataFrame, on, left_interval: tuple[str, str], right_interval: tuple[str, str], width: int = 1,
                  tails: tuple[str, str] = ("_l", "_r"), keep: Column | None = None) -> DataFrame:
    """Pairs of rows with equal ``on`` (NULL equals nothing) whose closed intervals share a point; columns get the
    ``tails``. Bounds are whole numbers or cast to them (dates: days by ``unix_date``; timestamps: seconds). ``width``: of the narrowest
    bins, about that of a short interval. ``keep``: a condition on the pairs, checked with the overlap."""
    a, b = tails
    one, two = _sided(left, a, *left_interval, width), _sided(right, b, *right_interval, width)
    used = {tail: sorted(r[0] for r in rows.select("__level" + tail).distinct().collect()) for tail, rows in ((a, one), (b, two))}     # at most MOST_LEVELS

    def wider(tail: str, levels: list, strictly: bool) -> Column:
        own = F.col("__level" + tail)
        return F.filter(F.array(*map(F.lit, levels)), lambda x: x > own if strictly else x >= own)

    begin = F.greatest(F.col("__lo" + a), F.col("__lo" + b))
    same = reduce(and_, [F.col(c + a) == F.col(c + b) for c in on], (F.col("__in" + a) == F.col("__in" + b)) & (F.col("__bin" + a) == F.col("__bin" + b)))
    same = same & (F.col("__lo" + a) <= F.col("__hi" + b)) & (F.col("__lo" + b) <= F.col("__hi" + a)) & (_bin(begin, F.col("__in" + a), width) == F.col("__bin" + a))
    if keep is not None:
        same = same & keep
    columns = [*[c + a for c in left.columns], *[c + b for c in right.columns]]
    out = None
    # the narrower looks into the wider's bins; equal levels meet in the first join alone
    for lone, lthree in (((wider(a, used[b], False) if used[b] else None), None), (None, (wider(b, used[a], True) if used[a] else None))):
        if lone is None and lthree is None:
            continue
        found = _laid(one, a, width, lone).join(_laid(two, b, width, lthree), same).select(*columns)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else one.join(two, F.lit(False)).select(*columns)
