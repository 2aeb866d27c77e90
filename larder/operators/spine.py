"""Calendar spines and snapshot gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.expressions import month_start


def month_spine(df: DataFrame, date_col: str, name: str = "Month") -> DataFrame:
    """Every first-of-month from the earliest to the latest month present,
    inclusive. One aggregate pass for the bounds, then one row per month."""
    m = month_start(date_col)
    bounds = df.agg(F.min(m).alias("_lo"), F.max(m).alias("_hi"))
    return bounds.select(F.explode(
        F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 MONTH"))).alias(name))


def snapshot_gaps(df: DataFrame, series_key, date_col: str,
                  name: str = "MissingMonth") -> DataFrame:
    """Months with no snapshot inside each series' own first..last month.

    The dense scaffold (series × month) is never built, neither as a
    cartesian product of all keys nor per series: observed (series, month)
    pairs are de-duplicated map-side first (a series with millions of rows
    costs no more than one with a row per month), each observed month is
    compared with the previous one of its series, and only the months
    strictly between them are generated. A series holds at most one row per
    calendar month at that point, so the window stays small per series.
    """
    series_key = list(series_key)
    observed = (df.select(*series_key, month_start(date_col).alias(name))
                  .where(F.col(name).isNotNull()).distinct())
    prev = F.lag(name).over(Window.partitionBy(*series_key).orderBy(name))
    steps = observed.select(*series_key, F.col(name).alias("_cur"), prev.alias("_prev"))
    gaps = steps.where(F.col("_prev").isNotNull()
                       & (F.add_months(F.col("_prev"), 1) < F.col("_cur")))
    return gaps.select(*series_key, F.explode(F.sequence(
        F.add_months(F.col("_prev"), 1), F.add_months(F.col("_cur"), -1),
        F.expr("INTERVAL 1 MONTH"))).alias(name))
