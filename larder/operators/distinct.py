"""DISTINCT and distinct counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols) -> DataFrame:
    """SELECT DISTINCT cols: NULL is one value. Partial aggregation map-side."""
    return df.select(*cols).distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def distinct_count(df: DataFrame, cols, suffix: str = "_distinct") -> DataFrame:
    """nunique() per column, NULLs not counted. One pass for all columns."""
    return df.agg(*[F.countDistinct(F.col(c)).alias(f"{c}{suffix}") for c in cols])
