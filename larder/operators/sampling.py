"""Deterministic samples and sample views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_order(key_cols, seed: int = 42):
    """md5 of the seed and the key as text: a shuffle order that is the same on
    every run, in every engine that has md5."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") for c in key_cols]
    return F.md5(F.concat_ws("|", *parts))


def sample_n(df: DataFrame, n: int, key_cols, seed: int = 42) -> DataFrame:
    """n rows chosen uniformly by a seeded hash of the key (shuffle then slice).

    Returns every row when n exceeds the row count. Planned as a top-n: each
    task keeps n candidates, so at most n × tasks rows reach the final merge.
    """
    key_cols = list(key_cols)
    return (df.withColumn("__h", hash_order(key_cols, seed))
              .orderBy(F.col("__h"), *[F.col(c) for c in key_cols])
              .limit(n).drop("__h"))


def sample_rows(df: DataFrame, n: int = 10, order_cols=None) -> DataFrame:
    """First n rows of a stable order (LIMIT n for viewing data)."""
    order_cols = list(order_cols or df.columns)
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols]).limit(n)
