"""Schema profile (INFORMATION_SCHEMA.COLUMNS) for any DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_profile(df: DataFrame, table_name: str) -> DataFrame:
    """One row per column: name, position, type, nullable flag and the number of
    NULLs actually present. The NULL counts come from a single aggregate over
    the data, then ``stack`` turns the one wide row into one row per column."""
    fields = df.schema.fields
    counts = df.agg(*[(F.count(F.lit(1)) - F.count(F.col(f.name))).alias(f"n{i}")
                      for i, f in enumerate(fields)])
    parts = []
    for i, f in enumerate(fields):
        parts += [F.lit(f.name), F.lit(i + 1), F.lit(f.dataType.simpleString()),
                  F.lit("YES" if f.nullable else "NO"), F.col(f"n{i}")]
    stacked = counts.select(F.inline(F.array(*[
        F.struct(parts[5 * i].alias("COLUMN_NAME"),
                 parts[5 * i + 1].alias("ORDINAL_POSITION"),
                 parts[5 * i + 2].alias("DATA_TYPE"),
                 parts[5 * i + 3].alias("IS_NULLABLE"),
                 parts[5 * i + 4].alias("NULL_COUNT"))
        for i in range(len(fields))])))
    return stacked.select(F.lit(table_name).alias("TABLE_NAME"), "*")
