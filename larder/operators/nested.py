"""Text columns that hold JSON objects, parsed to typed columns with a drift report and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATUS = "__status"
OK, EMPTY, BROKEN, MISFIT = "ok", "empty", "no object", "misfit"


def _checked(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """``df`` with ``__texts`` (key -> value as text) of the declared keys, ``__keys`` and ``__status``."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = df.withColumns({"__keys": F.json_object_keys(column), "__texts": F.from_json(column, texts)})
    misfits = [F.col("__texts")[f.name].isNotNull() & F.col("__texts")[f.name].try_cast(f.dataType).isNull() for f in schema.fields]
    missing = [F.col("__texts")[f.name].isNull() for f in schema.fields if not f.nullable]
    bad = F.lit(False)
    for c in misfits + missing:
        bad = bad | c
    blank = F.col(column).isNull() | (F.trim(F.col(column)) == "")
    return rows.withColumn(STATUS, F.when(blank, EMPTY).when(F.col("__keys").isNull(), BROKEN).when(bad, MISFIT).otherwise(OK))


def typed_columns(df: DataFrame, column: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects). Rows: ``df`` with one typed column per declared key, NULL where the object has none or the text is
    empty. Rejects: the rows of ``df`` whose text is no JSON object, holds a value that does not fit its declared type or lacks a key
    declared NOT NULL, with the reason in ``reject_reason``. Keys that are not declared are ignored here and reported by ``drift``."""
    rows = _checked(df, column, schema)
    good = rows.where(F.col(STATUS).isin(OK, EMPTY)).select(*df.columns, *[F.col("__texts")[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return good, rows.where(~F.col(STATUS).isin(OK, EMPTY)).select(*df.columns, F.col(STATUS).alias("reject_reason"))


def drift(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """(key, declared, n_rows, n_misfits): every key that occurs or is declared, in how many objects, and in how many its value does not fit the
    declared type. One scan; keys are counted in the tasks that read them."""
    kinds = {f.name: f.dataType for f in schema.fields}
    rows = _checked(df, column, schema).where(F.col("__keys").isNotNull())
    misfit = F.coalesce(*[F.when(F.col("key") == k, F.col("__texts")[k].isNotNull() & F.col("__texts")[k].try_cast(kind).isNull()) for k, kind in kinds.items()], F.lit(False))
    seen = rows.select("__texts", F.explode(F.array_distinct("__keys")).alias("key")).groupBy("key").agg(
        F.count("*").alias("n_rows"), F.count(F.when(misfit, 1)).alias("n_misfits"))
    declared = df.sparkSession.createDataFrame([(k, k_.simpleString()) for k, k_ in kinds.items()], "key string, declared string")
    return seen.join(declared, "key", "full").select("key", "declared", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_misfits", F.lit(0)).alias("n_misfits"))
