"""CSV and Parquet/catalog sources and sinks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


class SourceMissing(FileNotFoundError):
    """Raised when an input path does not exist (instead of a bare AnalysisException)."""


def _guard(fn, path):
    try:
        return fn()
    except AnalysisException as exc:  # PATH_NOT_FOUND and friends
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise SourceMissing(f"input not found: {path}") from exc
        raise


def source_error(spark: SparkSession, source: str, error: Exception) -> DataFrame:
    """(Source, Error): a declared row in place of a source that could not be read."""
    kind = "SourceMissing" if isinstance(error, SourceMissing) else type(error).__name__
    return spark.createDataFrame([(source, kind)], "Source string, Error string")


# RFC 4180: quotes are doubled inside quotes, and a quoted value may hold commas,
# quotes and line breaks. NULL is written as a marker, so that it is not taken for
# an empty text; blanks stay as they are. A text that looks like the marker gets one
# backslash more when written, and loses it when read.
NULL_MARK = r"\N"
_CSV = {"quote": '"', "escape": '"', "nullValue": NULL_MARK,
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, mode: str = "PERMISSIVE", null_mark: str = NULL_MARK) -> DataFrame:
    """CSV with a header row; pass ``schema`` in production (inference scans the data twice).
    Line breaks inside quotes mean that one file cannot be split over tasks: give
    large inputs as many files. Files that write NULL as nothing are read with
    ``null_mark=""``. PERMISSIVE turns a value that does not fit its column into NULL, which the
    bad-value reports then count; FAILFAST stops at the first such row."""
    reader = spark.read.options(**{**_CSV, "nullValue": null_mark}, header=header, mode=mode, multiLine=True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    rows = _guard(lambda: reader.csv(path), path)
    if null_mark != NULL_MARK:
        return rows
    return _texts(rows, lambda c: F.when(c.rlike(r"^\\{2,}N$"), F.substring(c, 2, 1 << 30)).otherwise(c))


def _texts(df: DataFrame, change) -> DataFrame:
    """``df`` with ``change`` applied to its text columns."""
    return df.select(*[change(df[f.name]).alias(f.name) if isinstance(f.dataType, StringType) else df[f.name] for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header and no index column; one file per partition."""
    marked = _texts(df, lambda c: F.when(c.rlike(r"^\\+N$"), F.concat(F.lit("\\"), c)).otherwise(c))
    marked.write.mode(mode).options(**_CSV, emptyValue='""', header=True).csv(path)
    return path


def load_csv(spark: SparkSession, path: str, schema: StructType, table: str, null_mark: str = NULL_MARK, append: bool = False) -> DataFrame:
    """CSV → catalog table with declared columns. Returns the rejected rows (as texts): those
    with a value that does not fit its column; the table gets all others, in place of its rows or (``append``) after them."""
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields])
    rows = read_csv(spark, path, texts, null_mark=null_mark)
    fits = [rows[f.name].isNull() | rows[f.name].try_cast(f.dataType).isNotNull() for f in schema.fields]
    good = reduce(and_, fits)
    typed = rows.where(good).select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    if append:
        insert_rows(typed, table)
    else:
        save_table(typed, table)
    return rows.where(~good)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _guard(lambda: spark.read.parquet(path), path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by=None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def ensure_database(spark: SparkSession, name: str | None, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS [LOCATION] + USE."""
    if not name:
        return
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    spark.catalog.setCurrentDatabase(name)


def create_table(spark: SparkSession, name: str, schema: StructType) -> None:
    """DROP TABLE IF EXISTS + CREATE TABLE with declared columns, empty."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")


def insert_rows(df: DataFrame, name: str) -> None:
    """INSERT INTO a standing table … SELECT: the table's columns by name, cast to its types. A column
    that is missing or not the table's is an error; so is a value that does not fit (ANSI casts)."""
    schema = df.sparkSession.table(name).schema
    if set(df.columns) != set(schema.names):
        raise ValueError(f"columns {sorted(set(df.columns) ^ set(schema.names))} are not on both sides")
    df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]).write.insertInto(name)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by=None) -> str:
    """CREATE TABLE AS SELECT / SELECT INTO, idempotent on rerun (overwrite)."""
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return name
