"""Loads into standing tables over the given inputs: stable keys, incremental append, MERGE and DELETE."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.expressions import date_key
from larder.operators.incremental import delete, load_changed, merge
from larder.operators.dedup import keep_first
from larder.operators.key_registry import KeyRegistry
from larder.session import shared_scratch, write_scratch
from larder.schemas import BUSINESS_KEY
from larder.sources import testdata as td
from larder.sources.files import SourceMissing, create_table, ensure_database, load_csv, source_error, write_csv
from larder.sources.tables import FolderTable
from larder.streaming.dedup import DAY, dedup_stream

SERIES = ["ProductID", "WarehouseLocation"]
SERIES_KEY = T.StructType([T.StructField("ProductID", T.LongType()), T.StructField("WarehouseLocation", T.StringType())])

#: A standing table of snapshots, one folder per month.
SNAPSHOTS = T.StructType([
    T.StructField("ProductID", T.LongType()), T.StructField("ProductName", T.StringType()), T.StructField("WarehouseLocation", T.StringType()),
    T.StructField("unitsAvailable", T.DoubleType()), T.StructField("unitsDemanded", T.DoubleType()), T.StructField("SnapshotDate", T.DateType()),
    T.StructField("Delivery", T.IntegerType()), T.StructField("DateKey", T.IntegerType())])

# Last ship year of each delivery but the last one. Lines that are still open ('O') come one delivery late.
DELIVERED_UPTO = [1996, 1998, 2000]
FULL_DEMAND = 45.0           # a correction of so many units or more closes the series' snapshot


def stable_series_keys(spark: SparkSession, d: str) -> KeyRegistry:
    """Keys of all (product, warehouse) series, given out in one load per order year."""
    lines = td.table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("ProductID"), "l_suppkey")
    orders = td.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    wh = td.warehouses(spark, d)
    arrivals = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
                     .join(wh, F.col("l_suppkey") == F.col("s_suppkey"), "left")
                     .select(*SERIES, "year").distinct())
    arrivals = write_scratch(arrivals, "arrivals")
    registry = KeyRegistry(spark, shared_scratch(spark, "series-keys"), SERIES_KEY, "SeriesKey")
    years = sorted((r[0] for r in arrivals.select("year").distinct().collect()), key=lambda y: (y is None, y))
    for year in years:       # lines without an order come last
        registry.register(arrivals.where(F.col("year").eqNullSafe(F.lit(year))))
    return registry


def delivered_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Raw snapshots with their month's key, the delivery that brought them and their order."""
    last = F.lit(len(DELIVERED_UPTO) + 1)
    for k, year in reversed(list(enumerate(DELIVERED_UPTO, 1))):
        last = F.when(F.year("l_shipdate") <= year, F.lit(k)).otherwise(last)
    delivery = (last + F.when(F.col("l_linestatus") == "O", F.lit(1)).otherwise(F.lit(0))).cast("int")
    raw = td.raw_inventory(spark, d, ids=False, extra=[delivery.alias("Delivery"), td.lineitem_row()])
    return raw.withColumn("DateKey", date_key("SnapshotDate"))


def snapshot_table(spark: SparkSession, name: str) -> FolderTable:
    return FolderTable(spark, shared_scratch(spark, name), SNAPSHOTS, "DateKey")


def load_deliveries(spark: SparkSession, d: str) -> tuple[FolderTable, list]:
    """Delivery after delivery into one table: the source holds all rows so far, a load reads the months
    that changed. Returns the table and the months of each load. What was delivered is shaped and written
    once: a load reads that instead of joining all lines anew."""
    rows = write_scratch(delivered_snapshots(spark, d), "delivered")
    table, ledger, loads = snapshot_table(spark, "snapshots"), None, []
    for k in range(1, len(DELIVERED_UPTO) + 3):
        values, ledger = load_changed(table, rows.where(F.col("Delivery") <= k), BUSINESS_KEY, [td.ROW], ledger)
        loads.append(values)
    return table, loads


def corrected_snapshots(spark: SparkSession, d: str) -> tuple[FolderTable, dict, list]:
    """A table of the closed lines' snapshots, merged with those of the open ones: full demand closes a
    snapshot, other matches bring new counts, the rest is new. Then snapshots without a demand go."""
    rows = delivered_snapshots(spark, d)
    is_open = F.col(f"{td.ROW}.l_linestatus") == "O"
    table = snapshot_table(spark, "corrected")
    table.append(keep_first(rows.where(~is_open), [*BUSINESS_KEY, "DateKey"], [td.ROW]))
    batch = keep_first(rows.where(is_open), [*BUSINESS_KEY, "DateKey"], [td.ROW]).drop(td.ROW)
    done = merge(table, batch, BUSINESS_KEY, ["unitsAvailable", "unitsDemanded", "Delivery"], delete_when=F.col("unitsDemanded") >= FULL_DEMAND)
    return table, done, delete(table, F.col("unitsDemanded").isNull())


PRODUCT_TABLE = T.StructType([T.StructField("ProductID", T.LongType(), False), T.StructField("ProductName", T.StringType()), T.StructField("Category", T.StringType()),
                              T.StructField("CostPrice", T.DecimalType(10, 2)), T.StructField("Size", T.IntegerType())])
UNSIZED = 45                 # larger sizes are written as a text that fits no integer


def catalog_products(spark: SparkSession, d: str) -> DataFrame:
    """Products by way of CSV files into a typed catalog table, loaded twice, and an append of the newer half: loaded rows,
    rejected rows, and the row of a source that does not exist. The session's database stays what it was."""
    parts = td.table(spark, d, "part")
    size = F.when(F.col("p_size") > UNSIZED, F.concat(F.lit("size "), F.col("p_size").cast("string"))).otherwise(F.col("p_size").cast("string"))
    rows = parts.select(F.col("p_partkey").alias("ProductID"), F.col("p_name").alias("ProductName"), F.col("p_type").alias("Category"),
                        F.round(F.col("p_retailprice") / td.COST_MARKUP, 2).alias("CostPrice"), size.alias("Size"))
    older, newer = (shared_scratch(spark, n) for n in ("older-csv", "newer-csv"))
    half = (parts.agg(F.max("p_partkey")).first()[0] or 0) // 2
    write_csv(rows.where(F.col("ProductID") <= half), older)
    write_csv(rows.where(F.col("ProductID") > half), newer)
    before, name = spark.catalog.currentDatabase(), f"larder_{uuid.uuid4().hex}"
    try:
        ensure_database(spark, name, shared_scratch(spark, "catalog"))
        table, rejects = f"{name}.products", []
        for _ in range(2):                           # a rerun gives the same table
            create_table(spark, table, PRODUCT_TABLE)
            rejects = [load_csv(spark, path, PRODUCT_TABLE, table, append=True) for path in (older, newer)]
        try:
            missing = load_csv(spark, shared_scratch(spark, "missing"), PRODUCT_TABLE, table, append=True).limit(0)
        except SourceMissing as error:
            missing = source_error(spark, "missing", error).select(*[F.lit(None).cast("string").alias(c) for c in PRODUCT_TABLE.names], F.col("Error").alias("Status"))
        loaded = spark.table(table)
    finally:
        spark.catalog.setCurrentDatabase(before)
    out = loaded.select(*[F.col(c).cast("string").alias(c) for c in loaded.columns], F.lit("loaded").alias("Status"))
    for r in rejects:
        out = out.unionByName(r.withColumn("Status", F.lit("rejected")))
    return out.unionByName(missing)


EVENT_KEY = ["user_id", "event_type"]


def streamed_events(spark: SparkSession, d: str, n_files: int = 4) -> FolderTable:
    """Events written as files by time, streamed into a table of each user's first event of a kind per day."""
    events = td.table(spark, d, "events")
    files = shared_scratch(spark, "event-files")
    events.repartitionByRange(n_files, "ts").write.parquet(files)
    span = events.agg((F.unix_date(F.to_date(F.max("ts"))) - F.unix_date(F.to_date(F.min("ts")))).alias("days")).first()["days"] or 0
    schema = T.StructType([*events.schema.fields, T.StructField(DAY, T.IntegerType())])
    table = FolderTable(spark, shared_scratch(spark, "streamed"), schema, DAY)
    # the files of one writer come in any order: the state keeps the whole span
    dedup_stream(spark, files, events.schema, table, shared_scratch(spark, "stream-checkpoint"), EVENT_KEY, "ts", ["event_id"], f"{span + 1} days", n_files // 2)
    return table


def q_catalog_load(spark, d):
    return catalog_products(spark, d)


def q_stream_dedup(spark, d):
    return streamed_events(spark, d).read()


def q_stable_keys(spark, d):
    return stable_series_keys(spark, d).read()


def q_incremental_load(spark, d):
    return load_deliveries(spark, d)[0].read()


def q_merge_snapshots(spark, d):
    return corrected_snapshots(spark, d)[0].read()


QUERIES = {
    "stable_keys": q_stable_keys,
    "incremental_load": q_incremental_load,
    "merge_snapshots": q_merge_snapshots,
    "catalog_load": q_catalog_load,
    "stream_dedup": q_stream_dedup,
}
