"""Streamed de-duplication against keep-first over all files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.dedup import keep_first
from larder.plans import loads
from larder.session import shared_scratch
from larder.sources.files import SourceMissing, create_table, ensure_database, insert_rows, source_error
from larder.sources.tables import FolderTable
from larder.streaming.dedup import DAY, dedup_stream, first_per_day

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user", T.LongType()), T.StructField("v", T.DoubleType())])


class Stream:
    def __init__(self, spark, **kw):
        self.spark, self.kw = spark, kw
        self.files, self.checkpoint = shared_scratch(spark, "in"), shared_scratch(spark, "checkpoint")
        self.table = FolderTable(spark, shared_scratch(spark, "out"), T.StructType([*SCHEMA.fields, T.StructField(DAY, T.IntegerType())]), DAY)

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.files)

    def run(self):
        return dedup_stream(self.spark, self.files, SCHEMA, self.table, self.checkpoint, ["user"], "ts", ["id"], files_per_batch=1, **self.kw)

    def rows(self):
        return sorted((r.id, r.user, r.DateKey) for r in self.table.read().collect())


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_first_rows_stay_over_files_and_restarts(spark):
    s = Stream(spark, delay="5 days")
    s.add([(5, at(1), 1, 1.0), (7, at(1, 5), 1, 2.0), (8, at(1), 2, None), (5, at(1), 1, 1.0), (9, None, 1, 1.0), (10, at(1), None, 1.0)])
    first = s.run()
    assert (first.rows_in, first.rows_late) == (6, 0) and s.rows() == [(5, 1, 20240101), (8, 2, 20240101)]
    # an earlier row of a key, another day, a repeat; then again nothing new
    s.add([(3, at(1, 20), 1, 9.0), (11, at(2), 1, 1.0), (8, at(1), 2, None)])
    assert s.run().rows_in == 3 and s.rows() == [(3, 1, 20240101), (8, 2, 20240101), (11, 1, 20240102)]
    assert s.run().rows_in == 0 and len(s.rows()) == 3


def test_late_rows_are_counted_and_left_out(spark):
    s = Stream(spark, delay="1 day")
    s.add([(5, at(1), 1, 1.0)])
    s.run()
    s.add([(6, at(10), 1, 1.0)])
    s.run()                                              # moves the watermark to day 9
    s.add([(1, at(1), 3, 1.0), (2, at(1), 4, 1.0), (7, at(9, 12), 1, 1.0)])
    report = s.run()
    assert report.rows_late == 2 and s.rows() == [(5, 1, 20240101), (6, 1, 20240110), (7, 1, 20240109)]


def test_state_is_the_batch_result(spark):
    rows = [(k, at(1 + k % 3, k % 24), k % 4, float(k)) for k in range(60, 0, -1)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = first_per_day(table, ["user"], "ts", ["id"], "1 day")
    want = keep_first(table.withColumn(DAY, F.date_format("ts", "yyyyMMdd").cast("int")), ["user", DAY], ["id"])
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_streamed_events_equal_keep_first(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    want = keep_first(events.withColumn(DAY, F.date_format("ts", "yyyyMMdd").cast("int")), ["user_id", "event_type", DAY], ["event_id"])
    got = loads.streamed_events(spark, SF).read().select(want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


# --- catalog ---------------------------------------------------------------

def test_insert_into_a_declared_table(spark):
    before = spark.catalog.currentDatabase()
    try:
        ensure_database(spark, "larder_insert_db", shared_scratch(spark, "db"))
        create_table(spark, "t", T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DecimalType(6, 2))]))
        insert_rows(spark.createDataFrame([("1.239", 7)], "b string, a long"), "t")
        insert_rows(spark.createDataFrame([(None, 8)], "b double, a long"), "t")
        assert sorted((r.a, str(r.b)) for r in spark.table("t").collect()) == [(7, "1.24"), (8, "None")]
        with pytest.raises(ValueError):
            insert_rows(spark.createDataFrame([(1,)], "a int"), "t")
        with pytest.raises(Exception, match="CAST|OVERFLOW|overflow"):
            insert_rows(spark.createDataFrame([(1 << 40, 1.0)], "a long, b double"), "t")
        assert spark.table("t").count() == 2
        create_table(spark, "t", T.StructType([T.StructField("a", T.IntegerType())]))      # drops the old one
        assert spark.table("t").count() == 0
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE IF EXISTS larder_insert_db CASCADE")


def test_catalog_load_leaves_the_session_as_it_was(spark):
    before = spark.catalog.currentDatabase()
    status = {r.Status: r["count"] for r in loads.catalog_products(spark, SF).groupBy("Status").count().collect()}
    assert spark.catalog.currentDatabase() == before
    assert status["SourceMissing"] == 1 and status["loaded"] + status["rejected"] == spark.read.parquet(f"{SF}/part.parquet").count()


def test_source_error_row(spark):
    assert source_error(spark, "x", SourceMissing("gone")).first().Error == "SourceMissing"
    assert source_error(spark, "x", KeyError("k")).first().Error == "KeyError"
