"""Standing tables: stable keys, append against history, changed partitions, MERGE and DELETE."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.impute import impute_group_mean
from larder.operators.incremental import BatchRefused, append_new, changed_partitions, delete, fingerprints, load_changed, merge
from larder.operators.key_registry import KeyRegistry
from larder.plans import loads
from larder.plans.inventory import IMPUTE_COLUMNS
from larder.session import local_path, shared_scratch
from larder.sources.tables import FolderTable

SF = "/root/testdata/sf0.001"
KEY = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
ROWS = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.IntegerType()), T.StructField("v", T.DoubleType())])


def registry(spark):
    return KeyRegistry(spark, shared_scratch(spark, "registry"), KEY, "k")


def table(spark, rows=()):
    t = FolderTable(spark, shared_scratch(spark, "folders"), ROWS, "day")
    if rows:
        t.append(spark.createDataFrame(list(rows), "id long, day int, v double"))
    return t


def batch(spark, rows):
    return spark.createDataFrame(rows, "id long, day int, v double")


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "day", "v").collect()), key=str)


def all_files(t):
    return {os.path.join(d, f) for d, _, fs in os.walk(local_path(t.path)) for f in fs if f.endswith(".parquet")}


# --- stable keys ---------------------------------------------------------

def test_keys_never_move(spark):
    reg = registry(spark)
    assert reg.register(spark.createDataFrame([(5, "x"), (7, None), (5, "x"), (None, None)], KEY)) == 3
    first = {(r.a, r.b): r.k for r in reg.read().collect()}
    assert first == {(None, None): 1, (5, "x"): 2, (7, None): 3}
    # smaller natural keys, known ones and repeats in the next load
    assert reg.register(spark.createDataFrame([(1, "a"), (7, None), (None, None), (6, "z"), (1, "a")], KEY)) == 2
    now = {(r.a, r.b): (r.k, r.FirstLoad) for r in reg.read().collect()}
    assert {k: v[0] for k, v in now.items() if k in first} == first
    assert now[(1, "a")] == (4, 2) and now[(6, "z")] == (5, 2)


def test_an_empty_load_commits_nothing_and_a_broken_one_is_overwritten(spark):
    reg = registry(spark)
    assert reg.register(spark.createDataFrame([], KEY)) == 0 and reg.commits() == [] and reg.read().count() == 0
    reg.register(spark.createDataFrame([(1, "a")], KEY))
    assert reg.register(spark.createDataFrame([(1, "a")], KEY)) == 0
    # keys of a load that ended before its commit
    spark.createDataFrame([(99, 9, "lost", 2)], reg.schema).write.parquet(f"{reg.path}/keys/load=2")
    assert reg.read().count() == 1
    reg.register(spark.createDataFrame([(2, "b")], KEY))
    assert sorted((r.k, r.a) for r in reg.read().collect()) == [(1, 1), (2, 2)]


def test_keyed_rows(spark):
    reg = registry(spark)
    reg.register(spark.createDataFrame([(1, None), (2, "b")], KEY))
    got = reg.keyed(spark.createDataFrame([(1, None, "r1"), (3, "c", "r2"), (2, "b", "r3"), (2, "b", "r3")], "a long, b string, extra string"))
    assert sorted((r.extra, r.k) for r in got.collect()) == [("r1", 1), ("r2", None), ("r3", 2), ("r3", 2)] or \
        {(r.extra, r.k) for r in got.collect()} == {("r1", 1), ("r2", None), ("r3", 2)}


def test_first_loads_keys_stay_to_the_end(spark):
    reg = loads.stable_series_keys(spark, SF)
    commits = reg.commits()
    assert commits[-1].high_water == reg.read().count() == reg.read().select("SeriesKey").distinct().count()
    by_load = {r.FirstLoad: (r.lo, r.hi) for r in reg.read().groupBy("FirstLoad").agg(F.min("SeriesKey").alias("lo"), F.max("SeriesKey").alias("hi")).collect()}
    for before, after in zip(commits, commits[1:]):
        assert by_load[after.load] == (before.high_water + 1, after.high_water)


# --- append --------------------------------------------------------------

def test_append_keeps_history_and_first_rows(spark):
    t = table(spark, [(1, 1, 1.0), (2, 2, 2.0)])
    append_new(t, batch(spark, [(1, 1, 9.0), (3, 1, 5.0), (3, 1, 4.0), (2, 3, 7.0), (None, 1, 8.0)]), ["id"], ["v"])
    want = sorted([(1, 1, 1.0), (2, 2, 2.0), (3, 1, 4.0), (2, 3, 7.0), (None, 1, 8.0)], key=str)
    assert rows_of(t.read()) == want
    append_new(t, batch(spark, [(1, 1, 9.0), (3, 1, 5.0), (None, 1, 8.0)]), ["id"], ["v"])      # comes twice
    append_new(t, batch(spark, []), ["id"], ["v"])
    assert rows_of(t.read()) == want


def test_append_reads_touched_folders_only(spark):
    t = table(spark, [(k, k % 10, 1.0) for k in range(100)])
    read = t.read([3, 7, 55])
    assert {os.path.basename(os.path.dirname(f)) for f in read.inputFiles()} == {"day=3", "day=7"}
    before = all_files(t)
    append_new(t, batch(spark, [(3, 3, 1.0), (1000, 3, 1.0)]), ["id"], ["v"])
    new = all_files(t) - before
    assert before <= all_files(t) and {os.path.basename(os.path.dirname(f)) for f in new} == {"day=3"}


def test_changed_partitions(spark):
    source = batch(spark, [(1, 1, 1.0), (2, 2, None), (3, 3, 3.0), (4, None, 4.0)])
    values, ledger = changed_partitions(source, "day", None)
    assert values == [None, 1, 2, 3]
    moved = batch(spark, [(4, None, 4.0), (3, 3, 3.0), (2, 2, 0.0), (1, 1, 1.0), (1, 1, 1.0), (9, 4, 1.0)])
    assert changed_partitions(moved, "day", ledger)[0] == [1, 2, 4]       # changed, repeated row, new; the order of rows is no change
    assert changed_partitions(source, "day", ledger)[0] == []


def test_load_changed_takes_late_rows_once(spark):
    t = table(spark)
    first = batch(spark, [(1, 1, 1.0), (2, 2, 2.0)])
    values, ledger = load_changed(t, first, ["id"], ["v"])
    assert values == [1, 2]
    values, ledger = load_changed(t, first.unionByName(batch(spark, [(1, 1, 0.0), (5, 2, 5.0)])), ["id"], ["v"], ledger)
    assert values == [1, 2] and rows_of(t.read()) == [(1, 1, 1.0), (2, 2, 2.0), (5, 2, 5.0)]
    assert load_changed(t, first.unionByName(batch(spark, [(1, 1, 0.0), (5, 2, 5.0)])), ["id"], ["v"], ledger)[0] == []


def test_deliveries_touch_fewer_months_and_equal_one_load(spark):
    whole, months = loads.load_deliveries(spark, SF)
    assert len(months) == 5 and set(months[0]) & set(months[1]) and not set(months[0]) & set(months[2])
    rows = loads.delivered_snapshots(spark, SF)
    from larder.operators.dedup import keep_first
    once = keep_first(rows, ["ProductID", "WarehouseLocation", "SnapshotDate", "DateKey"], ["Delivery", "_row"]).drop("_row")
    assert whole.read().exceptAll(once.select(whole.schema.names)).count() == 0 and whole.read().count() == once.count()


# --- MERGE and DELETE ----------------------------------------------------

def test_merge_updates_inserts_and_deletes(spark):
    t = table(spark, [(1, 1, 1.0), (2, 1, 2.0), (3, 2, 3.0), (None, 1, 7.0)])
    done = merge(t, batch(spark, [(1, 1, 10.0), (2, 1, -1.0), (4, 3, 4.0), (5, 3, -1.0), (None, 1, 8.0)]), ["id"], ["v"], delete_when=F.col("v") < 0)
    assert done == {"updated": 2, "inserted": 1, "deleted": 1}
    assert rows_of(t.read()) == sorted([(1, 1, 10.0), (3, 2, 3.0), (4, 3, 4.0), (None, 1, 8.0)], key=str)


def test_merge_rewrites_touched_folders_only_and_drops_empty_ones(spark):
    t = table(spark, [(k, k % 4, 1.0) for k in range(40)])
    before = all_files(t)
    merge(t, batch(spark, [(1, 1, 5.0)]), ["id"], ["v"])
    assert {os.path.basename(os.path.dirname(f)) for f in before ^ all_files(t)} == {"day=1"}
    done = merge(t, batch(spark, [(k, 2, 0.0) for k in range(2, 40, 4)]), ["id"], ["v"], delete_when=F.lit(True))
    assert done["deleted"] == 10 and not os.path.exists(local_path(t.folder(2))) and t.read().count() == 30


def test_merge_of_some_columns_keeps_the_others(spark):
    t = table(spark, [(1, 1, 1.0)])
    merge(t, batch(spark, [(1, 1, None), (2, 1, 2.0)]).select("id", "day", "v"), ["id"], [])
    assert rows_of(t.read()) == [(1, 1, 1.0), (2, 1, 2.0)]


@pytest.mark.parametrize("rows", [[(1, 1, 5.0), (1, 1, 6.0)], [(1, None, 5.0)], [(1, 1, -5.0)]])
def test_a_refused_batch_leaves_the_table_as_it_was(spark, rows):
    t = table(spark, [(1, 1, 1.0), (2, 2, 2.0)])
    before = all_files(t)
    with pytest.raises(BatchRefused):
        merge(t, batch(spark, [*rows, (2, 2, 9.0)]), ["id"], ["v"], checks={"negative": lambda df: df["v"] < 0})
    assert all_files(t) == before and rows_of(t.read()) == [(1, 1, 1.0), (2, 2, 2.0)]


def test_a_failing_write_leaves_the_table_as_it_was(spark):
    t = table(spark, [(1, 1, 1.0), (2, 2, 2.0)])
    before = all_files(t)
    bad = t.read([1, 2]).withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        t.replace(bad, [1, 2])
    assert all_files(t) == before and rows_of(t.read()) == [(1, 1, 1.0), (2, 2, 2.0)]


def test_delete(spark):
    t = table(spark, [(k, k % 4, float(k) if k % 5 else None) for k in range(40)])
    before = all_files(t)
    assert delete(t, F.col("v") == 6.0) == [2]
    assert {os.path.basename(os.path.dirname(f)) for f in before ^ all_files(t)} == {"day=2"}
    assert t.read().count() == 39 and t.read().where("v IS NULL").count() == 8
    assert delete(t, F.col("day") == 3) == [3] and not os.path.exists(local_path(t.folder(3)))
    assert delete(t, F.col("v") > 1000) == []


def test_empty_table(spark):
    t = table(spark)
    assert t.read().count() == 0 and t.read([1]).count() == 0 and delete(t, F.lit(True)) == []
    assert merge(t, batch(spark, []), ["id"], ["v"]) == {"updated": 0, "inserted": 0, "deleted": 0}
    assert merge(t, batch(spark, [(1, 1, 1.0)]), ["id"], ["v"])["inserted"] == 1
    assert FolderTable(spark, t.path, ROWS, "day").read().count() == 1


def test_partition_column_must_name_folders_plainly(spark):
    with pytest.raises(TypeError):
        FolderTable(spark, "x", T.StructType([T.StructField("p", T.StringType())]), "p")
    dated = FolderTable(spark, shared_scratch(spark, "dated"), T.StructType([T.StructField("p", T.DateType()), T.StructField("v", T.LongType())]), "p")
    dated.append(spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "p date, v long"))
    assert [r.v for r in dated.read([dt.date(2024, 1, 2)]).collect()] == [2]


# --- imputation by written means ------------------------------------------

@pytest.mark.parametrize("most", [0, 1 << 20])
def test_impute_with_and_without_broadcast(spark, inv, most):
    d = dt.date(2022, 1, 1)
    df = inv([(1, 1, "a", "W", 2.0, 4.0, d), (2, 1, "a", "W", None, 5.0, d), (3, None, "a", "W", None, 1.0, d), (4, 2, "b", "W", None, 1.0, d)])
    got = {r.SnapshotInvID: r.unitsAvailable for r in impute_group_mean(df, "ProductID", IMPUTE_COLUMNS, max_broadcast=most).collect()}
    assert got == {1: 2.0, 2: 2.0, 3: None, 4: None}


def test_mean_of_nan_is_the_mean_of_the_rest(spark):
    from larder.functions.expressions import exact_mean
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    assert df.agg(exact_mean("x")).first()[0] == 1.5


def test_a_load_knows_its_partitions(spark, monkeypatch):
    """``load_changed`` has the changed partitions already: no pass over the batch looks for them again."""
    t = table(spark)
    monkeypatch.setattr(FolderTable, "values_in", lambda *_: pytest.fail("a second pass"))
    load_changed(t, batch(spark, [(1, 1, 1.0), (2, 2, 2.0)]), ["id"], ["v"])
    assert t.read().count() == 2


def test_deliveries_are_shaped_once(spark, monkeypatch):
    """All loads read the shaped rows, none joins the lines again."""
    files, real = [], loads.load_changed
    monkeypatch.setattr(loads, "load_changed", lambda t, source, *rest: (files.extend(source.inputFiles()), real(t, source, *rest))[1])
    loads.load_deliveries(spark, SF)
    assert files and not any("lineitem" in f for f in files)


def test_fingerprint_sum_is_exact(spark):
    df = batch(spark, [(i, i % 3, float(i)) for i in range(1000)])
    hashes = df.select(df.columns[1], F.xxhash64(*df.columns).alias("h")).collect()
    part = df.columns[1]
    for r in fingerprints(df, part).collect():
        own = [h["h"] for h in hashes if h[part] == r[part]]
        assert (r["n"], int(r["sum"])) == (len(own), sum(own))
