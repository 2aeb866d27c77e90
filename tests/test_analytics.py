"""Series, as-of and interval joins, groupings, sketches and nested text against simple references."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.asof import asof_join
from larder.operators.intervals import interval_join
from larder.operators.keys import PART
from larder.operators.lattice import cube_sets, distinct_counts, grouping_sets, merged_sketches, rollup_sets, sketch_table
from larder.operators.nested import drift, typed_columns
from larder.operators.series import global_ranks, moving_frames, running_totals


@pytest.fixture(params=[1, 8, 40])
def ranges(spark, request):
    """The number of ranges that sorted rows are cut into."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def series_rows(spark, n=900):
    """One series holds most rows, others few; NULL series, NULL and repeated values."""
    rng = random.Random(n)
    rows = [("hot" if rng.random() < 0.7 else rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(20)]), k, rng.choice([None, 1.25, 2.5, -3.0]), k * 2) for k in range(n)]
    rows.append(("nulls", 1, n, None, 0))
    return spark.createDataFrame(rows, "s string, o int, tie long, v double, position_ long")


ORDER = ["o", "tie"]           # Spark sorts NULLs first


def test_running_totals(spark, ranges):
    df = series_rows(spark)
    got = running_totals(df, ["s"], ["o", "tie"], {"total": "v", "ties": "tie"})
    w = Window.partitionBy("s").orderBy(*ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(*df.columns, F.row_number().over(w).cast("long").alias("position"), F.sum("v").over(upto).alias("total"), F.sum("tie").over(upto).cast("double").alias("ties"))
    assert rows_of(got) == rows_of(want)
    assert running_totals(df.limit(0), ["s"], ["o"], {"t": "v"}).count() == 0


def test_a_hot_series_is_split_over_windows(spark):
    """No window holds the whole series: its rows lie in many ranges."""
    from larder.operators.keys import ordered_parts
    df = spark.range(20_000).selectExpr("'hot' AS s", "id AS o", "id % 7 AS v")
    sizes = [r["count"] for r in ordered_parts(df, ["s", "o"], "hot", 16).groupBy(PART, "s").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * 20_000 / 16
    plan = running_totals(df, ["s"], ["o"], {"t": "v"})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("__part" in line or "__cpart" in line or "__n0" in line for line in windows)


@pytest.mark.parametrize("rows,block", [(1, 4), (3, 8), (5, 1 << 14), (60, 1)])
def test_moving_frames(spark, rows, block):
    df = series_rows(spark, 400)
    got = moving_frames(df, ["s"], ["o", "tie"], rows, {"n": F.count("v"), "lo": F.min("v"), "all": F.sum("tie")}, block=block)
    w = Window.partitionBy("s").orderBy(*ORDER)
    frame = w.rowsBetween(-(rows - 1), 0)
    want = df.select(*df.columns, F.row_number().over(w).cast("long").alias("position"), F.count("v").over(frame).alias("n"), F.min("v").over(frame).alias("lo"),
                     F.sum("tie").over(frame).alias("all"))
    assert rows_of(got) == rows_of(want)


def test_moving_frames_refuse_an_empty_frame(spark):
    with pytest.raises(ValueError):
        moving_frames(series_rows(spark, 5), ["s"], ["o"], 0, {})


@pytest.mark.parametrize("order", [["o"], ["s", "v"], ["tie"]])
def test_global_ranks(spark, ranges, order):
    df = series_rows(spark)
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    exact = Window.orderBy(*[F.col(c).asc_nulls_first() for c in [*order, "tie"]])
    want = df.select(*df.columns, F.row_number().over(exact).cast("long").alias("row_number"), F.rank().over(w).cast("long").alias("rank"),
                     F.dense_rank().over(w).cast("long").alias("dense_rank"), F.percent_rank().over(w).alias("percent_rank"), F.ntile(7).over(exact).cast("long").alias("ntile"))
    assert rows_of(global_ranks(df, order, [] if order == ["tie"] else ["tie"], tiles=7)) == rows_of(want)


def test_ranks_of_one_value_over_many_ranges(spark, ranges):
    df = spark.range(500).selectExpr("5 AS v", "id AS tie").unionByName(spark.createDataFrame([(1, 0), (9, 0), (9, 1)], "v int, tie long"))
    got = {(r.v, r.rank, r.dense_rank) for r in global_ranks(df, ["v"], ["tie"]).collect()}
    assert got == {(1, 1, 1), (5, 2, 2), (9, 502, 3)}


def test_ranks_of_few_and_no_rows(spark):
    one = global_ranks(spark.createDataFrame([(3,)], "v int"), ["v"]).first()
    assert (one.row_number, one.rank, one.dense_rank, one.percent_rank, one.ntile) == (1, 1, 1, 0.0, 1)
    assert global_ranks(spark.createDataFrame([], "v int"), ["v"]).count() == 0


# --- as-of -----------------------------------------------------------------

def asof_brute(left, right, exact, reach=None):
    out = []
    for key, t, name in left:
        best = None
        for rkey, rt, tie, v in right:
            if None in (key, t, rkey, rt) or rkey != key or not (rt <= t if exact else rt < t):
                continue
            if best is None or (rt, tie) > best[:2]:
                best = (rt, tie, v)
        if best and reach is not None and t - best[0] > reach:
            best = None
        out.append((key, t, name, best[0] if best else None, best[2] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("exact", [True, False])
def test_asof_join(spark, ranges, exact):
    rng = random.Random(ranges)
    key = lambda: "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None, "only-left"])
    left = [(key(), rng.choice([None, *range(60)]), f"l{k}") for k in range(400)] + [("hot", 30, "same"), ("hot", 30, "same")]
    right = [(k if k != "only-left" else "only-right", rng.choice([None, *range(0, 60, 3)]), t, t * 10) for t, k in enumerate(key() for _ in range(150))]
    l_ = spark.createDataFrame(left, "k string, t int, name string")
    r_ = spark.createDataFrame(right, "k string, t int, tie int, v int")
    got = asof_join(l_, r_, ["k"], "t", "t", {"v": "v"}, ties=["tie"], exact=exact)
    assert got.columns == ["k", "t", "name", "matched_at", "v"]
    assert rows_of(got) == asof_brute(left, right, exact)
    near = asof_join(l_, r_, ["k"], "t", "t", {"v": "v"}, ties=["tie"], exact=exact, within=F.col("t") - F.col("matched_at") <= 2)
    assert rows_of(near) == asof_brute(left, right, exact, 2)


def test_asof_carry_passes_ranges_without_a_match(spark, ranges):
    """One early right row serves a whole hot key that spans all ranges."""
    left = spark.range(1, 3001).selectExpr("'hot' AS k", "id AS t")
    right = spark.createDataFrame([("hot", 0, 7)], "k string, t long, v int")
    got = asof_join(left, right, ["k"], "t", "t", {"v": "v"})
    assert got.where("v = 7 AND matched_at = 0").count() == 3000


def test_asof_empty_sides(spark):
    left = spark.createDataFrame([("a", 1)], "k string, t int")
    right = spark.createDataFrame([], "k string, t int, v int")
    assert rows_of(asof_join(left, right, ["k"], "t", "t", {"v": "v"})) == [("a", 1, None, None)]
    assert asof_join(left.limit(0), right, ["k"], "t", "t", {"v": "v"}).count() == 0


# --- intervals -------------------------------------------------------------

@pytest.mark.parametrize("width", [1, 10, 1000])
def test_interval_join(spark, width):
    rng = random.Random(width)

    def some(n):
        rows = []
        for k in range(n):
            lo = rng.randint(-200, 200)
            rows.append((rng.choice(["a", "a", "b", None]), k, rng.choice([None, lo]) if k % 17 == 0 else lo, lo + rng.choice([-3, 0, 0, 1, 5, 40, 399, 5000])))
        return rows
    a, b = some(150), some(120)
    schema = "g string, id int, lo int, hi int"
    got = interval_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["g"], ("lo", "hi"), ("lo", "hi"), width=width)
    want = [(*x, *y) for x in a for y in b if None not in (x[0], y[0], x[2], y[2]) and x[0] == y[0] and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]]
    assert rows_of(got) == sorted(want, key=str)                    # no pair is lost or found twice


def test_interval_join_of_a_table_with_itself(spark):
    df = spark.createDataFrame([(1, 0, 10), (2, 5, 6), (3, 11, 11), (3, 11, 11)], "id int, lo long, hi long")
    got = interval_join(df, df, [], ("lo", "hi"), ("lo", "hi"), keep=F.col("id_l") < F.col("id_r"))
    assert [(r.id_l, r.id_r) for r in got.collect()] == [(1, 2)]
    assert interval_join(df, df.limit(0), [], ("lo", "hi"), ("lo", "hi")).count() == 0


def test_long_intervals_have_two_copies(spark):
    from larder.operators.intervals import _laid, _sided
    df = spark.createDataFrame([(1, 0, 10 ** 9), (2, -7, 10 ** 12), (3, 5, 5)], "id int, lo long, hi long")
    copies = _laid(_sided(df, "_l", "lo", "hi", 1), "_l", 1, None).groupBy("id_l").count().collect()
    assert all(r["count"] <= 2 for r in copies) and len(copies) == 3


# --- groupings -------------------------------------------------------------

def grouped(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice(["p", "q"]), rng.choice([None, 1.5, 2.25, 7.0])) for _ in range(500)]
    return spark.createDataFrame(rows, "a string, b int, c string, v double")


@pytest.mark.parametrize("kind", ["cube", "rollup", "sets"])
def test_grouping_sets(spark, kind):
    df = grouped(spark)
    df.createOrReplaceTempView("lattice_rows")
    dims = ["a", "b", "c"]
    sets = {"cube": cube_sets(dims), "rollup": rollup_sets(dims), "sets": [("a",), ("c", "b"), ("a",), ()]}[kind]
    clause = {"cube": "CUBE (a, b, c)", "rollup": "ROLLUP (a, b, c)", "sets": "GROUPING SETS ((a), (b, c), ())"}[kind]
    want = spark.sql("SELECT a, b, c, CAST(grouping_id(a, b, c) AS INT), count(*), sum(v), count(v), min(v), max(v), sum(v) / count(v) "
                     f"FROM lattice_rows GROUP BY {clause}") if kind != "sets" else spark.sql(
        "SELECT a, b, c, CAST((CASE WHEN grouping(a) = 1 THEN 4 ELSE 0 END) + (CASE WHEN grouping(b) = 1 THEN 2 ELSE 0 END) + (CASE WHEN grouping(c) = 1 THEN 1 ELSE 0 END) AS INT), "
        f"count(*), sum(v), count(v), min(v), max(v), sum(v) / count(v) FROM lattice_rows GROUP BY {clause}")
    assert rows_of(grouping_sets(df, dims, sets, {"v": "v"})) == rows_of(want)


def test_coarser_sets_come_from_smaller_ones(spark):
    parents = {}
    grouping_sets(grouped(spark), ["a", "b", "c"], cube_sets(["a", "b", "c"]), {"v": "v"}, parents)
    assert all(set(s) < set(p) for s, p in parents.items())
    assert all(len(p) == len(s) + 1 for s, p in parents.items())    # never from the rows, nor from further up than need be


def test_grouping_sets_of_no_rows(spark):
    got = grouping_sets(grouped(spark).limit(0), ["a", "b"], rollup_sets(["a", "b"]), {"v": "v"}).collect()
    assert [(r.grouping_id, r.n_rows, r.v_sum, r.v_count, r.v_avg) for r in got] == [(3, 0, None, 0, None)]


def test_distinct_counts(spark):
    df = grouped(spark)
    got = {r.a: (r.nb, r.nv) for r in distinct_counts(df, ["a"], {"nb": "b", "nv": "v"}).collect()}
    want = {r.a: (r.nb, r.nv) for r in df.groupBy("a").agg(F.countDistinct("b").alias("nb"), F.countDistinct("v").alias("nv")).collect()}
    assert got == want and None in got
    assert distinct_counts(df.limit(0), ["a"], {"nb": "b"}).count() == 0
    plan = distinct_counts(df, ["a"], {"nb": "b", "nv": "v"})._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_sketches_merge_without_the_rows(spark):
    df = spark.range(60_000).selectExpr("id % 3 AS g", "id % 10 AS m", "id % 9000 AS k", "CAST(id AS DOUBLE) AS v")
    stored = sketch_table(df, ["g", "m"], "k", "v")
    assert stored.count() == 30
    for r in merged_sketches(stored, ["g"], [0.5, 0.9]).collect():
        assert abs(r.n_distinct - 3000) < 90 and abs(r.q_50 - 30_000) < 1200 and abs(r.q_90 - 54_000) < 1200
    whole = merged_sketches(stored, [], [0.25]).first()
    assert abs(whole.n_distinct - 9000) < 270 and abs(whole.q_25 - 15_000) < 1200


# --- nested text ------------------------------------------------------------

PROPS = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType()), T.StructField("must", T.BooleanType(), False)])


def props(spark):
    rows = [(1, '{"k": 5, "name": "x", "must": true}'), (2, '{"k": "7", "must": false, "new": 1}'), (3, '{"k": "seven", "must": true}'), (4, '{"k": 1}'),
            (5, "no json"), (6, None), (7, "  "), (8, "[1, 2]"), (9, '{"must": true, "k": null, "new": {"deep": 1}}'), (1, '{"k": 5, "name": "x", "must": true}')]
    return spark.createDataFrame(rows, "id int, props string")


def test_typed_columns_and_rejects(spark):
    rows, rejects = typed_columns(props(spark), "props", PROPS)
    assert sorted(((r.id, r.k, r.name, r.must) for r in rows.collect()), key=str) == sorted(
        [(1, 5, "x", True), (1, 5, "x", True), (2, 7, None, False), (6, None, None, None), (7, None, None, None), (9, None, None, True)], key=str)
    assert {(r.id, r.reject_reason) for r in rejects.collect()} == {(3, "misfit"), (4, "misfit"), (5, "no object"), (8, "no object")}


def test_drift_report(spark):
    got = {r.key: (r.declared, r.n_rows, r.n_misfits) for r in drift(props(spark), "props", PROPS).collect()}
    assert got == {"k": ("bigint", 6, 1), "name": ("string", 2, 0), "must": ("boolean", 5, 0), "new": (None, 2, 0)}
    assert {r.key: r.n_rows for r in drift(props(spark).limit(0), "props", PROPS).collect()} == {"k": 0, "name": 0, "must": 0}
