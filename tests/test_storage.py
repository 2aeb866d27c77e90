"""CSV fidelity, typed table loads, key enforcement and rounding."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder import schemas
from larder.functions.expressions import exact_mean, to_measure
from larder.operators.dedup import duplicate_report
from larder.operators.quality import KeyViolation, assert_key
from larder.plans import inventory as pl
from larder.sources.files import ensure_database, load_csv, read_csv, save_table, write_csv

TEXTS = ['12" Monitor, "LED"', "two\nlines", "crlf\r\nline", "  ", "", None, "a,b", '"', "\\\\", " x ", r"\N", r"\\N", r"\\\N", "N", r" \N", r"\n"]


def test_csv_reads_back_equal(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    back = read_csv(spark, write_csv(df.coalesce(1), str(tmp_path / "c")), "id long, t string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_csv_of_another_writer(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,t\n1,"12"" Monitor, LED"\n2,\n3,plain\n')
    rows = read_csv(spark, str(tmp_path / "x.csv"), "id int, t string", null_mark="").collect()
    assert [tuple(r) for r in rows] == [(1, '12" Monitor, LED'), (2, None), (3, "plain")]


@pytest.fixture
def database(spark):
    before = spark.catalog.currentDatabase()
    ensure_database(spark, "larder_test_db")
    ensure_database(spark, "larder_test_db")           # again: no error
    yield "larder_test_db"
    spark.catalog.setCurrentDatabase(before)
    spark.sql("DROP DATABASE larder_test_db CASCADE")


def test_csv_into_a_table_with_rejects(spark, tmp_path, database):
    (tmp_path / "p.csv").write_text("ProductID,ProductName,Category,Supplier,CostPrice,UnitPrice,WarehouseLocation\n"
                                    '1,"A, B",c,s,1.5,2.5,"X, Y"\nx,bad,c,s,1,2,w\n3,ok,c,s,,2,w\n')
    rejected = load_csv(spark, str(tmp_path / "p.csv"), schemas.PRODUCTS, "products_loaded", null_mark="").collect()
    assert [r["ProductName"] for r in rejected] == ["bad"]
    table = spark.table("products_loaded")
    assert [f.dataType for f in table.schema.fields] == [f.dataType for f in schemas.PRODUCTS.fields]
    assert sorted((r["ProductID"], r["CostPrice"]) for r in table.collect()) == [(1, 1.5), (3, None)]
    save_table(spark.range(2), "products_loaded")      # a rerun replaces the table
    assert spark.table("products_loaded").count() == 2


def _run(inv, spark, rows, products):
    prods = spark.createDataFrame(products, "ProductID long, ProductName string, Category string, Supplier string, CostPrice double, UnitPrice double, WarehouseLocation string")
    return pl.run_pipeline(inv(rows), prods, pl.config_for("test").with_(database=None), persist=False)


def test_outputs_take_the_declared_layout(spark, inv, tmp_path):
    import datetime as dt
    rows = [(1, 1, "p", "w", 1.0, 2.0, dt.date(2024, 1, 1)), (2, 2, "q", "w", None, 2.0, dt.date(2024, 2, 1))]
    res = _run(inv, spark, rows, [(1, "p", "c", "s", 1.0, 2.0, "w"), (2, "q", "c", "s", 1.0, 2.0, "w")])
    written = pl.write_outputs(res, str(tmp_path / "out"))
    for name, layout in schemas.OUTPUTS.items():
        got = spark.read.parquet(written[name]).schema
        assert {f.name: f.dataType for f in got.fields} == {f.name: f.dataType for f in layout.fields}


def test_duplicate_fact_key_is_refused(spark, inv, tmp_path):
    import datetime as dt
    rows = [(1, 1, "p", "w", 1.0, 2.0, dt.date(2024, 1, 1))]
    res = _run(inv, spark, rows, [(1, "p", "c", "s", 1.0, 2.0, "w")])
    res.frames["fact"] = res.frames["fact"].unionAll(res.frames["fact"])
    with pytest.raises(KeyViolation):
        pl.write_outputs(res, str(tmp_path / "out"))
    with pytest.raises(KeyViolation):
        assert_key(spark.createDataFrame([(None,), (1,)], "k int"), ["k"])


def test_ties_round_half_up(spark):
    df = spark.createDataFrame([(19.525,), (4.975,), (8.325,), (-8.325,), (2.5,)], "x double")
    got = [r[0] for r in df.select(to_measure("x")).collect()]
    assert got == [Decimal(t) for t in ("19.53", "4.98", "8.33", "-8.33", "2.50")]


def test_mean_does_not_depend_on_the_order(spark):
    vals = [0.1 * i for i in range(1000)]
    means = {spark.createDataFrame([(v,) for v in v_], "x double").repartition(k).agg(exact_mean("x")).first()[0]
             for k, v_ in ((1, vals), (7, vals[::-1]), (3, sorted(vals, key=str)))}
    assert len(means) == 1


def test_duplicate_report_reads_ids_and_keys_alone(spark, inv):
    df = inv([]).withColumn("unitsDemanded", F.col("unitsDemanded") + 1)
    plan = duplicate_report(df, schemas.BUSINESS_KEY, ["SnapshotInvID"], "SnapshotInvID")._jdf.queryExecution().optimizedPlan().toString()
    assert "unitsDemanded" not in plan.split("LogicalRDD")[0]


def test_checkpoints_stay_off_local_disks_of_a_cluster():
    from larder.session import _on_local_disk
    assert all(map(_on_local_disk, ("file:/a/b", "file:///a", "/a/b", "spark-warehouse")))
    assert not any(map(_on_local_disk, ("hdfs://n/a", "s3a://b/c", "viewfs://x/y")))
