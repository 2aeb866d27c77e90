"""Sources and sinks, legacy layout, end-to-end pipeline writes and reruns."""

import datetime as dt
import os
import uuid

import pytest

from larder.config import config_for
from larder.plans import inventory as pl
from larder.schemas import PRODUCTS, from_v1
from larder.session import ensure_checkpoint_dir, local_path, shared_scratch
from larder.sources.catalog import schema_profile
from larder.sources.files import SourceMissing, read_csv

D = dt.date(2022, 1, 1)


def test_csv_quoted_commas_crlf(spark):
    folder = local_path(shared_scratch(spark, "csv-test"))
    os.makedirs(folder)
    path = os.path.join(folder, "products.csv")
    with open(path, "w", newline="") as f:
        f.write("ProductID,ProductName,Category,Supplier,CostPrice,UnitPrice,WarehouseLocation\r\n")
        f.write('1,"Smith, Jones and Co Lamp",Decor,"King, Weber",10.5,20.25,"Pune, Maharashtra"\r\n')
        f.write("2,Tablet,Electronics,Acme,1,2,\"Ranchi, Jharkhand\"\r\n")
    rows = read_csv(spark, path, schema=PRODUCTS).orderBy("ProductID").collect()
    assert rows[0]["ProductName"] == "Smith, Jones and Co Lamp"
    assert rows[0]["WarehouseLocation"] == "Pune, Maharashtra"
    assert rows[1]["WarehouseLocation"] == "Ranchi, Jharkhand"   # no stray CR
    assert rows[1]["UnitPrice"] == 2.0


def test_missing_source_raises_clear_error(spark):
    with pytest.raises(SourceMissing):
        read_csv(spark, f"/nonexistent/{uuid.uuid4().hex}.csv", schema=PRODUCTS)


def test_v1_rename(spark):
    v1 = spark.createDataFrame([(1, 2, "a", "W", 3.0, 4.0, D)],
                               "InvID long, ProductID long, ProductName string, "
                               "WarehouseLocation string, Availability double, Demand double, "
                               "OrderDate date")
    assert from_v1(v1).columns == ["SnapshotInvID", "ProductID", "ProductName",
                                   "WarehouseLocation", "unitsAvailable", "unitsDemanded",
                                   "SnapshotDate"]


def test_schema_profile_counts_nulls(inv):
    df = inv([(1, None, "a", "W", None, 1.0, D), (2, 3, "b", "W", 2.0, None, D)])
    rows = {r["COLUMN_NAME"]: r for r in schema_profile(df, "t").collect()}
    assert rows["ProductID"]["NULL_COUNT"] == 1 and rows["unitsAvailable"]["NULL_COUNT"] == 1
    assert rows["SnapshotDate"]["ORDINAL_POSITION"] == 7 and rows["SnapshotDate"]["DATA_TYPE"] == "date"


def _fixture(spark, inv):
    raw = inv([
        (1, 1, "a", "W1", None, 100.0, dt.date(2022, 1, 1)),
        (2, 1, "a", "W1", 40.0, 50.0, dt.date(2022, 1, 1)),     # duplicate key of id 1
        (3, 1, "a", "W2", 80.0, 60.0, dt.date(2022, 2, 1)),     # available > demand
        (4, 2, "b", "W2", -3.0, None, dt.date(2023, 3, 1)),     # negative, NULL demand
        (5, 2, "b", "W1", 9000.0, 9.0, dt.date(2024, 9, 1)),    # outlier
    ])
    products = spark.createDataFrame(
        [(1, "a", "C1", "S1", 8.0, 10.0, "W1"), (2, "b", "C2", "S2", 4.0, 5.0, "W2")],
        "ProductID long, ProductName string, Category string, Supplier string, "
        "CostPrice double, UnitPrice double, WarehouseLocation string")
    return raw, products


def test_pipeline_end_to_end_and_idempotent_writes(spark, inv):
    raw, products = _fixture(spark, inv)
    cfg = config_for("test").with_(percentile=0.75)
    res = pl.run_pipeline(raw, products, cfg)
    assert res.frames["dedup"].count() == 4
    assert {r["IssueCount"] for r in res.reports["rules_post"].collect()} == {0}
    assert res.frames["fact"].count() == 4
    assert res.reports["fact_orphans"].count() == 0
    audit = {r["Step"]: r["RowsOut"] for r in pl.audit(res).collect()}
    assert audit["raw"] == 5 and audit["dedup"] == 4 and audit["dim_date"] == 1096
    base = shared_scratch(spark, "pipeline-out")
    first = pl.write_outputs(res, base)
    again = pl.write_outputs(pl.run_pipeline(raw, products, cfg), base)
    assert first == again
    fact = spark.read.parquet(first["fact"]).select(*res.frames["fact"].columns)
    assert fact.count() == 4
    assert fact.exceptAll(res.frames["fact"]).count() == 0
    folders = sorted(f for f in os.listdir(local_path(first["fact"])) if f.startswith("DateKey="))
    assert folders == ["DateKey=20220101", "DateKey=20220201", "DateKey=20230301",
                       "DateKey=20240901"]
    assert spark.read.parquet(first["fact"]).where("DateKey = 20220101").count() == 1
    res.release()


def test_checkpoint_dir_is_read_from_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_dialect_options_unrounded_caps_and_no_cost_price(spark, inv):
    raw, products = _fixture(spark, inv)
    cfg = config_for("production").with_(percentile=0.75, cap_scale=None,
                                          include_cost_price=False)
    res = pl.run_pipeline(raw, products, cfg)
    assert "CostPrice" not in res.frames["dim_product"].columns
    # unrounded: the exact interpolated value, not a 2-decimal cap
    demand_cap = res.caps["unitsDemanded"]
    vals = sorted(r["unitsDemanded"] for r in res.frames["dedup"].collect()
                  if r["unitsDemanded"] is not None)
    pos = 0.75 * (len(vals) - 1)
    lo = int(pos)
    want = vals[lo] + (pos - lo) * (vals[min(lo + 1, len(vals) - 1)] - vals[lo])
    assert abs(demand_cap - want) < 1e-9
    msgs = [r["Status"] for r in res.reports["threshold_messages"].collect()]
    assert any(m.startswith("Capping Demand at: ") for m in msgs)
    res.release()


def test_csv_bad_value_becomes_null(spark):
    folder = local_path(shared_scratch(spark, "csv-bad"))
    os.makedirs(folder)
    path = os.path.join(folder, "p.csv")
    with open(path, "w") as f:
        f.write("ProductID,ProductName,Category,Supplier,CostPrice,UnitPrice,WarehouseLocation\n")
        f.write("1,a,C,S,abc,2.5,W\n")
    r = read_csv(spark, path, schema=PRODUCTS).collect()[0]
    assert r["CostPrice"] is None and r["UnitPrice"] == 2.5


def test_case_insensitive_locations_opt_in(spark, inv):
    raw = inv([(1, 1, "a", "Pune", 5.0, 9.0, D), (2, 1, "a", "PUNE", 6.0, 9.0, D),
               (3, 2, "b", "Delhi", 1.0, 2.0, D)])
    products = spark.createDataFrame(
        [(1, "a", "C1", "S1", 8.0, 10.0, "Pune"), (2, "b", "C2", "S2", 4.0, 5.0, "Delhi")],
        "ProductID long, ProductName string, Category string, Supplier string, "
        "CostPrice double, UnitPrice double, WarehouseLocation string")
    binary = pl.run_pipeline(raw, products, config_for("test"))
    assert binary.frames["dedup"].count() == 3 and binary.frames["dim_warehouse"].count() == 3
    ci = pl.run_pipeline(raw, products, config_for("test").with_(text_collation="UTF8_LCASE"))
    assert ci.frames["dedup"].count() == 2 and ci.frames["dim_warehouse"].count() == 2
    assert ci.frames["fact"].count() == 2
    binary.release()
    ci.release()


def test_environments_differ_only_in_names():
    test, prod = config_for("test"), config_for("production")
    assert (test.database, prod.database) == ("test_inv", "prod_inv")
    assert test.with_(env="x", database=None) == prod.with_(env="x", database=None)
    with pytest.raises(ValueError):
        config_for("staging")
