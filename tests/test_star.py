"""Star schema: dimensions, fact, orphans, key checks, spines."""

import datetime as dt

from larder.operators import quality
from larder.operators.spine import month_spine, snapshot_gaps
from larder.plans import star

D1, D2 = dt.date(2022, 1, 1), dt.date(2025, 1, 1)


def test_dim_date_default_bounds(spark):
    dd = star.dim_date(spark, "2022-01-01", "2024-12-31")
    assert dd.count() == 1096
    r = dd.where("FullDate = DATE'2022-02-07'").collect()[0]
    assert (r["DateKey"], r["MonthName"], r["DayOfWeekName"]) == (20220207, "February", "Monday")


def test_fact_orphans_and_fan_out(spark, inv):
    clean = inv([(1, 1, "a", "W", 1.0, 2.0, D1), (2, 2, "b", "W", 1.0, 2.0, D2),
                 (3, 3, "c", "V", 1.0, 2.0, D1)]).select(
        "SnapshotInvID", "ProductID", "ProductName", "WarehouseLocation", "SnapshotDate",
        "unitsDemanded", "unitsAvailable")
    products = spark.createDataFrame(
        [(1, "a", "C", "S", 10.0, 8.0), (1, "a", "C", "S", 11.0, 8.0), (2, "b", "C", "S", 5.0, 4.0),
         (3, "c", "C", "S", 5.0, 4.0)],
        "ProductID long, ProductName string, Category string, Supplier string, "
        "UnitPrice double, CostPrice double")
    dp = star.dim_product(products)
    assert sorted(r["ProductKey"] for r in dp.collect()) == [1, 2, 3, 4]
    dw = star.dim_warehouse(clean)
    dd = star.dim_date(spark, "2022-01-01", "2024-12-31")
    fact = star.fact_inventory(clean, dd, dp, dw, 1096)
    assert fact.count() == 3          # product 1 fans out to two rows; row 2 is an orphan
    orphans = star.fact_orphans(clean, dd, dp, dw).collect()
    assert [(r["SnapshotInvID"], r["MissingDate"]) for r in orphans] == [(2, True)]
    viol = {r["Check"]: r["ViolationCount"] for r in quality.key_violations(
        fact, ["DateKey", "ProductKey", "WarehouseKey"]).collect()}
    assert viol == {"null key": 0, "duplicate key": 0}


def test_fact_orphans_give_every_reason(spark, inv):
    rows = [(1, 1, "a", "W", 1.0, 2.0, D1), (2, 2, "b", "W", 1.0, 2.0, D1), (3, 1, "a", "V", 1.0, 2.0, D1), (4, 1, "a", "W", 1.0, 2.0, D2),
            (5, None, "a", None, 1.0, 2.0, None), (6, 2, "b", "V", 1.0, 2.0, D2)]
    products = spark.createDataFrame([(1,)], "ProductID long")
    warehouses = spark.createDataFrame([("W",)], "WarehouseLocation string")
    got = star.fact_orphans(inv(rows), star.dim_date(spark, "2022-01-01", "2024-12-31"), products, warehouses).collect()
    reasons = {r["SnapshotInvID"]: (r["MissingDate"], r["MissingProduct"], r["MissingWarehouse"]) for r in got}
    assert reasons == {2: (False, True, False), 3: (False, False, True), 4: (True, False, False),
                       5: (True, True, True), 6: (True, True, True)}


def test_month_spine_and_gaps(spark, inv):
    df = inv([(1, 1, "a", "W", 1.0, 1.0, dt.date(2022, 1, 1)),
              (2, 1, "a", "W", 1.0, 1.0, dt.date(2022, 4, 1)),
              (3, 2, "b", "W", 1.0, 1.0, dt.date(2024, 9, 1))])
    assert month_spine(df, "SnapshotDate").count() == 33
    gaps = sorted((r["ProductID"], r["MissingMonth"]) for r in
                  snapshot_gaps(df, ["ProductID", "WarehouseLocation"], "SnapshotDate").collect())
    assert gaps == [(1, dt.date(2022, 2, 1)), (1, dt.date(2022, 3, 1))]


def test_gaps_group_null_series_keys(spark, inv):
    df = inv([(1, None, "a", None, 1.0, 1.0, dt.date(2022, 1, 1)),
              (2, None, "a", None, 1.0, 1.0, dt.date(2022, 3, 1))])
    gaps = snapshot_gaps(df, ["ProductID", "WarehouseLocation"], "SnapshotDate").collect()
    assert [(g["ProductID"], g["MissingMonth"]) for g in gaps] == [(None, dt.date(2022, 2, 1))]
