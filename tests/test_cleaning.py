"""Edge rows of the cleaning operators (imputation, dedup, caps, rules)."""

import datetime as dt

from pyspark.sql import functions as F

from larder.operators import quality
from larder.operators.dedup import duplicate_report, keep_first, later_duplicates
from larder.operators.impute import complete_case_means, impute_group_mean
from larder.operators.outliers import apply_caps, cap_outliers
from larder.operators.rules import enforce_rules
from larder.plans.inventory import IMPUTE_COLUMNS, inventory_checks

D = dt.date(2022, 1, 1)
KEY = ["ProductID", "WarehouseLocation", "SnapshotDate"]


def by_id(df):
    return {r["SnapshotInvID"]: r.asDict() for r in df.collect()}


def test_complete_case_mean_and_unmatched_groups(inv):
    df = inv([
        (1, 1, "a", "W", None, 10.0, D),     # availability NULL → 4 (complete row only)
        (2, 1, "a", "W", 4.0, 20.0, D),
        (3, 2, "b", "W", 5.0, None, D),      # group 2 has no complete row: stays NULL
        (4, None, "c", "W", None, None, D),  # NULL key: never matched
    ])
    means = {r["ProductID"]: r for r in complete_case_means(df, "ProductID", IMPUTE_COLUMNS).collect()}
    assert means[1]["avg_demand"] == 20.0 and means[1]["avg_availability"] == 4.0
    out = by_id(impute_group_mean(df, "ProductID", IMPUTE_COLUMNS))
    assert out[1]["unitsAvailable"] == 4.0 and out[1]["unitsDemanded"] == 10.0
    assert out[3]["unitsDemanded"] is None
    assert out[4]["unitsDemanded"] is None and out[4]["unitsAvailable"] is None
    assert len(out) == 4


def test_keep_first_groups_null_keys(inv):
    df = inv([
        (5, 1, "a", None, 1.0, 1.0, D),
        (3, 1, "a", None, 2.0, 2.0, D),
        (9, 1, "a", "W", 3.0, 3.0, D),
        (None, 2, "b", "W", 1.0, 1.0, D),   # NULL id sorts first
        (7, 2, "b", "W", 1.0, 1.0, D),
    ])
    kept = by_id(keep_first(df, KEY, ["SnapshotInvID"]))
    assert set(kept) == {3, 9, None}
    dups = duplicate_report(df, KEY, ["SnapshotInvID"], "SnapshotInvID").collect()
    assert sorted(r["SnapshotInvID"] for r in dups) == [5, 7]
    assert {r["Status"] for r in dups} == {"This is a duplicate row"}


def test_dedup_hot_key_complement(inv, spark):
    # One key holds most rows: kept + later duplicates = all rows, exactly once.
    rows = [(i, 1, "a", "W", float(i), 1.0, D) for i in range(1, 3001)]
    rows += [(10000 + i, i, "b", "W", 1.0, 1.0, D) for i in range(2, 200)]
    df = inv(rows)
    kept = keep_first(df, KEY, ["SnapshotInvID"])
    later = later_duplicates(df, KEY, ["SnapshotInvID"])
    assert kept.count() == 199 and later.count() == 2999
    assert kept.unionByName(later).exceptAll(df).count() == 0
    assert quality.duplicate_keys(kept, KEY).count() == 0


def test_caps_boundary_and_null(inv):
    df = inv([(i, 1, "a", "W", float(i), float(i), D) for i in range(1, 101)]
             + [(101, 1, "a", "W", None, None, D)])
    capped, caps = cap_outliers(df, ["unitsDemanded", "unitsAvailable"], 0.99, scale=2)
    assert caps["unitsDemanded"] == 99.01     # (100-1)*0.99 = 98.01 → 99 + 0.01
    out = by_id(capped)
    assert out[101]["unitsDemanded"] is None
    assert out[100]["unitsDemanded"] == 99.01 and out[99]["unitsDemanded"] == 99.0
    # a value equal to the cap is unchanged (strict >)
    eq = by_id(apply_caps(df, {"unitsDemanded": 50.0}))
    assert eq[50]["unitsDemanded"] == 50.0 and eq[51]["unitsDemanded"] == 50.0


def test_rule_order_and_null_demand(inv):
    df = inv([(1, 1, "a", "W", -5.0, -10.0, D), (2, 1, "a", "W", 7.0, None, D),
              (3, 1, "a", "W", 9.0, 4.0, D), (4, 1, "a", "W", 2.0, 4.0, D)])
    out = by_id(enforce_rules(df))
    assert out[1]["unitsAvailable"] == 0.0
    assert out[2]["unitsAvailable"] == 7.0
    assert out[3]["unitsAvailable"] == 4.0 and out[4]["unitsAvailable"] == 2.0
    post = {r["IssueType"]: r["IssueCount"] for r in quality.rule_violations(enforce_rules(df)).collect()}
    assert post == {"Availability > Demand": 1, "Negative Availability": 0}


def test_blank_is_spaces_only_and_empty_input(inv):
    df = inv([(1, 1, "\t", "  ", 1.0, 1.0, D), (0, 0, None, "W", None, None, None)])
    r = quality.bad_counts(df, inventory_checks()).collect()[0].asDict()
    assert r["Bad_ProductName"] == 1          # NULL only; tab is not blank
    assert r["Bad_WarehouseLocation"] == 1    # spaces are blank
    assert r["Bad_SnapshotInvID"] == 1 and r["Bad_ProductID"] == 1
    empty = quality.bad_counts(df.limit(0), inventory_checks()).collect()[0].asDict()
    assert all(v is None for v in empty.values())
    nulls = quality.null_counts(df.limit(0), ["unitsDemanded"]).collect()[0]
    assert nulls["NullCount"] == 0


def test_metric_profile_one_scan(inv):
    df = inv([(1, 1, "a", "W", 1.0, 3.0, D), (2, 1, "a", "W", 5.0, 7.0, D)])
    rows = {r["Metric"]: r for r in quality.metric_profile(df, {"d": "unitsDemanded"}).collect()}
    assert (rows["d"]["MinValue"], rows["d"]["MaxValue"], rows["d"]["AvgValue"]) == (3.0, 7.0, 5.0)


def test_identical_rows_reported_once(inv):
    # Two rows identical in every column (ids included): one survives, the
    # other is listed once — multiset semantics, as ROW_NUMBER > 1 gives.
    r = (7, 1, "a", "W", 1.0, 1.0, D)
    df = inv([r, r, (8, 1, "a", "W", 2.0, 2.0, D)])
    assert keep_first(df, KEY, ["SnapshotInvID"]).count() == 1
    later = later_duplicates(df, KEY, ["SnapshotInvID"]).collect()
    assert sorted(x["SnapshotInvID"] for x in later) == [7, 8]


def test_later_duplicates_tasks_follow_the_rows(spark, monkeypatch):
    """Tasks of the difference hold a bounded number of rows; exact copies and NULLs count one by one."""
    from larder.operators import dedup
    monkeypatch.setattr(dedup, "TASK_ROWS", 20)
    rows = [(i, i % 50 or None, "a") for i in range(200)] + [(7, 7, "a")] * 3 + [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "id long, k long, s string")
    later = later_duplicates(df, ["k", "s"], ["id"])
    assert later.rdd.getNumPartitions() >= 2 * len(rows) // 20
    seen, want = set(), []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        want += [r] if r[1:] in seen else []
        seen.add(r[1:])
    assert sorted(map(str, map(tuple, later.collect()))) == sorted(map(str, want))
