"""Registered queries: one callable per operator, each ``(spark, sf_dir) -> DataFrame``
over the whole given tables. Computed columns carry the same aliases as the
DuckDB oracle in ``larder.plans.oracle``; doubles that come from averages
are rounded so both engines hash the same values."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.config import config_for
from larder.functions.expressions import any_of, days_between, rounded, shift_days
from larder.operators import quality
from larder.operators.dedup import duplicate_report, keep_first
from larder.operators.distinct import distinct_count, distinct_rows, distinct_values
from larder.operators.impute import complete_case_means
from larder.operators.joins import lookup
from larder.operators.keys import rekey, surrogate_key
from larder.operators.outliers import apply_caps
from larder.operators.perturb import append_duplicates, mask_nulls, scale_outliers
from larder.operators.rules import enforce_rules
from larder.operators.sampling import sample_n, sample_rows
from larder.operators.spine import month_spine, snapshot_gaps
from larder.plans import analytics, loads, marts, star
from larder.plans import inventory as pl
from larder.schemas import BUSINESS_KEY
from larder.session import shared_scratch
from larder.sources import testdata as td
from larder.sources.catalog import schema_profile
from larder.sources.files import read_csv, write_csv

CFG = config_for("test")
BY_ROW = CFG.with_(order_by=(td.ROW,))
DOUBLE_DIGITS = 6
SAMPLE_SIZE = 1000
SAMPLE_SEED = 42
EVENT_KEY = ["user_id", "event_type", "event_date"]


def _round(df: DataFrame, cols, digits: int = DOUBLE_DIGITS) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _to_double(df: DataFrame, cols) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


MEASURES = ["unitsAvailable", "unitsDemanded"]


# ---- stage builders --------------------------------------------------------

class Stages:
    """Builds each pipeline stage at most once per query, so the eager steps
    (split points of the snapshot ids, the cap thresholds, the date bounds)
    run once however many outputs share them.

    The de-duplicated stage is persisted (memory, spilling to disk; lost
    blocks are recomputed from lineage) because the cap passes, the cleaned
    table and the fact all read it — the table the original scripts
    materialise at this step. ``release`` gives the memory back.
    """

    _live = []

    @classmethod
    def release(cls):
        """Unpersist the frames of all queries so far."""
        while cls._live:
            cls._live.pop().unpersist()

    def __init__(self, spark: SparkSession, sf_dir: str, ids: bool = True):
        """``ids=False``: for outputs without SnapshotInvID. The snapshots are not numbered then;
        keep-first goes by the lineitem order that the numbers stand for."""
        self.spark, self.d, self.ids = spark, sf_dir, ids
        self._memo = {}
        self._shared = set()

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def _share(self, name):
        """Persist an already built stage once a second reader needs it."""
        df = getattr(self, name)
        if name not in self._shared:
            self._shared.add(name)
            df.persist(StorageLevel.MEMORY_AND_DISK)
            Stages._live.append(df)
        return df

    @property
    def raw(self):
        # The snapshot table with its ids: the stored input of the original
        # scripts. The numbered rows lie in the shared folder, so it is read, not cached.
        if not self.ids:
            return self._get("raw", lambda: td.raw_inventory(self.spark, self.d, ids=False, extra=[td.lineitem_row()]))
        return self._get("raw", lambda: td.raw_inventory(self.spark, self.d))

    @property
    def products(self):
        return self._get("products", lambda: td.products(self.spark, self.d))

    @property
    def imputed(self):
        # Imputation reads the snapshots three ways (means, rows with and
        # without NULLs).
        return self._get("imputed", lambda: pl.impute(self.raw))

    @property
    def dedup(self):
        if not self.ids:
            return self._get("dedup", lambda: pl.deduplicate(self.imputed, BY_ROW).drop(td.ROW))
        return self._get("dedup", lambda: pl.deduplicate(self.imputed, CFG))

    @property
    def caps(self):
        # The cap passes and every later stage read the de-duplicated table.
        return self._get("caps", lambda: pl.compute_caps(self._share("dedup"), CFG))

    @property
    def capped(self):
        return self._get("capped", lambda: apply_caps(self.dedup, self.caps))

    @property
    def clean(self):
        return self._get("clean", lambda: enforce_rules(self.capped))

    @property
    def bounds(self):
        # Cleaning keeps at least one row per key, so the raw date range is
        # the cleaned one; only the date column is read.
        return self._get("bounds", lambda: star.date_bounds(
            td.table(self.spark, self.d, "lineitem").select(
                F.trunc(F.col("l_shipdate").cast("date"), "month").alias("SnapshotDate")),
            "SnapshotDate"))

    def star(self, bounds=None):
        lo, hi = bounds or self.bounds
        dates = star.dim_date(self.spark, lo, hi)
        prods = star.dim_product(self.products)
        whs = self.dim_warehouse()
        return self.clean, dates, prods, whs, star.dim_date_rows(lo, hi)

    def dim_warehouse(self):
        # DISTINCT WarehouseLocation of the cleaned table. Keep-first leaves a row of
        # every (product, warehouse, date), and capping and the rules only rewrite the
        # unit columns, so the raw snapshots have exactly the same locations.
        return star.dim_warehouse(plain(self.spark, self.d))

    def fact(self):
        c, dates, prods, whs, rows = self.star()
        return star.fact_inventory(c, dates, prods, whs, rows), dates, prods, whs


def raw(spark, d):
    return Stages(spark, d).raw


def plain(spark, d):
    """The raw snapshots without their ids, for queries that never read them."""
    return td.raw_inventory(spark, d, ids=False)


def products(spark, d):
    return td.products(spark, d)


def imputed(spark, d):
    return Stages(spark, d).imputed


def dedup(spark, d, ids=True):
    return Stages(spark, d, ids).dedup


def capped_and_caps(spark, d, ids=True):
    st = Stages(spark, d, ids)
    return st.capped, st.caps


def clean(spark, d, ids=True):
    return Stages(spark, d, ids).clean


def star_parts(spark, d, bounds=None, ids=False):
    return Stages(spark, d, ids).star(bounds)


def events(spark, d):
    return td.table(spark, d, "events").withColumn("event_date", F.to_date("ts"))


# ---- queries ---------------------------------------------------------------

def q_dedup_events(spark, d):
    ev = events(spark, d)
    return keep_first(ev, EVENT_KEY, ["event_id"]).drop("event_date")


def q_dup_detect_events(spark, d):
    return duplicate_report(events(spark, d), EVENT_KEY, ["event_id"], "event_id")


def q_row_counts(spark, d):
    return quality.row_counts({"products_table": products(spark, d),
                               "inventory_with_issues": plain(spark, d)})


def q_sample_rows(spark, d):
    return sample_rows(raw(spark, d), 10, ["SnapshotInvID"])


def q_schema_profile(spark, d):
    return schema_profile(raw(spark, d), "inventory_with_issues")


def q_dq_bad_rows(spark, d):
    return raw(spark, d).where(any_of(list(pl.inventory_checks().values())))


def q_dq_bad_rows_products(spark, d):
    return quality.bad_rows(products(spark, d), pl.PRODUCT_NUMERIC, pl.PRODUCT_TEXT)


def q_dq_bad_counts(spark, d):
    return quality.bad_counts(raw(spark, d), pl.inventory_checks())


def q_perturb_nulls(spark, d):
    return mask_nulls(td.inventory_snapshots(spark, d), "unitsDemanded", "SnapshotInvID", 20, 3)


def q_perturb_outliers(spark, d):
    return scale_outliers(td.inventory_snapshots(spark, d), "unitsAvailable", "SnapshotInvID",
                          50.0, 50, 13)


def q_append_dups(spark, d):
    return append_duplicates(raw(spark, d), "SnapshotInvID", 50, 0, renumber=True)


def q_rekey(spark, d):
    return rekey(raw(spark, d), "SnapshotInvID", BUSINESS_KEY + ["SnapshotInvID"])


def q_group_avg_complete_case(spark, d):
    return _round(complete_case_means(plain(spark, d), "ProductID", pl.IMPUTE_COLUMNS),
                  ["avg_demand", "avg_availability"])


def q_impute_mean_by_group(spark, d):
    return _round(imputed(spark, d), MEASURES)


def q_null_recheck(spark, d):
    return quality.null_counts(pl.impute(plain(spark, d)), ["unitsDemanded", "unitsAvailable",
                                                   "SnapshotDate"])


def q_dup_detect(spark, d):
    return duplicate_report(raw(spark, d), BUSINESS_KEY, ["SnapshotInvID"], "SnapshotInvID")


def q_dedup_keep_first(spark, d):
    return _round(dedup(spark, d), MEASURES)


def q_dedup_check(spark, d):
    return quality.duplicate_keys(dedup(spark, d, ids=False), BUSINESS_KEY)


def q_duplicate_keys_raw(spark, d):
    return quality.duplicate_keys(plain(spark, d), BUSINESS_KEY)


def q_percentile_caps(spark, d):
    return _round(pl.caps_frame(dedup(spark, d, ids=False), CFG), ["percentile"], 4)


def q_threshold_messages(spark, d):
    return pl.threshold_messages(pl.caps_frame(dedup(spark, d, ids=False), CFG), CFG)


def q_cap_outliers(spark, d):
    return _round(capped_and_caps(spark, d)[0], MEASURES)


def q_metric_profile(spark, d):
    prof = quality.metric_profile(capped_and_caps(spark, d, ids=False)[0], pl.PROFILE_METRICS)
    return _round(prof, ["MinValue", "MaxValue", "AvgValue"], 4)


def q_rule_violations(spark, d):
    return quality.rule_violations(capped_and_caps(spark, d, ids=False)[0])


def q_rule_enforce(spark, d):
    return _round(clean(spark, d), MEASURES)


def q_rule_violations_post(spark, d):
    return quality.rule_violations(clean(spark, d, ids=False))


def q_union_checks(spark, d):
    c = clean(spark, d, ids=False)
    nulls = quality.null_counts(c, ["unitsDemanded", "unitsAvailable", "SnapshotDate"]).select(
        F.lit("nulls").alias("Report"), F.col("ColumnName").alias("Item"),
        F.col("NullCount").alias("IssueCount"))
    rules = quality.rule_violations(c).select(
        F.lit("rules").alias("Report"), F.col("IssueType").alias("Item"), "IssueCount")
    dups = quality.duplicate_keys(c, BUSINESS_KEY).agg(F.count(F.lit(1)).alias("IssueCount")) \
        .select(F.lit("duplicates").alias("Report"), F.lit("business key").alias("Item"),
                "IssueCount")
    return nulls.unionByName(rules).unionByName(dups)


def q_dim_product(spark, d):
    return _to_double(star.dim_product(products(spark, d)),
                      ["UnitPrice", "CostPrice"])


def q_dim_warehouse(spark, d):
    return Stages(spark, d).dim_warehouse()


def q_dim_date(spark, d):
    lo, hi = Stages(spark, d).bounds
    return star.dim_date(spark, lo, hi)


def q_fact_build(spark, d):
    c, dates, prods, whs, rows = star_parts(spark, d)
    return _to_double(star.fact_inventory(c, dates, prods, whs, rows), MEASURES)


def _order_calendar(spark, d):
    """Calendar of the order dates (exact span, not whole years)."""
    return star.date_bounds(td.table(spark, d, "orders"), "o_orderdate", whole_years=False)


def q_fact_orphans(spark, d):
    c, dates, prods, whs, _ = star_parts(spark, d, bounds=_order_calendar(spark, d), ids=True)
    return star.fact_orphans(c, dates, prods, whs)


def q_fact_pk_check(spark, d):
    c, dates, prods, whs, rows = star_parts(spark, d)
    fact = star.fact_inventory(c, dates, prods, whs, rows)
    return quality.key_violations(fact, ["DateKey", "ProductKey", "WarehouseKey"])


def q_surrogate_key(spark, d):
    return surrogate_key(plain(spark, d), ["ProductID", "WarehouseLocation"], "SeriesKey")


def q_distinct_products(spark, d):
    return distinct_rows(plain(spark, d), ["ProductID", "ProductName"])


def q_distinct_values(spark, d):
    return distinct_values(plain(spark, d), "WarehouseLocation")


def q_distinct_count(spark, d):
    return distinct_count(plain(spark, d), ["ProductID", "WarehouseLocation", "SnapshotDate"])


def q_enrich_lookup(spark, d):
    attrs = products(spark, d).select("ProductID", "Category", "Supplier", "UnitPrice")
    return lookup(raw(spark, d), attrs, "ProductID").select(
        "SnapshotInvID", "ProductID", "ProductName", "Category", "Supplier", "UnitPrice",
        "WarehouseLocation", "SnapshotDate", "unitsDemanded")


def q_month_spine(spark, d):
    return month_spine(plain(spark, d), "SnapshotDate")


def q_scaffold_gaps(spark, d):
    return snapshot_gaps(plain(spark, d), ["ProductID", "WarehouseLocation"], "SnapshotDate")


def q_sample_n(spark, d):
    return sample_n(raw(spark, d), SAMPLE_SIZE, ["SnapshotInvID"], SAMPLE_SEED)


FIRST_SNAPSHOT = dt.date(1995, 1, 1)


def q_scalar_numeric_date(spark, d):
    r = raw(spark, d)
    dem, av = F.col("unitsDemanded"), F.col("unitsAvailable")
    return r.select(
        "SnapshotInvID",
        shift_days("SnapshotDate", 1).alias("NextDay"),
        days_between(F.add_months("SnapshotDate", 1), "SnapshotDate").alias("DaysInMonth"),
        days_between("SnapshotDate", F.lit(FIRST_SNAPSHOT)).alias("DaysSinceStart"),
        F.round(dem * F.lit(1.07), 2).alias("DemandWithTax"),
        rounded(dem, 10, 2).cast("double").alias("DemandDecimal"),
        F.when(dem - av > 0, dem - av).otherwise(F.lit(0.0)).alias("Shortage"),
        F.concat(F.lit("P"), F.col("ProductID").cast("string"), F.lit("@"),
                 F.col("WarehouseLocation")).alias("SeriesLabel"))


def _run(spark, d):
    st = Stages(spark, d, ids=False)
    lo, hi = st.bounds
    res = pl.run_pipeline(st.raw, st.products, BY_ROW.with_(date_start=lo, date_end=hi),
                          persist=True)
    Stages._live.append(res.frames["dedup"])
    return res


def q_step_audit(spark, d):
    return pl.audit(_run(spark, d))


def q_inventory_end_to_end(spark, d):
    return _to_double(_run(spark, d).frames["fact"], MEASURES)


def _star_for_marts(spark, d):
    return Stages(spark, d, ids=False).fact()


def q_mart_products_by_category(spark, d):
    return marts.products_by_category(
        star.dim_product(products(spark, d)))


def q_mart_margin(spark, d):
    return _round(marts.margin_by_category(
        star.dim_product(products(spark, d))),
                  ["AvgMargin", "AvgMarginRate"])


def q_mart_supplier(spark, d):
    fact, _, prods, _ = _star_for_marts(spark, d)
    return _round(marts.supplier_performance(fact, prods),
                  ["TotalDemand", "TotalAvailable", "FillRate"], 4)


def q_mart_warehouse_month(spark, d):
    fact, dates, _, whs = _star_for_marts(spark, d)
    return _round(marts.warehouse_month(fact, whs, dates), ["TotalDemand", "TotalAvailable"], 4)


PRODUCTS_CSV_SCHEMA = ("ProductID BIGINT, ProductName STRING, Category STRING, Supplier STRING, "
                       "CostPrice DOUBLE, UnitPrice DOUBLE, WarehouseLocation STRING")


def q_csv_roundtrip(spark, d):
    path = shared_scratch(spark, "products-csv")
    write_csv(products(spark, d), path)
    return read_csv(spark, path, schema=PRODUCTS_CSV_SCHEMA)


QUERIES = {
    "dedup_events": q_dedup_events,
    "dup_detect_events": q_dup_detect_events,
    "row_counts": q_row_counts,
    "sample_rows": q_sample_rows,
    "schema_profile": q_schema_profile,
    "dq_bad_rows": q_dq_bad_rows,
    "dq_bad_rows_products": q_dq_bad_rows_products,
    "dq_bad_counts": q_dq_bad_counts,
    "perturb_nulls": q_perturb_nulls,
    "perturb_outliers": q_perturb_outliers,
    "append_dups": q_append_dups,
    "rekey": q_rekey,
    "group_avg_complete_case": q_group_avg_complete_case,
    "impute_mean_by_group": q_impute_mean_by_group,
    "null_recheck": q_null_recheck,
    "dup_detect": q_dup_detect,
    "dedup_keep_first": q_dedup_keep_first,
    "dedup_check": q_dedup_check,
    "duplicate_keys_raw": q_duplicate_keys_raw,
    "percentile_caps": q_percentile_caps,
    "threshold_messages": q_threshold_messages,
    "cap_outliers": q_cap_outliers,
    "metric_profile": q_metric_profile,
    "rule_violations": q_rule_violations,
    "rule_enforce": q_rule_enforce,
    "rule_violations_post": q_rule_violations_post,
    "union_checks": q_union_checks,
    "dim_product": q_dim_product,
    "dim_warehouse": q_dim_warehouse,
    "dim_date": q_dim_date,
    "fact_build": q_fact_build,
    "fact_orphans": q_fact_orphans,
    "fact_pk_check": q_fact_pk_check,
    "surrogate_key": q_surrogate_key,
    "distinct_products": q_distinct_products,
    "distinct_values": q_distinct_values,
    "distinct_count": q_distinct_count,
    "enrich_lookup": q_enrich_lookup,
    "month_spine": q_month_spine,
    "scaffold_gaps": q_scaffold_gaps,
    "sample_n": q_sample_n,
    "scalar_numeric_date": q_scalar_numeric_date,
    "step_audit": q_step_audit,
    "inventory_end_to_end": q_inventory_end_to_end,
    "mart_products_by_category": q_mart_products_by_category,
    "mart_margin": q_mart_margin,
    "mart_supplier": q_mart_supplier,
    "mart_warehouse_month": q_mart_warehouse_month,
    "csv_roundtrip": q_csv_roundtrip,
    **loads.QUERIES,
    **analytics.QUERIES,
}
