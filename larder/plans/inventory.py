"""End-to-end inventory pipeline: raw snapshots → cleaned table → star schema,
with a validation report and an audit row after every step.

Order is fixed and matters: impute (means include duplicates and outliers)
→ de-duplicate → cap (both caps from the same de-duplicated data) → enforce
rules → dimensions and fact.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder import labels as L
from larder import schemas
from larder.config import PipelineConfig, config_for
from larder.functions.expressions import bad_number, bad_text, rounded
from larder.operators import quality
from larder.operators.dedup import duplicate_report, keep_first
from larder.operators.impute import impute_group_mean
from larder.operators.outliers import apply_caps, exact_percentiles, percentile_frame
from larder.operators.rules import enforce_rules
from larder.plans import star
from larder.sources.files import ensure_database, save_table, write_parquet

IMPUTE_COLUMNS = {"unitsDemanded": L.AVG_DEMAND, "unitsAvailable": L.AVG_AVAILABILITY}
PROFILE_METRICS = {L.METRIC_DEMAND: "unitsDemanded", L.METRIC_AVAILABILITY: "unitsAvailable"}
CAP_MESSAGES = {"unitsDemanded": L.CAP_DEMAND_MESSAGE,
                "unitsAvailable": L.CAP_AVAILABILITY_MESSAGE}


def inventory_checks() -> dict:
    """The seven bad-value checks of the inventory table. Zero is bad for ids,
    not for the unit counts."""
    return {
        L.BAD_SNAPSHOT_ID: bad_number("SnapshotInvID"),
        L.BAD_PRODUCT_ID: bad_number("ProductID"),
        L.BAD_PRODUCT_NAME: bad_text("ProductName"),
        L.BAD_WAREHOUSE: bad_text("WarehouseLocation"),
        L.BAD_AVAILABILITY: F.col("unitsAvailable").isNull(),
        L.BAD_DEMAND: F.col("unitsDemanded").isNull(),
        L.BAD_SNAPSHOT_DATE: F.col("SnapshotDate").isNull(),
    }


PRODUCT_NUMERIC = ["ProductID", "CostPrice", "UnitPrice"]
PRODUCT_TEXT = ["ProductName", "Category", "Supplier", "WarehouseLocation"]


def impute(raw: DataFrame) -> DataFrame:
    return impute_group_mean(raw, "ProductID", IMPUTE_COLUMNS)


def deduplicate(imputed: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return keep_first(imputed, list(cfg.business_key), list(cfg.order_by))


def caps_frame(dedup: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return percentile_frame(dedup, ["unitsDemanded", "unitsAvailable"], cfg.percentile,
                            cfg.cap_scale)


def compute_caps(dedup: DataFrame, cfg: PipelineConfig) -> dict:
    """Both caps from the same de-duplicated data, before either is applied."""
    return exact_percentiles(dedup, ["unitsDemanded", "unitsAvailable"], cfg.percentile,
                             scale=cfg.cap_scale)


def threshold_messages(frame: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """'Capping Demand at: 2500.00' — the cap printed as DECIMAL(10,2) text."""
    value = F.col("cap" if cfg.cap_scale is not None else "percentile")
    text = rounded(value, 10, cfg.cap_scale) if cfg.cap_scale is not None else value
    prefix = F.coalesce(*[F.when(F.col("column_name") == c, F.lit(p))
                          for c, p in CAP_MESSAGES.items()])
    return frame.select(F.concat(prefix, text.cast("string")).alias("Status"))


@dataclass
class PipelineResult:
    config: PipelineConfig
    frames: dict = field(default_factory=dict)    # intermediate and output tables
    reports: dict = field(default_factory=dict)   # validation reports
    caps: dict = field(default_factory=dict)
    date_range: tuple = (None, None)

    def release(self):
        for df in self.frames.values():
            if df.is_cached:
                df.unpersist()


def run_pipeline(raw: DataFrame, products: DataFrame, cfg: PipelineConfig | str = "test",
                 persist: bool = True) -> PipelineResult:
    """Build every table and report lazily; only the cap thresholds and the
    date bounds are computed eagerly (a handful of scalars), and the two keyed
    dimensions are written to the shared folder.

    Snapshots without SnapshotInvID are taken too, if ``cfg.order_by`` names
    columns that order them: reports of ids are then left out."""
    cfg = config_for(cfg) if isinstance(cfg, str) else cfg
    spark = raw.sparkSession
    if cfg.text_collation:
        # Opt-in, like a case-insensitive server collation: the location is
        # compared under the collation in the dedup key, the warehouse
        # dimension's DISTINCT and the fact join. Default: binary.
        raw = raw.withColumn("WarehouseLocation",
                             F.collate("WarehouseLocation", cfg.text_collation))
    res = PipelineResult(cfg)
    f, r = res.frames, res.reports

    f["raw"] = raw
    f["products"] = products
    r["product_bad_rows"] = quality.bad_rows(products, PRODUCT_NUMERIC, PRODUCT_TEXT)
    with_ids = "SnapshotInvID" in raw.columns
    checks = inventory_checks()
    if not with_ids:
        del checks[L.BAD_SNAPSHOT_ID]
    r["bad_counts"] = quality.bad_counts(raw, checks)

    f["imputed"] = impute(raw)
    r["null_recheck"] = quality.null_counts(f["imputed"], ["unitsDemanded", "unitsAvailable",
                                                          "SnapshotDate"])
    if with_ids:
        r["duplicates"] = duplicate_report(raw, list(cfg.business_key), list(cfg.order_by),
                                           "SnapshotInvID")

    dedup = deduplicate(f["imputed"], cfg)
    if not with_ids:
        dedup = dedup.drop(*[c for c in cfg.order_by if c not in cfg.business_key])
    if persist:
        # Feeds the percentile passes, the caps and everything downstream.
        dedup = dedup.persist(StorageLevel.MEMORY_AND_DISK)
    f["dedup"] = dedup
    r["dedup_check"] = quality.duplicate_keys(dedup, list(cfg.business_key))

    r["caps"] = caps_frame(dedup, cfg)
    field_name = "percentile" if cfg.cap_scale is None else "cap"
    res.caps = {row["column_name"]: row[field_name] for row in r["caps"].collect()}
    r["threshold_messages"] = threshold_messages(r["caps"], cfg)
    f["capped"] = apply_caps(dedup, res.caps)
    r["metric_profile"] = quality.metric_profile(f["capped"], PROFILE_METRICS)
    r["rules_pre"] = quality.rule_violations(f["capped"])

    f["clean"] = enforce_rules(f["capped"])
    r["rules_post"] = quality.rule_violations(f["clean"])

    if cfg.date_start and cfg.date_end:
        lo, hi = cfg.date_start, cfg.date_end
    else:
        # Cleaning never changes the date range (keep-first keeps one row per key).
        lo, hi = star.date_bounds(dedup, "SnapshotDate")
    res.date_range = (lo, hi)
    f["dim_product"] = star.dim_product(products, cfg.include_cost_price)
    f["dim_warehouse"] = star.dim_warehouse(f["clean"])
    if lo is not None:
        f["dim_date"] = star.dim_date(spark, lo, hi)
        rows = star.dim_date_rows(lo, hi)
    else:
        f["dim_date"] = star.dim_date(spark, "2000-01-01", "1999-12-31")  # empty
        rows = 0
    f["fact"] = star.fact_inventory(f["clean"], f["dim_date"], f["dim_product"],
                                    f["dim_warehouse"], rows)
    if with_ids:
        r["fact_orphans"] = star.fact_orphans(f["clean"], f["dim_date"], f["dim_product"],
                                              f["dim_warehouse"])
    r["fact_key"] = quality.key_violations(f["fact"], ["DateKey", "ProductKey", "WarehouseKey"])
    return res


# Audit steps and the status message of each.
AUDIT_STEPS = [
    ("raw", "Raw snapshots loaded."),
    ("imputed", "NULL demand/availability replaced with per-product means."),
    ("dedup", "Deduplication complete."),
    ("capped", "Outliers capped at the upper percentile."),
    ("clean", "Business logic applied."),
    ("dim_product", "DimProduct created."),
    ("dim_warehouse", "DimWarehouse created."),
    ("dim_date", "DimDate created."),
    ("fact", "Star schema created."),
]


def audit(res: PipelineResult) -> DataFrame:
    """(StepNo, Step, RowsIn, RowsOut, Message): one row per step. Each row
    count is an aggregate over that step's frame (the cap values themselves
    are in ``res.caps`` and the threshold-message report)."""
    parts = []
    for i, (step, msg) in enumerate(AUDIT_STEPS, start=1):
        parts.append(res.frames[step].agg(F.count(F.lit(1)).alias("RowsOut"))
                     .select(F.lit(i).alias("StepNo"), F.lit(step).alias("Step"), "RowsOut",
                             F.lit(msg).alias("Message")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # Nine rows: the ordered window runs on a tiny input.
    prev = F.lag("RowsOut").over(Window.orderBy("StepNo"))
    return out.select("StepNo", "Step", prev.alias("RowsIn"), "RowsOut", "Message")


OUTPUT_TABLES = ["dedup", "clean", "dim_product", "dim_warehouse", "dim_date", "fact"]
# The fact is a monthly periodic snapshot: one DateKey per month, so one folder
# per month. Date filters prune folders, and a join with a filtered DimDate can
# prune them at run time (dynamic partition pruning).
PARTITION_BY = {"fact": ["DateKey"]}


def write_outputs(res: PipelineResult, output_dir: str | None = None) -> dict:
    """Persist the outputs (overwrite, so reruns are idempotent). Dimensions are
    written before the fact so a reader sees a consistent star."""
    cfg = res.config
    written = {}
    quality.assert_key(res.frames["fact"], schemas.FACT_KEY)   # what a PRIMARY KEY would reject
    base = output_dir or cfg.output_dir
    if base is None and cfg.database:
        ensure_database(res.frames["raw"].sparkSession, cfg.database)
    for name in OUTPUT_TABLES:
        df = schemas.shaped(res.frames[name], name)
        parts = PARTITION_BY.get(name)
        if base is not None:
            path = f"{base.rstrip('/')}/{cfg.env}/{name}"
            written[name] = write_parquet(df, path, partition_by=parts)
        else:
            written[name] = save_table(df, f"{cfg.env}_{name}", partition_by=parts)
    return written
