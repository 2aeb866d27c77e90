"""Shape the given TPC-H-like tables into the inventory model.

lineitem → inventory snapshots, part → product master, supplier → nation →
warehouse names. Every row of the inputs is used; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.expressions import month_start
from larder.operators.keys import dense_index
from larder.operators.perturb import Rule, perturb
from larder.sources.files import read_parquet

# lineitem holds no exact duplicate rows, so ordering by every column is a
# total order: the snapshot ids it yields are unique and reproducible. Only
# inputs with ids pay for the numbering: what is injected depends on SEED.
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                  "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus"]

# Injection rules of the test fixture (modulus of the seed, residue, effect).
DEMAND_RULES = [Rule("null", 20, 3), Rule("scale", 50, 11, 100.0)]
AVAILABLE_RULES = [Rule("null", 20, 7), Rule("negate", 97, 5), Rule("scale", 50, 13, 50.0)]
ROW = "_row"
SEED = "l_orderkey * 7 + l_linenumber * 13 + l_partkey * 3 + l_suppkey"
AVAILABLE_MODULUS = 51        # unitsAvailable = max(0, quantity - orderkey % 51)
COST_MARKUP = 1.25            # CostPrice = UnitPrice / 1.25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier key → warehouse name (the supplier's nation)."""
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (supp.join(nation, supp.s_nationkey == nation.n_nationkey, "left")
            .select("s_suppkey", F.col("n_name").alias("WarehouseLocation")))


def lineitem_row():
    """The order of the snapshots as one column: sorts as their ids do, without numbering them."""
    return F.struct(*LINEITEM_ORDER).alias(ROW)


def _shaped(spark: SparkSession, sf_dir: str, li: DataFrame, ids: bool, extra=()) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    wh = warehouses(spark, sf_dir)
    joined = (li.join(part, li.l_partkey == part.p_partkey, "left")
                .join(wh, li.l_suppkey == wh.s_suppkey, "left"))
    available = F.greatest(F.lit(0.0),
                           F.col("l_quantity") - (F.col("l_orderkey") % F.lit(AVAILABLE_MODULUS)))
    return joined.select(
        *([F.col("SnapshotInvID").cast("long")] if ids else []),
        F.col("l_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("WarehouseLocation"),
        available.cast("double").alias("unitsAvailable"),
        F.col("l_quantity").cast("double").alias("unitsDemanded"),
        month_start("l_shipdate").alias("SnapshotDate"),
        F.expr(SEED).alias("_seed"),
        *extra,
    )


def _lineitem(spark: SparkSession, sf_dir: str, ids: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER)
    return dense_index(li, LINEITEM_ORDER, "SnapshotInvID") if ids else li


def inventory_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean snapshots: one row per lineitem, v2 inventory layout."""
    return _shaped(spark, sf_dir, _lineitem(spark, sf_dir, True), True).drop("_seed")


def raw_inventory(spark: SparkSession, sf_dir: str, ids: bool = True, extra=()) -> DataFrame:
    """Snapshots with NULLs, outliers and negative values injected by rules on
    stored columns; ``ids=False`` leaves out SnapshotInvID and with it the numbering.
    ``extra``: columns over lineitem that come along."""
    df = _shaped(spark, sf_dir, _lineitem(spark, sf_dir, ids), ids, extra)
    df = perturb(df, "unitsDemanded", "_seed", DEMAND_RULES)
    return perturb(df, "unitsAvailable", "_seed", AVAILABLE_RULES).drop("_seed")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master from part: type as category, brand as supplier, a cost
    price below the retail price, and a home warehouse picked by key."""
    part = table(spark, sf_dir, "part")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    n_nations = max(nation.count(), 1)
    home = part.withColumn("_home", F.pmod(F.col("p_partkey"), F.lit(n_nations)).cast("int"))
    joined = home.join(nation, home._home == nation.n_nationkey, "left")
    return joined.select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Supplier"),
        F.round(F.col("p_retailprice") / F.lit(COST_MARKUP), 2).alias("CostPrice"),
        F.col("p_retailprice").alias("UnitPrice"),
        F.col("n_name").alias("WarehouseLocation"),
    )
