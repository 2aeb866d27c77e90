"""Analytic queries over the given tables: as-of and interval joins, running totals, moving frames, ranks,
several groupings at once, sketches, nested text."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.asof import asof_join
from larder.operators.intervals import interval_join
from larder.operators.lattice import cube_sets, distinct_counts, grouping_sets, merged_sketches, rollup_sets, sketch_table
from larder.operators.nested import drift, typed_columns
from larder.operators.series import EXACT, global_ranks, moving_frames, running_totals
from larder.session import write_scratch
from larder.sources import testdata as td

SHIPPED = ["l_shipdate", *[c for c in td.LINEITEM_ORDER if c != "l_shipdate"]]       # a total order of the lines by ship date
FRAME = 7
SALES_DIMS = ["Category", "WarehouseLocation", "Year"]
NARROW_DAYS = 32             # width of the narrowest bins of order periods
DISTINCT_ERROR, RANK_ERROR = 0.03, 0.02
PROPS = T.StructType([T.StructField("k", T.LongType())])


def _lines(spark, d, *columns):
    return td.table(spark, d, "lineitem").select(*columns)


def _located(spark, d):
    """Lines with their warehouse."""
    wh = td.warehouses(spark, d)
    return _lines(spark, d, *td.LINEITEM_ORDER).join(wh, F.col("l_suppkey") == F.col("s_suppkey"), "left").drop("s_suppkey")


def q_asof_returns(spark, d):
    """The last returned line shipped from the same warehouse at or before each line."""
    lines = write_scratch(_located(spark, d), "lines")
    found = asof_join(lines, lines.where("l_returnflag = 'R'"), ["WarehouseLocation"], "l_shipdate", "l_shipdate",
                      {"return_order": "l_orderkey", "return_line": "l_linenumber", "return_quantity": "l_quantity"}, ties=td.LINEITEM_ORDER)
    return found.select(*td.LINEITEM_ORDER, "WarehouseLocation", "matched_at", "return_order", "return_line", "return_quantity")


def q_asof_errors(spark, d):
    """The last error of the same user before each event, if it was less than a day ago."""
    events = td.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    recent = F.col("ts") - F.col("matched_at") < F.expr("INTERVAL 1 DAY")
    return asof_join(events, events.where("event_type = 'error'"), ["user_id"], "ts", "ts", {"error_id": "event_id"}, ties=["event_id"], exact=False, within=recent)


def q_order_overlaps(spark, d):
    """Pairs of orders of one customer that were open on the same day, from the order to its last shipment."""
    last = _lines(spark, d, "l_orderkey", "l_shipdate").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    orders = td.table(spark, d, "orders").join(last, F.col("o_orderkey") == F.col("l_orderkey"))
    day = lambda c: F.unix_date(F.col(c).cast("date")).cast("long")
    periods = write_scratch(orders.select(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("order"), day("o_orderdate").alias("lo"), day("last").alias("hi")), "periods")
    pairs = interval_join(periods, periods, ["cust"], ("lo", "hi"), ("lo", "hi"), width=NARROW_DAYS, keep=F.col("order_l") < F.col("order_r"))
    return pairs.select(F.col("cust_l").alias("cust"), F.col("order_l").alias("order_a"), F.col("order_r").alias("order_b"),
                        (F.least("hi_l", "hi_r") - F.greatest("lo_l", "lo_r") + 1).alias("days"))


def q_running_totals(spark, d):
    """Running units and sales of all lines of a return flag: three series, each a large part of the table."""
    lines = _lines(spark, d, *td.LINEITEM_ORDER)
    return running_totals(lines, ["l_returnflag"], SHIPPED, {"units": "l_quantity", "sales": "l_extendedprice"}).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "position", "units", "sales")


def q_moving_frames(spark, d):
    """Mean units and the extremes of the price over the last lines of the same return flag."""
    lines = _lines(spark, d, *td.LINEITEM_ORDER)
    mean = {"units_sum": F.sum(F.col("l_quantity").cast(EXACT)), "units_n": F.count("l_quantity")}
    moved = moving_frames(lines, ["l_returnflag"], SHIPPED, FRAME, {**mean, "price_min": F.min("l_extendedprice"), "price_max": F.max("l_extendedprice")})
    return moved.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "position",
                        (F.col("units_sum").cast("double") / F.nullif("units_n", F.lit(0))).alias("units_mean"), "price_min", "price_max")


def q_global_ranks(spark, d):
    """Every line ranked by its quantity, of which there are few: ties of many thousand rows."""
    lines = _lines(spark, d, *td.LINEITEM_ORDER)
    ranked = global_ranks(lines, ["l_quantity"], [c for c in td.LINEITEM_ORDER if c != "l_quantity"])
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "row_number", "rank", "dense_rank", "percent_rank", "ntile")


def _sales(spark, d):
    part = td.table(spark, d, "part").select("p_partkey", F.col("p_type").alias("Category"))
    lines = _located(spark, d).join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    return lines.select("Category", "WarehouseLocation", F.year("l_shipdate").alias("Year"), "l_quantity", "l_extendedprice")


def q_sales_cube(spark, d):
    return grouping_sets(_sales(spark, d), SALES_DIMS, cube_sets(SALES_DIMS), {"units": "l_quantity", "sales": "l_extendedprice"})


def q_sales_rollup(spark, d):
    dims = ["Year", "WarehouseLocation", "Category"]
    return grouping_sets(_sales(spark, d), dims, rollup_sets(dims), {"sales": "l_extendedprice"})


def q_distinct_by_group(spark, d):
    lines = _lines(spark, d, "l_returnflag", "l_partkey", "l_suppkey", "l_orderkey", "l_shipdate")
    return distinct_counts(lines, ["l_returnflag"], {"n_products": "l_partkey", "n_suppliers": "l_suppkey", "n_orders": "l_orderkey", "n_ship_days": "l_shipdate"})


def q_sketch_accuracy(spark, d):
    """Sketches per warehouse and month, merged per warehouse, against the exact figures."""
    lines = _located(spark, d).select("WarehouseLocation", F.trunc("l_shipdate", "month").alias("month"), "l_partkey", "l_extendedprice")
    stored = sketch_table(lines, ["WarehouseLocation", "month"], "l_partkey", "l_extendedprice")
    merged = write_scratch(merged_sketches(stored, ["WarehouseLocation"], [0.5, 0.9]), "merged").withColumnRenamed("WarehouseLocation", "w")
    # where the sketched quantiles really lie
    both = lines.join(merged, F.col("WarehouseLocation").eqNullSafe(F.col("w")))
    below = lambda q: F.avg((F.col("l_extendedprice") < F.col(q)).cast("int"))
    upto = lambda q: F.avg((F.col("l_extendedprice") <= F.col(q)).cast("int"))
    ranks = both.groupBy("WarehouseLocation").agg(F.count("*").alias("n_rows"), F.max("n_distinct").alias("guess"),
                                                  *[f(q).alias(f"{n}_{q}") for q in ("q_50", "q_90") for n, f in (("below", below), ("upto", upto))])
    exact = distinct_counts(lines, ["WarehouseLocation"], {"n_products": "l_partkey"}).withColumnRenamed("WarehouseLocation", "w")
    right = lambda q, at: (F.col(f"below_{q}") <= at + RANK_ERROR) & (F.col(f"upto_{q}") >= at - RANK_ERROR)
    return ranks.join(exact, F.col("WarehouseLocation").eqNullSafe(F.col("w"))).select(
        "WarehouseLocation", "n_rows", "n_products", (F.abs(F.col("guess") - F.col("n_products")) <= F.greatest(F.lit(1.0), DISTINCT_ERROR * F.col("n_products"))).alias("products_close"),
        right("q_50", 0.5).alias("median_close"), right("q_90", 0.9).alias("q90_close"))


def q_props_typed(spark, d):
    return typed_columns(td.table(spark, d, "events").select("event_id", "event_type", "props"), "props", PROPS)[0].drop("props")


def q_props_drift(spark, d):
    return drift(td.table(spark, d, "events").select("props"), "props", PROPS)


QUERIES = {
    "asof_returns": q_asof_returns,
    "asof_errors": q_asof_errors,
    "order_overlaps": q_order_overlaps,
    "running_totals": q_running_totals,
    "moving_frames": q_moving_frames,
    "global_ranks": q_global_ranks,
    "sales_cube": q_sales_cube,
    "sales_rollup": q_sales_rollup,
    "distinct_by_group": q_distinct_by_group,
    "sketch_accuracy": q_sketch_accuracy,
    "props_typed": q_props_typed,
    "props_drift": q_props_drift,
}
