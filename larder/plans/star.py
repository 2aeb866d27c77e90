"""Star schema: product, warehouse and date dimensions and the inventory fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.expressions import date_key, day_name, month_name, to_measure
from larder.operators.joins import broadcast_bounded
from larder.operators.keys import dense_index

PRODUCT_ATTRS = ["ProductID", "ProductName", "Category", "Supplier", "UnitPrice", "CostPrice"]


def dim_product(products: DataFrame, include_cost_price: bool = True) -> DataFrame:
    """DISTINCT product attributes with a dense ProductKey from 1 (ordered by
    the attributes). Prices become DECIMAL(10,2) after the DISTINCT, as an
    INSERT into a DECIMAL column would."""
    attrs = PRODUCT_ATTRS if include_cost_price else PRODUCT_ATTRS[:-1]
    keyed = dense_index(products.select(*attrs).distinct(), attrs, "ProductKey")
    out = [F.col("ProductKey").cast("int"), "ProductID", "ProductName", "Category", "Supplier",
           to_measure("UnitPrice").alias("UnitPrice")]
    if include_cost_price:
        out.append(to_measure("CostPrice").alias("CostPrice"))
    return keyed.select(*out)


def dim_warehouse(clean: DataFrame) -> DataFrame:
    """DISTINCT warehouse names of the cleaned snapshots with a dense WarehouseKey."""
    keyed = dense_index(clean.select("WarehouseLocation").distinct(),
                        ["WarehouseLocation"], "WarehouseKey")
    return keyed.select(F.col("WarehouseKey").cast("int"), "WarehouseLocation")


def date_bounds(df: DataFrame, date_col: str, whole_years: bool = True):
    """(first, last) date of a column, widened to whole calendar years.
    One aggregate of two values; returns Python dates (None, None) if empty."""
    r = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"),
               F.max(F.col(date_col).cast("date")).alias("hi")).collect()[0]
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        return None, None
    if whole_years:
        lo, hi = dt.date(lo.year, 1, 1), dt.date(hi.year, 12, 31)
    return lo, hi


def _as_date(d):
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """One row per day from start to end inclusive (a tally from spark.range,
    generated in parallel, no recursion)."""
    start, end = _as_date(start), _as_date(end)
    n_days = max((end - start).days + 1, 0)
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(n_days).select(
        date_key(d).alias("DateKey"), d.alias("FullDate"),
        F.year(d).alias("Year"), F.month(d).alias("Month"), F.dayofmonth(d).alias("DayOfMonth"),
        month_name(d).alias("MonthName"), day_name(d).alias("DayOfWeekName"))


def dim_date_rows(start, end) -> int:
    return max((_as_date(end) - _as_date(start)).days + 1, 0)


def fact_inventory(clean: DataFrame, dates: DataFrame, products: DataFrame,
                   warehouses: DataFrame, date_rows: int | None = None,
                   count_dims: bool = True) -> DataFrame:
    """Cleaned snapshots joined to the three dimensions (inner joins).

    The date dimension's size is known (one row per day), so it is broadcast
    when that count is small; the other dimensions grow with the data: they are
    counted first (two small written tables) and broadcast below the same bound,
    else joined by a shuffle. A ProductID that appears in
    several product rows fans out, exactly as the inner join does.
    """
    d = dates.select("DateKey", "FullDate")
    if date_rows is not None:
        d = broadcast_bounded(d, date_rows)
    p = products.select("ProductKey", "ProductID")
    w = warehouses.select("WarehouseKey", "WarehouseLocation")
    if count_dims:
        p, w = broadcast_bounded(p, p.count()), broadcast_bounded(w, w.count())
    j = (clean.join(d, clean.SnapshotDate == d.FullDate, "inner")
              .join(p, "ProductID", "inner")
              .join(w, "WarehouseLocation", "inner"))
    return j.select("DateKey", "ProductKey", "WarehouseKey",
                    to_measure("unitsDemanded").alias("unitsDemanded"),
                    to_measure("unitsAvailable").alias("unitsAvailable"))


def fact_orphans(clean: DataFrame, dates: DataFrame, products: DataFrame,
                 warehouses: DataFrame) -> DataFrame:
    """Cleaned rows that the fact's inner joins drop, with the reason(s).

    Each dimension contributes only its DISTINCT join keys, so the checks
    never fan out; one row per orphaned snapshot.
    """
    dk = dates.select(F.col("FullDate").alias("_d")).distinct().withColumn("_hd", F.lit(True))
    pk = products.select(F.col("ProductID").alias("_p")).distinct().withColumn("_hp", F.lit(True))
    wk = (warehouses.select(F.col("WarehouseLocation").alias("_w")).distinct()
          .withColumn("_hw", F.lit(True)))
    j = (clean.join(dk, clean.SnapshotDate == dk._d, "left")
              .join(pk, F.col("ProductID") == pk._p, "left")
              .join(wk, F.col("WarehouseLocation") == wk._w, "left"))
    return (j.select("SnapshotInvID", "ProductID", "WarehouseLocation", "SnapshotDate",
                     F.col("_hd").isNull().alias("MissingDate"),
                     F.col("_hp").isNull().alias("MissingProduct"),
                     F.col("_hw").isNull().alias("MissingWarehouse"))
             .where("MissingDate OR MissingProduct OR MissingWarehouse"))
