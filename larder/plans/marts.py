"""Reporting queries over the star schema (product distribution, margin,
supplier performance, warehouse-by-month inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def products_by_category(dim_product: DataFrame) -> DataFrame:
    return dim_product.groupBy("Category").agg(F.count(F.lit(1)).alias("ProductCount"))


def margin_by_category(dim_product: DataFrame) -> DataFrame:
    """Average unit margin and margin rate per category (needs CostPrice)."""
    m = F.col("UnitPrice").cast("double") - F.col("CostPrice").cast("double")
    return dim_product.groupBy("Category").agg(
        F.avg(m).alias("AvgMargin"),
        F.avg(m / F.col("UnitPrice").cast("double")).alias("AvgMarginRate"))


def supplier_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Demand, availability and fill rate per supplier. The fact is reduced to
    one row per ProductKey before the join, so the join input is the size of
    the product dimension, not of the fact."""
    per_product = fact.groupBy("ProductKey").agg(
        F.sum("unitsDemanded").alias("_d"), F.sum("unitsAvailable").alias("_a"))
    j = per_product.join(dim_product.select("ProductKey", "Supplier"), "ProductKey")
    return (j.groupBy("Supplier")
             .agg(F.sum("_d").cast("double").alias("TotalDemand"),
                  F.sum("_a").cast("double").alias("TotalAvailable"))
             .withColumn("FillRate", F.when(F.col("TotalDemand") != 0,
                                            F.col("TotalAvailable") / F.col("TotalDemand"))))


def warehouse_month(fact: DataFrame, dim_warehouse: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly demand against availability per warehouse."""
    per_key = fact.groupBy("WarehouseKey", "DateKey").agg(
        F.sum("unitsDemanded").alias("_d"), F.sum("unitsAvailable").alias("_a"))
    j = (per_key.join(dim_warehouse, "WarehouseKey")
                .join(dim_date.select("DateKey", "Year", "Month"), "DateKey"))
    return (j.groupBy("WarehouseLocation", "Year", "Month")
             .agg(F.sum("_d").cast("double").alias("TotalDemand"),
                  F.sum("_a").cast("double").alias("TotalAvailable")))
