"""Table layouts of the inventory model (raw snapshots, product master, star schema)."""

from __future__ import annotations

from pyspark.sql import types as T

# Product master as shipped in CSV form: ids are ints, prices floats.
PRODUCTS = T.StructType([
    T.StructField("ProductID", T.IntegerType()),
    T.StructField("ProductName", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Supplier", T.StringType()),
    T.StructField("CostPrice", T.DoubleType()),
    T.StructField("UnitPrice", T.DoubleType()),
    T.StructField("WarehouseLocation", T.StringType()),
])

# Inventory snapshot (v2 layout). Counts are doubles: NULLs made the source
# write them as floats, and imputed means are fractional anyway.
INVENTORY = T.StructType([
    T.StructField("SnapshotInvID", T.LongType()),
    T.StructField("ProductID", T.LongType()),
    T.StructField("ProductName", T.StringType()),
    T.StructField("WarehouseLocation", T.StringType()),
    T.StructField("unitsAvailable", T.DoubleType()),
    T.StructField("unitsDemanded", T.DoubleType()),
    T.StructField("SnapshotDate", T.DateType()),
])

# Legacy (v1) inventory column names and their v2 names.
V1_TO_V2 = {
    "InvID": "SnapshotInvID",
    "ProductID": "ProductID",
    "ProductName": "ProductName",
    "WarehouseLocation": "WarehouseLocation",
    "Availability": "unitsAvailable",
    "Demand": "unitsDemanded",
    "OrderDate": "SnapshotDate",
}

BUSINESS_KEY = ["ProductID", "WarehouseLocation", "SnapshotDate"]
MEASURE = T.DecimalType(10, 2)
FACT_KEY = ["DateKey", "ProductKey", "WarehouseKey"]


def _layout(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Declared layouts of the outputs; in the cleaned table date and demand come
# before the derived availability.
_INT, _LONG, _TEXT, _DAY, _DOUBLE = T.IntegerType(), T.LongType(), T.StringType(), T.DateType(), T.DoubleType()
OUTPUTS = {
    "dedup": INVENTORY,
    "clean": _layout(SnapshotInvID=_LONG, ProductID=_LONG, ProductName=_TEXT, WarehouseLocation=_TEXT,
                     SnapshotDate=_DAY, unitsDemanded=_DOUBLE, unitsAvailable=_DOUBLE),
    "dim_product": _layout(ProductKey=_INT, ProductID=_LONG, ProductName=_TEXT, Category=_TEXT,
                           Supplier=_TEXT, UnitPrice=MEASURE, CostPrice=MEASURE),
    "dim_warehouse": _layout(WarehouseKey=_INT, WarehouseLocation=_TEXT),
    "dim_date": _layout(DateKey=_INT, FullDate=_DAY, Year=_INT, Month=_INT, DayOfMonth=_INT,
                        MonthName=_TEXT, DayOfWeekName=_TEXT),
    "fact": _layout(DateKey=_INT, ProductKey=_INT, WarehouseKey=_INT, unitsDemanded=MEASURE,
                    unitsAvailable=MEASURE),
}


def shaped(df, name: str):
    """A typed load (INSERT … SELECT into a declared table): the layout's columns, in
    its order and types. Columns that an option leaves out stay out."""
    fields = [f for f in OUTPUTS[name].fields if f.name in df.columns]
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in fields])


def from_v1(df):
    """Rename a legacy (v1) inventory frame to the v2 layout."""
    out = df
    for old, new in V1_TO_V2.items():
        if old in out.columns and old != new:
            out = out.withColumnRenamed(old, new)
    return out
