"""Dense sequential keys (IDENTITY / AUTO_INCREMENT / re-numbering) without a
single-partition window.

``row_number() OVER (ORDER BY …)`` with no PARTITION BY moves every row into
one task. Here the rows are range-partitioned and sorted by the order columns,
each gets its place within its partition, and the result is written once to the
shared folder, which fixes partitions and places. A row's key is its place plus
the rows in all partitions before its own (one count per partition).

The path is the same at every size. Rows equal on the whole order key are
spread over partitions by a hash of all their columns, so a repeated key does not pile
up in one task, and a task that runs again sends each row to the range it went to before;
such rows are numbered in an unspecified order, as with ROW_NUMBER. Only rows
equal in every column, which are no different from one another, are spread at random.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.session import write_scratch

PART, PLACE = "__part", "__place"
_PLACE_BITS = 33             # monotonically_increasing_id: partition above, place below


def ordered_parts(df: DataFrame, order_cols, name: str, parts: int | None = None) -> DataFrame:
    """``df`` written in ranges of ``order_cols`` (ascending, NULLs first) with
    ``__part`` (number of the range, in order) and ``__place`` (0, 1, … within it)."""
    keys = list(order_cols)
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    mid = "__mid"
    ranged = (df.repartitionByRange(n, *keys, F.xxhash64(*df.columns), F.rand(7)).sortWithinPartitions(*keys)
                .withColumn(mid, F.monotonically_increasing_id()))
    mask = (1 << _PLACE_BITS) - 1
    return write_scratch(ranged, name).select(
        *df.columns, F.shiftright(mid, _PLACE_BITS).cast("int").alias(PART),
        F.col(mid).bitwiseAND(F.lit(mask)).alias(PLACE))


def dense_index(df: DataFrame, order_cols, name: str, start: int = 1,
                parts: int | None = None) -> DataFrame:
    """Add ``name`` = start, start+1, … following ``order_cols`` (column names,
    ascending, NULLs first). Reads ``df`` once."""
    placed = ordered_parts(df, order_cols, "dense-key", parts)
    counts = placed.groupBy(PART).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: the window and the broadcast are bounded by their number.
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # never NULL, and declared so: columns of a table read back are nullable
    key = F.coalesce((F.col("__off") + F.col(PLACE) + F.lit(start)).cast("long"), F.lit(0).cast("long"))
    return placed.join(F.broadcast(offsets), PART).select(key.alias(name), *df.columns)


def surrogate_key(df: DataFrame, natural_key, name: str, distinct: bool = True) -> DataFrame:
    """DISTINCT over the natural key columns plus a dense key from 1, ordered by
    the natural key so reruns give the same keys."""
    cols = list(natural_key)
    base = df.select(*cols)
    return dense_index(base.distinct() if distinct else base, cols, name)


def rekey(df: DataFrame, id_col: str, order_cols=None) -> DataFrame:
    """Overwrite ``id_col`` with 1..n (re-numbering after rows were appended).

    Ordered by the current id then every other column, so the result is
    deterministic even when the old ids repeat.
    """
    others = [c for c in df.columns if c != id_col]
    order = list(order_cols) if order_cols else [id_col] + others
    tmp = "__rekey"
    out = dense_index(df, order, tmp).drop(id_col).withColumnRenamed(tmp, id_col)
    return out.select(*df.columns)
