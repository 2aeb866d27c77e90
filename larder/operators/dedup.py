"""Duplicate detection and keep-first deduplication over a business key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.labels import DUPLICATE_STATUS

_RN, _N = "__rn", "__n"
TASK_ROWS = 1 << 19          # rows that a task of a multiset difference groups


def _order(df: DataFrame, key, order):
    """ORDER BY the given columns, then every other column as a tie-break so
    the surviving row is deterministic even if the order columns tie."""
    order = list(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    return [F.col(c).asc_nulls_first() for c in order + rest]


def keep_first(df: DataFrame, key, order) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY key ORDER BY order) = 1.

    Catalyst plans a partial WindowGroupLimit before the shuffle, so each map
    task forwards at most one row per key: a hot key does not pile up in a
    single reducer. NULL key parts group together, NULL order values sort first.
    """
    key = list(key)
    w = Window.partitionBy(*key).orderBy(*_order(df, key, order))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def later_duplicates(df: DataFrame, key, order) -> DataFrame:
    """The rows ROW_NUMBER would number 2, 3, …: every row minus the first per key.

    A multiset difference (EXCEPT ALL) against ``keep_first``: rows are grouped on all
    columns, so those of a hot key spread over all reducers by their ids instead of
    landing in one window partition. The number of reducers follows the number of rows
    (one more pass counts them), and nothing is grouped before the shuffle, where hardly any two
    rows are equal: a task holds about ``TASK_ROWS`` rows at any input size.
    """
    columns = [F.col(c) for c in df.columns]
    signed = df.withColumn(_N, F.lit(1)).union(keep_first(df, key, order).withColumn(_N, F.lit(-1)))
    parts = max(1, -(-2 * df.count() // TASK_ROWS))
    left = signed.repartition(parts, *columns).groupBy(*columns).agg(F.sum(_N).alias(_N)).where(F.col(_N) > 0)
    return left.withColumn(_N, F.explode(F.sequence(F.lit(1).cast("long"), _N))).select(*columns)


def duplicate_report(df: DataFrame, key, order, id_col: str,
                     status: str = DUPLICATE_STATUS) -> DataFrame:
    """(id, key…, Status) for each duplicate row. Reads the id, key and order columns
    alone: which row is a duplicate does not depend on the measures."""
    key = list(key)
    narrow = df.select(*dict.fromkeys([id_col, *key, *order]))
    return later_duplicates(narrow, key, order).select(
        id_col, *key, F.lit(status).alias("Status"))
