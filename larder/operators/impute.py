"""Group-mean imputation (UPDATE … FROM a per-group AVG subquery, done functionally)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.expressions import all_not_null, any_null, exact_mean
from larder.operators.joins import BROADCAST_MAX_ROWS
from larder.session import write_scratch


def complete_case_means(df: DataFrame, key, cols: dict) -> DataFrame:
    """AVG of each column per key, over the rows where ALL ``cols`` are non-NULL.

    ``cols`` maps column → output alias. Partial aggregation happens map-side,
    so a key holding a third of the rows is reduced before the shuffle.
    """
    key = [key] if isinstance(key, str) else list(key)
    return (df.where(all_not_null(list(cols)))
              .groupBy(*key)
              .agg(*[exact_mean(c).alias(alias) for c, alias in cols.items()]))


def impute_group_mean(df: DataFrame, key, cols: dict, max_broadcast: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Replace NULLs in ``cols`` with the complete-case mean of their key group.

    The means (one row per key) are computed once and written, so their number is known.
    Up to ``BROADCAST_MAX_ROWS`` of them are broadcast and the rows are read once more, without a shuffle. Beyond
    that, rows with no NULL pass straight through, and the shuffle to the means carries only those that need a
    value. The join is LEFT: rows whose key has no complete row, or whose key is
    NULL, keep their NULLs, like an UPDATE that finds no match.
    """
    key = [key] if isinstance(key, str) else list(key)
    means = write_scratch(complete_case_means(df, key, cols), "means")
    filled = [F.coalesce(F.col(c), F.col(cols[c])).alias(c) if c in cols else F.col(c) for c in df.columns]
    if means.count() <= max_broadcast:
        return df.join(F.broadcast(means), key, "left").select(*filled)
    needs = any_null(list(cols))
    return df.where(~needs).unionByName(df.where(needs).join(means, key, "left").select(*filled))
