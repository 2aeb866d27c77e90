"""Lookups of attributes by key.

No broadcast hint here: the attribute side grows with the data (one row per
product), so the join strategy is left to the planner's size checks — the
static threshold for stored tables, and AQE's runtime sizes for derived
ones, with a sort-merge join (skew splitting on) beyond that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows below which a side whose row count we KNOW may be broadcast explicitly.
BROADCAST_MAX_ROWS = 2_000_000


def lookup(df: DataFrame, attrs: DataFrame, key: str, attr_key: str | None = None,
           how: str = "inner") -> DataFrame:
    """Attach the columns of ``attrs`` to each row of ``df`` matching on key."""
    attr_key = attr_key or key
    if attr_key == key:
        return df.join(attrs, key, how)
    return df.join(attrs, df[key] == attrs[attr_key], how).drop(attrs[attr_key])


def broadcast_bounded(df: DataFrame, known_rows: int, max_rows: int = BROADCAST_MAX_ROWS):
    """Broadcast hint only for a side whose row count is known and bounded."""
    return F.broadcast(df) if known_rows <= max_rows else df
