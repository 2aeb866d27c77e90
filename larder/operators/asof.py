"""As-of join: the last row of the right side at or before each row of the left, per key.

Both sides are merged into one order of (key, time) and cut into ranges, also within a
key; a row's match is the last right row before it in its range, or, where the range has none, the one
carried over the range's edge. So a key with a third of the rows is spread over tasks, and no pair
of rows is made but the ones that match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.keys import PART, PLACE, ordered_parts
from larder.operators.series import UPTO, carried, with_carried


def asof_join(left: DataFrame, right: DataFrame, on, left_time: str, right_time: str, take: dict[str, str], ties=(),
              exact: bool = True, within: Column | None = None) -> DataFrame:
    """Every row of ``left`` with columns of its match (``take``: alias -> right column), NULL where there is none.

    Of right rows with equal key and time the last in the order of ``ties`` counts. ``exact=False``: only
    rows before the left row's time match. ``within``: a condition over the left's columns, ``take``'s aliases and
    ``matched_at`` (the match's time); matches that fail it are dropped. Rows whose key or time is NULL match nothing."""
    on, aliases = list(on), list(take)
    side = 0 if exact else 1                         # right rows come first at equal times, if those match
    usable = lambda time: " AND ".join(f"`{c}` IS NOT NULL" for c in [*on, time])
    match = F.struct(F.col(right_time).alias("matched_at"), *[F.col(c).alias(a) for a, c in take.items()])
    marks = right.where(usable(right_time)).select(
        *on, F.col(right_time).alias("__t"), F.lit(side).alias("__side"), (F.struct(*ties) if ties else F.lit(0)).alias("__tie"), match.alias("__r"))
    whole = F.struct(*left.columns)
    rows = left.where(usable(left_time)).select(
        *on, F.col(left_time).alias("__t"), F.lit(1 - side).alias("__side"), F.lit(None).cast(marks.schema["__tie"].dataType).alias("__tie"), whole.alias("__l"))
    merged = rows.withColumn("__r", F.lit(None).cast(marks.schema["__r"].dataType)).unionByName(marks.withColumn("__l", F.lit(None).cast(rows.schema["__l"].dataType)))
    placed = ordered_parts(merged, [*on, "__t", "__side", "__tie"], "asof")
    last = placed.groupBy(PART, *on).agg(F.max_by("__r", F.when(F.col("__r").isNotNull(), F.col(PLACE))).alias("__end"))
    carry = carried(last, on, {"__before": F.last("__end", ignorenulls=True)})
    inside = Window.partitionBy(PART, *on).orderBy(PLACE).rowsBetween(*UPTO)
    found = with_carried(placed.withColumn("__near", F.last("__r", ignorenulls=True).over(inside)).where("__l IS NOT NULL"), carry, on)
    found = found.select("__l.*", F.coalesce("__near", "__before").alias("__m"))
    lone = left.where(f"NOT ({usable(left_time)})").withColumn("__m", F.lit(None).cast(found.schema["__m"].dataType))
    out = found.unionByName(lone).select(*left.columns, "__m.*")
    if within is not None:
        ok = F.coalesce(within, F.lit(False))
        out = out.select(*left.columns, *[F.when(ok, F.col(c)).alias(c) for c in ["matched_at", *aliases]])
    return out.select(*left.columns, "matched_at", *aliases)
