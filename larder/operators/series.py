"""Window functions over series of any length: running totals, moving frames, ranks.

A window gives a whole series to one task. Here rows are sorted into ranges of
(series, order) first, which cut a long series anywhere; windows run within a range, and what the
ranges before it add is carried over its edge. Only a range's first series can have
begun before it, so there is at most one carried row per range: these are few and are broadcast.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.keys import PART, PLACE, ordered_parts

EXACT = T.DecimalType(28, 10)
BLOCK = 1 << 14              # rows of a series that one task holds for moving frames
UPTO = (Window.unboundedPreceding, Window.currentRow)


def carried(summary: DataFrame, series, columns: dict[str, Column]) -> DataFrame:
    """``summary`` has one row per range and series. For each series that goes on from
    earlier ranges: ``columns`` (window aggregates, alias -> column) over those. At most one row per range."""
    past = Window.partitionBy(*series).orderBy(PART)
    before = past.rowsBetween(Window.unboundedPreceding, -1)
    rows = summary.withColumns({"__nth": F.row_number().over(past), **{name: c.over(before) for name, c in columns.items()}})
    return rows.where("__nth > 1").select(F.col(PART).alias("__cpart"), *[F.col(c).alias(f"__c_{c}") for c in series], *columns)


def with_carried(placed: DataFrame, carry: DataFrame, series) -> DataFrame:
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__c_{c}")) for c in series], F.col(PART) == F.col("__cpart"))
    return placed.join(F.broadcast(carry), same, "left").drop("__cpart", *[f"__c_{c}" for c in series])


def running_totals(df: DataFrame, series, order, totals: dict[str, str], position: str = "position") -> DataFrame:
    """``df`` with each row's position in its series (1, 2, …) and running sums (alias -> column), both in ``order``
    (ascending, NULLs first), which should be total. Sums are exact decimals, returned as
    doubles; NULLs add nothing, and a sum over NULLs alone is NULL. NULL series parts are equal."""
    series = list(series)
    placed = ordered_parts(df, [*series, *order], "running")
    parts = {f"__t{k}": F.col(c).cast(EXACT) for k, c in enumerate(totals.values())}
    summary = placed.groupBy(PART, *series).agg(F.count("*").alias("__n"), *[F.sum(c).alias(a) for a, c in parts.items()])
    carry = carried(summary, series, {"__n0": F.sum("__n"), **{f"{a}b": F.sum(a) for a in parts}})
    inside = Window.partitionBy(PART, *series).orderBy(PLACE)
    rows = with_carried(placed.withColumns({
        position: F.row_number().over(inside), **{a: F.sum(c).over(inside.rowsBetween(*UPTO)) for a, c in parts.items()}}), carry, series)
    nothing = F.lit(0).cast(EXACT)
    return rows.select(*df.columns, (F.col(position) + F.coalesce("__n0", F.lit(0))).cast("long").alias(position), *[
        F.when(F.col(a).isNotNull() | F.col(f"{a}b").isNotNull(), F.coalesce(a, nothing) + F.coalesce(f"{a}b", nothing)).cast("double").alias(name)
        for a, name in zip(parts, totals)])


def moving_frames(df: DataFrame, series, order, rows: int, aggregates: dict[str, Column], position: str = "position", block: int = BLOCK) -> DataFrame:
    """``df`` with position and ``aggregates`` (alias -> any aggregate) over the last ``rows`` rows of its series,
    itself included. Series are cut into blocks by position; the last rows of a block are copied to the next one, where
    they fill the frames of its first rows and are dropped again: at most rows / block of all rows are copied."""
    if rows < 1:
        raise ValueError("a frame holds one row at least")
    series, size = list(series), max(block, 4 * rows)
    placed = running_totals(df, series, order, {}, position)
    at = F.col(position) - 1
    own = placed.withColumns({"__block": F.floor(at / size), "__own": F.lit(True)})
    halo = own.where(at % size >= size - (rows - 1)).withColumns({"__block": F.col("__block") + 1, "__own": F.lit(False)})
    frame = Window.partitionBy(*series, "__block").orderBy(position).rowsBetween(-(rows - 1), 0)
    both = own.unionByName(halo).withColumns({name: c.over(frame) for name, c in aggregates.items()})
    return both.where("__own").select(*df.columns, position, *aggregates)


def global_ranks(df: DataFrame, order, ties=(), tiles: int = 100) -> DataFrame:
    """``df`` with row_number, rank, dense_rank, percent_rank and ntile over all its rows in ``order`` (ascending,
    NULLs first); ``ties`` order equal rows for row_number and ntile. No task gets more than a range: equal rows may lie in several
    ranges, and the ranks of those at a range's head are taken from where their run began."""
    order = list(order)
    placed = ordered_parts(df, [*order, *ties], "ranks")
    value = F.struct(*order)
    inside = Window.partitionBy(PART).orderBy(*order)
    placed = placed.withColumns({"__rank": F.rank().over(inside), "__dense": F.dense_rank().over(inside)})
    summary = placed.groupBy(PART).agg(
        F.count("*").alias("__n"), F.max("__dense").alias("__d"), F.min(value).alias("__first"), F.max(value).alias("__last"),
        (F.count("*") - F.max("__rank") + 1).alias("__tail"))
    # one row per range
    past = Window.orderBy(PART)
    before = past.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("__run", F.sum("__tail").over(Window.partitionBy("__last").orderBy(PART).rowsBetween(*UPTO)))
    summary = summary.withColumn("__on", F.coalesce(F.col("__first") == F.lag("__last").over(past), F.lit(False)))
    summary = summary.select(
        F.col(PART).alias("__part_"), "__on", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"), F.lag("__run").over(past).alias("__run0"),
        (F.coalesce(F.sum("__d").over(before), F.lit(0)) - F.sum(F.col("__on").cast("int")).over(past.rowsBetween(*UPTO))).alias("__d0"),
        F.sum("__n").over(Window.partitionBy()).alias("__all"))
    rows = placed.join(F.broadcast(summary), F.col(PART) == F.col("__part_"))
    number = F.col("__n0") + F.col(PLACE) + 1
    rank = F.col("__n0") + F.col("__rank") - F.when(F.col("__on") & (F.col("__rank") == 1), F.col("__run0")).otherwise(0)
    q, r = F.floor(F.col("__all") / tiles), F.col("__all") % tiles
    wide = r * (q + 1)                               # rows in the first, larger tiles
    tile = F.when(number <= wide, F.floor((number - 1) / (q + 1)) + 1).otherwise(F.floor((number - wide - 1) / F.greatest(q, F.lit(1))) + 1 + r)
    return rows.select(*df.columns, number.cast("long").alias("row_number"), rank.cast("long").alias("rank"),
                       (F.col("__d0") + F.col("__dense")).cast("long").alias("dense_rank"),
                       F.when(F.col("__all") > 1, (rank - 1) / (F.col("__all") - 1)).otherwise(0.0).alias("percent_rank"), tile.cast("long").alias("ntile"))
