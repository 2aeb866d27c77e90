"""Exact upper-percentile caps (PERCENTILE_CONT … WITHIN GROUP) at any scale.

Spark's exact ``percentile`` aggregate keeps a value → count map per column and
merges all of them in one final task, so its memory grows with the number of
distinct values. Here the exact value is found by one scan and one range sort:

1. values are counted per column and value (repeated values collapse map-side);
2. the counted values are written in ranges of (column, value), and the rows
   of each range are summed: a few numbers per range travel to the driver;
3. the two neighbouring ranks fall into one or two ranges; a running sum over
   those ranges alone picks the values, which are interpolated as PERCENTILE_CONT does.

The path is the same at every size and for any number of distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.expressions import cap_upper, rounded
from larder.operators.keys import PART, PLACE, ordered_parts


def percentile_frame(df: DataFrame, cols, p: float = 0.99, scale: int | None = 2,
                     parts: int | None = None) -> DataFrame:
    """(column_name, percentile, cap) per column: exact PERCENTILE_CONT(p),
    NULLs ignored, and the cap rounded half-up to ``scale`` decimals. Reads ``df`` once."""
    cols = list(cols)
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v"))
                               for c in cols]))
    counts = (df.select(*cols).select(pairs).where("v IS NOT NULL")
                .groupBy("name", "v").agg(F.count(F.lit(1)).alias("n")))
    ranged = ordered_parts(counts, ["name", "v"], "percentile", parts)
    # bounded: one row per range and column
    sums: dict[str, list] = {c: [] for c in cols}
    for r in ranged.groupBy("name", PART).agg(F.sum("n").alias("n")).orderBy("name", PART).collect():
        sums[r["name"]].append((r[PART], r["n"]))
    picks = {c: _ranks(sums[c], p) for c in cols}
    value = _picked(ranged, {c: pick for c, pick in picks.items() if pick})
    # one row per column; without values PERCENTILE_CONT is NULL
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    out = names.join(F.broadcast(value), "column_name", "left") if value is not None else names.withColumn("percentile", F.lit(None).cast("double"))
    cap = F.col("percentile") if scale is None else rounded("percentile", 38, scale).cast("double")
    return out.select("column_name", "percentile", cap.alias("cap"))


def _ranks(sums: list, p: float):
    """(rank, next rank, position between them, {range: values before it}) of the percentile; None without values."""
    total = sum(n for _, n in sums)
    if not total:
        return None
    pos = p * (total - 1)
    k = int(math.floor(pos))
    k2 = min(k + 1, total - 1)
    before, wanted = 0, {}
    for part, n in sums:
        if before <= k2 and before + n > k:
            wanted[part] = before
        before += n
    return k, k2, pos, wanted


def _picked(ranged: DataFrame, picks: dict) -> DataFrame | None:
    """(column_name, percentile): all columns' values out of the one or two ranges that hold them, in one scan."""
    if not picks:
        return None
    chosen = lambda use: F.coalesce(*[F.when(F.col("name") == c, use(pick)) for c, pick in picks.items()])
    lead = F.coalesce(*[F.when((F.col("name") == c) & (F.col(PART) == part), F.lit(before)) for c, (*_, wanted) in picks.items() for part, before in wanted.items()])
    near = ranged.withColumn("lead", lead).where("lead IS NOT NULL")
    # one or two ranges a column: each is a fixed share of the distinct values
    running = Window.partitionBy("name", PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.select("name", "v", (F.sum("n").over(running) + F.col("lead")).alias("upto"))
    at = lambda rank: F.min(F.when(F.col("upto") > chosen(rank), F.col("v")))
    picked = near.groupBy("name").agg(at(lambda x: F.lit(x[0])).alias("lo"), at(lambda x: F.lit(x[1])).alias("hi"))
    value = chosen(lambda x: F.col("lo") if x[0] == x[1] else F.lit(x[1] - x[2]) * F.col("lo") + F.lit(x[2] - x[0]) * F.col("hi"))
    return picked.select(F.col("name").alias("column_name"), value.cast("double").alias("percentile"))


def exact_percentiles(df: DataFrame, cols, p: float = 0.99, scale: int | None = None,
                      parts: int | None = None) -> dict:
    """{column: value} of PERCENTILE_CONT(p) (rounded to ``scale`` if given)."""
    rows = percentile_frame(df, cols, p, scale, parts).collect()
    return {r["column_name"]: r["percentile" if scale is None else "cap"] for r in rows}


def apply_caps(df: DataFrame, caps: dict) -> DataFrame:
    """x = cap WHERE x > cap for each column; caps are literals (no join)."""
    return df.select(*[cap_upper(c, caps[c]).alias(c) if caps.get(c) is not None else F.col(c)
                       for c in df.columns])


def cap_outliers(df: DataFrame, cols, p: float = 0.99, scale: int | None = 2, **kw):
    """Upper-tail capping at the p-th percentile. Both caps are taken before
    either column changes. Returns (capped frame, {column: cap})."""
    caps = exact_percentiles(df, cols, p, scale=scale, **kw)
    return apply_caps(df, caps), caps
