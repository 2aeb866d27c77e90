"""Aggregates over several groupings at once: ROLLUP, CUBE, GROUPING SETS, several DISTINCT counts, stored sketches."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.session import write_scratch

EXACT = T.DecimalType(28, 10)


def rollup_sets(dims) -> list[tuple]:
    return [tuple(dims[:k]) for k in range(len(dims), -1, -1)]


def cube_sets(dims) -> list[tuple]:
    return [s for k in range(len(dims), -1, -1) for s in combinations(dims, k)]


def grouping_sets(df: DataFrame, dims, sets, measures: dict[str, str], parents: dict | None = None) -> DataFrame:
    """One row per group of each of ``sets`` (subsets of ``dims``): the dimensions (NULL where not grouped by),
    grouping_id (a bit per dimension, the first the highest, set where it is not grouped by), n_rows, and for each
    measure (alias -> column) alias_sum, alias_count, alias_min, alias_max and alias_avg.

    The input is read once, into partial aggregates of the finest grouping; these are written, and every coarser set is made from the
    smallest set already there that contains it, never from the rows. Partial aggregates merge in
    any order: sums are decimals. A set without dimensions has one row, also for an empty input."""
    dims = list(dims)
    sets = [tuple(d for d in dims if d in s) for s in dict.fromkeys(map(tuple, sets))]
    parts = ["__n"]
    first = [F.count(F.lit(1)).alias("__n")]
    again = [F.coalesce(F.sum("__n"), F.lit(0)).alias("__n")]
    for a, c in measures.items():
        first += [F.sum(F.col(c).cast(EXACT)).alias(f"{a}__s"), F.count(c).alias(f"{a}__c"), F.min(c).alias(f"{a}__lo"), F.max(c).alias(f"{a}__hi")]
        again += [F.sum(f"{a}__s").cast(T.DecimalType(38, 10)).alias(f"{a}__s"), F.coalesce(F.sum(f"{a}__c"), F.lit(0)).alias(f"{a}__c"),
                  F.min(f"{a}__lo").alias(f"{a}__lo"), F.max(f"{a}__hi").alias(f"{a}__hi")]
    levels = {tuple(dims): write_scratch(df.groupBy(*dims).agg(*first), "lattice")}
    sizes = {tuple(dims): levels[tuple(dims)].count()}
    for s in sorted(dict.fromkeys(sets), key=len, reverse=True):
        if s in levels:
            continue
        source = min((k for k in levels if set(s) <= set(k)), key=lambda k: (sizes[k], len(k)))
        if parents is not None:
            parents[s] = source
        made = levels[source].groupBy(*s).agg(*again)
        feeds = any(set(t) < set(s) for t in sets)   # a level from which no other is made need not be written
        levels[s] = write_scratch(made, "lattice") if feeds else made
        sizes[s] = levels[s].count() if feeds else float("inf")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for s in dict.fromkeys(sets):
        gid = sum(1 << (len(dims) - 1 - k) for k, d in enumerate(dims) if d not in s)
        columns = [F.col(d) if d in s else F.lit(None).cast(kinds[d]).alias(d) for d in dims]
        out = [F.col("__n").alias("n_rows")]
        for a in measures:
            out += [F.col(f"{a}__s").cast("double").alias(f"{a}_sum"), F.col(f"{a}__c").alias(f"{a}_count"), F.col(f"{a}__lo").alias(f"{a}_min"),
                    F.col(f"{a}__hi").alias(f"{a}_max"), (F.col(f"{a}__s").cast("double") / F.nullif(F.col(f"{a}__c"), F.lit(0))).alias(f"{a}_avg")]
        rows.append(levels[s].select(*columns, F.lit(gid).alias("grouping_id"), *out))
    return reduce(DataFrame.unionByName, rows)


def distinct_counts(df: DataFrame, group, columns: dict[str, str]) -> DataFrame:
    """COUNT(DISTINCT c) of several columns per group (alias -> column; NULL values don't count, NULL groups are groups).

    One aggregation over all of them would repeat every row per column before the shuffle. Here each column is a scan
    of its own of two columns; equal (group, value) pairs collapse in the tasks that read them, and are dealt by both, so a group with most of the
    rows is spread by its values."""
    group = list(group)
    counts = []
    for alias, column in columns.items():
        pairs = df.select(*group, F.col(column).alias("__v")).distinct()
        counts.append(pairs.groupBy(*group).agg(F.count("__v").alias("__count")).select(*group, F.lit(alias).alias("__of"), "__count"))
    return reduce(DataFrame.unionByName, counts).groupBy(*group).agg(*[
        F.coalesce(F.sum(F.when(F.col("__of") == a, F.col("__count"))), F.lit(0)).cast("long").alias(a) for a in columns])


# --- sketches ----------------------------------------------------------------

LG_CONFIG = 14               # 2**14 registers: a standard error of about 0.65 %
KLL_SIZE = 800               # rank error of about 0.5 %


def sketch_table(df: DataFrame, by, distinct: str, quantile: str, name: str = "sketches") -> DataFrame:
    """One row per group: a sketch of the distinct ``distinct`` values and one of the ``quantile`` values' distribution,
    stored. Its size per group is bounded, whatever the rows."""
    made = df.groupBy(*by).agg(F.hll_sketch_agg(F.col(distinct).cast("string"), LG_CONFIG).alias("values"),
                               F.kll_sketch_agg_double(F.col(quantile).cast("double"), KLL_SIZE).alias("ranks"))
    return write_scratch(made, name)


def merged_sketches(sketches: DataFrame, by, quantiles) -> DataFrame:
    """Coarser groups out of stored sketches, without the rows: n_distinct and quantiles (fraction -> q_<percent>)."""
    merged = sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("values")).alias("n_distinct"),
                                       F.kll_merge_agg_double("ranks").alias("__ranks"))
    cut = [F.kll_sketch_get_quantile_double("__ranks", F.lit(float(q))).alias(f"q_{round(q * 100)}") for q in quantiles]
    return merged.select(*by, "n_distinct", *cut)
