"""Data-quality reports: bad rows, bad-value counts, NULL re-checks, duplicate
keys, rule violations, metric profiles and primary-key checks.

Every multi-check report is ONE aggregate over the data followed by
``stack``/``inline`` to turn the single wide row into report rows, instead of
a UNION ALL that would scan the input once per check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import labels as L
from larder.functions.expressions import any_of, bad_number, bad_text, col_of, flag_sum


def bad_row_predicate(numeric_cols=(), text_cols=(), zero_is_bad: bool = True) -> Column:
    preds = [bad_number(c, zero_is_bad) for c in numeric_cols] + [bad_text(c) for c in text_cols]
    return any_of(preds)


def bad_rows(df: DataFrame, numeric_cols=(), text_cols=()) -> DataFrame:
    """Rows where any numeric column is NULL or 0, or any text column is NULL or blank."""
    return df.where(bad_row_predicate(numeric_cols, text_cols))


def bad_counts(df: DataFrame, checks: dict) -> DataFrame:
    """One row, one column per check: SUM(CASE WHEN pred THEN 1 ELSE 0 END).

    ``checks`` maps output name → predicate Column. The sums are NULL when the
    input is empty, as in SQL.
    """
    return df.agg(*[flag_sum(pred).alias(name) for name, pred in checks.items()])


def _stack_report(wide: DataFrame, rows, schema_names) -> DataFrame:
    """Turn a one-row aggregate into report rows: ``rows`` is a list of tuples of Columns."""
    structs = [F.struct(*[v.alias(n) for v, n in zip(r, schema_names)]) for r in rows]
    return wide.select(F.inline(F.array(*structs)))


def null_counts(df: DataFrame, cols) -> DataFrame:
    """(NullCount, ColumnName) per column, one scan."""
    wide = df.agg(*[F.count(F.when(col_of(c).isNull(), F.lit(1))).alias(f"_n{i}")
                    for i, c in enumerate(cols)])
    rows = [(F.col(f"_n{i}"), F.lit(c)) for i, c in enumerate(cols)]
    return _stack_report(wide, rows, [L.NULL_COUNT, L.COLUMN_NAME])


def counts_by_condition(df: DataFrame, checks: dict, name_col: str = L.ISSUE_TYPE,
                        count_col: str = L.ISSUE_COUNT) -> DataFrame:
    """(name, COUNT(*) WHERE pred) per named predicate, one scan."""
    names = list(checks)
    wide = df.agg(*[F.count(F.when(checks[n], F.lit(1))).alias(f"_c{i}")
                    for i, n in enumerate(names)])
    rows = [(F.lit(n), F.col(f"_c{i}")) for i, n in enumerate(names)]
    return _stack_report(wide, rows, [name_col, count_col])


def rule_violations(df: DataFrame, available: str = "unitsAvailable",
                    demand: str = "unitsDemanded") -> DataFrame:
    """Availability above demand, and negative availability."""
    a, d = F.col(available), F.col(demand)
    return counts_by_condition(df, {
        L.ISSUE_ABOVE_DEMAND: a > d,
        L.ISSUE_NEGATIVE: a < 0,
    })


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """GROUP BY key HAVING COUNT(*) > 1. Partial aggregation runs before the
    shuffle, so a hot key costs one row per map task, not one per record."""
    key = list(key)
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias(L.DUPLICATE_COUNT))
              .where(F.col(L.DUPLICATE_COUNT) > 1))


def metric_profile(df: DataFrame, metrics: dict) -> DataFrame:
    """(Metric, MinValue, MaxValue, AvgValue) per named column, one scan."""
    names = list(metrics)
    aggs = []
    for i, n in enumerate(names):
        c = col_of(metrics[n])
        aggs += [F.min(c).alias(f"_mn{i}"), F.max(c).alias(f"_mx{i}"), F.avg(c).alias(f"_av{i}")]
    wide = df.agg(*aggs)
    rows = [(F.lit(n), F.col(f"_mn{i}").cast("double"), F.col(f"_mx{i}").cast("double"),
             F.col(f"_av{i}").cast("double")) for i, n in enumerate(names)]
    return _stack_report(wide, rows, list(L.PROFILE_COLUMNS))


def row_count(df: DataFrame, label: str, name_col: str = "TableName",
              count_col: str = L.TOTAL_RECORDS) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(label).alias(name_col), count_col)


def row_counts(tables: dict) -> DataFrame:
    """COUNT(*) of several tables as (TableName, Total_Records) rows."""
    out = None
    for label, df in tables.items():
        part = row_count(df, label)
        out = part if out is None else out.unionByName(part)
    return out


def key_violations(df: DataFrame, key) -> DataFrame:
    """Primary-key check: (Check, ViolationCount) for NULL key parts and for key
    values that occur more than once (counted as extra rows)."""
    key = list(key)
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    # one scan: NULL keys are groups too
    broken = any_of([F.col(c).isNull() for c in key])
    wide = groups.agg(F.coalesce(F.sum(F.when(broken, F.col("_n"))), F.lit(0)).cast("long").alias("_nulls"),
                      F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("_dups"))
    return _stack_report(wide, [(F.lit("null key"), F.col("_nulls")), (F.lit("duplicate key"), F.col("_dups"))],
                         ["Check", "ViolationCount"])


class KeyViolation(ValueError):
    pass


def assert_key(df: DataFrame, key) -> None:
    """Raise if ``key`` is not a unique, non-NULL key of ``df`` (what a PRIMARY
    KEY constraint would reject). Collects two numbers, never the rows."""
    bad = {r["Check"]: r["ViolationCount"] for r in key_violations(df, key).collect()}
    if any(v for v in bad.values()):
        raise KeyViolation(f"key {list(key)} violated: {bad}")
