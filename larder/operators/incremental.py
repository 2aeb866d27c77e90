"""Loading into tables that already hold rows: append without repeats, MERGE and DELETE.

All three find out which partitions a batch touches and read and write
those folders alone (``FolderTable``). Keys must contain the partition column or a column that
determines it, so that equal keys lie in one folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.dedup import keep_first
from larder.operators.key_registry import same_key
from larder.session import write_scratch
from larder.sources.tables import FolderTable


class BatchRefused(ValueError):
    """A batch that would break the table; nothing was written."""


# --- changed partitions -----------------------------------------------------

def fingerprints(source: DataFrame, partition: str) -> DataFrame:
    """(partition, n, sum, xor) of the row hashes per partition: equal for equal rows in any order.
    The sum adds up thirds of the hashes as longs, which is much cheaper than decimals and exact up to 2^41 rows."""
    low = F.lit((1 << 22) - 1)
    hashed = source.select(partition, F.xxhash64(*source.columns).alias("__h"))
    parts = [F.sum(c).cast("decimal(38,0)") for c in (F.shiftright("__h", 44), F.shiftright("__h", 22).bitwiseAND(low), F.col("__h").bitwiseAND(low))]
    total = F.lit(1 << 44).cast("decimal(15,0)") * parts[0].cast("decimal(22,0)") + F.lit(1 << 22).cast("decimal(15,0)") * parts[1].cast("decimal(22,0)") + parts[2]
    return hashed.groupBy(partition).agg(F.count("*").alias("n"), total.cast("decimal(38,0)").alias("sum"), F.bit_xor("__h").alias("xor"))


def changed_partitions(source: DataFrame, partition: str, ledger: DataFrame | None) -> tuple[list, DataFrame]:
    """The partitions whose rows are not those of ``ledger`` (fingerprints of an earlier load), and the
    new ledger. One scan of ``source``; a partition costs one row of the ledger."""
    now = write_scratch(fingerprints(source, partition), "fingerprints")
    if ledger is None:
        fresh = now
    else:
        fresh = now.join(ledger.select(*[F.col(c).alias(c + "_old") for c in now.columns]),
                         F.col(partition).eqNullSafe(F.col(partition + "_old")) & (F.col("n") == F.col("n_old"))
                         & (F.col("sum") == F.col("sum_old")) & (F.col("xor") == F.col("xor_old")), "left_anti")
    return sorted((r[0] for r in fresh.select(partition).collect()), key=lambda v: (v is not None, v)), now


# --- append -----------------------------------------------------------------

def append_new(table: FolderTable, batch: DataFrame, key, order, values: list | None = None) -> None:
    """Append the first row per key of ``batch`` (in ``order``) unless the table has the key. History wins over
    the batch, and a batch that comes twice adds nothing. NULL key parts are equal.
    ``values``: the partitions of the batch, if the caller knows them; else a pass finds them."""
    key = list(dict.fromkeys([*key, table.partition]))
    values = table.values_in(batch) if values is None else values
    if not values:
        return
    fresh = keep_first(batch, key, order)
    have = table.read(values).select(*[F.col(c).alias(c + "__have") for c in key])
    table.append(fresh.join(have, same_key(fresh, have, key, "__have"), "left_anti"))


def load_changed(table: FolderTable, source: DataFrame, key, order, ledger: DataFrame | None = None) -> tuple[list, DataFrame]:
    """One load from a source that holds all rows so far: only partitions that changed since ``ledger`` are read
    again and compared with the table. Returns them and the ledger for the next load."""
    values, now = changed_partitions(source, table.partition, ledger)
    column = F.col(table.partition)
    known = [v for v in values if v is not None]
    changed = column.isin(known) if known else F.lit(False)
    append_new(table, source.where(changed | column.isNull() if None in values else changed), key, order, values)
    return values, now


# --- MERGE and DELETE -------------------------------------------------------

def merge(table: FolderTable, batch: DataFrame, key, update, delete_when: Column | None = None,
          checks: dict[str, Callable[[DataFrame], Column]] | None = None) -> dict:
    """MERGE INTO table USING batch ON key: matched rows for which ``delete_when`` (over the batch's columns) holds go, other
    matched rows take the ``update`` columns from the batch, unmatched batch rows are inserted unless ``delete_when`` holds.

    The touched folders are read (their keys once more, to count), joined and written anew; all others stay as they are.
    The batch is refused, before anything is written, if a key repeats in it, its partition is NULL or
    a check (name -> condition that a bad row meets) finds a row. NULL key parts are equal.
    Returns the numbers of rows updated, inserted and deleted."""
    key = list(dict.fromkeys([*key, table.partition]))
    gone = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    staged = write_scratch(batch.withColumn("__gone", gone), "merge-batch")
    _refuse(table, staged, key, checks or {})
    values = table.values_in(staged)
    if not values:
        return {"updated": 0, "inserted": 0, "deleted": 0}
    old = table.read(values).withColumn("__old", F.lit(True))
    new = staged.select(*[F.col(c).alias(c + "__new") for c in staged.columns], F.lit(True).alias("__new"))
    joined = old.join(new, same_key(old, new, key, "__new"), "full")
    matched, lone = F.col("__old") & F.col("__new"), F.col("__old").isNull()
    gone = F.coalesce(F.col("__gone__new"), F.lit(False))
    done = joined.agg(F.count(F.when(matched & ~gone, 1)).alias("updated"), F.count(F.when(lone & ~gone, 1)).alias("inserted"),
                      F.count(F.when(matched & gone, 1)).alias("deleted")).first().asDict()
    wanted = set(update)
    rows = joined.where(~gone).select(*[
        F.when(lone | F.col("__new") if c in wanted else lone, F.col(c + "__new")).otherwise(F.col(c)).alias(c) if c + "__new" in joined.columns else F.col(c)
        for c in table.schema.names])
    table.replace(rows, values)
    return done


def _refuse(table: FolderTable, staged: DataFrame, key: list, checks: dict) -> None:
    missing = [c for c in key if c not in staged.columns]
    if missing:
        raise BatchRefused(f"the batch has no column {missing}")
    bad = {"NULL partition": F.col(table.partition).isNull(), **{name: check(staged) for name, check in checks.items()}}
    counts = staged.agg(*[F.count(F.when(c, 1)).alias(name) for name, c in bad.items()]).first().asDict()
    counts["repeated key"] = staged.groupBy(*key).count().where("count > 1").limit(1).count()
    found = {name: n for name, n in counts.items() if n}
    if found:
        raise BatchRefused(f"refused: {found}")


def delete(table: FolderTable, condition: Column) -> list:
    """DELETE FROM table WHERE condition. Folders without such a row are not rewritten; returns
    the partitions that were. A condition that is NULL keeps the row."""
    values = table.values_in(table.read().where(condition))
    if values:
        table.replace(table.read(values).where(~F.coalesce(condition, F.lit(False))), values)
    return values
