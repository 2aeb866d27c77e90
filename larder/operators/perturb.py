"""Deterministic data-quality injection and duplicate appending.

The injection rules key on a row id modulo a number instead of a random draw,
so the same rows are hit on every run and in any engine (SQL can express
the same rule), while the hit rate still equals 1/modulus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.keys import rekey


@dataclass(frozen=True)
class Rule:
    """When ``id % modulus == residue``: 'null' → NULL, 'scale' → x * factor,
    'negate' → -x - 1 (a strictly negative value even for x = 0)."""
    kind: str
    modulus: int
    residue: int
    factor: float = 1.0

    def apply(self, c):
        if self.kind == "null":
            return F.lit(None).cast("double")
        if self.kind == "scale":
            return c * F.lit(self.factor)
        if self.kind == "negate":
            return -c - F.lit(1)
        raise ValueError(f"unknown rule kind {self.kind!r}")


def perturb(df: DataFrame, column: str, id_col: str, rules) -> DataFrame:
    """Apply ``rules`` to ``column`` as one CASE chain: the first matching rule wins.
    NULL values stay NULL under 'scale' and 'negate'."""
    c = F.col(column)
    idc = F.col(id_col)
    expr = None
    for r in rules:
        cond = (idc % F.lit(r.modulus)) == F.lit(r.residue)
        expr = F.when(cond, r.apply(c)) if expr is None else expr.when(cond, r.apply(c))
    if expr is None:
        return df
    return df.withColumn(column, expr.otherwise(c))


def mask_nulls(df: DataFrame, column: str, id_col: str, modulus: int = 20,
               residue: int = 0) -> DataFrame:
    """Set ``column`` to NULL on 1/modulus of the rows."""
    return perturb(df, column, id_col, [Rule("null", modulus, residue)])


def scale_outliers(df: DataFrame, column: str, id_col: str, factor: float,
                   modulus: int = 50, residue: int = 0) -> DataFrame:
    """Multiply ``column`` by ``factor`` on 1/modulus of the rows (NULL stays NULL)."""
    return perturb(df, column, id_col, [Rule("scale", modulus, residue, factor)])


def append_duplicates(df: DataFrame, id_col: str, modulus: int = 50, residue: int = 0,
                      renumber: bool = True) -> DataFrame:
    """Append a copy of 1/modulus of the rows (picked by id), then optionally
    re-number the ids densely so every row has a unique id again."""
    copies = df.where((F.col(id_col) % F.lit(modulus)) == F.lit(residue))
    out = df.unionByName(copies)
    return rekey(out, id_col) if renumber else out
