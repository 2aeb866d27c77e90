"""Tables that a job writes to the shared folder between its steps.

A written table cuts the lineage: an executor lost later costs only the tasks
that read it. The folder is the one the cluster names in spark.checkpoint.dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import drop_path, shared_scratch


class Scratch:
    """Named intermediate tables of one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = shared_scratch(spark, name)
        self.step = 0
        self.paths: set[str] = set()

    def write(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as Parquet and read it back; ``drop`` takes the result."""
        self.step += 1
        path = f"{self.base}/{self.step}"
        self.paths.add(path)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for table in tables:
            drop_path(self.spark, table.scratch_path)
            self.paths.discard(table.scratch_path)

    def finish(self, df: DataFrame) -> DataFrame:
        """Write the last table, delete all others of this run and return it."""
        out = self.write(df)
        for path in self.paths - {out.scratch_path}:
            drop_path(self.spark, path)
        self.paths = {out.scratch_path}
        return out


def row_key(id_col: str, text_col: str):
    """Hash of a row's id and text: with the id itself it tells rows apart whose
    ids repeat. Rows equal in both count as copies of one another."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def crc_mod(id_col: str, n: int):
    """crc32 of the id as text, modulo n; null ids give 0."""
    as_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % n
