"""Surrogate keys that stay the same from load to load (IDENTITY / AUTO_INCREMENT on a standing table).

``dense_index`` numbers what one input holds; another input gives other numbers.
A registry keeps what it gave out: a load registers only the natural keys that
it does not know yet and numbers them from the high-water mark on, in the order of the
natural key. Keys given out before never move, also where a later natural key sorts before them.

Each load is a folder of its own and a commit row (load, number of keys, high-water mark). Readers
take committed loads alone, and the mark comes from the commit rows, so no
load scans the keys for their maximum. A load that failed before its commit is
overwritten by the next one. One load at a time is assumed.

NULL parts of a natural key are equal to each other; repeated rows are one key; an empty
batch commits nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.keys import dense_index
from larder.session import drop_path

LOAD = "FirstLoad"
COMMIT = "load long, n_keys long, high_water long"


def same_key(left: DataFrame, right: DataFrame, columns, tail: str = ""):
    """Null-safe equality on all columns; ``tail`` marks the right side's names."""
    return reduce(and_, [left[c].eqNullSafe(right[c + tail]) for c in columns])


class KeyRegistry:
    """natural key -> ``name``, under a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, natural_key: T.StructType, name: str):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.natural_key = [f.name for f in natural_key.fields]
        self.schema = T.StructType([T.StructField(name, T.LongType()), *natural_key.fields, T.StructField(LOAD, T.LongType())])

    def _exists(self, path: str) -> bool:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop_path)

    def commits(self) -> list:
        """One row per committed load, in order."""
        path = f"{self.path}/commits"
        if not self._exists(path):
            return []
        return self.spark.read.schema(COMMIT).parquet(path).orderBy("load").collect()

    def read(self) -> DataFrame:
        """(name, natural key, FirstLoad) of all committed loads."""
        paths = [f"{self.path}/keys/load={c.load}" for c in self.commits()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def unknown(self, batch: DataFrame) -> DataFrame:
        """The natural keys of ``batch`` that have no key yet. Both sides go by the whole natural key,
        repeats within the batch collapse before the shuffle."""
        new = batch.select(*[batch[f].cast(self.schema[f].dataType).alias(f) for f in self.natural_key]).distinct()
        known = self.read().select(*[F.col(c).alias(c + "__known") for c in self.natural_key])
        return new.join(known, same_key(new, known, self.natural_key, "__known"), "left_anti")

    def register(self, batch: DataFrame) -> int:
        """Give keys to the unknown natural keys of ``batch``; returns their number."""
        commits = self.commits()
        load = commits[-1]["load"] + 1 if commits else 1
        high = commits[-1]["high_water"] if commits else 0
        numbered = dense_index(self.unknown(batch), self.natural_key, self.name, start=high + 1)
        path = f"{self.path}/keys/load={load}"
        if self._exists(path):                       # of a load that ended before its commit
            drop_path(self.spark, path)
        numbered.select(self.name, *self.natural_key, F.lit(load).cast("long").alias(LOAD)).write.parquet(path)
        n = self.spark.read.schema(self.schema).parquet(path).count()
        if n:
            self.spark.createDataFrame([(load, n, high + n)], COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        else:
            drop_path(self.spark, path)
        return n

    def keyed(self, batch: DataFrame) -> DataFrame:
        """``batch`` with the key of every row; NULL where the natural key is not registered."""
        known = self.read().select(self.name, *[F.col(c).alias(c + "__known") for c in self.natural_key])
        return batch.join(known, same_key(batch, known, self.natural_key, "__known"), "left").select(self.name, *batch.columns)
