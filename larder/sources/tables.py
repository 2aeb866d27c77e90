"""Standing Parquet tables with one folder per value of a partition column.

``FolderTable`` reads, appends to and rewrites whole folders, and never more of
them than asked for: a caller that knows which partitions a batch touches pays for
those alone, however many the table has. One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from larder.session import drop_path


class FolderTable:
    """A table of a declared layout under ``path``, partitioned by an integer or date column."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition: str):
        if not isinstance(schema[partition].dataType, (T.IntegerType, T.LongType, T.DateType)):
            raise TypeError("the partition column is an integer or a date")
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self.schema = T.StructType([*[f for f in schema.fields if f.name != partition], schema[partition]])

    # --- folders ---------------------------------------------------------

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def folder(self, value) -> str:
        return f"{self.path}/{self.partition}={value}"

    def files(self, value) -> set[str]:
        """Names of a partition's data files; empty where it has no folder."""
        fs, path = self._fs(self.folder(value))
        if not fs.exists(path):
            return set()
        return {s.getPath().getName() for s in fs.listStatus(path) if s.isFile() and not s.getPath().getName().startswith(("_", "."))}

    def values_in(self, df: DataFrame) -> list:
        """The partition values that occur in ``df``, in order. Their number is bounded by the table's folders."""
        return sorted((r[0] for r in df.select(self.partition).distinct().collect()), key=lambda v: (v is not None, v))

    # --- rows ------------------------------------------------------------

    def read(self, values=None) -> DataFrame:
        """All rows, or those of some partitions: only their folders are listed and read."""
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        if values is None:
            fs, path = self._fs(self.path)
            paths = [self.path] if fs.exists(path) and any(s.isDirectory() and s.getPath().getName().startswith(f"{self.partition}=") for s in fs.listStatus(path)) else []
        else:
            paths = [self.folder(v) for v in values if self.files(v)]
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def shaped(self, df: DataFrame) -> DataFrame:
        """The table's columns, in its order and types; rebalanced, so that a partition's rows go to few
        files and one that holds much of the data is split over tasks."""
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields]).hint("rebalance", self.partition)

    def append(self, df: DataFrame) -> None:
        self.shaped(df).write.mode("append").partitionBy(self.partition).parquet(self.path)

    def replace(self, df: DataFrame, values) -> None:
        """Let ``df`` be all rows of the partitions ``values``; it may read them. Spark writes to
        a staging folder and swaps the folders at the end, so a job that fails leaves the table as it was."""
        before = {v: self.files(v) for v in values}
        self.shaped(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(self.path)
        for value, names in before.items():
            if names and self.files(value) == names:      # no row was written: nothing is left of it
                drop_path(self.spark, self.folder(value))
