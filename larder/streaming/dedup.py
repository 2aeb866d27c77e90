"""Keep-first de-duplication of a stream of files into a standing table.

Per key and day the first row in the order of ``order`` stays, however the rows are spread over files and micro-batches.
The state holds one row per key of the days that the watermark has not passed; when a batch
finds an earlier row of a key, the table's row is replaced by MERGE, which touches that day's folder alone. So the table equals
keep-first over all files at any time, but for rows that come later than ``delay`` behind the latest
event: these are dropped and counted. A stopped stream goes on from its checkpoint; a batch that runs twice
merges the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.expressions import date_key
from larder.operators.incremental import merge
from larder.sources.tables import FolderTable

DAY = "DateKey"


@dataclass
class StreamReport:
    batches: int
    rows_in: int
    rows_late: int


def first_per_day(stream: DataFrame, key, time: str, order, delay: str) -> DataFrame:
    """The first row per key and day of ``time``, for streams and tables alike; ``DateKey`` is the day."""
    rest = [c for c in stream.columns if c not in key]
    ordered = [*order, *[c for c in rest if c not in order]]
    timed = stream.withColumn("__at", F.col(time).cast("timestamp"))
    kept = timed.withWatermark("__at", delay).groupBy(F.window("__at", "1 day").alias("__day"), *key).agg(F.min(F.struct(*ordered)).alias("__first"))
    return kept.select(date_key(F.col("__day.start")).alias(DAY), *[F.col(c) if c in key else F.col(f"__first.{c}").alias(c) for c in stream.columns])


def dedup_stream(spark: SparkSession, files: str, schema: T.StructType, table: FolderTable, checkpoint: str, key, time: str, order, delay: str = "2 days",
                 files_per_batch: int = 1000) -> StreamReport:
    """Take all files of the folder ``files`` that the checkpoint has not seen, in micro-batches, and return what came.
    Rows whose key or time is NULL are left out, as are rows beyond the watermark (``rows_late``)."""
    key = list(key)
    usable = " AND ".join(f"`{c}` IS NOT NULL" for c in [*key, time])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(files).where(usable)
    others = [c for c in schema.names if c not in key]

    def upsert(batch: DataFrame, _: int) -> None:
        merge(FolderTable(batch.sparkSession, table.path, table.schema, table.partition), batch, [*key, DAY], others)

    query = (first_per_day(stream, key, time, order, delay).writeStream.outputMode("update").foreachBatch(upsert)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    done = query.recentProgress
    late = sum(op["numRowsDroppedByWatermark"] for p in done for op in p["stateOperators"])
    return StreamReport(sum(p["numInputRows"] > 0 for p in done), sum(p["numInputRows"] for p in done), late)
