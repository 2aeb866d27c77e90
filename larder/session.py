"""Spark session helpers: one place for the configuration the operators assume."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. AQE re-plans joins from runtime sizes
# (broadcast only what actually turned out small) and splits skewed join
# partitions; timestamps in the inputs are zone-less, UTC keeps date math stable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "larder", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster use the cluster's own session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset (local
    tests) a folder inside the session's warehouse is taken, if that is shared: on a
    cluster a warehouse on a local disk, which is Spark's default, is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        shared = warehouse and (sc.master.startswith("local") or not _on_local_disk(warehouse))
        if not shared:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = warehouse.rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


# Folders handed out by shared_scratch that nobody has dropped yet.
_SCRATCH: set[str] = set()


def _on_local_disk(path: str) -> bool:
    return "://" not in path.replace("file://", "file:") and (path.startswith(("file:", "/")) or ":" not in path)


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location.

    Used for tables that an operator writes between its steps and for sinks
    exercised inside a query, so nothing lands on a machine-local disk.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/larder-{name}-{uuid.uuid4().hex}"
    _SCRATCH.add(path)
    return path


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and
    fixes values that depend on the physical partitions. It stays until
    ``clear_scratch``, as frames returned to the caller may read it."""
    path = shared_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch folder; call it once the results that read them are used."""
    while _SCRATCH:
        drop_path(spark, _SCRATCH.pop())


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_scratch``, on whatever store it lies."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    _SCRATCH.discard(path)


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
