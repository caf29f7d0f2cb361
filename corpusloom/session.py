"""Session settings the operators are written for, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings recommended on every cluster. Aggregates run before joins
#: throughout the package, so skew left over after partial aggregation sits on one
#: side of a join and is split by AQE.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark compares each table's size with this before it broadcasts one.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # Lets AQE hash instead of sort where every partition of a side is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}

_local_folder: str | None = None


def local_session(cores: int | str = "*", memory: str = "16g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    parallelism = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.sql.shuffle.partitions", str(parallelism))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where it is set.

    Only a local session may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="corpusloom-")
    return _local_folder


def new_table_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and fixes the rows, so that a value which depends on the physical
    layout (a partition number) stays the same when a lost executor is replaced. Unlike
    a checkpointed RDD the table is columnar and carries its size, which lets Spark
    choose join strategies and prune columns.
    """
    path = new_table_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartition by ``key`` only when the scan has fewer tasks than there are cores.

    A large table already arrives in many splits and passes through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
