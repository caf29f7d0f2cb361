"""Tables and texts that the operators of this package write and read."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import new_table_path


#: Parts that a host's rows are joined in where the join is not a broadcast.
SALTS = 32


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, and its path: lineage ends here."""
    path = new_table_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Removes a table that ``written`` made."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def size_on_disk(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.getContentSummary(target).getLength()


def bytes_of(setting: str) -> int:
    """The bytes that a size setting such as 10485760b, 256k or 64MB stands for."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", setting.lower()).groups()
    return int(number) << 10 * "bkmgtp".index((unit or "b")[0])


def per_host(table: DataFrame, spread: Column) -> tuple[DataFrame, Column]:
    """``table``, of one row per host, written and with ``_salt``; and the rows' own salt.

    Joined on the host and the salt to a large table whose rows ``spread`` tells apart. The
    written table has a known size: within Spark's broadcast threshold the large side is
    not shuffled, and there is one salt. Beyond it each host's row is repeated ``SALTS``
    times, which spreads a hot host over as many tasks.
    """
    spark = table.sparkSession
    table, path = written(table, "per-host")
    limit = bytes_of(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    if size_on_disk(spark, path) <= limit:
        return table.withColumn("_salt", F.lit(0)), F.lit(0)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return table.withColumn("_salt", salts), F.pmod(spread, F.lit(SALTS)).cast("int")


def sample_share(count: int, rows: int) -> float:
    """The share of ``count`` rows that makes a sample of ``rows`` at most.

    Four standard errors below the whole, so that a draw by hash stays within it.
    """
    return 1.0 if count <= rows else max(rows - 4 * rows**0.5, 1) / count


def drawn(share, *keys) -> Column:
    """Whether the hash of the keys falls into ``share`` (a number or a column) of all."""
    bits = F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double")
    return bits < F.lit(float(2**53)) * share


def held_out(key: str, parts: int, part: int):
    """Whether crc32 of the key as text falls in ``part``; a null key does not."""
    value = F.crc32(F.col(key).cast("string").cast("binary")) % parts == part
    return F.coalesce(value, F.lit(False))
