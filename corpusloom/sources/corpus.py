"""Corpus tables: declared schemas, readers, line view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import strip
from corpusloom.operators.indexing import with_index

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("genre", T.StringType()),
    ]
)


def read_corpus(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = CORPUS_SCHEMA,
    **options: str,
) -> DataFrame:
    """Read a corpus table as ``schema``, by column name; columns it lacks come back null.

    Rows without content are left out, as nothing downstream can use them;
    ``count_missing_content`` reports how many there are. Where no row has an ``id``, each
    gets one from its content (see ``with_text_id``).
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options = {"header": "true", "multiLine": "true", "escape": '"', **options}
    elif fmt == "json":
        reader = reader.schema(schema)  # by name already, and nothing has to be inferred
    found = reader.options(**options).load(path)
    named = {name.lower(): name for name in found.columns}
    columns = [
        (F.col(f"`{named[f.name.lower()]}`") if f.name.lower() in named else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in schema
    ]
    df = found.select(*columns).filter(F.col("content").isNotNull())
    without = "id" not in named or (fmt == "json" and df.filter("id is not null").isEmpty())
    if "id" in schema.names and without:
        df = with_text_id(df.drop("id")).select(*schema.names)
    return df


#: Copies of one row that are made in one task.
COPIES = 10_000


def with_text_id(df: DataFrame) -> DataFrame:
    """Add ``id``: a hash of the row, and from the second equal row on its number.

    The same rows get the same ids whatever order they are read in. Equal rows are counted
    and made again in parts, so that very many of them do not meet in one task.
    """
    keyed = df.withColumn("_hash", F.substring(F.sha2(F.to_json(F.struct(*df.columns)), 256), 1, 32))
    sizes = keyed.groupBy("_hash").agg(F.count("*").alias("_n"))
    parts = F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES))
    single = keyed.dropDuplicates(["_hash"]).join(sizes, "_hash")
    parted = single.withColumn("_part", F.explode(parts)).repartition("_hash", "_part")
    first = F.col("_part") * COPIES + 1
    copies = F.sequence(first, F.least(first + COPIES - 1, F.col("_n")))
    numbered = parted.withColumn("_k", F.explode(copies))
    suffix = F.when(F.col("_k") == 1, "").otherwise(F.concat(F.lit("-"), F.col("_k")))
    return numbered.withColumn("id", F.concat("_hash", suffix)).drop("_hash", "_n", "_k", "_part")


def count_missing_content(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("content").isNull()).alias("missing"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as ``(file, line_no, line)``: one stripped line per row, numbered from 0.

    A large file is read in splits; where a split begins in its file and the order of rows
    inside it give the order, and one dense index over all files the numbers.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row_in_task"),
        strip(F.col("value")).alias("line"),
    )
    placed = with_index(raw, ["file", "_block", "_row_in_task"], "_idx")
    first = placed.groupBy("file").agg(F.min("_idx").alias("_first"))
    return placed.join(first, "file").select(
        "file", (F.col("_idx") - F.col("_first")).alias("line_no"), "line"
    )


def read_token_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stored stream ``(pos, token_id)`` as ``write_token_stream`` leaves it."""
    return spark.read.schema("pos bigint, token_id bigint").parquet(path)


def write_token_stream(stream: DataFrame, path: str) -> None:
    stream.select("pos", "token_id").write.mode("overwrite").parquet(path)


def split_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line of a text, numbered from 0 within the text."""
    return df.select(
        id_col, F.posexplode(F.split(text_col, "\n")).alias("line_no", "line")
    )


def write_splits(df: DataFrame, path: str) -> None:
    """Write partitioned by ``split`` so that reading one split prunes the others."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
