"""The test tables as the corpus the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import head_lines
from corpusloom.operators.hmm import training_lines
from corpusloom.session import spread
from corpusloom.sources.corpus import split_lines


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def documents(self) -> DataFrame:
        """``(id, content)``."""
        docs = self.read("documents").select(
            F.col("doc_id").alias("id"), F.col("text").alias("content")
        )
        return spread(docs, "id")

    def corpus(self) -> DataFrame:
        """``(id, content, title, url, genre)``: the poem corpus view of ``documents``."""
        docs = self.read("documents").select("doc_id", "text", "lang", "source")
        labelled = self.read("labels").select("doc_id", F.lit(True).alias("labelled")).distinct()
        has_lines = F.contains("text", F.lit("\n"))
        return (
            spread(docs, "doc_id")
            .join(labelled, "doc_id", "left")
            .select(
                F.col("doc_id").alias("id"),
                F.col("text").alias("content"),
                F.when(has_lines, head_lines(F.col("text"), 1)).alias("title"),
                F.concat(F.lit("doc://"), "source", F.lit("/"), "doc_id").alias("url"),
                F.when(F.col("labelled"), F.col("lang")).alias("genre"),
            )
        )

    def lines(self) -> DataFrame:
        """``(id, line_no, line)``."""
        return split_lines(self.documents(), "id", "content")

    def training_lines(self) -> DataFrame:
        return training_lines(self.lines())

    def prompts(self) -> DataFrame:
        """``(id, text)`` to continue."""
        return self.read("benchmark").select(F.col("item_id").alias("id"), "text")

    def conversations(self) -> DataFrame:
        """``(conv_id, turn, text)``: texts apart from the documents."""
        turns = self.read("conversations").select("conv_id", "turn", "text")
        return spread(turns, "conv_id")

    def logits(self) -> DataFrame:
        """``(context, token, logit, target)``; every tenth context is masked."""
        target = F.when(F.col("vec_id") % 10 == 0, -1).otherwise(F.col("label"))
        return spread(self.read("embeddings"), "vec_id").select(
            F.col("vec_id").alias("context"),
            target.alias("target"),
            F.posexplode("embedding").alias("token", "value"),
        ).select("context", "token", F.col("value").cast("double").alias("logit"), "target")
