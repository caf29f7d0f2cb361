"""Documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, lines, packing, simhash, toxicity
from corpusloom.llm.store import drop_table, held_out, read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject.

    It learns from the same labelled rows as the query of operator 9.
    """
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    corpus = read(spark, sf_dir, "documents")
    model = toxicity.train(corpus, labels.filter(~held_out("doc_id", 5, 0)))
    scored = toxicity.score(docs, model, column="_toxicity")
    return scored.filter("_toxicity < 0.5").select(*docs.columns)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that their source repeats; ``n_chars`` follows the text."""
    return lines.drop_site_lines(docs, count_column="n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints at most three bits apart.

    Fingerprints and groups are those of the query of operator 7.
    """
    return simhash.keep_one(docs, simhash.near_duplicates(docs.filter("doc_id IS NOT NULL")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_site_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: No SQL expresses the stages that train, hash or tokenise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written as Parquet and read again."""
    docs, path = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        done, new_path = written(stage(spark, docs, sf_dir), name)
        if path is not None:
            drop_table(spark, path)
        docs, path = done, new_path
    return docs
