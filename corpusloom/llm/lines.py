"""Lines that a site repeats over its pages, found by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import per_host

#: White space in the sense of ASCII; a line is compared without it at its ends.
BLANKS = " \t\x0b\x0c\r"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def site_lines(docs: DataFrame, host: str, text: str) -> DataFrame:
    """``(host, line, pages, total)``: on how many of a host's pages a line stands.

    Pages of one host with the same text count as one page, so copies of a page do not turn
    its own lines into boilerplate. A line is its 64-bit hash. Only hashes are shuffled,
    after they were counted inside the map tasks.
    """
    pages = docs.select(
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.col(host).isNull().alias("no_host"),
        F.xxhash64(text).alias("page"),
        F.array_distinct(
            F.transform(
                F.filter(
                    F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: _bare(line) != ""
                ),
                lambda line: F.xxhash64(_bare(line)),
            )
        ).alias("lines"),
    )
    site = ["host", "no_host"]
    distinct = pages.select(*site, "page", F.explode("lines").alias("line")).distinct()
    counts = distinct.groupBy(*site, "line").agg(F.count("*").alias("pages"))
    totals = pages.select(*site, "page").distinct().groupBy(*site).agg(F.count("*").alias("total"))
    return counts.join(totals, site)


def drop_site_lines(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = 0.01,
    min_pages: int = 5,
    count_column: str | None = None,
    dropped_column: str | None = None,
) -> DataFrame:
    """``docs`` without the lines that stand on more than ``ratio`` of their host's pages.

    Lines are parted by line feeds and compared without white space at their ends; lines
    of white space only are never dropped. A line must stand on ``min_pages`` different
    pages as well, so that small hosts keep what they say. Every occurrence goes, also
    repeats within a page; the rest stays in order. A null text stays null, a text whose
    lines all go is empty, and no row is removed; null hosts form one host of their own.
    ``count_column`` is set to the new length in code points, ``dropped_column`` to the
    number of lines dropped (0 for a null text); other columns pass through.

    A host has at most (lines per page) / ``ratio`` such lines, so they travel as one array
    per host to the pages, whose texts are neither exploded nor regrouped (``per_host``).
    """
    boilerplate = (
        site_lines(docs, host, text)
        .filter((F.col("pages") >= min_pages) & (F.col("pages") > ratio * F.col("total")))
        .groupBy("host", "no_host")
        .agg(F.collect_list("line").alias("_site_lines"))
        .withColumnRenamed("host", "_site")
        .withColumnRenamed("no_host", "_no_site")
    )
    boilerplate, salt = per_host(boilerplate, F.xxhash64(text))
    lines = F.split(F.col(text), "\n")
    known = F.coalesce("_site_lines", F.array().cast("array<bigint>"))
    left = F.filter(
        lines,
        lambda line: (_bare(line) == "")
        | ~F.array_contains(known, F.xxhash64(_bare(line))),
    )
    joined = docs.join(
        boilerplate,
        (F.coalesce(F.col(host).cast("string"), F.lit("")) == F.col("_site"))
        & (F.col(host).isNull() == F.col("_no_site"))
        & (salt == F.col("_salt")),
        "left",
    )
    # Computed once, and only on hosts with such lines; null where nothing changes.
    staged = joined.withColumn("_left", F.when(F.size(known) > 0, left))
    values = {c: F.col(c) for c in docs.columns}
    values[text] = F.coalesce(F.array_join("_left", "\n"), F.col(text))
    if count_column:
        values[count_column] = F.length(values[text]).cast(docs.schema[count_column].dataType)
    if dropped_column:
        gone = F.size(lines) - F.size("_left")
        gone = F.when(F.col("_left").isNull(), 0).otherwise(gone)
        values[dropped_column] = gone.cast("bigint")
    return staged.select(*[value.alias(name) for name, value in values.items()])
