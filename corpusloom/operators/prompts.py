"""Prompt/target rows: one pass over the corpus, several rows per text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import (
    clean_content,
    clean_genre,
    clean_title,
    head_lines,
    tail_lines,
)
from corpusloom.functions.tokens import EOS


@dataclass(frozen=True)
class Wording:
    """The prompt phrases. Spacing after the colons differs on purpose."""

    title: str = "làm thơ với tiêu đề: "
    title_alone: str = "làm thơ với tiêu đề:"
    genre: str = "tuân theo thể thơ: "
    first: str = "câu đầu:"
    second: str = "hai câu đầu:"
    second_after_both: str = "hai câu đầu: "


def clean_corpus(corpus: DataFrame) -> DataFrame:
    """The columns ``id, text, genre, title``, cleaned and null-filled."""
    return corpus.select(
        "id",
        clean_content(F.col("content")).alias("text"),
        clean_genre(F.col("genre")).alias("genre"),
        clean_title(F.col("title")).alias("title"),
    )


def build_prompts(
    cleaned: DataFrame,
    with_title: bool = True,
    with_genre: bool = True,
    with_first: bool = False,
    with_second: bool = False,
    augment: bool = False,
    eos: str = EOS,
    wording: Wording = Wording(),
) -> DataFrame:
    """Rows ``(id, variant, source, target)`` for every prompt form the flags ask for."""
    if not (with_title or with_genre or with_first or with_second):
        raise ValueError("at least one of title, genre, first and second is needed")

    text, title, genre = F.col("text"), F.col("title"), F.col("genre")
    lead, names = [], []
    if with_title:
        lead += [F.lit(wording.title), title, F.lit(eos)]
        names.append("title")
    if with_genre:
        lead += [F.lit(wording.genre), genre, F.lit(eos)]
        names.append("genre")
    second = wording.second_after_both if with_title and with_genre else wording.second

    def row(variant, source, target):
        return F.struct(
            F.lit("_".join(variant)).alias("variant"),
            F.concat(*source).alias("source"),
            target.alias("target"),
        )

    rows = []
    if with_first:
        opening = [F.lit(wording.first), head_lines(text, 1), F.lit("\n")]
        rows.append(row([*names, "first"], lead + opening, tail_lines(text, 1)))
    if with_second:
        opening = [F.lit(second), head_lines(text, 2), F.lit("\n")]
        rows.append(row([*names, "second"], lead + opening, tail_lines(text, 2)))
    if with_title and with_genre:
        rows.append(row(names, lead[:-1], text))
        if augment:
            rows.append(row(["augment"], [F.lit(wording.genre), genre], text))
    elif with_title:
        rows.append(row(names, [F.lit(wording.title_alone), title], text))
    elif with_genre:
        rows.append(row(names, lead[:-1], text))
    return cleaned.select("id", F.inline(F.array(*rows)))
