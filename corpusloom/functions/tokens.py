"""Tokenisers as column expressions returning arrays of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import SPACE_CLASS, UNKNOWN, WORD_CLASS, delete_punctuation

BOS, PAD, EOS = "<s>", "<pad>", "</s>"


def words(text: Column) -> Column:
    """Lower-case, delete ASCII punctuation, split on whitespace."""
    parts = F.split(delete_punctuation(F.lower(text)), f"[{SPACE_CLASS}]+")
    return F.array_remove(parts, "")


def runs(text: Column, newline: bool = True) -> Column:
    """Alternating word and non-word runs; lone single spaces are dropped."""
    if newline:
        text = F.concat(text, F.lit("\n"))
    pattern = f"[{WORD_CLASS}]+|[^{WORD_CLASS}]+"
    return F.array_remove(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), " ")


def pieces(text: Column) -> Column:
    """Runs in which each newline and each special marker is a token of its own."""
    pattern = rf"{EOS}|{UNKNOWN}|\n|[{WORD_CLASS}]+|[^{WORD_CLASS}\n<]+|<"
    return F.array_remove(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), " ")


def chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def long_words(text: Column) -> Column:
    """Lower-cased runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD_CLASS}]{{2,}}"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{WORD_CLASS}]+"))


TOKENIZERS = {"words": words, "runs": runs, "pieces": pieces, "chars": chars}


def token_rows(df, id_cols, text_col, tokenizer):
    """One row per token: the id columns, ``pos`` from 0, ``token``."""
    return df.select(*id_cols, F.posexplode(tokenizer(F.col(text_col))).alias("pos", "token"))


def ngrams(tokens: Column, n: int) -> Column:
    """All ``n``-grams of an array, each as an array; empty when it is too short."""
    return F.when(
        F.size(tokens) >= n,
        F.transform(
            F.sequence(F.lit(1), F.size(tokens) - F.lit(n - 1)),
            lambda i: F.slice(tokens, i, n),
        ),
    )
