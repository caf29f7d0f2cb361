"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure is a column expression over the text; no Python runs on the rows. What is
used more than once is bound by ``let`` so that Spark evaluates it once per row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, and the signs that count as symbols.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Fixed lists: frequent function words of the languages of the corpus.
STOP_WORDS = (
    # English
    "the of and to a in is it that for on with as was at by an be this are or from "
    # French
    "de la le les et des en un une du que est pour qui dans par sur au pas plus "
    # German
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es "
    # Spanish
    "el los y del se las por con no su para al lo como o pero sus"
).split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, "[\\x20\\x09-\\x0D]+")
    )


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that stand in the text twice or more.

    Windows are compared by 64-bit hashes. Only a text with equal windows is sorted: equal
    hashes then are neighbours, and each place adds the words that the next place, at most
    three further, does not add itself.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(hashes, i + 1), F.get(hashes, i + 2)),
        )

    def covered(window: Column) -> Column:
        pairs = F.array_sort(F.transform(window, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = let(
            pairs,
            lambda a: F.filter(
                a,
                lambda x, i: F.get(a, i - 1)["h"].eqNullSafe(x["h"])
                | F.get(a, i + 1)["h"].eqNullSafe(x["h"]),
            ),
        )
        places = F.array_sort(F.transform(again, lambda x: x["i"]))
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(
                    p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))
                ),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )

    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: let(
            windows(hashes),
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(
                covered(w)
            ),
        ),
    )


def stop_words(words: Column) -> Column:
    """Words that are function words once ASCII signs around them are gone."""
    signs = ".,;:!?()\"'"
    return F.size(
        F.filter(words, lambda w: F.lower(F.btrim(w, F.lit(signs))).isin(*STOP_WORDS))
    )


#: The measures, over the columns ``_text`` (never null) and ``_words``.
MEASURES: dict[str, Callable[[], Column]] = {
    "n_words": lambda: F.size("_words"),
    "word_chars": lambda: F.length(_without(F.col("_text"), SPACES)),
    "n_symbols": lambda: F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS)),
    "n_lines": lambda: F.size(
        F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    ),
    "n_dup_lines": lambda: duplicate_lines(F.col("_text")),
    "n_repeat_words": lambda: repeated_words(F.col("_words")),
    "n_stop_words": lambda: stop_words(F.col("_words")),
    "n_bang_words": lambda: F.size(F.filter("_words", lambda w: F.endswith(w, F.lit("!!")))),
}


@dataclass(frozen=True)
class Rule:
    """Keeps a text if ``low <= numerator / denominator <= high``; an open end is None.

    A denominator of zero makes the ratio zero.
    """

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        value = F.col(self.numerator).cast("double")
        if self.denominator:
            under = F.col(self.denominator)
            value = F.when(under == 0, 0.0).otherwise(value / under)
        checks = [F.lit(True)]
        if self.low is not None:
            checks.append(value >= self.low)
        if self.high is not None:
            checks.append(value <= self.high)
        return checks[0] if len(checks) == 1 else checks[1] & checks[-1]


#: The base verdict of the contract and the ratios that come on top of it.
BASE = [
    Rule("enough_words", "n_words", low=50),
    Rule("few_repeats", "n_repeat_words", "n_words", high=0.5),
]
RULES = [
    Rule("word_length", "word_chars", "n_words", low=2.0, high=14.0),
    Rule("few_symbols", "n_symbols", "word_chars", high=0.05),
    Rule("few_symbols_per_word", "n_symbols", "n_words", high=0.25),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01),
    Rule("no_shouting", "n_bang_words", "n_words", high=0.2),
    Rule("few_repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("line_length", "n_words", "n_lines", low=2.0),
]


def apply_rules(
    docs: DataFrame, text: str = "text", base: list[Rule] = BASE, rules: list[Rule] = RULES
) -> DataFrame:
    """``docs`` with all measures, ``base_failed``, ``failed`` and ``kept``.

    ``failed`` names the rules a text breaks, in the order of the table. A null text counts
    as empty: no words, base failed. Measures that a column of ``docs`` is named after
    replace it; other columns, nulls and repeated rows pass through, one row for each.
    """
    added = [*MEASURES, "base_failed", "failed", "kept"]
    kept = docs.drop(*[c for c in added if c != text])
    state = kept.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    state = state.withColumn("_words", words_of(F.col("_text")))
    state = state.select(
        *kept.columns, *[make().cast("bigint").alias(name) for name, make in MEASURES.items()]
    )
    broken = [F.when(~rule.passes(), F.lit(rule.name)) for rule in [*base, *rules]]
    base_failed = ~F.lit(True)
    for rule in base:
        base_failed = base_failed | ~rule.passes()
    return (
        state.withColumn("base_failed", base_failed)
        .withColumn("failed", F.filter(F.array(*broken), lambda x: x.isNotNull()))
        .withColumn("kept", F.size("failed") == 0)
    )
