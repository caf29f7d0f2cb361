"""Secrets in texts: known shapes, and long strings of high entropy.

All of it is column expressions. Places are counted in code points: a text is split at the
matches of a pattern, and the lengths of pieces and matches add up to where each begins.
Only texts in which a cheap test of the pattern holds are split at all.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.quality_rules import let


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: Fixed patterns of the base kinds, in the order they are listed in.
ASSIGN = (
    "(?:" + _any_case("password|passwd|secret|token|api_?key") + ")"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ASSIGN_LENGTH = 6

#: Strings that may be secrets, whatever stands around them.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"


@dataclass(frozen=True)
class CharacterClass:
    """Strings of one alphabet; a window of them must reach ``bits`` per character."""

    name: str
    pattern: str
    bits: float


#: The first class whose pattern a candidate matches decides.
CLASSES = [
    CharacterClass("hex", "^[0-9a-f]+$|^[0-9A-F]+$", 2.9),
    CharacterClass("alphanumeric", "^[A-Za-z0-9]+$", 3.5),
    CharacterClass("base64", "^[A-Za-z0-9+/_=-]+$", 3.6),
]
#: Characters of a window; entropy is taken over each window of a candidate.
WINDOW = 20

#: Candidates that are let pass: one sort of characters only, words joined by signs, version
#: 4 identifiers, numbers with separators, paths of words, and marked examples.
ALLOWED = [
    "^[A-Za-z]+$",
    "^[0-9_+/=-]+$",
    "^[A-Za-z]+(?:[-_/+=]+[A-Za-z]+)*[-_/+=]*$",
    "^[A-Za-z]+(?:[-_/][A-Za-z0-9]{1,8}){2,}$",
    "^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "(?i)example|sample|dummy|placeholder|changeme|redacted",
    "(.)\\1{7}",
    "0123456789|abcdefghij|ABCDEFGHIJ",
]

#: Matches of a text that are put in place at a time.
GROUP = 512

_NO_SPANS = "array<struct<kind:string,rank:int,start:int,end:int,match:string>>"


def matches(text: Column, pattern: str, kind: str, rank: int, accept=None) -> Column:
    """Spans of the leftmost non-overlapping matches that ``accept`` (of the match) takes."""

    def spans(pieces: Column, found: Column) -> Column:
        lengths = F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("p"), m.alias("m")))
        none = F.array().cast(_NO_SPANS)

        def step(state: Column, x: Column) -> Column:
            start = state["at"] + x["p"]
            end = start + F.length(x["m"])
            span = F.struct(
                F.lit(kind).alias("kind"),
                F.lit(rank).alias("rank"),
                start.alias("start"),
                end.alias("end"),
                x["m"].alias("match"),
            )
            return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

        def group(state: Column, part: Column) -> Column:
            begin = F.struct(state["at"].alias("at"), none.alias("spans"))
            return let(
                F.aggregate(part, begin, step),
                lambda done: F.struct(
                    done["at"].alias("at"),
                    F.concat(state["parts"], F.array(done["spans"])).alias("parts"),
                ),
            )

        def walk(whole: Column) -> Column:
            # Lists grow by copying, so matches are taken in parts of GROUP.
            parts = F.transform(
                F.sequence(F.lit(0), F.floor(F.size(whole) / GROUP).cast("int")),
                lambda g: F.slice(whole, g * GROUP + 1, GROUP),
            )
            begin = F.struct(F.lit(0).alias("at"), F.array(none).alias("parts"))
            return F.aggregate(parts, begin, group, lambda state: F.flatten(state["parts"]))

        return let(F.filter(lengths, lambda x: x["m"].isNotNull()), walk)

    found = spans(F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    if accept is not None:
        found = F.filter(found, lambda s: accept(s["match"]))
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(_NO_SPANS))


def _class_of(candidate: Column) -> tuple[Column, Column]:
    name, bits = F.lit(None).cast("string"), F.lit(math.inf)
    for known in reversed(CLASSES):
        inside = F.regexp_like(candidate, F.lit(known.pattern))
        name = F.when(inside, known.name).otherwise(name)
        bits = F.when(inside, known.bits).otherwise(bits)
    return name, bits


def peak_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of ``window`` neighbouring characters.

    The window slides by one character: its counts, an array over ASCII, change by one up
    and one down, and so does the sum of c log2 c that the entropy is taken from.
    """
    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c))
    codes = F.filter(codes, lambda c: c > 0)
    # c log2 c for every count that a window can have.
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])

    def slide(chars: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), 128).alias("counts"),
            F.lit(0.0).alias("sum"),
            F.lit(math.inf).alias("least"),
        )

        def change(counts: Column, code: Column, by: int) -> Column:
            return F.transform(counts, lambda n, k: F.when(k == code, n + by).otherwise(n))

        def step(state: Column, i: Column) -> Column:
            new, old = F.get(chars, i), F.get(chars, i - window)
            up = F.get(state["counts"], new)
            counts = change(state["counts"], new, 1)
            total = state["sum"] + F.get(terms, up + 1) - F.get(terms, up)

            def leave(grown: Column) -> Column:
                down = F.get(grown, old)
                return F.struct(
                    F.when(i >= window, change(grown, old, -1)).otherwise(grown).alias("counts"),
                    F.when(i >= window, total + F.get(terms, down - 1) - F.get(terms, down))
                    .otherwise(total)
                    .alias("sum"),
                )

            return let(
                let(counts, leave),
                lambda now: F.struct(
                    now["counts"].alias("counts"),
                    now["sum"].alias("sum"),
                    F.when(i + 1 >= window, F.least(state["least"], now["sum"]))
                    .otherwise(state["least"])
                    .alias("least"),
                ),
            )

        places = F.sequence(F.lit(0), F.size(chars) - 1)
        return F.aggregate(
            places, start, step, lambda s: F.lit(math.log2(window)) - s["least"] / window
        )

    return let(codes, slide)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: spans of kind, start, end, match and rank of the kind.

    Sorted by start, then by kind in the order assign, access, hex, entropy. The base kinds
    are the contract's patterns. An entropy span is a candidate of 20 characters or more in
    which some window of its character class is dense enough, that no allow-list pattern
    takes and that lies in no base span. Null and empty texts have no spans. Every row and
    all other columns come back; a column ``secrets`` is replaced.
    """
    kept = docs.drop("secrets")
    whole = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        matches(
            whole,
            ASSIGN,
            "assign",
            0,
            lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= ASSIGN_LENGTH,
        ),
        matches(whole, ACCESS, "access", 1),
        matches(whole, HEX, "hex", 2),
    )

    def dense(candidate: Column) -> Column:
        allowed = F.lit(False)
        for pattern in ALLOWED:
            allowed = allowed | F.regexp_like(candidate, F.lit(pattern))
        _, bits = _class_of(candidate)
        return F.when(allowed, F.lit(False)).otherwise(peak_entropy(candidate) >= bits)

    def added(spans: Column) -> Column:
        found = matches(F.col("_whole"), CANDIDATE, "entropy", 3)
        outside = F.filter(
            found,
            lambda e: ~F.exists(spans, lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"])),
        )
        return F.filter(outside, lambda e: dense(e["match"]))

    def ordered(spans: Column) -> Column:
        keyed = F.transform(
            spans,
            lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["match"]),
        )
        return F.transform(
            F.array_sort(keyed),
            lambda s: F.struct(
                s["kind"].alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                s["match"].alias("match"),
                s["rank"].alias("rank"),
            ),
        )

    staged = kept.withColumn("_whole", whole).withColumn("_base", base)
    both = F.concat("_base", added(F.col("_base")))
    return staged.select(*kept.columns, ordered(both).alias("secrets"))


def written_out(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
