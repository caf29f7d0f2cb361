"""Character classes and string cleaning as column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python treats as whitespace, as a regex class and as a
# list of characters, and the word-character class (letters, numbers, underscore).
SPACE_CLASS = r"\t-\r\x1c-\x20\x{85}\p{Z}"
SPACE_CHARS = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
WORD_CLASS = r"\p{L}\p{N}_"
PUNCTUATION = string.punctuation

# The un-spacing replacements, applied in this order.
UNSPACE = [
    (" .", "."),
    (" ?", "?"),
    (" !", "!"),
    (" ,", ","),
    (" ' ", "'"),
    (" n't", "n't"),
    (" 'm", "'m"),
    (" 's", "'s"),
    (" 've", "'ve"),
    (" 're", "'re"),
]

UNKNOWN = "<unk>"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def unspace_punctuation(text: Column) -> Column:
    for spaced, tight in UNSPACE:
        text = F.replace(text, F.lit(spaced), F.lit(tight))
    return text


def delete_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def clean_content(text: Column) -> Column:
    return unspace_punctuation(strip(text))


def clean_genre(genre: Column, unknown: str = UNKNOWN) -> Column:
    return F.coalesce(clean_content(genre), F.lit(unknown))


def clean_title(title: Column, unknown: str = UNKNOWN) -> Column:
    """Lower-case, put one space between words and punctuation runs."""
    words = rf"[{WORD_CLASS}\p{{M}}]+|[^{WORD_CLASS}\p{{M}}{SPACE_CLASS}]+"
    spaced = F.array_join(
        F.regexp_extract_all(F.lower(strip(title)), F.lit(words), F.lit(0)), " "
    )
    return F.coalesce(spaced, F.lit(unknown))


def normalise_line(line: Column) -> Column:
    return F.lower(delete_punctuation(strip(line)))


def newline_to_period(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("."))


def truncate_chars(text: Column, limit: int = 256) -> Column:
    return F.substring(text, 1, limit)


def head_lines(text: Column, k: int) -> Column:
    """The first ``k`` lines, joined by newlines."""
    return F.substring_index(text, "\n", k)


def tail_lines(text: Column, k: int) -> Column:
    """Everything after the first ``k`` lines; empty when there are no more."""
    return F.substr(text, F.length(head_lines(text, k)) + F.lit(2))
