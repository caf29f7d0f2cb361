import pytest

LONG = "Lorem ipsum dolor sit amet consectetur. " * 8000

#: Null and empty texts, white space, a very long text, ties, repeated rows, null keys.
ROWS = [
    (1, "A clean text of a few plain words.\nAnd a second line of it.", "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n \n", "en", "b", 5),
    (5, LONG, "en", "b", len(LONG)),
    (6, "Same text twice over here.", "en", "a", 2),
    (7, "Same text twice over here.", "de", "b", 2),
    (8, "Repeated row", "en", "a", 3),
    (8, "Repeated row", "en", "a", 3),
    (None, "A row without a key", "en", "a", 4),
    (9, "Öl, straße & 漢字 ½ “quoted”", None, "c", 6),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every oddity, and columns whose names clash with those of results."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(ROWS, schema).repartition(3)
    clash = ["score", "label", "key", "fingerprint", "component", "node", "secrets", "items", "kept"]
    clash += ["n_words", "html", "url", "page", "line", "lines", "total", "host", "start", "a", "b"]
    for name in clash:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs


@pytest.fixture(scope="session")
def documents(odd):
    return odd.select("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"
