import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_oracle  # noqa: E402

from corpusloom import plans  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "project_columns",
    "tokenize_runs",
    "prompts_title_genre",
    "build_vocab",
    "vocab_encode",
    "lm_windows",
    "markov_argmax",
    "write_line",
    "top_k_filter",
    "ngram_repetition",
    "perplexity",
    "perplexity_kneser_ney",
    "hmm_em_step",
    "hmm_viterbi",
]

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(plans.QUERIES) - set(plans.SQL) == {"hmm_train"}


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_same_rows_as_sql(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = check_oracle.connect(FOLDER).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert check_oracle.table(df.collect(), df.columns) == check_oracle.table(cursor.fetchall(), columns)


@needs_data
def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5
