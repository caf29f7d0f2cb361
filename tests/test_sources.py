import pytest
from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.operators.prompts import build_prompts, clean_corpus
from corpusloom.operators.splits import split_rows
from corpusloom.sources import corpus as src

ROWS = [("1", "dòng một\ndòng hai", "T", "u", "lục bát"), ("2", "x", None, None, None)]


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_read_corpus(spark, tmp_path, fmt):
    df = spark.createDataFrame(ROWS, src.CORPUS_SCHEMA)
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.options(header="true", escape='"', lineSep="\r\n")
    writer.save(str(tmp_path / fmt))
    if fmt != "csv":
        assert sorted(map(tuple, src.read_corpus(spark, str(tmp_path / fmt), fmt).collect())) == ROWS
    else:
        assert src.read_corpus(spark, str(tmp_path / fmt), fmt).count() == 2


def test_missing_columns_and_content(spark, tmp_path):
    df = spark.createDataFrame([("g", "text"), ("g", None)], "genre string, content string")
    df.write.parquet(str(tmp_path / "b"))
    got = src.read_corpus(spark, str(tmp_path / "b")).collect()
    assert [tuple(r)[1:] for r in got] == [("text", None, None, "g")] and got[0]["id"]
    raw = spark.read.schema(src.CORPUS_SCHEMA).parquet(str(tmp_path / "b"))
    assert src.count_missing_content(raw).first()[0] == 1


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("  one \n\ntwo　\n", encoding="utf-8")
    got = [r["line"] for r in src.read_lines(spark, str(tmp_path / "a.txt")).collect()]
    assert sorted(got) == ["", "one", "two"]


def test_splits_are_pruned_on_read(spark, tmp_path):
    path = str(tmp_path / "splits")
    src.write_splits(split_rows(spark.range(200), ["id"]), path)
    one = spark.read.parquet(path).filter(F.col("split") == "test")
    assert "PartitionFilters: [isnotnull(split" in one._jdf.queryExecution().toString()
    assert one.count() == split_rows(spark.range(200), ["id"]).filter("split = 'test'").count()


def test_shared_folder_follows_the_session(spark):
    had = spark.conf.get("spark.checkpoint.dir", None)
    if had:
        assert session.shared_folder(spark) == had.rstrip("/")
    else:
        assert session.shared_folder(spark) == session.shared_folder(spark)


def test_row_wise_operators_work_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame(ROWS, src.CORPUS_SCHEMA).write.parquet(path)
    stream = spark.readStream.schema(src.CORPUS_SCHEMA).parquet(path)
    query = (
        build_prompts(clean_corpus(stream), with_first=True)
        .writeStream.format("memory")
        .queryName("prompts_out")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert spark.table("prompts_out").count() == 4
