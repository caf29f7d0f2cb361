import corpus_pipeline
from corpusloom.llm import simhash
from corpusloom.llm.packing import CAPACITY
from tests.llm.conftest import ROWS


def test_stages_return_documents_and_take_odd_ones(spark, documents, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 0, 0), (3, 0, 0), (9, 1, 0), (8, 1, 0), (5, 1, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    spark.createDataFrame([(1, "same text twice over")], "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (documents, documents.limit(0)):
            assert stage(spark, docs, str(folder)).columns == documents.columns, name
    assert corpus_pipeline.drop_contaminated(spark, documents, str(folder)).count() == len(ROWS) - 2
    assert corpus_pipeline.run(spark, str(folder)).count() > 0


def test_pipeline_of_the_tables(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = rows.select("doc_id").distinct()
    assert 0.5 * docs.count() < kept.count() < docs.count()
    toxic = labels.filter("toxic = 1")
    assert kept.join(toxic, "doc_id").count() < 0.3 * toxic.count()
    single = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    assert single.groupBy("text").count().filter("count > 1").count() == 0
    assert single.select("text").distinct().count() > 0.9 * docs.select("text").distinct().count()
    sizes = rows.groupBy("sequence_id").sum("length").collect()
    assert all(n <= CAPACITY and n & (n - 1) == 0 for _, n in sizes)


def test_near_duplicates_are_those_of_simhash(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    groups = simhash.near_duplicates(docs).select("component").distinct()
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf).select("doc_id")
    assert sorted(kept.collect()) == sorted(groups.collect())
