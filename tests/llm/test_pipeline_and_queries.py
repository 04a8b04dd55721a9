import corpus_pipeline
from ledgerlens.llm import langid, ngram_join
from ledgerlens.llm.queries import ORACLE, QUERIES


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_stages_keep_columns_and_take_effect(spark, tmp_path, edge):
    path = str(tmp_path)
    edge.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "don't we'll I'D 'tis")], "item_id bigint, text string").write.parquet(
        f"{path}/benchmark.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        left.append(sorted(r.doc_id or -1 for r in docs.collect()))
    assert not {1, 2, 3, 12, 15} & set(left[0])
    assert left[1].count(6) == 0 and 13 in left[1] and 8 not in left[1]      # equal after lower-casing
    assert 7 in left[2] and 13 not in left[2]                                # near copies: the least id stays
    assert 11 in left[2] and 11 not in left[3]                               # holds a benchmark passage
    rows = corpus_pipeline.run(spark, path).collect()
    assert sorted(r.doc_id or -1 for r in rows) == left[3]


def test_pipeline_on_an_empty_table(spark, tmp_path, empty):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clean_documents_stay(spark, documents):
    kept = {r.doc_id for r in langid.drop_unidentified(documents).collect()}
    assert kept == {r.doc_id for r in documents.collect()}
    comp = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(documents).collect()}
    kept = {r.doc_id for r in ngram_join.drop_near_copies(documents).collect()}
    assert kept == {d for d, c in comp.items() if d == c}
