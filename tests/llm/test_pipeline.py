import corpus_pipeline
from __spark_entry__ import queries
from tests.llm.common import documents, no_documents, odd_documents
from tilecast.llm import host_rules, language_id, near_dups

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = documents(spark)
    seen = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF)
        assert out.schema.names == docs.schema.names
        assert out.exceptAll(seen).count() == 0
        seen = out.cache()
    assert 0 < seen.count() < docs.count()
    ids = {r.doc_id for r in seen.select("doc_id").collect()}
    packed = {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
    assert packed == ids
    seen.unpersist()


def test_each_stage_is_its_operator(spark):
    docs = documents(spark)
    named = dict(corpus_pipeline.STAGES)
    kept = lambda df: {r.doc_id for r in df.collect()}
    assert kept(named["language"](spark, docs, SF)) == kept(language_id.identify(docs).filter("lang_pred <> 'und' and score >= 0.25"))
    assert kept(named["quality"](spark, docs, SF)) == kept(host_rules.quality_rules(docs).filter("kept"))
    assert kept(named["near_duplicates"](spark, docs, SF)) == kept(near_dups.near_duplicates(docs).filter("kept"))


def test_odd_rows_pass_through(spark):
    for make in (odd_documents, no_documents):
        docs = make(spark)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= 0


def test_all_eleven_queries_are_registered():
    names = set(queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
