import corpus_pipeline as P
from silverline.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages_in_order_with_document_columns(spark):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == ["quality rules", "n-gram Jaccard join", "personal data", "source mix", "BPE"]
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF).checkpoint()
        assert docs.columns == columns, name
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids
        if name == "personal data":
            assert now == ids
        ids = now
    out = P.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count()


def test_run_equals_its_stages(spark):
    got = P.run(spark, SF)
    docs = read(spark, SF, "documents")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
