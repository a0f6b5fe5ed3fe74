"""The registered queries and the pipeline."""

import corpus_pipeline
from orchard.llm.queries import ORACLE, QUERIES


def test_one_query_per_operator():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 14))
    assert "pipeline" in names and set(ORACLE) <= set(QUERIES)


def test_pipeline_stages(spark, tmp_path):
    src = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{src}/documents.parquet")
    seen = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, src)
        if name == "packing":
            assert {r.doc_id for r in out.select("doc_id").collect()} == seen
            break
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        assert out.columns == docs.columns
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= seen and len(ids) > 0.5 * len(seen)
        seen, docs = ids, out
