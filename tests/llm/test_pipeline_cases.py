"""Pipeline stages over nulls, repeated ids, ties, clashing columns and empty tables."""

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCES = [" ".join(f"{a}{i}{b}" for i in range(60)) for a in "abc" for b in ("x", "y")]


def table(spark):
    rows = [(1, SENTENCES[0]), (2, None), (3, ""), (None, SENTENCES[1]), (None, None),
            (5, SENTENCES[2]), (5, SENTENCES[3]), (5, SENTENCES[3]), (6, SENTENCES[0]), (7, "one two"), (8, "w " * 50_000)]
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_cases(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = table(spark)
    extra = docs.selectExpr("*", "1 AS score", "2 AS id", "'v' AS version", "3 AS length")
    for given in (docs, extra):
        out = stage(spark, given, SF)
        rows = out.collect()
        assert {r.doc_id for r in rows} <= {r.doc_id for r in given.collect()}
        if name != "packing":
            assert out.columns == given.columns
        assert stage(spark, given.limit(0), SF).count() == 0


def test_one_id_with_two_texts_is_judged_by_text(spark):
    """The join: of equal rows one stays, of copies the smallest id, of one id with two texts both."""
    out = corpus_pipeline.jaccard_stage(spark, table(spark), SF).select("doc_id", "text").collect()
    texts = sorted((r.doc_id, r.text) for r in out if r.doc_id == 5)
    assert texts == sorted([(5, SENTENCES[2]), (5, SENTENCES[3])])
    assert {r.doc_id for r in out} == {1, 2, 3, None, 5, 7, 8}
    assert sum(r.doc_id is None for r in out) == 2
