"""The pipeline and every registered query of the subpackage."""

import corpus_pipeline
from codelake.llm import queries
from conftest import SCHEMA  # noqa: F401


def test_oracles_belong_to_queries():
    assert set(queries.ORACLES) <= set(queries.QUERIES) and len(queries.QUERIES) == 10


def test_stages_keep_columns(spark, docs):
    seen, sf = docs, "/root/testdata/sf0.01"
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, sf).cache()
        assert seen.columns == docs.columns, name
        counts.append(seen.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0 and seen.select("doc_id").distinct().count() <= counts[3]
    assert corpus_pipeline.run(spark, sf).count() == counts[-1]


def test_odd_pipeline(spark, odd, nothing):
    for start in (odd, nothing):
        seen = start
        for _, stage in corpus_pipeline.STAGES:
            seen = stage(spark, seen, "/root/testdata/sf0.001").cache()
        assert seen.count() >= 0
