from cases import linked, quality, secrets

import corpus_pipeline
from nearfield.llm.common import stored


def test_each_stage_acts_on_what_it_gets(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kinds = docs.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, small))
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.dtypes == kinds and set(after) <= set(before)
        if name == "language":
            assert all(any(map(str.isalpha, r.text)) for r in after.values())
        elif name == "quality":
            assert not any(quality(r.text)[-1] for r in after.values())
        elif name == "near_copies":
            keys = sorted(before)
            assert set(after) == {keys[c] for _, c in linked([before[k].text for k in keys], 5, 80)}
        else:
            assert set(after) == set(before)
            assert all((r.text != before[k].text) == bool(secrets(before[k].text)) for k, r in after.items())
            assert not any(secrets(r.text) for r in after.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert {r.doc_id for r in packed} == set(after)


def test_stages_take_strained_and_empty_tables(spark, strained, small):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, strained.limit(0), small).count() == 0
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, strained, small).columns == strained.columns


def test_run_equals_the_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small))
    assert corpus_pipeline.run(spark, small).count() == docs.count() > 0
