"""Each stage does its own part on its own input."""

import re

import pytest
from test_operators import brute_near

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, sf)
    assert good.columns == docs.columns
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()}
    kept = {r[0] for r in good.select("doc_id").collect()}
    assert sum(i in kept for i, q in labels.items() if q == 1) >= 0.99 * sum(labels.values())
    exact = stages["exact_dedup"](spark, good, sf)
    assert exact.columns == docs.columns
    best = {}
    for i, t in good.select("doc_id", "text").collect():
        key = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        best[key] = min(best.get(key, i), i)
    assert sorted(r[0] for r in exact.select("doc_id").collect()) == sorted(best.values())
    near = stages["near_dedup"](spark, exact, sf)
    want = [i for i, _, _, k in brute_near([(i, t or "") for i, t in exact.select("doc_id", "text").collect()]) if k]
    assert near.columns == docs.columns and sorted(r[0] for r in near.select("doc_id").collect()) == want
    packed = stages["packing"](spark, near, sf)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == set(want)
    ids = lambda d: sorted(map(tuple, d.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()))
    assert ids(corpus_pipeline.run(spark, sf)) == ids(packed)  # cuts may differ with the partitions


def test_repeats_and_nulls(spark):
    docs = spark.createDataFrame([(1, "same text"), (1, "Same text"), (2, "same text"), (None, "lone"), (None, "Lone"), (3, None), (4, "")], "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, "")
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 1), (False, 3), (True, 0)]
    assert dict(corpus_pipeline.STAGES)["near_dedup"](spark, got, "").count() == 3
