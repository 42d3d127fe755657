"""Positions in a global order, however the rows are partitioned and whichever columns are consumed."""

import pytest
from pyspark.sql import functions as F

from trailmark.operators import matching, sequences


@pytest.fixture
def settings(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    yield spark.conf
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("partitions", ["16", "200"])
def test_ordinals_of_wide_rows(spark, settings, monkeypatch, adaptive, partitions):
    settings.set("spark.sql.adaptive.enabled", adaptive)
    settings.set("spark.sql.shuffle.partitions", partitions)
    monkeypatch.setattr(sequences, "RANGE_ROWS", 10_000)
    n = 120_000
    rows = spark.range(n).select(((F.col("id") * 7919) % n * 3).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("a"), (F.col("id") % 13).alias("b"), F.rand(1).alias("c"))
    got = sequences.ordinals(rows, "k")
    one = got.agg(F.count("*"), F.countDistinct("ordinal"), F.min("ordinal"), F.max("ordinal"), F.count_if(F.col("ordinal") * 3 != F.col("k")), F.countDistinct("a"), F.sum("b"), F.count("c")).first()
    assert tuple(one)[:6] == (n, n, 0, n - 1, 0, n) and one[7] == n
    assert len({(r.ordinal, r.a) for r in got.collect()}) == n


def test_offsets_of_strings_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(sequences, "RANGE_ROWS", 7)
    rows = [(None, 5)] + [(f"s{i:03d}", i % 4) for i in range(100)]
    got = {r.k: r.start for r in sequences.offsets(spark.createDataFrame(rows, "k string, n long").repartition(5), "k", "n").collect()}
    at = 0
    for k, n in rows:
        assert got[k] == at
        at += n
    assert sequences.offsets(spark.createDataFrame([], "k string, n long"), "k", "n").count() == 0


def test_side_by_side(spark, monkeypatch):
    monkeypatch.setattr(sequences, "RANGE_ROWS", 10)
    left, right = spark.range(50).withColumnRenamed("id", "a"), spark.range(100, 130).withColumnRenamed("id", "b")
    got = sorted((r.n, r.a, r.b) for r in matching.positional(left, right, "a", "b").collect())
    assert got == [(i, i, 100 + i if i < 30 else None) for i in range(50)]
