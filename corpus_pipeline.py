"""documents -> quality classifier -> exact dedup -> near-duplicate dedup -> packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import queries, stage
from trailmark.llm.kk_packing import packed
from trailmark.llm.lsm_dedup import exact_duplicates
from trailmark.llm.minhash_join import near_duplicates
from trailmark.llm.skew import IdFilter, parted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of sf_dir.

    Null and empty texts are scored like others, repeated rows each; an empty table stays empty; all columns are kept.
    """
    stage.text_batches(spark)
    return queries.accepted(spark, docs, sf_dir)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the one with the smallest doc_id; of rows that repeat one, one.

    Null counts as an empty text; a null doc_id stays only where its group has no other; an empty table stays empty; columns of any name are kept.
    """
    stage.text_batches(spark)
    digest = "digest"
    while digest in docs.columns:
        digest = f"_{digest}"
    gone = stage.written(exact_duplicates(docs, keep="smallest").where("not kept").select("doc_id", "keep_id", F.col("text_sha256").alias(digest)), "gone")
    sure, doubt = parted(docs, "doc_id", IdFilter.build(gone, "doc_id"))
    doubt = doubt.withColumn(digest, F.sha2(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256))
    once = gone.where("doc_id <=> keep_id").select("doc_id", digest).distinct()
    other = gone.where("not (doc_id <=> keep_id)").select("doc_id", digest).distinct()
    same = lambda t: doubt["doc_id"].eqNullSafe(t["doc_id"]) & (doubt[digest] == t[digest])
    rest = doubt.join(other, same(other), "left_anti").join(once, same(once), "left_anti")
    repeated = doubt.join(once, same(once), "left_semi").dropDuplicates(["doc_id", digest])
    return sure.unionByName(rest.unionByName(repeated).drop(digest))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id.

    Texts without words and rows with a null doc_id stay; rows that repeat a doc_id go or stay together; an empty table stays empty; all columns are kept.
    """
    stage.text_batches(spark)
    gone = stage.written(near_duplicates(docs).where("not kept").select("doc_id"), "gone")
    sure, doubt = parted(docs, "doc_id", IdFilter.build(gone, "doc_id"))
    return sure.unionByName(doubt.join(gone, "doc_id", "left_anti").select(docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences of 1024 tokens; a null or empty text is its end id, repeated rows are packed each, an empty table gives none."""
    stage.text_batches(spark)
    return packed(docs, queries.vocabulary("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("packing", packing)]

#: A trained classifier, tokens and packing have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage.written(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
