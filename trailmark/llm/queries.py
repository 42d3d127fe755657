"""The fixed queries of this subpackage and the SQL that gives their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_windows, html_extract, iblt, pitman_yor, quality_fm, stage
from .bpe_fst import round_trip
from .kk_packing import packed
from .lsm_dedup import exact_duplicates
from .minhash_join import near_duplicates
from .pfor_store import read_ids, write_ids


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return stage.text_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("extracted_text").cast("long"))


def quality_model(spark: SparkSession, sf_dir: str) -> quality_fm.Model:
    return quality_fm.fit(_table(spark, sf_dir), _table(spark, sf_dir, "labels"))


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that the classifier predicts as 1."""
    return quality_fm.accepted(docs, quality_model(spark, sf_dir))


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_fm.scored(_table(spark, sf_dir), quality_model(spark, sf_dir))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(_table(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir))


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat_windows.read_back(chat_windows.chat_windows(rows.unionByName(extra), budget=1024, history=256, tokenizer=vocabulary("byte_bpe_50k.json")))


def op6_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op7_pfor_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = stage.new_path(spark, "ids")
    write_ids(_table(spark, sf_dir), folder, vocabulary("word_bpe_49k.json"))
    return read_ids(spark, folder, with_ids=False)


def op8_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprints(_table(spark, sf_dir))


def op9_pitman_yor_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scored(_table(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op10_lsm_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir), keep="largest")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUERIES = {f.__name__: f for f in (op1_html_layout_text, op2_quality_fm, op3_bpe_codec, op4_minhash_near_dedup, op5_chat_windows, op6_karmarkar_karp_packing, op7_pfor_token_files, op8_iblt_fingerprints, op9_pitman_yor_lm, op10_lsm_exact_dedup)}

ORACLES = {
    "op10_lsm_exact_dedup": f"SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256({_LOWER}) AS text_sha256 FROM documents WINDOW w AS (PARTITION BY {_LOWER})",
}
