"""The registered queries of this subpackage.

Each thin query applies one operator with its production parameters to a whole
table and derives the contract's digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm import sql
from gridtally.llm.bpe import bpe_decode, bpe_encode, read_ranks, token_digests
from gridtally.llm.decontaminate import contamination_summary, find_contamination
from gridtally.llm.hard_negatives import mine_hard_negatives
from gridtally.llm.html_extract import extract_text
from gridtally.llm.licenses import scan_licenses
from gridtally.llm.line_dedup import dedup_lines
from gridtally.llm.quality_fm import score_quality, train_quality
from gridtally.llm.quality_rules import judge
from gridtally.llm.sharding import place
from gridtally.llm.simhash import simhash_components
from gridtally.llm.toxicity import score_toxicity, train_toxicity
from gridtally.llm.training import remainder
from gridtally.llm.wavelet import read_shards, write_shards
from gridtally.llm.whitening import whiten
from gridtally.plans.session import staging_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_TOKENIZER, END_ID = "word_bpe_49k.json", 1
SHARDS = [f"shard-{i:03d}" for i in range(128)]
TABLE_SIZE = 65537


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> tuple[bytes, str]:
    """The public vocabulary's bytes and the pattern that splits texts."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"), "doc_id", "text", shingle=3,
                              max_distance=2)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(_table(spark, sf_dir, "documents"), "doc_id", "text", [F.col("doc_id")],
                       min_docs=3, min_chars=20)
    return rows.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_summary(find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), "text", "item_id",
        "text", [F.col("doc_id")], window=10))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model, cuts = train_toxicity(docs, labels, "doc_id", "text", "toxic", "lang",
                                 remainder("doc_id", 5) != 0)
    keep = [F.col("doc_id"), (remainder("doc_id", 5) == 0).alias("held_out")]
    rows = score_toxicity(docs, "text", keep, model, F.col("lang"), cuts)
    return rows.select("doc_id", "held_out", "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"), "flagged")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer_files()
    docs = _table(spark, sf_dir, "documents")
    encoded = bpe_encode(docs, "text", [F.col("doc_id")], ranks, pattern)
    return bpe_decode(encoded, "ids", ranks).select("doc_id", *token_digests())


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    rows = extract_text(pages, "url", "html", [F.col("page_id"), F.col("url")])
    return rows.withColumn("n_chars", F.length("text").cast("long"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = train_quality(docs, labels, "doc_id", "text", "quality", remainder("doc_id", 4) != 2)
    keep = [F.col("doc_id"), (remainder("doc_id", 4) == 2).alias("held_out")]
    return score_quality(docs, "text", keep, model).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(_table(spark, sf_dir, "documents"), "text", [F.col("doc_id")])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *[F.col(f"counts.{n}") for n in names], "base_failed", "kept",
                       "posterior")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id")
    return place(docs, F.col("doc_id"), SHARDS, TABLE_SIZE)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_licenses(_table(spark, sf_dir, "documents"), "text", [F.col("doc_id")])
    return rows.select("doc_id", "license", "score",
                       F.size("matches").cast("long").alias("n_matches"),
                       F.array_sort(F.array_distinct("matches.license")).alias("licenses"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(_table(spark, sf_dir, "embeddings"), [F.col("vec_id")], "embedding", scale=256,
                  components=4)
    return rows.select("kept.vec_id", "component", "n", F.col("deviation").cast("long").alias(
        "deviation"), "whitened", "explained", "identity_error")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label,
                               F.col("vec_id") % 50 == 0)


def op13_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(WORD_TOKENIZER), encoding="utf-8") as f:
        tokenizer = f.read()
    path = staging_path(spark, "token-shards")
    write_shards(_table(spark, sf_dir, "documents"), "text", "doc_id", path, tokenizer, END_ID)
    rows = read_shards(spark, path, out=F.crc32("ids").alias("ids_crc32"))
    return rows.withColumnRenamed("key", "doc_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_simhash, op2_line_dedup, op3_decontamination, op4_toxicity, op5_bpe,
        op6_html_extraction, op7_quality, op8_quality_rules, op9_sharding, op10_license_scan,
        op11_whitening, op12_hard_negatives, op13_token_shards, pipeline)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
