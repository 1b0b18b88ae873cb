"""A corpus pipeline over ``documents``.

``STAGES`` lists (name, function) in order; each function takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and reread as the next
stage's ``docs``. ``run`` applies them to the table ``documents`` of ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm.bpe import bpe_decode, bpe_encode, token_digests
from gridtally.llm.decontaminate import find_contamination
from gridtally.llm.line_dedup import dedup_lines
from gridtally.llm.quality_rules import keep_good
from gridtally.llm.queries import tokenizer_files
from gridtally.llm.simhash import near_dedup
from gridtally.plans.session import drop_staged, staging_path


def _columns(df: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in df.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return keep_good(docs, "text")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; ``n_chars`` follows the text."""
    out = ("_gt_lines", "_gt_dropped", "_gt_kept")
    rows = dedup_lines(docs, "doc_id", "text", _columns(docs), out)
    changed = {"text": F.when(F.col("text").isNull(), None).otherwise(F.col("_gt_kept"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_gt_dropped") == 0, F.col("n_chars")).otherwise(
            F.length("_gt_kept").cast(docs.schema["n_chars"].dataType))
    return rows.withColumns(changed).select(*_columns(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return near_dedup(docs, "doc_id", "text", shingle=3, max_distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(docs, benchmark, "text", "item_id", "text",
                               [F.struct(*_columns(docs)).alias("_gt_doc")])
    return found.where(F.size("spans") == 0).select("_gt_doc.*")


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the token ids of the text, and digests of both ways."""
    ranks, pattern = tokenizer_files()
    kept = [F.col(c) for c in ("doc_id", "lang", "source") if c in docs.columns]
    encoded = bpe_encode(docs, "text", kept, ranks, pattern)
    rows = bpe_decode(encoded, "ids", ranks)
    return rows.select(*[c for c in ("doc_id", "lang", "source") if c in docs.columns], "ids",
                       *token_digests())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("bpe_tokens", bpe_tokens),
]

#: SQL has neither XXH64 fingerprints nor BPE; tests hold run() against a
#: brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages; each one's rows are written to the shared folder.

    A stage's folder goes when the next one is written; the one that the lazy
    result reads stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = staging_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_staged(spark, before)  # nothing reads it any more
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
