"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import utf8


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    label_col: str, usable: Column, max_rows: int, max_bytes: int,
                    extra: list[Column] = ()) -> list:
    """At most ``max_rows`` rows (text, label, extra columns) to fit a model on.

    Of the labelled ids for which ``usable`` holds, those with the smallest
    hash of the id are taken, so the choice is the same in every run and does
    not depend on the tables' order. Conflicting labels of one id: the largest
    counts; null ids and labels are left out; so are texts over ``max_bytes``.
    The sample is a classifier's training set only; scores cover all rows.
    """
    chosen = (labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("_gt_id")).agg(F.max(label_col).alias("_gt_label"))
              .orderBy(F.xxhash64("_gt_id"), "_gt_id").limit(max_rows))
    texts = docs.select(F.col(id_col).alias("_gt_id"), utf8(text_col).alias("_gt_text"),
                        *[c.alias(f"_gt_x{i}") for i, c in enumerate(extra)])
    rows = texts.where(F.octet_length("_gt_text") <= max_bytes).join(
        F.broadcast(chosen), "_gt_id").orderBy(F.xxhash64("_gt_id", "_gt_text")).limit(max_rows)
    return [(bytes(r._gt_text), int(r._gt_label), *tuple(r)[3:]) for r in rows.select(
        "_gt_id", "_gt_text", "_gt_label", *[f"_gt_x{i}" for i in range(len(extra))]).collect()]
