"""Whitespace token counts per document and over a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions.columns import whitespace_tokens


def doc_token_counts(docs: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, n_distinct_tokens)`` per document, whole text."""
    toks = whitespace_tokens(text_col)
    return docs.select(
        id_col,
        F.size(toks).cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct(toks)).cast("bigint").alias("n_distinct_tokens"),
    )


def corpus_token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(token, n)`` over all documents. Tokens are exploded in place and
    counted with partial aggregation, so frequent tokens are combined per
    task before the shuffle."""
    return (docs.select(F.explode(whitespace_tokens(text_col)).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
