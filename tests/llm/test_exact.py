"""Operators with exact results against brute force, on the test tables and on
odd documents (nulls, blanks, ties, repeated rows, long texts, clashing columns)."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gridtally.llm import queries as Q
from gridtally.llm.bpe import bpe_decode, bpe_encode, token_digests
from gridtally.llm.decontaminate import contamination_summary, find_contamination
from gridtally.llm.line_dedup import dedup_lines
from gridtally.llm.quality_rules import judge
from gridtally.llm.simhash import near_dedup, simhash_components
from tests.conftest import SF01
from tests.llm import brute
from tests.llm.conftest import odd_documents


def same(df, want):
    assert Counter(tuple(r) for r in df.collect()) == Counter(want)


@pytest.fixture(scope="module")
def encoding():
    return brute.tokenizer(public_tokenizers.path(Q.VOCABULARY), public_tokenizers.PATTERN)


def test_simhash_query(spark, pairs):
    same(Q.op1_simhash(spark, SF01), brute.simhash(pairs))


def test_simhash_odd(odd):
    same(simhash_components(odd, "doc_id", "text"), brute.simhash(odd_documents()))


def test_line_dedup_query(spark, pairs):
    got = Q.op2_line_dedup(spark, SF01)
    same(got, [(d, n, k, brute.sha(t)) for d, n, k, t in brute.line_dedup(pairs)])


def test_line_dedup_odd(odd):
    got = dedup_lines(odd, "doc_id", "text", [F.col("doc_id")])
    same(got, brute.line_dedup(odd_documents()))


def test_contamination_query(spark, pairs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    want = brute.contamination(pairs, items)
    assert sum(w[-1] for w in want) > 0
    same(Q.op3_decontamination(spark, SF01), want)


@pytest.mark.parametrize("part_bytes", [4 << 20, 240])
def test_contamination_odd(spark, odd, part_bytes):
    items = [(1, "one two"), (2, "one"), (3, None), (4, "...!"), (None, "no id at all"),
             (5, "AB ab ab ab ab cd ef gh ab ab ab AB ab"), (5, "under the same"),
             (6, odd_documents()[0][1]), (60, "déjà3"), (7, "line line")]
    table = spark.createDataFrame(items, "item_id int, text string")
    found = find_contamination(odd, table, "text", "item_id", "text", [F.col("doc_id")],
                               part_bytes=part_bytes)
    same(contamination_summary(found), brute.contamination(odd_documents(), items))


def test_bpe_query(spark, pairs, encoding):
    same(Q.op5_bpe(spark, SF01), brute.bpe(pairs, encoding))


def test_bpe_odd(spark, odd, encoding):
    ranks, pattern = Q.tokenizer_files()
    got = bpe_decode(bpe_encode(odd, "text", [F.col("doc_id")], ranks, pattern), "ids", ranks)
    same(got.select("doc_id", *token_digests()), brute.bpe(odd_documents(), encoding))


def test_quality_counts_query(spark, pairs):
    rows = Q.op8_quality_rules(spark, SF01).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words, r.base_failed) for r in rows)
    want = []
    for d, t in pairs:
        c = brute.rule_counts(t)
        want.append((d, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == Counter(want)
    assert not any(r.kept and r.base_failed for r in rows)


def test_quality_counts_odd(odd):
    rows = judge(odd, "text", [F.col("doc_id")]).select("doc_id", "counts.*").collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words) for r in rows)
    assert got == Counter((d, *brute.rule_counts(t)) for d, t in odd_documents())


def test_near_dedup_keeps_one_of_each_class(odd):
    kept = near_dedup(odd, "doc_id", "text")
    assert kept.columns == odd.columns
    docs = odd_documents()
    low = -(1 << 63)
    classes = {}  # ids by class, rows told apart by their position
    for i, _, root in brute.simhash([(i, t) for i, (_, t) in enumerate(docs)]):
        classes.setdefault(root, []).append(low if docs[i][0] is None else docs[i][0])
    got = Counter(low if r.doc_id is None else r.doc_id for r in kept.collect())
    assert got == Counter(map(min, classes.values()))


def test_license_query_equals_all_templates_on_all_passages(spark, pairs):
    from gridtally.llm.licenses import TEMPLATES

    def bag(text):
        words = brute.ITEM_WORD.findall(text.translate(brute.LOWER))
        return Counter(zip(words, words[1:]))

    known = [(n, bag(t)) for n, texts in TEMPLATES.items() for t in texts]

    def best(passage):
        mine = bag(passage)
        scores = [(-2 * (mine & t).total() / (mine.total() + t.total()), n) for n, t in known]
        score, name = min(scores)
        return (score, name) if mine and -score >= 0.8 else None

    want = []
    for d, text in pairs:
        lines = (text or "").split("\n")
        passages = [x for x in lines if brute.ITEM_WORD.search(x)]
        block, blocks = [], []
        for x in [*lines, ""]:
            if brute.ITEM_WORD.search(x):
                block.append(x)
            else:
                blocks.append(block)
                block = []
        passages += ["\n".join(b) for b in blocks if len(b) > 1]
        whole = sum(bool(brute.ITEM_WORD.search(x)) for x in lines) > 1
        passages += [text] if whole else []
        if whole and len(lines) == max(map(len, blocks)):
            passages.pop()  # the only paragraph is the whole text
        hits = [h for h in map(best, passages) if h]
        score, name = min(hits, default=(0.0, None), key=lambda h: (h[0], h[1] or ""))
        want.append((d, name, -score, len(hits)))
    got = Q.op10_license_scan(spark, SF01).collect()
    assert Counter((r.doc_id, r.license, round(r.score, 9), r.n_matches) for r in got) == Counter(
        (d, n, round(s, 9) + 0.0, k) for d, n, s, k in want)
