"""Token shards: the wavelet matrix against plain arrays, files against the library."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from gridtally.llm import wavelet
from gridtally.llm.queries import END_ID, WORD_TOKENIZER, op13_token_shards
from gridtally.llm.wavelet import (
    WaveletMatrix, count_token, find_token, read_shards, shard_table, write_shards,
)
from gridtally.llm.word_bpe import WordEncoder
from gridtally.plans.session import staging_path
from tests.conftest import SF001


@pytest.fixture(scope="module")
def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    with open(public_tokenizers.path(WORD_TOKENIZER), encoding="utf-8") as f:
        return f.read()


def library_ids(tokenizer, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 5), (511, 3), (512, 700), (513, 2),
                                    (5000, 49408), (4096, 1), (9999, 17)])
def test_matrix_against_a_plain_array(n, top):
    rng = np.random.default_rng(n)
    values = (rng.integers(0, top, n) // rng.integers(1, 9, n)).astype("<u2")
    m = WaveletMatrix.from_bytes(WaveletMatrix.build(values).to_bytes())
    assert (m.decode(np.dtype("<u4")) == values).all() and m.n == n
    at = rng.integers(0, n, 200) if n else np.zeros(0, int)
    assert (m.access(at) == values[at]).all()
    for token in {*values[:20].tolist(), 0, top, top + 1, 1 << 17}:
        places = np.flatnonzero(values == token)
        assert m.rank(token) == len(places)
        assert (m.select(token) == places).all()
        lo, hi = sorted(rng.integers(0, n + 1, 2).tolist())
        assert m.rank(token, hi, lo) == ((places >= lo) & (places < hi)).sum()
        if len(places):
            k = len(places) // 2
            assert m.select(token, [k])[0] == places[k]
            with pytest.raises(IndexError):
                m.select(token, [len(places)])
    with pytest.raises(IndexError):
        m.access([n])


def test_file_is_smaller_than_the_ids_and_knows_its_kind():
    values = np.minimum(np.random.default_rng(3).zipf(1.5, 100_000), 49_000).astype("<u2")
    image = WaveletMatrix.build(values).to_bytes()
    assert len(image) < values.nbytes
    with pytest.raises(ValueError):
        WaveletMatrix.from_bytes(b"another file" + image)


def test_encoder_equals_the_library(tokenizer, pairs, odd):
    texts = [t or "" for _, t in pairs] + [r.text or "" for r in odd.collect()] + [
        "", " ", "<|endoftext|> x<|startoftext|>y <|", "don't WE'LL I'd &'s ''s 's '", "é ́ a",
        "İstanbul ΑΣ ς ﬁ ½ ² ª º µ × ÷ a×b ß ẞ ÿ Ÿ ÀÖØÞ", "日本語 12345 ٣٤", "\x00a\x1cb\x0bc\x0cd\x85e\xa0f g",
        "a\r\nb\tc", "😀😀 👩‍👩‍👧", "a﻿b ​ c"]
    encoder = WordEncoder(tokenizer)
    got = []
    for k in (3, 400):  # batches, and a slice of an array
        for i in range(0, len(texts), k):
            ids, n = encoder.encode(pa.array(texts).slice(i, k))
            got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert got == library_ids(tokenizer, texts)
        got = []


def test_encoder_starts_anew_when_it_is_full(tokenizer, pairs, monkeypatch):
    import gridtally.llm.word_bpe as word_bpe

    monkeypatch.setattr(word_bpe, "KEPT", 50)
    encoder, texts = WordEncoder(tokenizer), [t or "" for _, t in pairs[:60]]
    for i in range(0, 60, 7):
        ids, n = encoder.encode(pa.array(texts[i:i + 7]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == library_ids(
            tokenizer, texts[i:i + 7])


def test_an_encoder_keeps_a_bounded_number_of_pieces(tokenizer, monkeypatch):
    import gridtally.llm.word_bpe as word_bpe

    monkeypatch.setattr(word_bpe, "KEPT", 2000)
    encoder, sizes = WordEncoder(tokenizer), []
    for i in range(12):
        texts = [f"{'met again ' * 3} only{chr(97 + i)}{'xyz'[j % 3] * (j // 3 + 1)} A{i}b{j}." for j in range(90)]
        ids, n = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == library_ids(tokenizer, texts)
        held = [x for x in vars(encoder).values() if isinstance(x, dict)]
        sizes.append(sum(map(len, held)))
        assert "again" in encoder.known  # what is met in each batch stays
    # of pieces and words together, and what one batch adds at most
    assert max(sizes) <= 2000 + 2 * 400 and max(sizes) > 1000


def test_other_tokenizers_are_refused(tokenizer):
    with pytest.raises(ValueError):
        WordEncoder(tokenizer.replace("Lowercase", "NFD"))


@pytest.mark.parametrize("shard_tokens, partitions", [(64, 3), (1 << 21, 5)])
def test_shards_of_odd_documents(spark, odd, tokenizer, monkeypatch, shard_tokens, partitions):
    monkeypatch.setattr(wavelet, "SLICE_BYTES", 5000)
    docs = odd.withColumnRenamed("n_chars", "tie").withColumnRenamed("fp", "key")
    path = staging_path(spark, "t-shards")
    write_shards(docs, "text", "doc_id", path, tokenizer, END_ID, shard_tokens, partitions)
    rows = [tuple(r) for r in read_shards(spark, path).orderBy("start").collect()]
    ids = [r[3] for r in rows]
    given = odd.select("doc_id", "text").collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, np.array([*i, END_ID], "<u4").tobytes())
                  for r, i in zip(given, library_ids(tokenizer, [r.text for r in given])))
    assert sorted((r[0] is not None, r[0] or 0, bytes(r[3])) for r in rows) == want
    assert [(r[0] is not None, r[0] or 0) for r in rows] == [w[:2] for w in want]
    assert [r[1] for r in rows] == [sum(len(x) // 4 for x in ids[:i]) for i in range(len(ids))]
    assert [r[2] for r in rows] == [len(x) // 4 for x in ids]
    files = shard_table(spark, path).collect()
    assert len(files) == len(spark.read.parquet(path).inputFiles())
    assert all(f.n_tokens <= shard_tokens or f.n_docs == 1 for f in files)

    everything = np.concatenate([np.frombuffer(x, "<u4") for x in ids])
    for token in (END_ID, int(everything[5]), 40_000):
        hits = [(r[0], p) for r in rows
                for p in np.flatnonzero(np.frombuffer(r[3], "<u4") == token).tolist()]
        found = [tuple(r) for r in find_token(spark, path, token).collect()]
        key = lambda x: (x[0] is not None, x[0] or 0, x[1])
        assert sorted(found, key=key) == sorted(hits, key=key)
        assert sum(r.n for r in count_token(spark, path, token).collect()) == len(hits)


def test_empty_table_and_text_keys(spark, tokenizer):
    path = staging_path(spark, "t-shards")
    empty = spark.createDataFrame([], "doc_id long, text string")
    write_shards(empty, "text", "doc_id", path, tokenizer, END_ID)
    assert read_shards(spark, path).count() == 0 and find_token(spark, path, 1).count() == 0
    path = staging_path(spark, "t-shards")
    named = spark.createDataFrame([("doc-2", "two"), ("doc-1", None)], "doc_id string, text string")
    write_shards(named, "text", "doc_id", path, tokenizer, END_ID)
    rows = read_shards(spark, path, "string").orderBy("start").collect()
    assert [(r.key, r.start, r.n_tokens) for r in rows] == [("doc-1", 0, 1), ("doc-2", 1, 2)]


def test_query_against_the_library(spark, tokenizer):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()
    start, want = 0, []
    for d, ids in zip(docs, library_ids(tokenizer, [d.text for d in docs])):
        ids = [*ids, 1]
        want.append((d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, op13_token_shards(spark, SF001).collect())) == want
