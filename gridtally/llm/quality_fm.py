"""Quality classifier: a factorisation machine.

Inputs are hashed words, structure statistics and metadata of the text (length,
lines, share of non-ASCII bytes). Words weigh ``sqrt(count)``, scaled to length
one; each statistic is one of ``BINS`` indicator inputs, cut at quantiles of the
training texts, so pairs of statistics and words interact through their rank-
``RANK`` factors. Scores take linear time by the identity

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).
"""

from __future__ import annotations

import zlib
from collections import Counter
from math import log1p

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from gridtally.llm.common import map_text, shipped, unpacked
from gridtally.llm.decontaminate import item_words
from gridtally.llm.training import labelled_sample

BUCKETS, RANK, BINS = 1 << 15, 8, 8
KNOWN_WORDS = 200_000

_SYMBOLS, _MARKS, _DIGITS = b"#*$%&|<>", b"!?", b"0123456789"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HIGH = bytes(range(128, 256))

STATISTICS = ("words", "symbols", "upper", "marks", "digits", "distinct", "top_word",
              "same_as_before", "dup_lines", "word_bytes", "stops", "lines", "bytes", "non_ascii")


def statistics(text: bytes) -> list[float]:
    """Shares and log sizes of a text, in the order of ``STATISTICS``."""
    size = len(text)
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]

    def share(chars: bytes, of: int) -> float:
        return (size - len(text.translate(None, chars))) / max(1, of)

    return [
        log1p(len(words)), share(_SYMBOLS, n), share(_UPPER, size), share(_MARKS, n),
        share(_DIGITS, size), len(counts) / n, max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)), sum(map(len, words)) / n,
        share(b".", n), log1p(len(lines)), log1p(size), share(_HIGH, size)]


class FactorisationMachine:
    """Bias, linear weights and rank-``RANK`` factors over all inputs."""

    def __init__(self, seed: int = 11) -> None:
        import numpy as np

        n = BUCKETS + len(STATISTICS) * BINS
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.linear = np.zeros(n, np.float32)
        self.factors = rng.normal(0, 0.02, (n, RANK)).astype(np.float32)
        self.edges = np.zeros((len(STATISTICS), BINS - 1))

    def encoder(self):
        """A function from text to (input numbers, values)."""
        import numpy as np

        edges = self.edges
        base = BUCKETS + BINS * np.arange(len(STATISTICS))

        class Known(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) >= KNOWN_WORDS:
                    self.clear()
                at = self[word] = zlib.crc32(word) & (BUCKETS - 1)
                return at

        known = Known()

        def encode(text: bytes):
            words = item_words(text)
            ids, counts = np.unique(
                np.fromiter(map(known.__getitem__, words), np.int64, len(words)),
                return_counts=True)
            values = np.sqrt(counts, dtype=np.float32)
            values /= max(1e-6, float(np.sqrt((values * values).sum())))
            stats = np.array(statistics(text))
            bins = base + (stats[:, None] > edges).sum(axis=1)
            return (np.concatenate([ids, bins]),
                    np.concatenate([values, np.ones(len(bins), np.float32)]))

        return encode

    def logit(self, ids, values) -> float:
        v = self.factors[ids] * values[:, None]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        return float(self.bias) + float(self.linear[ids] @ values) + pairs

    def scorer(self):
        """A function from UTF-8 text to the probability of the label."""
        from math import exp

        encode = self.encoder()

        def score(text: bytes) -> float:
            return 1 / (1 + exp(-max(-30.0, min(30.0, self.logit(*encode(text))))))

        return score

    def fit(self, samples: list[tuple[bytes, int]], rounds: int = 6, rate: float = 0.08,
            decay: float = 1e-4, seed: int = 11) -> FactorisationMachine:
        """Adagrad on the logistic loss, one text a step, both classes equally heavy.

        The score is then shifted back to the training share of the label.
        """
        import numpy as np

        stats = np.array([statistics(t) for t, _ in samples])
        cuts = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
        # the outermost bins hold rare extremes, which matter most
        cuts[:, 0] = np.quantile(stats, 0.02, axis=0)
        cuts[:, -1] = np.quantile(stats, 0.95, axis=0)
        self.edges = np.sort(cuts, axis=1)
        encode = self.encoder()
        rows = [(*encode(t), y) for t, y in samples]
        n_one = sum(y for _, _, y in rows)
        weight = (len(rows) / (2 * (len(rows) - n_one)), len(rows) / (2 * n_one))
        h_bias, h_lin, h_fac = 1e-2, np.full_like(self.linear, 1e-2), np.full_like(self.factors, 1e-2)
        rng = np.random.default_rng(seed)
        for _ in range(rounds):
            for at in rng.permutation(len(rows)):
                ids, x, y = rows[at]
                f = self.factors[ids]
                v = f * x[:, None]
                total = v.sum(axis=0)
                logit = self.bias + self.linear[ids] @ x + 0.5 * (total ** 2 - (v * v).sum(axis=0)).sum()
                err = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight[y]
                g_lin = err * x + decay * self.linear[ids]
                g_fac = err * x[:, None] * (total - v) + decay * f
                h_bias += err * err
                self.bias -= rate * err / np.sqrt(h_bias)
                h_lin[ids] += g_lin ** 2
                self.linear[ids] -= rate * g_lin / np.sqrt(h_lin[ids])
                h_fac[ids] += g_fac ** 2
                self.factors[ids] -= rate * g_fac / np.sqrt(h_fac[ids])
        self.bias = float(self.bias) + float(np.log(weight[0] / weight[1]))
        return self


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                  label_col: str, usable: Column, max_rows: int = 6000,
                  max_bytes: int = 65536) -> FactorisationMachine | None:
    """The fitted machine; None without usable rows or with one label only."""
    rows = labelled_sample(docs, labels, id_col, text_col, label_col, usable, max_rows, max_bytes)
    samples = [(t, 1 if y > 0 else 0) for t, y in rows]
    if len({y for _, y in samples}) < 2:
        return None
    return FactorisationMachine().fit(samples)


def score_quality(df: DataFrame, text_col: str, keep: list,
                  model: FactorisationMachine | None) -> DataFrame:
    """``keep`` columns and ``score`` for every whole text.

    Null and empty texts are scored by their statistics alone. Without a model
    every score is 0.
    """
    held = shipped(df.sparkSession, model)  # about 1 MB, whatever the input

    def start():
        model = unpacked(held)
        if model is None:
            return lambda text: (0.0,)
        score = model.scorer()
        return lambda text: (score(text),)

    return map_text(df, keep, text_col, start, [T.StructField("score", T.DoubleType())])
