"""Toxicity: a convolutional text classifier, trained in numpy.

Words are hashed: a word's embedding is the mean of the rows of its whole form,
of its first four and five bytes and of its last four. Filters of one, two and
three words slide over the text; each filter's maximum over all positions goes
through a rectifier into a logistic output. The embedding's first column starts
as the smoothed log odds of a feature among toxic and clean training texts and
everything is then fitted by Adagrad.

Scoring needs no matrix product per position: a word's embedding times all
filter weights is computed once per distinct word and looked up after that, so
the work per word is a few additions. Whole texts are scored, in chunks that
overlap by the widest filter. Thresholds are calibrated per language on training
rows that the fit has not seen; they decide ``flagged`` and never the score.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm.common import map_text, shipped, unpacked, utf8
from gridtally.llm.decontaminate import item_words
from gridtally.llm.training import labelled_sample

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
MARKS = 1 << 23  # bits for the ids of labelled rows
BINS = 1024  # of scores, for the thresholds
KNOWN_WORDS = 150_000  # distinct words that a task remembers before it starts over


def word_features(word: bytes) -> tuple[int, int, int, int]:
    """Hashed features of a word; short words repeat their whole form."""
    crc = zlib.crc32
    whole = crc(word) & (BUCKETS - 1)
    return (whole,
            crc(b"4" + word[:4]) & (BUCKETS - 1) if len(word) > 4 else whole,
            crc(b"5" + word[:5]) & (BUCKETS - 1) if len(word) > 5 else whole,
            crc(b"-" + word[-4:]) & (BUCKETS - 1) if len(word) > 4 else whole)


class TextCnn:
    """Parameters: embedding, filters (one matrix per width), biases, output."""

    def __init__(self, seed: int = 7) -> None:
        import numpy as np

        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
        self.conv = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        for c in self.conv:
            c[:, 0, :] = np.abs(c[:, 0, :]) + 0.2
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = np.full((len(WIDTHS), FILTERS), 0.1, np.float32)
        self.out_bias = np.float32(-1.0)

    def projection(self):
        """Embedding columns to the products with every filter's every position."""
        import numpy as np

        return np.concatenate([c[j] for c in self.conv for j in range(len(c))], axis=1)

    def scorer(self):
        """A function from UTF-8 text to the probability of the label."""
        import numpy as np

        table_of = self.emb @ self.projection()  # (buckets, products)
        known: dict[bytes, int] = {}
        rows = np.zeros((1024, table_of.shape[1]), np.float32)
        state = {"rows": rows}

        def positions(words):
            new = {w for w in words if w not in known}
            if new:
                if len(known) + len(new) > KNOWN_WORDS:
                    known.clear()
                    new = set(words)
                first = len(known)
                while len(state["rows"]) < first + len(new):
                    state["rows"] = np.concatenate([state["rows"], np.zeros_like(state["rows"])])
                ids = np.array([word_features(w) for w in new])
                state["rows"][first:first + len(new)] = table_of[ids].mean(axis=1)
                known.update(zip(new, range(first, first + len(new))))
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

        widest = max(WIDTHS)

        def score(text: bytes) -> float:
            words = item_words(text)
            best = [np.full(FILTERS, -np.inf, np.float32) for _ in WIDTHS]
            step = 1 << 14
            for start in range(0, max(1, len(words)), step):
                chunk = words[start:start + step + widest - 1]
                at = positions(chunk)  # may make the rows anew
                got = state["rows"][at]
                if len(words) < widest:  # as if zero words followed
                    got = np.concatenate([got, np.zeros(
                        (widest - len(words), table_of.shape[1]), np.float32)])
                col = 0
                for k, w in enumerate(WIDTHS):
                    n = len(got) - w + 1
                    if n > 0:
                        total = got[:n, col:col + FILTERS]
                        for j in range(1, w):
                            total = total + got[j:j + n, col + j * FILTERS:col + (j + 1) * FILTERS]
                        best[k] = np.maximum(best[k], total.max(axis=0))
                    col += w * FILTERS
            pooled = np.stack([np.maximum(b + c, 0) for b, c in zip(best, self.bias)])
            logit = float((pooled * self.out).sum() + self.out_bias)
            return float(1 / (1 + np.exp(-max(-30.0, min(30.0, logit)))))

        return score

    def gradients(self, ids, label: int, weight: float = 1.0):
        """Derivatives of a text's weighted log loss, None where it is as good as zero.

        ``ids`` holds the features of the text's words, one row a word. For the
        output's bias, for the other parameters in order (filters, biases,
        outputs), then the touched embedding rows and theirs.
        """
        import numpy as np

        widest = max(WIDTHS)
        emb = self.emb[ids].mean(axis=1) if len(ids) else np.zeros((0, DIM), np.float32)
        if len(emb) < widest:  # as if zero words followed
            emb = np.concatenate([emb, np.zeros((widest - len(emb), DIM), np.float32)])
        pooled, places = [], []
        for k, w in enumerate(WIDTHS):
            m = len(emb) - w + 1
            act = sum(emb[j:j + m] @ self.conv[k][j] for j in range(w))
            top = act.argmax(axis=0)
            places.append(top)
            pooled.append(np.maximum(act[top, np.arange(FILTERS)] + self.bias[k], 0))
        pooled = np.stack(pooled)
        logit = (pooled * self.out).sum() + self.out_bias
        err = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label
        if abs(err) < 0.01:
            return None
        err = np.float32(err * weight)
        back = err * self.out * (pooled > 0)
        grads, touched, pulls = [], [], []
        for k, w in enumerate(WIDTHS):
            g = np.zeros_like(self.conv[k])
            for j in range(w):
                spot = places[k] + j
                g[j] = (emb[spot] * back[k][:, None]).T
                inside = spot < len(ids)
                touched.append(ids[spot[inside]])
                pulls.append((self.conv[k][j].T * back[k][:, None])[inside])
            grads.append(g)
        grads += [back[k] for k in range(len(WIDTHS))] + [err * pooled]
        pull = np.repeat(np.concatenate(pulls) / 4, 4, axis=0)  # four features a word
        spots, where = np.unique(np.concatenate(touched).ravel(), return_inverse=True)
        pulled = np.zeros((len(spots), DIM), np.float32)
        np.add.at(pulled, where, pull)
        return err, grads, spots, pulled

    def fit(self, samples: list[tuple[bytes, int]], rounds: int = 4, rate: float = 0.05,
            seed: int = 7) -> TextCnn:
        """Adagrad over whole training texts, one text a step.

        Texts with the label weigh as the root of clean texts per text with it
        (at least 1): a missed one costs more than a false alarm.
        """
        import numpy as np

        rng = np.random.default_rng(seed)
        memo: dict[bytes, tuple] = {}
        docs = []
        for text, label in samples:
            words = item_words(text)
            for w in words:
                if w not in memo:
                    memo[w] = word_features(w)
            ids = np.array([memo[w] for w in words], np.int32).reshape(-1, 4)
            docs.append((ids, label))
        memo.clear()
        seen = np.zeros((2, BUCKETS), np.float64)
        for ids, label in docs:
            seen[label][np.unique(ids)] += 1
        n = [max(1, sum(1 for _, y in docs if y == k)) for k in (0, 1)]
        odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
        # a feature that is rare among texts says little either way
        weight = (seen[0] + seen[1]) / (seen[0] + seen[1] + 5.0)
        self.emb[:, 0] = 0.5 * odds * weight
        weights = (1.0, max(1.0, (n[0] / n[1]) ** 0.5))
        past = [np.full_like(x, 1e-2) for x in (*self.conv, *self.bias, self.out)]
        past_emb, past_out = np.full_like(self.emb, 1e-2), 1e-2
        for _ in range(rounds):
            for at in rng.permutation(len(docs)):
                ids, label = docs[at]
                step = self.gradients(ids, label, weights[label])
                if step is None:
                    continue
                err, grads, spots, pulled = step
                for p, g, h in zip((*self.conv, *self.bias, self.out), grads, past):
                    h += g * g
                    p -= rate * g / np.sqrt(h)
                past_out += err * err
                self.out_bias -= rate * err / np.sqrt(past_out)
                past_emb[spots] += pulled * pulled
                self.emb[spots] -= rate * pulled / np.sqrt(past_emb[spots])
        return self


def binned_threshold(counts: dict[int, list[int]]) -> float:
    """The cut with the fewest errors; in the widest gap of equally good ones.

    ``counts``: rows labelled 0 and rows labelled 1 by score bin.
    """
    if not all(sum(c[y] for c in counts.values()) for y in (0, 1)):
        return 0.5
    bins = sorted(counts)
    errors = sum(c[0] for c in counts.values())  # everything flagged
    cuts = [(errors, 0.0, bins[0] / BINS)]
    for i, b in enumerate(bins):
        errors += counts[b][1] - counts[b][0]
        cuts.append((errors, (b + 1) / BINS, bins[i + 1] / BINS if i + 1 < len(bins) else 1.0))
    least = min(e for e, _, _ in cuts)
    _, a, b = max((c for c in cuts if c[0] == least), key=lambda c: c[2] - c[1])
    return (a + b) / 2


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``_gt_id`` may be among ``ids``, without moving any of them.

    A bitmap of ``MARKS`` bits (1 MB, whatever the input) is broadcast. Where ids share
    a bit, and that is everywhere with far more ids than bits, rows too many are left,
    which the exact join on their scores drops.
    """
    slot = F.pmod(F.xxhash64("_gt_id"), F.lit(MARKS))
    bits = ids.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("_gt_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("_gt_bits"))
    at = F.bitmap_bit_position("_gt_slot").cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_gt_bits"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10)
    held = byte.cast("int").bitwiseAND(F.element_at(
        F.array(*[F.lit(1 << i) for i in range(8)]), at % 8 + 1)) > 0
    return rows.withColumn("_gt_slot", slot).withColumn(
        "_gt_bucket", F.bitmap_bucket_number("_gt_slot")).join(
        F.broadcast(bits), "_gt_bucket").where(held).select(*rows.columns)


def calibrate(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
              lang_col: str, usable: Column, model: TextCnn, fitted: list[tuple]) -> dict:
    """Thresholds by language from all usable labelled rows but the ``fitted`` (id, text hash).

    Only counts by language, score bin and label reach the driver.
    """
    given = labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("_gt_id")).agg((F.max(label_col) > 0).cast("int").alias("_gt_label"))
    kind = docs.schema[id_col].dataType
    given = given.withColumn("_gt_id", F.col("_gt_id").cast(kind))
    taken = docs.sparkSession.createDataFrame(fitted, T.StructType(
        [T.StructField("_gt_id", kind), T.StructField("_gt_hash", T.LongType())]))
    rows = _marked(docs.where(usable & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_gt_id"), F.col(lang_col).cast("string").alias("_gt_tongue"),
        F.col(text_col).alias("_gt_body")), given)
    scored = score_toxicity(rows, "_gt_body", [
        F.col("_gt_id"), F.col("_gt_tongue"), F.xxhash64(utf8("_gt_body")).alias("_gt_hash")], model)
    left = scored.join(F.broadcast(taken), ["_gt_id", "_gt_hash"], "left_anti").join(given, "_gt_id")
    bins = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int")
    langs: dict = {}
    for lang, b, label, n in left.groupBy("_gt_tongue", bins.alias("b"), "_gt_label").count().collect():
        for key in {lang, None}:
            langs.setdefault(key, {}).setdefault(b, [0, 0])[label] += n
    cuts = {None: binned_threshold(langs.get(None, {}))}
    for lang, counts in langs.items():
        if all(sum(c[y] for c in counts.values()) for y in (0, 1)):
            cuts[lang] = binned_threshold(counts)
    return cuts


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                   label_col: str, lang_col: str, usable: Column, max_rows: int = 6000,
                   max_bytes: int = 65536) -> tuple[TextCnn | None, dict]:
    """The fitted classifier and the thresholds by language (None: all others).

    Without usable rows, or with one label only, there is no classifier. Every
    fifth row of the sample is not fitted, and the thresholds rest on all usable
    labelled rows that are not. ``usable`` is a condition on the id.
    """
    rows = labelled_sample(docs, labels, id_col, text_col, label_col, usable, max_rows,
                           max_bytes, [F.col(id_col), F.xxhash64(utf8(text_col))])
    fit = [r for i, r in enumerate(rows) if i % 5]
    if len({label > 0 for _, label, *_ in fit}) < 2:
        return None, {None: 0.5}
    model = TextCnn().fit([(text, 1 if label > 0 else 0) for text, label, *_ in fit])
    return model, calibrate(docs, labels, id_col, text_col, label_col, lang_col, usable, model,
                            [(key, digest) for _, _, key, digest in fit])


def score_toxicity(df: DataFrame, text_col: str, keep: list, model: TextCnn | None,
                   lang: Column | None = None, cuts: dict | None = None) -> DataFrame:
    """``keep`` columns, ``score`` and ``flagged`` for every whole text.

    Null and empty texts are scored as texts without words. Without a model
    every score is 0. ``flagged`` compares the score with the threshold of the
    row's language (unknown or null: the common one).
    """
    cuts = cuts or {None: 0.5}
    spark = df.sparkSession
    held = shipped(spark, model)  # about 2 MB, whatever the input
    cut = F.lit(float(cuts.get(None, 0.5)))
    for name in sorted(k for k in cuts if k is not None):
        cut = F.when(F.col("_gt_lang") == name, float(cuts[name])).otherwise(cut)

    def start():
        model = unpacked(held)
        if model is None:
            return lambda text: (0.0,)
        score = model.scorer()
        return lambda text: (score(text),)

    tongue = (lang if lang is not None else F.lit(None)).cast("string").alias("_gt_lang")
    scored = map_text(df, [*keep, tongue], text_col, start,
                      [T.StructField("score", T.DoubleType())])
    return scored.withColumn("flagged", F.col("score") >= cut).drop("_gt_lang")
