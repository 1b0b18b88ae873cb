"""Whitening and hard negatives against plain numpy over the same rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.llm import hard_negatives, whitening
from gridtally.llm.hard_negatives import Packed, Tops, field_bits, mine_hard_negatives
from gridtally.llm.queries import op11_whitening, op12_hard_negatives
from gridtally.llm.vectors import Extent, extent
from gridtally.llm.whitening import whiten
from tests.conftest import SF01


@pytest.fixture(scope="module")
def strange(spark):
    """Vectors with every odd case, under column names that the operators use themselves."""
    rng = random.Random(3)

    def v(n=5):
        return [rng.uniform(-1, 1) for _ in range(n)]

    hot = v()
    rows = [(i, v(), rng.randrange(3)) for i in range(120)]
    rows += [(200 + i, hot, i % 2) for i in range(60)]  # copies, ties in every score
    rows += [(300, None, 1), (301, [None, 1.0, 0.0, 0.0, 0.0], 1), (302, [math.nan] * 5, 1),
             (303, [math.inf, 0.0, 0.0, 0.0, 0.0], 2), (304, v(4), 0), (305, [], 0), (306, v(), None),
             (None, v(), 1), (50, v(), 2), (50, rows[50][1], 0), (7, rows[7][1], rows[7][2]),
             (307, [-0.0] * 5, 1), (308, [0.0] * 5, 2)]
    return spark.createDataFrame(
        [(*r, i, "k", [1.0]) for i, r in enumerate(rows)],
        "vec_id long, embedding array<double>, label int, at int, id string, x array<double>")


def whole(rows, scale=256):
    good = [r for r in rows if r.embedding is not None and len(r.embedding) == 5
            and all(c is not None and math.isfinite(c) for c in r.embedding)]
    return good, [[math.floor(scale * c) for c in r.embedding] for r in good]


def test_whitening_of_strange_rows(spark, strange, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    docs = strange.repartition(3)
    got = whiten(docs, [F.col("vec_id"), F.col("at"), F.col("x")], "embedding", components=9).collect()
    good, x = whole(strange.collect())
    fit = np.unique(np.array(x), axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(got) == len(good) * 5  # five entries, so five components at most
    at = {r.at: k for k, r in enumerate(good)}
    signs = {}
    for r in got:
        k, j = at[r.kept.at], r.component - 1
        want = (np.array(x[k]) - s / n) @ u[:, j] / math.sqrt(e[j])
        sign = signs.setdefault(j, 1 if abs(want - r.whitened) < abs(want + r.whitened) else -1)
        assert abs(sign * want - r.whitened) < 1e-9
        assert r.kept.vec_id == good[k].vec_id and r.kept.x == [1.0] and r.n == n
        assert int(r.deviation) == sum((n * a - int(b)) ** 2 for a, b in zip(x[k], s))
        assert abs(r.explained - e[j] / e.sum()) < 1e-12 and r.identity_error < 1e-9


def test_whitening_is_exact_with_large_numbers(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-4e6, 4e6) for _ in range(3)]) for i in range(50)]
    got = whiten(spark.createDataFrame(rows, "i long, v array<double>"), [F.col("i")], "v", scale=4096)
    x = {i: [math.floor(4096 * c) for c in v] for i, v in rows}
    s = [sum(v[j] for v in x.values()) for j in range(3)]
    for r in got.collect():
        assert int(r.deviation) == sum((50 * a - b) ** 2 for a, b in zip(x[r.kept.i], s))
        assert r.identity_error < 1e-4


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 1.0])],
                                  [(i, [0.25, 0.5]) for i in range(9)]])
def test_whitening_without_spread_gives_no_rows(spark, rows):
    df = spark.createDataFrame(rows, "i long, v array<double>")
    assert whiten(df, [F.col("i")], "v").count() == 0


def test_a_flat_direction_has_no_component(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    got = whiten(spark.createDataFrame(rows, "i long, v array<float>"), [F.col("i")], "v").collect()
    assert {r.component for r in got} == {1} and len(got) == 20
    assert all(abs(r.explained - 1) < 1e-12 for r in got)


def test_whitening_query_against_numpy(spark):
    rows = op11_whitening(spark, SF01).collect()
    given = spark.read.parquet(f"{SF01}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(256 * np.array([r.embedding for r in given], float)).astype(int)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    e, u = np.linalg.eigh((fit - s / n).T @ (fit - s / n) / n)
    want = (x - s / n) @ u[:, ::-1][:, :4] / np.sqrt(e[::-1][:4])
    z = {(r.vec_id, r.component): r for r in rows}
    got = np.array([[z[r.vec_id, c].whitened for c in (1, 2, 3, 4)] for r in given])
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-9
    assert [z[r.vec_id, 1].deviation for r in given] == ((n * x - s) ** 2).sum(1).tolist()
    assert len(rows) == 4 * len(given) and max(r.identity_error for r in rows) < 1e-9


# ------------------------------------------------------------- hard negatives
def brute(rows, positives=5, negatives=3, band=(50, 95), anchors=lambda i: i % 50 == 0):
    """(id, label, x) rows -> the operator's rows."""
    out = []
    for i, label, x in rows:
        if not anchors(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for j, other, y in rows if j != i)
        mine = [(-s, j) for s, j, other in scored if other == label][:positives]
        for score, j in mine:
            hits = [(-s, m) for s, m, other in scored
                    if other != label and band[0] * score <= -100 * s <= band[1] * score]
            out += [(i, j, k + 1, m, score, s) for k, (s, m) in enumerate(hits[:negatives])]
    return sorted(out)


def of_ids(good, x):
    """One row an id, as the docstring says; without rows that take no part."""
    best = {}
    for r, v in zip(good, x):
        if r.vec_id is not None and r.label is not None:
            best[r.vec_id] = min(best.get(r.vec_id, (9, [])), (r.label, v)) if r.vec_id in best else (
                r.label, v)
    return [(i, *b) for i, b in best.items()]


@pytest.mark.parametrize("scale", [256, 1 << 26])  # doubles, then wide integers
def test_hard_negatives_of_strange_rows(spark, strange, monkeypatch, scale):
    for name, value in (("ANCHORS", 20), ("CANDIDATES", 40), ("TILE", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    shape = extent(strange, "embedding", scale)
    assert (2 * field_bits(shape) <= 53) == (scale == 256)
    got = mine_hard_negatives(strange, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 3 == 0,
                              scale=scale)
    good, x = whole(strange.collect(), scale)
    want = brute(of_ids(good, x), anchors=lambda i: i % 3 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


@pytest.mark.parametrize("low, high, dim", [(-3, 4, 2), (0, 0, 1), (-600, 500, 64), (5, 9, 3),
                                            (-(1 << 26), 1 << 26, 4)])
def test_packed_products_are_exact(low, high, dim):
    rng = np.random.default_rng(dim)
    shape = Extent(dim, low, high, 0)
    for n in (1, 2, 3, 131):
        x, a = rng.integers(low, high + 1, (n, dim)), rng.integers(low, high + 1, (4, dim))
        x[0], a[0] = high, high
        x[-1], a[-1] = low, low
        assert (Packed(x, shape).scores(a) == a @ x.T).all()


def test_tops_keep_the_best_in_any_order():
    rng = random.Random(2)
    offers = [(rng.randrange(4), rng.randrange(6), i) for i in range(200)]
    tops = Tops(4, 3)
    for k in range(0, 200, 17):
        s, v, i = (np.array(c) for c in zip(*offers[k:k + 17]))
        tops.offer(s, v, i)
    for slot in range(4):
        best = sorted((-v, i) for s, v, i in offers if s == slot)[:3]
        assert [(-a, b) for a, b in zip(tops.score[slot], tops.ident[slot])] == best


def test_hard_negatives_of_tables_without_any(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    args = ("vec_id", "embedding", F.col("label"), F.col("vec_id") % 50 == 0)
    assert mine_hard_negatives(empty, *args).count() == 0
    alone = spark.createDataFrame([(50, [1.0], 1), (51, [1.0], 2)], empty.schema)
    assert mine_hard_negatives(alone, *args).count() == 0  # no positive


def test_hard_negatives_query_against_brute_force(spark):
    given = spark.read.parquet(f"{SF01}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label,
             [math.floor(256 * c) for c in r.embedding]) for r in given]
    assert sorted(map(tuple, op12_hard_negatives(spark, SF01).collect())) == brute(rows)
