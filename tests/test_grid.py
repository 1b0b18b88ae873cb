import random

import pytest
from pyspark.sql import functions as F

from gridtally.functions.grid import coarsen, located, mgrs, with_mgrs

# Golden vectors (lat, lon, p5, p3, p2, p1).
GOLDEN = [
    (42.0, -93.0, "15TWG0000049776", "15TWG000497", "15TWG0049", "15TWG04"),
    (0.0, 0.0, "31NAA6602100000", "31NAA660000", "31NAA6600", "31NAA60"),
    (38.8895, -77.0353, "18SUJ2347806483", "18SUJ234064", "18SUJ2306", "18SUJ20"),
    (-33.8568, 151.2153, "56HLH3490052288", "56HLH349522", "56HLH3452", "56HLH35"),
    (21.3069, -157.8583, "04QFJ1841756542", "04QFJ184565", "04QFJ1856", "04QFJ15"),
    (60.39, 5.32, "32VKN9723000510", "32VKN972005", "32VKN9700", "32VKN90"),
    (78.22, 15.65, "33XWG1481383004", "33XWG148830", "33XWG1483", "33XWG18"),
]


def test_golden_vectors(spark):
    df = spark.createDataFrame([g[:2] for g in GOLDEN], "lat double, lon double")
    out = with_mgrs(df, "lat", "lon", {"p5": 5, "p3": 3, "p2": 2, "p1": 1}).collect()
    for row, g in zip(out, GOLDEN):
        assert (row.p5, row.p3, row.p2, row.p1) == g[2:]


def test_single_column_form_matches_staged(spark):
    df = spark.createDataFrame([g[:2] for g in GOLDEN], "lat double, lon double")
    a = df.select(mgrs("lat", "lon", 3).alias("g")).collect()
    assert [r.g for r in a] == [g[3] for g in GOLDEN]


def test_edge_inputs(spark):
    rows = [(None, "1.0"), ("95", "1.0"), ("abc", "2"), ("NaN", "3"), ("-90.5", "3"),
            ("10", "181"), ("10", "180"), ("84", "0"), ("-80", "0"), (" 21.3069", "-157.8583")]
    df = spark.createDataFrame(rows, "lat string, lon string")
    out = with_mgrs(df, "lat", "lon", {"g": 3}).select("g", located("lat", "lon").alias("ok"))
    got = [(r.g, r.ok) for r in out.collect()]
    assert [g for g, _ in got[:6]] == [None] * 6
    assert [ok for _, ok in got[:6]] == [False] * 6
    assert got[6][0].startswith("01P")  # lon 180 is the antimeridian: zone 1
    assert got[7][0][2] == "X" and got[8][0][2] == "C"
    assert got[9][0] == "04QFJ184565"  # text with a leading blank is read
    assert all(ok == (g is not None) for g, ok in got)


def test_coarsen_equals_direct(spark):
    rnd = random.Random(7)
    pts = [(rnd.uniform(-79.9, 83.9), rnd.uniform(-180, 180)) for _ in range(3000)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    out = with_mgrs(df, "lat", "lon", {"g5": 5, "g3": 3, "g2": 2, "g1": 1})
    bad = out.filter(
        (coarsen("g5", 3, 5) != F.col("g3")) | (coarsen("g5", 2, 5) != F.col("g2"))
        | (coarsen("g5", 1, 5) != F.col("g1")) | (coarsen("g3", 1, 3) != F.col("g1"))
    ).count()
    assert bad == 0
    assert out.filter(F.col("g5").isNull()).count() == 0
    assert out.filter(~F.col("g3").rlike(r"^\d{2}[C-HJ-NP-X][A-HJ-NP-Z][A-HJ-NP-V]\d{6}$")).count() == 0


def test_precision_bounds():
    with pytest.raises(ValueError):
        mgrs("a", "b", 6)
    with pytest.raises(ValueError):
        coarsen("g", 4, 3)


def test_column_and_sql_forms_agree_worldwide(spark):
    """``mgrs`` (Column functions) and ``with_mgrs`` (staged SQL expressions)
    are two spellings of the same arithmetic: identical ids everywhere."""
    rnd = random.Random(13)
    pts = [(rnd.uniform(-85, 85), rnd.uniform(-181, 181)) for _ in range(20000)]
    pts += [(56.5, 3.5), (72.5, 8.9), (72.5, 9.0), (-80.0, -180.0), (84.0, 179.99)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    a = with_mgrs(df, "lat", "lon", {"g5": 5, "g2": 2})
    b = df.select("*", mgrs("lat", "lon", 5).alias("g5")).select(
        "*", mgrs("lat", "lon", 2).alias("g2"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_unbounded_coordinates_give_null(spark):
    """Under ANSI rules one huge or infinite value must not end the job."""
    rows = [("10", x) for x in ("1e20", "Infinity", "-Infinity", "NaN", "-1e308", "180.0001")]
    rows += [(x, "10") for x in ("1e20", "Infinity", "-Infinity", "NaN", "90.0001", "")]
    df = spark.createDataFrame(rows, "lat string, lon string")
    assert all(r.g is None for r in with_mgrs(df, "lat", "lon", {"g": 3}).collect())
    assert all(r.g is None for r in df.select(mgrs("lat", "lon", 3).alias("g")).collect())
    assert not any(r.ok for r in df.select(located("lat", "lon").alias("ok")).collect())


# (lat, lon, id). The first has published coordinates, 1530125.78 E 2426773.60 N (DMA TM
# 8358.2); the poles are the grid's origins; the rest follow from the letter tables.
POLAR = [
    (84 + 17 / 60 + 14.042 / 3600, -(132 + 14 / 60 + 52.761 / 3600), "YTM3012526773"),
    (90.0, 0.0, "ZAH0000000000"), (90.0, -77.0, "ZAH0000000000"),
    (-90.0, 0.0, "BAN0000000000"), (-90.0, 180.0, "BAN0000000000"),
    (88.0, 90.0, "ZCH2206900000"), (88.0, -90.0, "YXH7793000000"),
    (84.0, 0.0, "31XDP6500529005"), (-80.0, 0.0, "31CDM4186716915"),  # the other grid's edge
    (84.0001, 0.0, "ZAA0000033283"), (-80.0001, 180.0, "BAA0000087060"),
    (-80.0001, -180.0, "BAA0000087060"),
]


def test_polar_vectors_and_their_coarse_cells(spark):
    df = spark.createDataFrame([p[:2] for p in POLAR], "lat double, lon double")
    out = with_mgrs(df, "lat", "lon", {"g": 5, "square": 0}).select(
        "*", mgrs("lat", "lon", 5).alias("one"), located("lat", "lon").alias("ok"),
        *[coarsen("g", p, 5).alias(f"c{p}") for p in (3, 0)]).collect()
    for r, (_, _, want) in zip(out, POLAR):
        head, digits = want[:-10], want[-10:]
        assert (r.g, r.one, r.ok, r.square) == (want, want, True, head)
        assert (r.c3, r.c0) == (head + digits[:3] + digits[5:8], head)


def test_polar_forms_agree_and_squares_are_all_known(spark):
    rng = random.Random(11)
    pts = [(rng.choice([1, -1]) * rng.uniform(79.5, 90.0), rng.uniform(-180, 180))
           for _ in range(20_000)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    rows = with_mgrs(df, "lat", "lon", {"a": 4}).select(
        "a", mgrs("lat", "lon", 4).alias("b"), "lat", "lon").collect()
    for r in rows:
        assert r.a == r.b and r.a
        if r.lat > 84:
            assert len(r.a) == 11 and r.a[0] == ("Z" if r.lon >= 0 else "Y")
        elif r.lat < -80:
            assert len(r.a) == 11 and r.a[0] == ("B" if r.lon >= 0 else "A")
