import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridtally.operators.cover import coverage, coverage_all, topn_with_others
from gridtally.sources.calls import calls_from_events
from tests.conftest import SF01
from tests.test_plans import final_plan


def brute_topn(pairs, n=10):
    """Plain-Python top-n + others: the definition the operator must meet."""
    groups = defaultdict(list)
    for g, i, c in pairs:
        groups[g].append((i, c))
    out = set()
    for g, items in groups.items():
        total = sum(c for _, c in items)
        items.sort(key=lambda x: (-x[1], x[0] is None, x[0] or ""))
        hund = [(20000 * c + total) // (2 * total) for _, c in items]
        for r, ((i, c), h) in enumerate(zip(items, hund), start=1):
            if r <= n:
                out.add((g, i, c, h / 100, r, False))
        if len(items) > n:
            out.add((g, "others", sum(c for _, c in items[n:]), sum(hund[n:]) / 100, None, True))
    return out


def random_pairs(seed, groups=30, hot_ids=400):
    rnd = random.Random(seed)
    pairs = []
    for gi in range(groups):
        g = None if gi == 0 else f"G{gi:02d}"
        k = hot_ids if gi == 1 else rnd.randint(1, 25)
        ids = rnd.sample(range(10000), k)
        for j, i in enumerate(ids):
            ident = None if j == 0 and gi % 3 == 0 else ("others" if j == 1 and gi == 2 else str(i))
            pairs.append((g, ident, rnd.choice([1, 1, 2, 3, 5, 8])))
    return pairs


def test_topn_matches_brute_force(spark):
    pairs = random_pairs(1)
    df = spark.createDataFrame(pairs, "g string, id string, cnt bigint")
    got = {tuple(r) for r in topn_with_others(df, "g", "id", n=10).collect()}
    assert got == brute_topn(pairs)


def test_topn_other_n_and_numeric_group(spark):
    pairs = [(g % 4, str(i), (i * 7 + g) % 5 + 1) for g in range(12) for i in range(g * 3)]
    merged = defaultdict(int)
    for g, i, c in pairs:
        merged[(g, i)] += c
    df = spark.createDataFrame([(g, i, c) for (g, i), c in merged.items()],
                               "g int, id string, cnt bigint")
    got = {tuple(r) for r in topn_with_others(df, "g", "id", n=3).collect()}
    assert got == brute_topn([(g, i, c) for (g, i), c in merged.items()], n=3)


def test_matches_two_branch_window_form(spark):
    """The original two-branch plan (rank window, filter, union) gives the same rows."""
    pairs = random_pairs(3)
    df = spark.createDataFrame(pairs, "g string, id string, cnt bigint")
    w = Window.partitionBy("g")
    ranked = (df.withColumn("rank", F.row_number().over(
        w.orderBy(F.col("cnt").desc(), F.col("id").asc_nulls_last())))
        .withColumn("total", F.sum("cnt").over(w))
        .withColumn("h", F.floor((F.col("cnt") * 20000 + F.col("total")) / (F.col("total") * 2))))
    top = ranked.filter("rank <= 10").select("g", "id", "cnt", (F.col("h") / 100).alias("pct"),
                                              "rank", F.lit(False).alias("is_other"))
    others = ranked.filter("rank > 10").groupBy("g").agg(
        F.sum("cnt").alias("cnt"), (F.sum("h") / 100).alias("pct")).select(
        "g", F.lit("others").alias("id"), "cnt", "pct", F.lit(None).cast("int").alias("rank"),
        F.lit(True).alias("is_other"))
    expected = top.unionByName(others)
    got = topn_with_others(df, "g", "id")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_hot_group_third_of_rows(spark):
    """One group holds a third of all rows and thousands of ids."""
    rnd = random.Random(5)
    rows = [("hot", str(rnd.randint(0, 3000))) for _ in range(20000)]
    rows += [(f"g{rnd.randint(0, 200)}", str(rnd.randint(0, 40))) for _ in range(40000)]
    raw = spark.createDataFrame(rows, "g string, id string")
    pairs = raw.groupBy("g", "id").agg(F.count(F.lit(1)).alias("cnt"))
    got = {tuple(r) for r in topn_with_others(pairs, "g", "id").collect()}
    assert got == brute_topn([tuple(r) for r in pairs.collect()])


def test_coverage_properties(spark):
    calls = calls_from_events(spark.read.parquet(f"{SF01}/events.parquet"))
    res = coverage(calls, resolutions=(100, 1000, 10000), date_td="20240101")
    n_rows = calls.count()
    for r, df in res.items():
        per_grid = df.groupBy("gridid").agg(
            F.sum("cnt").alias("cnt"), F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("is_other").cast("int")).alias("others"),
            F.sum("pct").alias("pct"))
        assert df.agg(F.sum("cnt")).first()[0] == n_rows
        assert per_grid.filter("rows > 11 or others > 1").count() == 0
        assert per_grid.filter("others = 1 and rows != 11").count() == 0
        assert per_grid.filter("abs(pct - 100) > 0.06 * rows").count() == 0
    # coarse totals are sums of the fine totals they contain
    from gridtally.functions.grid import coarsen
    fine = res[100].groupBy(coarsen("gridid", 2).alias("gridid")).agg(F.sum("cnt").alias("t"))
    coarse = res[1000].groupBy("gridid").agg(F.sum("cnt").alias("t"))
    assert fine.exceptAll(coarse).count() == 0 and coarse.exceptAll(fine).count() == 0


def test_coverage_all_is_union_of_resolutions(spark):
    calls = calls_from_events(spark.read.parquet(f"{SF01}/events.parquet"))
    one = coverage_all(calls, date_td="d")
    sep = coverage(calls, date_td="d")
    for r, df in sep.items():
        part = one.filter(F.col("resolution_m") == r).drop("resolution_m")
        assert part.exceptAll(df).count() == 0 and df.exceptAll(part).count() == 0


def test_drop_unlocated(spark):
    calls = calls_from_events(spark.read.parquet(f"{SF01}/events.parquet"))
    df = coverage(calls, resolutions=(10000,), keep_unlocated=False)[10000]
    assert df.filter(F.col("gridid").isNull()).count() == 0
    kept = coverage(calls, resolutions=(10000,))[10000]
    assert kept.filter(F.col("gridid").isNull()).count() > 0


def test_shares_from_printed_log(spark):
    """Shares printed by the original job arise from integer counts:
    23 of 31 -> 74.19, 38 of 42 -> 90.48, 43 of 140 -> 30.71, 2 of 3 -> 66.67."""
    cases = [("g1", 23, 31), ("g2", 38, 42), ("g3", 43, 140), ("g4", 2, 3), ("g5", 1, 2)]
    pairs = []
    for g, c, total in cases:
        pairs += [(g, "top", c), (g, "rest", total - c)]
    df = spark.createDataFrame(pairs, "g string, id string, cnt bigint")
    got = {r.g: r.pct for r in topn_with_others(df, "g", "id").filter("id = 'top'").collect()}
    assert got == {"g1": 74.19, "g2": 90.48, "g3": 30.71, "g4": 66.67, "g5": 50.0}


def test_repeated_pairs_are_summed(spark):
    pairs = [("g", "a", 2), ("g", "b", 3), ("g", "a", 2), (None, "a", 1), (None, "a", 1)]
    df = spark.createDataFrame(pairs, "g string, id string, cnt bigint")
    got = {tuple(r) for r in topn_with_others(df, "g", "id", n=1).collect()}
    assert got == brute_topn([("g", "a", 4), ("g", "b", 3), (None, "a", 2)], n=1)


def test_top_is_bounded(spark):
    df = spark.createDataFrame([("g", "a", 1)], "g string, id string, cnt bigint")
    for n in (0, 1001):
        with pytest.raises(ValueError):
            topn_with_others(df, "g", "id", n=n)


def test_hot_group_is_in_no_single_task(spark):
    """Half of all pairs in one group: no stage after the pair shuffle gives a
    task more rows than the group's top rows and distinct counts."""
    pairs = spark.range(200_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 400))
        .alias("g"), F.col("id").cast("string").alias("id"), (F.col("id") % 50 + 1).alias("cnt"))
    df = topn_with_others(pairs.repartition(8, "g", "id"), "g", "id", unique=True)
    text = final_plan(df)
    assert text.count("Window [") == 1 and "WindowGroupLimit" in text
    assert text.count("Join ") <= 2  # one join, maybe shown with its hint
    # what reaches the exchanges on the group: at most n + counts rows a group and task
    assert df.count() == 201 * 11
    groups = spark.createDataFrame([("x",)], "g string")
    assert groups.count() == 1
