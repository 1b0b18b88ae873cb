import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridtally.functions.columns import (
    cast_all_except, cast_all_except_counted, cast_losses, env_tag, whitespace_tokens,
)
from gridtally.operators.quality import (
    day_gaps, dedup_keys, freshness, md5_threshold, profile, reconcile, sample_by_hash, sample_k,
)


def test_reconcile_multiset(spark):
    a = spark.createDataFrame([("000001",), ("000002",), ("000002",), ("000003",)], "id string")
    b = spark.createDataFrame([("000002",), ("000003",), ("000004",)], "id string")
    got = sorted(tuple(r) for r in reconcile(a, b, "id").collect())
    assert got == [("000001", "left_only"), ("000002", "left_only"), ("000004", "right_only")]
    same = reconcile(a, a, "id").count()
    assert same == 0


def test_reconcile_deals_out_the_copies_of_a_hot_id(spark):
    a = spark.range(45_001).selectExpr("cast(null as string) id")
    b = spark.createDataFrame([("x",)] * 3, "id string")
    rows = reconcile(a, b, "id")
    assert sorted(map(tuple, rows.groupBy("id", "side").count().collect()), key=str) == [
        ("x", "right_only", 3), (None, "left_only", 45_001)]
    per_task = rows.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) < 45_001


def test_freshness_and_gaps(spark):
    d = dt.date(2024, 1, 1)
    rows = [("s1", d), ("s1", d + dt.timedelta(days=1)), ("s1", d + dt.timedelta(days=4)),
            ("s2", d), ("s2", d + dt.timedelta(days=5))]
    df = spark.createDataFrame(rows, "src string, day date")
    gaps = sorted(tuple(r) for r in day_gaps(df, F.col("day"), by=["src"]).collect())
    assert gaps == [("s1", d + dt.timedelta(days=2)), ("s1", d + dt.timedelta(days=3))] + [
        ("s2", d + dt.timedelta(days=k)) for k in range(1, 5)]
    fr = {r.src: r for r in freshness(df, F.col("day"), "2024-01-06", 1, by=["src"]).collect()}
    assert fr["s1"].expected_day == d + dt.timedelta(days=4)
    assert fr["s1"].expected_present and fr["s1"].lag_days == 0
    assert not fr["s2"].expected_present and fr["s2"].latest_day == d and fr["s2"].lag_days == 4


def test_sample_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = sample_by_hash(df, ["k"], 0.1)
    n = a.count()
    assert 1700 < n < 2300
    assert a.exceptAll(sample_by_hash(df, ["k"], 0.1)).count() == 0
    assert sample_by_hash(df, ["k"], 1.0).count() == 20000
    assert sample_by_hash(df, ["k"], 0.0).count() == 0
    assert md5_threshold(0.5) == "80000000"


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "x int, y string")
    r = profile(df, ["y"], ["y"]).first()
    assert (r.records, r.distinct_y, r.nulls_y) == (3, 1, 1)


def test_cast_all_except_bad_text(spark):
    df = spark.createDataFrame([("1.5", "x", "abc"), ("2", "y", None)], "a string, b string, c string")
    out = cast_all_except(df, ["b"])
    assert out.columns == ["a", "b", "c"]
    assert [tuple(r) for r in out.collect()] == [(1.5, "x", None), (2.0, "y", None)]
    assert dict(out.dtypes) == {"a": "double", "b": "string", "c": "double"}


def test_env_tag(spark):
    df = spark.createDataFrame([("Indoor",), ("Outdoor",), (None,), ("indoor",)], "i string")
    assert [r[0] for r in df.select(env_tag("i")).collect()] == [
        "Indoor", "Outdoor", "Outdoor", "Outdoor"]


def test_whitespace_tokens_match_python_split(spark):
    texts = ["a b", "  lead and trail  ", "", "   ", "tab\there\nnew\x0bvt\x1cfs",
             "nb\xa0sp　ideo ls", "one", "x\r\ny", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(whitespace_tokens("t")).collect()]
    assert got == [t.split() if t is not None else None for t in texts]


def test_day_gaps_with_bounds(spark):
    d = dt.date(2024, 1, 3)
    rows = [("s1", d), ("s1", d + dt.timedelta(days=2)), ("s2", d + dt.timedelta(days=9))]
    df = spark.createDataFrame(rows, "src string, day date")
    got = sorted(tuple(r) for r in day_gaps(df, F.col("day"), by=["src"],
                                            start="2024-01-01", end="2024-01-06").collect())
    want = [("s1", dt.date(2024, 1, k)) for k in (1, 2, 4, 6)]
    want += [("s2", dt.date(2024, 1, k)) for k in range(1, 7)]  # no day inside: all are missing
    assert got == want
    glob = sorted(r[0] for r in day_gaps(df, F.col("day")).collect())
    assert glob == [dt.date(2024, 1, k) for k in (4, 6, 7, 8, 9, 10, 11)]


def test_global_freshness_and_approx_profile(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(d,), (d + dt.timedelta(days=3),)], "day date")
    r = freshness(df, F.col("day"), "2024-01-06", delay_days=1).first()
    assert (r.expected_day, r.expected_present, r.latest_day, r.lag_days) == (
        d + dt.timedelta(days=4), False, d + dt.timedelta(days=3), 1)
    many = spark.range(5000).select((F.col("id") % 1000).alias("k"))
    p = profile(many, ["k"], exact=False).first()
    assert p.records == 5000 and 950 <= p.distinct_k <= 1050  # HyperLogLog++ estimate


def test_gaps_of_empty_and_absent_sources(spark):
    empty = spark.createDataFrame([], "src string, day date")
    days = [dt.date(2024, 1, k) for k in (1, 2, 3)]
    got = day_gaps(empty, F.col("day"), start="2024-01-01", end="2024-01-03")
    assert sorted(r[0] for r in got.collect()) == days
    assert day_gaps(empty, F.col("day")).count() == 0
    one = spark.createDataFrame([("s1", days[1]), (None, days[0])], "src string, day date")
    listed = spark.createDataFrame([("s1",), ("s9",), (None,)], "src string")
    got = day_gaps(one, F.col("day"), by=["src"], start="2024-01-01", end="2024-01-03",
                   sources=listed).collect()
    assert sorted((r.src or "", r.missing_day) for r in got) == [
        ("", days[1]), ("", days[2]), ("s1", days[0]), ("s1", days[2]),
        *[("s9", d) for d in days]]
    # a window that ends before the source begins is empty, not reversed
    assert day_gaps(one, F.col("day"), by=["src"], start="2024-02-01").count() == 0


def test_stale_and_unseen_sources_stay(spark):
    rows = [("old", dt.date(2022, 5, 1)), ("new", dt.date(2024, 1, 4)), ("new", dt.date(2024, 3, 1))]
    df = spark.createDataFrame(rows, "src string, day date")
    listed = spark.createDataFrame([("never",), ("old",)], "src string")
    got = {r.src: (r.expected_present, r.latest_day, r.lag_days) for r in freshness(
        df, F.col("day"), "2024-01-06", 1, by=["src"], sources=listed).collect()}
    assert got == {"old": (False, None, None), "never": (False, None, None),
                   "new": (False, dt.date(2024, 1, 4), 1)}
    none = freshness(df.limit(0), F.col("day"), "2024-01-06").collect()
    assert [(r.expected_present, r.latest_day, r.lag_days) for r in none] == [(False, None, None)]


def test_sample_keeps_a_share_of_rows_without_key(spark):
    df = spark.range(10000).select("id", F.lit(None).cast("string").alias("k"))
    for share in (0.1, 0.5, 0.9):
        n = sample_by_hash(df, ["k"], share, rows_without_key=["id"]).count()
        assert abs(n - 10000 * share) < 250
    # ("a|b", "c") and ("a", "b|c"), (NULL, "x") and ("x", NULL) are different keys
    pairs = spark.createDataFrame([(f"a{i}|b", "c") for i in range(300)]
                                  + [(f"a{i}", "b|c") for i in range(300)], "x string, y string")
    kept = sample_by_hash(pairs, ["x", "y"], 0.5).collect()
    left = {r.x.split("|")[0] for r in kept if r.y == "c"}
    right = {r.x for r in kept if r.y == "b|c"}
    assert left != right


def test_dedup_keys_is_deterministic(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), (None, 1, "p"), (None, 2, None), ("b", 1, "q")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    for order in (rows, rows[::-1]):
        shuffled = spark.createDataFrame(order, df.schema).repartition(3)
        got = sorted(map(tuple, dedup_keys(shuffled, ["k"], ["t"]).collect()), key=str)
        assert got == sorted([("a", 3, "z"), (None, 2, None), ("b", 1, "q")], key=str)


def test_reconcile_counts_copies_in_one_shuffle(spark):
    a = spark.createDataFrame([("x",)] * 5 + [(None,)] * 2, "id string")
    b = spark.createDataFrame([("x",)] * 2 + [(None,)] + [("y",)] * 3, "id string")
    out = reconcile(a, b, "id")
    got = sorted(((r.id or "", r.side) for r in out.collect()))
    assert got == [("", "left_only")] + [("x", "left_only")] * 3 + [("y", "right_only")] * 3
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_sample_k_is_exact_and_merges(spark):
    df = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else 'g' || id % 40 end g")
    whole = {tuple(r) for r in sample_k(df, ["g"], ["id"], 7).collect()}
    sizes = {r.g: r["count"] for r in df.groupBy("g").count().collect()}
    for g, n in sizes.items():
        assert sum(x[1] == g for x in whole) == min(7, n)
    parts = [sample_k(df.where(f"id % 4 = {k}"), ["g"], ["id"], 7) for k in range(4)]
    union = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert {tuple(r) for r in sample_k(union, ["g"], ["id"], 7).collect()} == whole
    assert {tuple(r) for r in sample_k(df.repartition(5), ["g"], ["id"], 7).collect()} == whole
    assert sample_k(df, [], ["id"], 9).count() == 9
    plan = sample_k(df, ["g"], ["id"], 7)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # each task's own k
    with pytest.raises(ValueError):
        sample_k(df, ["g"], ["id"], 0)


def test_cast_losses_come_from_the_same_pass(spark):
    df = spark.createDataFrame([("1", "x", "k"), (" 2.5", None, "k"), ("", "7", "k"), ("NaN", "1e3", "k")],
                               "a string, b string, `keep me` string")
    typed, seen = cast_all_except_counted(df, ["keep me"])
    assert str(typed.collect()) == str(cast_all_except(df, ["keep me"]).collect())
    assert cast_losses(seen) == {"a": (4, 1), "b": (3, 1)}
    typed, seen = cast_all_except_counted(df, ["keep me"], counted=["b"])
    assert typed.count() == 4 and cast_losses(seen) == {"b": (3, 1)}
    typed, seen = cast_all_except_counted(df, df.columns)
    assert typed.count() == 4 and cast_losses(seen) == {}
    typed, seen = cast_all_except_counted(df.limit(0), ["keep me"])
    assert typed.count() == 0 and cast_losses(seen) == {"a": (0, 0), "b": (0, 0)}
