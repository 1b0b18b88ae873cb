import datetime as dt
import random

from pyspark.sql import functions as F

from gridtally.functions.columns import clock_decimal_hours, clock_minutes, clock_to_timestamp
from gridtally.operators.bursts import access_bursts, burst_witnesses

# Invented access rows (key, HHMM): bursts of 3 within an hour for a and c.
ACCESS = [("a", "0210"), ("b", "0100"), ("a", "0155"), ("b", "0215"), ("b", "0330"),
          ("a", "0250"), ("c", "2301"), ("b", "0140"), ("c", "2302"), ("c", "2305")]


def brute(rows, n=3, within=dt.timedelta(hours=1)):
    by = {}
    for k, t, i in rows:
        by.setdefault(k, []).append((t, i))
    out = set()
    for k, ts in by.items():
        ts.sort()
        for j in range(len(ts) - n + 1):
            if ts[j + n - 1][0] < ts[j][0] + within:
                out.add((k, ts[j][0], ts[j][1]))
    return out


def test_golden_clock_rows(spark):
    df = spark.createDataFrame(ACCESS, "key string, hhmm string").withColumn(
        "ts", clock_to_timestamp(F.lit("2024-01-09").cast("date"), "hhmm"))
    keys = sorted(r.key for r in access_bursts(df, "key", "ts").collect())
    assert keys == ["a", "c"]
    w = burst_witnesses(df, "key", "ts").orderBy("key").collect()
    assert [(r.ts_1.strftime("%H%M"), r.ts_3.strftime("%H%M")) for r in w] == [
        ("0155", "0250"), ("2301", "2305")]


def test_clock_text(spark):
    bad = ["x1", "2460", "549", "-1-5", "2400", "1260", " 930", "09300", "", None, "0930\n"]
    df = spark.createDataFrame([("0549",), ("1543",), ("0000",), ("2359",)] + [(b,) for b in bad],
                               "hhmm string")
    got = df.select(clock_minutes("hhmm").alias("m"), clock_decimal_hours("hhmm").alias("h")).collect()
    assert [(r.m, r.h) for r in got] == [(349, 5.82), (943, 15.72), (0, 0.0), (1439, 23.98)] + [
        (None, None)] * len(bad)
    stamps = df.select(clock_to_timestamp(F.lit("2024-01-09").cast("date"), "hhmm").alias("t"))
    assert [r.t is None for r in stamps.collect()] == [False] * 4 + [True] * len(bad)


def test_matches_brute_force_with_small_buckets(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(4000):
        k = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 30)}"
        t = base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400))
        if i % 50 == 0 and rows:
            t = rows[-1][1]  # equal timestamps
        rows.append((k, t, i))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, i bigint")
    want = brute(rows)
    for bucket in (3600, 7200, 86400):
        got = {tuple(r) for r in access_bursts(df, "k", "ts", order=["i"], method="buckets",
                                               bucket_seconds=bucket).collect()}
        assert got == want, bucket


def test_bucket_boundary_lookahead(spark):
    base = dt.datetime(2024, 1, 1, 3, 59, 0)  # bucket edge at 04:00 for 4 h buckets
    rows = [("a", base, 1), ("a", base + dt.timedelta(minutes=30), 2),
            ("a", base + dt.timedelta(minutes=59), 3), ("a", base + dt.timedelta(minutes=61), 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, i bigint")
    got = {tuple(r) for r in access_bursts(df, "k", "ts", order=["i"], method="buckets").collect()}
    assert got == brute(rows) == {("a", base, 1), ("a", base + dt.timedelta(minutes=30), 2)}


def test_sorted_method_across_many_partitions(spark):
    """Tiny sort partitions: runs of a hot key and the n-1 lookahead cross
    partition boundaries, some partitions hold fewer than n-1 rows."""
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(1500):
        k = "hot" if i % 2 == 0 else f"k{rnd.randint(0, 9)}"
        rows.append((k, base + dt.timedelta(seconds=rnd.randint(0, 2 * 86400)), i))
    rows += [("dup", base, 10_000 + j) for j in range(4)]  # equal timestamps
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, i bigint")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in (2, 3, 4):
            got = {tuple(r) for r in access_bursts(df, "k", "ts", n=n, order=["i"],
                                                   method="sorted").collect()}
            assert got == brute(rows, n=n), n
        w = burst_witnesses(df, "k", "ts", n=3, order=["i"], method="sorted")
        b = burst_witnesses(df, "k", "ts", n=3, order=["i"], method="buckets")
        assert w.exceptAll(b).count() == 0 and b.exceptAll(w).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_null_keys_and_times_agree_across_methods(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(None, base + dt.timedelta(minutes=m), m) for m in (0, 10, 20, 200)]
    rows += [("a", None, 100 + j) for j in range(3)]  # NULL times never burst
    rows += [("a", base + dt.timedelta(minutes=m), 200 + m) for m in (5, 6, 7)]
    rows += [("b", base + dt.timedelta(minutes=m), 300 + m) for m in (0, 30, 61)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, i bigint")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        s = {tuple(r) for r in access_bursts(df, "k", "ts", order=["i"], method="sorted").collect()}
        b = {tuple(r) for r in access_bursts(df, "k", "ts", order=["i"], method="buckets").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert s == b == {(None, base, 0), ("a", base + dt.timedelta(minutes=5), 205)}


def test_big_integer_keys_beside_null_keys(spark):
    base, big = dt.datetime(2024, 1, 1), 1 << 53
    rows = [(None, base, 1)]
    rows += [(big + k, base + dt.timedelta(minutes=m), big + 10 * k + m)
             for k in (0, 1) for m in (0, 5)]
    rows += [(big + 1, base + dt.timedelta(minutes=9), None)]
    df = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, i bigint")
    for method in ("sorted", "buckets"):
        got = [tuple(r) for r in access_bursts(df, "k", "ts", order=["i"], method=method).collect()]
        assert got == [(big + 1, base, big + 10)], method


def test_clock_change_does_not_make_a_burst(spark):
    """0, 2800 and 4000 seconds over the end of daylight saving time."""
    start = 1699163400  # 2023-11-05 05:50:00 UTC
    rows = [("a", start), ("a", start + 2800), ("a", start + 4000)]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(rows, "k string, s long").select(
            "k", F.timestamp_seconds("s").alias("ts"))
        for method in ("sorted", "buckets"):
            assert access_bursts(df, "k", "ts", method=method).count() == 0, method
            assert access_bursts(df, "k", "ts", within_seconds=4001, method=method).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
