"""Data-quality operators: id reconciliation, freshness, day gaps, sampling,
profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.functions.dates import _day

COPIES = 10_000  # copies of an id that one array holds


def reconcile(left: DataFrame, right: DataFrame, col: str,
              labels: tuple[str, str] = ("left_only", "right_only")) -> DataFrame:
    """Multiset difference of two id lists, both ways: ``(col, side)``.

    Duplicates count: an id twice on the left and once on the right is reported
    once. Left rows weigh +1 and right rows -1; one partial aggregation by id
    gives both sides in one shuffle, and an id's rows are then repeated by its
    weight: cut into chunks of ``COPIES``, which are dealt by ranges of (id, chunk), so
    that no id makes one large array or rests in one task and a retried task deals
    alike. NULL ids are one id.
    """
    weighed = left.select(col, F.lit(1).alias("_w")).unionByName(
        right.select(col, F.lit(-1).alias("_w")))
    rest = weighed.groupBy(col).agg(F.sum("_w").alias("_w")).filter("_w <> 0")
    n, chunk = F.abs("_w"), F.lit(COPIES).cast("long")
    chunks = rest.select(col, "_w", F.explode(F.sequence(F.lit(0).cast("long"), n - 1, chunk)).alias(
        "_from")).select(col, F.when(F.col("_w") > 0, labels[0]).otherwise(labels[1]).alias("_side"),
                         "_from", F.least(chunk, n - F.col("_from")).cast("int").alias("_n"))
    width = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartitionByRange(width, col, "_from")
    return dealt.select(col, F.explode(F.array_repeat("_side", F.col("_n"))).alias("side"))


def dedup_keys(df: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``latest`` columns.

    Ties go to the row whose remaining columns are largest, so the survivor is
    the same in every run. One aggregation with map-side combine: a hot key
    sends one row per task. NULL keys are keys of their own.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest]
    plain = [c for c in rest if "map<" not in dict(df.dtypes)[c]]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns]),
                                          F.struct(*latest, *plain)).alias("_row"))
    return best.select("_row.*")


def freshness(df: DataFrame, day: Column, as_of, delay_days: int = 1,
              floor_day: str = "2023-01-01", by: Sequence[str] = (),
              sources: DataFrame | None = None) -> DataFrame:
    """Is the expected day there, and if not, which day is the latest?

    Expected day = ``as_of - delay_days``. Per source (``by``): whether rows for
    the expected day exist, the latest day with rows between ``floor_day`` and
    the expected day, and the lag in days. A source with nothing in between is
    reported with both NULL. ``sources`` (the ``by`` columns) lists sources that
    are expected even if they have no row at all. Without ``by`` there is
    always one row.
    """
    expected = F.date_sub(_day(as_of), delay_days)
    d = day.cast("date")
    inside = (d >= F.to_date(F.lit(floor_day))) & (d <= expected)
    out = df.groupBy(*by).agg(
        F.max(F.when(inside, d)).alias("latest_day"),
        F.max(F.when(d == expected, True)).alias("_hit"))
    out = _with_sources(out, by, sources)
    return out.select(
        *by,
        expected.alias("expected_day"),
        F.coalesce("_hit", F.lit(False)).alias("expected_present"),
        F.col("latest_day"),
        F.datediff(expected, F.col("latest_day")).alias("lag_days"),
    )


def _with_sources(found: DataFrame, by: Sequence[str], sources: DataFrame | None) -> DataFrame:
    """Adds the listed sources that are not among ``found``."""
    if sources is None:
        return found
    listed = sources.select(*by).distinct().alias("s")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in by]
    rest = [c for c in found.columns if c not in by]
    joined = found.alias("f").join(listed, same, "full")
    return joined.select(*[F.coalesce(f"f.{c}", f"s.{c}").alias(c) for c in by],
                         *[f"f.{c}" for c in rest])


def day_gaps(df: DataFrame, day: Column, by: Sequence[str] = (),
             start: str | None = None, end: str | None = None,
             sources: DataFrame | None = None) -> DataFrame:
    """Missing days per source: ``(by..., missing_day)``.

    The calendar per source runs from ``start`` (default: its first day with
    rows) to ``end`` (default: its last). With both given, a source without a
    row in between misses every day, and so does a table without rows if there
    is no ``by``. ``sources`` lists sources that may have no row at all. One
    aggregation: a source's set of days is bounded by the calendar, not by the
    number of records, and combines map-side.
    """
    d = day.cast("date")
    lo = F.to_date(F.lit(start)) if start else F.lit(None).cast("date")
    hi = F.to_date(F.lit(end)) if end else F.lit(None).cast("date")
    inside = F.coalesce(d >= lo, F.lit(True)) & F.coalesce(d <= hi, F.lit(True))
    found = df.groupBy(*by).agg(F.collect_set(F.when(inside, d)).alias("_days"),
                                F.min(d).alias("_first"), F.max(d).alias("_last"))
    found = _with_sources(found, by, sources)
    first, last = F.coalesce(lo, F.col("_first")), F.coalesce(hi, F.col("_last"))
    calendar = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    none = F.array().cast("array<date>")
    return found.select(*by, F.explode(F.array_except(
        F.coalesce(calendar, none), F.coalesce("_days", none))).alias("missing_day"))


def md5_threshold(fraction: float) -> str:
    """Hex prefix bound: a row is kept when its 8-hex-digit md5 prefix is below."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return "%08x" % min(int(fraction * 16 ** 8), 16 ** 8 - 1) if fraction < 1 else "g"


def sample_by_hash(df: DataFrame, cols: Sequence[str], fraction: float,
                   rows_without_key: Sequence[str] = ()) -> DataFrame:
    """Repeatable sample: keep rows whose md5 of the key falls below ``fraction``.

    The same keys are kept on every run and in any engine with md5;
    ``DataFrame.sample`` is the faster, seed-based alternative. A key is the
    columns' texts, each as ``length:text``, or ``-`` where NULL, so no two
    keys are spelt alike. Rows whose key columns are all NULL share one key
    and are kept or dropped together, unless ``rows_without_key`` names other
    columns that decide for them one by one.
    """
    key = _spelt(cols)
    if rows_without_key:
        empty = F.lit(True)
        for c in cols:
            empty = empty & F.col(c).isNull()
        key = F.when(empty, _spelt([*cols, *rows_without_key])).otherwise(key)
    return df.filter(F.substring(F.md5(key), 1, 8) < F.lit(md5_threshold(fraction)))


def _spelt(names: Sequence[str]) -> Column:
    texts = [F.col(c).cast("string") for c in names]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t),
                                 F.lit("-")) for t in texts])


def sample_k(df: DataFrame, by: Sequence[str], key: Sequence[str], k: int) -> DataFrame:
    """A repeatable sample of exactly ``k`` rows per group (all of them, if fewer).

    The rows whose md5 of the key (spelt as in ``sample_by_hash``) is smallest; ties, which
    only equal keys make, go by the key itself. Bottom-k samples merge: the sample of a
    union is the sample of the union of the samples, so days can be sampled apart. Every
    task passes on at most ``k`` rows of a group (``WindowGroupLimit``), however hot it
    is; ``k`` is at most 1000, where Spark stops doing so. NULL groups and keys are
    values of their own; without ``by`` the table is one group.
    """
    if not 1 <= k <= 1000:
        raise ValueError("k must be between 1 and 1000")
    marked = df.withColumn("_order", F.md5(_spelt(key)))
    order = ["_order", *[F.col(c).asc_nulls_first() for c in key]]
    if not by:  # a top-k of the whole table: Spark merges the tasks' own
        return marked.orderBy(*order).limit(k).drop("_order")
    window = Window.partitionBy(*by).orderBy(*order)
    return marked.withColumn("_nth", F.row_number().over(window)).where(
        F.col("_nth") <= k).drop("_order", "_nth")


def profile(df: DataFrame, distinct_cols: Sequence[str] = (), null_cols: Sequence[str] = (),
            exact: bool = True) -> DataFrame:
    """One row: ``records`` plus ``distinct_<c>`` and ``nulls_<c>`` per column.

    Exact distinct counts of several columns make Spark expand each row once
    per column before the shuffle; ``exact=False`` uses HyperLogLog++ sketches
    merged map-side instead.
    """
    dc = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        *[dc(c).alias(f"distinct_{c}") for c in distinct_cols],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in null_cols],
    )
