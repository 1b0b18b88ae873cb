"""Per-day partial aggregates, from which any window of days is merged.

Weekly windows overlap, so the same days are scanned by several jobs. A day is scanned
once here, and leaves three small tables, each with one folder a day:

* ``measures``: for every (grid cell, indoor/outdoor tag) the sum and the number of
  values of each measure, the number of rows, and a HyperLogLog sketch of the
  subscribers;
* ``subscribers``: the distinct subscribers of every (cell, tag), for exact counts;
* ``pairs``: rows of every (cell, station id).

Sums and counts merge by addition, sketches by union, subscriber sets by distinct. Pair
counts can be subtracted too, so a window slides by adding its new days and taking away
the old ones (``slide_pairs``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.functions.columns import env_tag
from gridtally.functions.grid import coarsen, with_mgrs
from gridtally.operators.kpi import KPI_MEASURES
from gridtally.sources.scan import DAY_PARTITION
from gridtally.sources.sinks import _fs, _rename

#: Buckets of a sketch are 2 to this power; the standard error is 1.04 / sqrt(buckets).
SKETCH_LG_K = 12
TABLES = ("subscribers", "pairs", "measures")  # the last one marks a day as complete
KEYS = ["gridid", "env_tag"]

_SUMS = [f"sum_{src} double" for src, _, _ in KPI_MEASURES]
_COUNTS = [f"n_{src} long" for src, _, _ in KPI_MEASURES]
SCHEMAS = {
    "measures": f"gridid string, env_tag string, {', '.join(_SUMS + _COUNTS)}, records_cnt long, "
                f"sketch binary, {DAY_PARTITION} string",
    "subscribers": f"gridid string, env_tag string, subscriber string, {DAY_PARTITION} string",
    "pairs": f"gridid string, kind string, id string, cnt long, {DAY_PARTITION} string",
}


def measure_states(calls: DataFrame, precision: int = 3, subscriber: str = "subscriber_id",
                   lat: str = "end_latitude", lon: str = "end_longitude",
                   indicator: str = "indoor_outdoor_indicator_name") -> DataFrame:
    """The ``measures`` rows of located calls; one aggregation, combined map-side."""
    sources = [src for src, _, _ in KPI_MEASURES]
    narrow = calls.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        DAY_PARTITION, env_tag(indicator).alias("env_tag"), lat, lon, subscriber, *sources)
    cells = with_mgrs(narrow, lat, lon, {"gridid": precision})
    return cells.groupBy(DAY_PARTITION, *KEYS).agg(
        *[F.sum(c).cast("double").alias(f"sum_{c}") for c in sources],
        *[F.count(c).alias(f"n_{c}") for c in sources],
        F.count(F.lit(1)).alias("records_cnt"),
        F.hll_sketch_agg(F.col(subscriber), F.lit(SKETCH_LG_K)).alias("sketch"))


def subscriber_states(calls: DataFrame, precision: int = 3, subscriber: str = "subscriber_id",
                      lat: str = "end_latitude", lon: str = "end_longitude",
                      indicator: str = "indoor_outdoor_indicator_name") -> DataFrame:
    """The ``subscribers`` rows of located calls."""
    narrow = calls.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()
                          & F.col(subscriber).isNotNull()).select(
        DAY_PARTITION, env_tag(indicator).alias("env_tag"), lat, lon,
        F.col(subscriber).cast("string").alias("subscriber"))
    cells = with_mgrs(narrow, lat, lon, {"gridid": precision})
    return cells.select(DAY_PARTITION, *KEYS, "subscriber").distinct()


def pair_states(calls: DataFrame, id_columns: dict[str, str], precision: int = 3,
                lat: str = "end_latitude", lon: str = "end_longitude") -> DataFrame:
    """The ``pairs`` rows: ``{kind: id column}`` of all calls, located or not."""
    cells = with_mgrs(calls.select(DAY_PARTITION, lat, lon, *id_columns.values()), lat, lon,
                      {"gridid": precision})
    ids = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("id"))
                              for k, c in id_columns.items()])).alias("p")
    return cells.select(DAY_PARTITION, "gridid", ids).groupBy(
        DAY_PARTITION, "gridid", "p.kind", "p.id").agg(F.count(F.lit(1)).alias("cnt"))


def stored_days(spark: SparkSession, root: str) -> list[str]:
    """Days whose states are complete under ``root`` (metadata only)."""
    p, fs = _fs(spark, f"{root.rstrip('/')}/{TABLES[-1]}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    head = f"{DAY_PARTITION}="
    return sorted(n.removeprefix(head) for n in names if n.startswith(head))


def add_days(calls: DataFrame, root: str, days: Sequence[str], id_columns: dict[str, str],
             precision: int = 3) -> list[str]:
    """Store the states of those of ``days`` that are not stored yet; returns them.

    ``calls`` must have numeric measures and ``UTC_date``; only rows of the new days are
    used, and that filter reaches a partitioned scan. Each table is written to a hidden
    folder and its days are renamed into place, ``measures`` last, so a job that
    dies leaves no half day that counts as stored, and running it again mends it. A day
    without rows is stored as an empty folder.
    """
    spark, root = calls.sparkSession, root.rstrip("/")
    new = sorted(set(days) - set(stored_days(spark, root)))
    if not new:
        return []
    fresh = calls.where(F.col(DAY_PARTITION).isin(new))
    made = {"subscribers": subscriber_states(fresh, precision),
            "pairs": pair_states(fresh, id_columns, precision),
            "measures": measure_states(fresh, precision)}
    staged = f"{root}/.new-{uuid.uuid4().hex[:12]}"
    p, fs = _fs(spark, staged)
    try:
        for name in TABLES:
            columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
            made[name].select(*columns).write.partitionBy(DAY_PARTITION).parquet(f"{staged}/{name}")
        for name in TABLES:
            for day in new:
                part = f"{name}/{DAY_PARTITION}={day}"
                here, there = f"{staged}/{part}", f"{root}/{part}"
                target, _ = _fs(spark, there)
                if fs.exists(target):  # left by a job that died before ``measures``
                    fs.delete(target, True)
                fs.mkdirs(target.getParent())
                if fs.exists(_fs(spark, here)[0]):
                    _rename(spark, here, there)
                else:
                    fs.mkdirs(target)
    finally:
        fs.delete(p, True)
    return new


def read_states(spark: SparkSession, root: str, table: str, start: str, end: str) -> DataFrame:
    """State rows of the stored days from ``start`` to ``end``; other days are not opened."""
    days = [d for d in stored_days(spark, root) if start <= d <= end]
    if not days:
        return spark.createDataFrame([], SCHEMAS[table])
    base = f"{root.rstrip('/')}/{table}"
    return spark.read.schema(SCHEMAS[table]).option("basePath", base).parquet(
        *[f"{base}/{DAY_PARTITION}={d}" for d in days])


def _coarse(states: DataFrame, precision: int | None, stored: int) -> DataFrame:
    if precision is None or precision == stored:
        return states
    return states.withColumn("gridid", coarsen("gridid", precision, stored))


def kpi_from_states(spark: SparkSession, root: str, start: str, end: str, exact_distinct: bool = True,
                    precision: int | None = None, stored_precision: int = 3,
                    stamps: tuple[str, str] | None = None) -> DataFrame:
    """The table of ``grid_kpi`` for a window of stored days, without the calls.

    ``precision`` may be coarser than the stored one. With ``exact_distinct`` subscribers
    are counted from their day sets, else estimated from the sketches' union.
    """
    measures = _coarse(read_states(spark, root, "measures", start, end), precision, stored_precision)

    def merged(src: str, how: str, out: str) -> Column:
        total = F.sum(f"sum_{src}")
        return (total if how == "sum" else F.try_divide(total, F.sum(f"n_{src}"))).alias(out)

    unique = [] if exact_distinct else [
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_imsi_cnt")]
    kpi = measures.groupBy(*KEYS).agg(*[merged(*m) for m in KPI_MEASURES], *unique,
                                      F.sum("records_cnt").alias("records_cnt"))
    if exact_distinct:
        people = _coarse(read_states(spark, root, "subscribers", start, end), precision, stored_precision)
        seen = people.groupBy(*KEYS).agg(F.count_distinct("subscriber").alias("n")).alias("s")
        kpi = kpi.alias("m").join(seen, F.col("m.gridid").eqNullSafe(F.col("s.gridid"))
                                  & (F.col("m.env_tag") == F.col("s.env_tag")), "left")
        kpi = kpi.select("m.*", F.coalesce("s.n", F.lit(0)).alias("unique_imsi_cnt"))
    stamps = stamps or (start, end)
    return kpi.select(*KEYS, *[out for _, _, out in KPI_MEASURES], "unique_imsi_cnt", "records_cnt",
                      F.lit(stamps[0]).cast("string").alias("start_week"),
                      F.lit(stamps[1]).cast("string").alias("end_week"))


def pairs_of_days(spark: SparkSession, root: str, kind: str, start: str, end: str) -> DataFrame:
    """(gridid, id, cnt): pair counts of the stored days from ``start`` to ``end``."""
    rows = read_states(spark, root, "pairs", start, end).where(F.col("kind") == kind)
    return rows.groupBy("gridid", "id").agg(F.sum("cnt").alias("cnt"))


def slide_pairs(state: DataFrame, added: DataFrame, dropped: DataFrame) -> DataFrame:
    """Pair counts of a window moved on: plus the new days, minus the old ones.

    Pairs that are left with no row go. Taking away days that are not in the state is
    an error (a count below zero), raised when the rows are used. One aggregation over
    the state and the changed days; the days that stay are not read.
    """
    rows = (state.select("gridid", "id", "cnt").unionByName(added.select("gridid", "id", "cnt"))
            .unionByName(dropped.select("gridid", "id", (-F.col("cnt")).alias("cnt"))))
    moved = rows.groupBy("gridid", "id").agg(F.sum("cnt").alias("cnt")).where("cnt <> 0")
    wrong = F.raise_error(F.lit("days were taken away that the window does not hold"))
    return moved.withColumn("cnt", F.when(F.col("cnt") < 0, wrong.cast("long")).otherwise(F.col("cnt")))
