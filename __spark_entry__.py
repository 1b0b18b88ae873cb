"""

``entry(spark)`` runs the flagship query on sf0.001; ``queries()`` maps each
DataFrame``; ``oracle_sql()`` gives, for each key, DuckDB SQL over the same
parquet tables. Every computed column is aliased to the same name on both
sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import timedelta
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_sql as osql  # noqa: E402
from gridtally.functions.columns import (  # noqa: E402
    cast_all_except, cast_all_except_counted, cast_losses, clock_decimal_hours, clock_minutes,
    clock_to_timestamp, env_tag,
)
from gridtally.functions.dates import day_str, trailing_days, weekly_window  # noqa: E402
from gridtally.functions.grid import coarsen, mgrs, with_mgrs  # noqa: E402
from gridtally.operators.bursts import access_bursts, burst_witnesses  # noqa: E402
from gridtally.operators.cover import (  # noqa: E402
    coverage, coverage_all, coverage_from_pairs, topn_with_others,
)
from gridtally.operators.kpi import grid_kpi  # noqa: E402
from gridtally.operators.quality import (  # noqa: E402
    day_gaps, dedup_keys, freshness, profile, reconcile, sample_by_hash, sample_k,
)
from gridtally.operators.states import (  # noqa: E402
    add_days, kpi_from_states, pairs_of_days, slide_pairs, stored_days,
)
from gridtally.operators.text import corpus_token_counts, doc_token_counts  # noqa: E402
from gridtally.plans.session import staging_path  # noqa: E402
from gridtally.sources.alerts import ALERT_FIELDS, read_alerts  # noqa: E402
from gridtally.sources.calls import calls_from_events  # noqa: E402
from gridtally.sources.scan import day_report, hour_report, scan_days  # noqa: E402
from gridtally.sources.sinks import (  # noqa: E402
    preview, read_csv, read_prefix, write_csv, write_parquet, write_ranged,
)

# The training-data operators are an optional subpackage: without its folder and
# corpus_pipeline.py the other queries still register. An error inside it is raised.
if find_spec("gridtally.llm") and find_spec("corpus_pipeline"):
    from gridtally.llm import queries as llm_queries
else:
    llm_queries = None

# Stamp written into every coverage row (the first day of the test data).
DATE_TD = "20240101"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls_from_events(_table(spark, sf_dir, "events"))


def _cover(id_col: str, id_name: str, resolution: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return coverage(_calls(spark, sf_dir), id_col=id_col, id_name=id_name,
                        resolutions=(resolution,), date_td=DATE_TD)[resolution]
    return run


# Fixed parameters of the date-based queries.
AS_OF = "2024-01-17"  # a Wednesday inside the test data
SCAN_DAYS = [f"2023{d:04d}" for d in (1230, 1231)] + [f"202401{d:02d}" for d in range(1, 32)] + [
    "20240201", "20240202"]
KPI_WEEK = ("20240108", "20240114")


def _cover_all(id_col: str, id_name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return coverage_all(_calls(spark, sf_dir), id_col=id_col, id_name=id_name,
                            date_td=DATE_TD)
    return run


def entry(spark: SparkSession) -> DataFrame:
    """eNB coverage at 1 km on sf0.001."""
    return _cover("current_enodeb_id", "enb", 1000)(spark, "/root/testdata/sf0.001")


# ---------------------------------------------------------------- queries
def q_nation_top_customers(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    per_customer = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("cnt"))
    pairs = (per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
             .join(nation, customer.c_nationkey == nation.n_nationkey)
             .select("n_name", F.col("c_custkey").cast("string").alias("customer"), "cnt"))
    # the sum of repeated pairs gives one shuffle that both of its reads share
    return topn_with_others(pairs, "n_name", "customer", n=10)


def q_grid_kpi(spark, sf_dir):
    week = F.to_date("ts").between(*[f"{d[:4]}-{d[4:6]}-{d[6:]}" for d in KPI_WEEK])
    return grid_kpi(_calls(spark, sf_dir).filter(week), precision=3,
                    start_week=KPI_WEEK[0], end_week=KPI_WEEK[1])


ALL_DAYS = ("20231201", "20240229")  # holds every event


def _day_states(spark, sf_dir) -> str:
    """The day states of all calls, stored; the calls are not needed again."""
    root = staging_path(spark, "day_states")
    calls = _calls(spark, sf_dir)
    days = [r[0] for r in calls.select("UTC_date").distinct().collect()]
    add_days(calls, root, days, {"enb": "current_enodeb_id", "gnb": "serving_nr_cell_id"})
    return root


def q_kpi_from_day_states(spark, sf_dir):
    """The KPI table over all days, merged from the states of each day."""
    return kpi_from_states(spark, _day_states(spark, sf_dir), *ALL_DAYS)


def q_kpi_coarse_from_day_states(spark, sf_dir):
    """One week at 1 km from the same 100 m states."""
    return kpi_from_states(spark, _day_states(spark, sf_dir), *KPI_WEEK, precision=2)


def q_enb_cover_slid(spark, sf_dir):
    """eNB coverage at 1 km of the last ten days, reached by sliding a window of ten days
    over all days, four at a time (the last step takes what is left)."""
    root = _day_states(spark, sf_dir)
    days = stored_days(spark, root)
    lo, hi = 0, min(10, len(days)) - 1
    state = pairs_of_days(spark, root, "enb", days[lo], days[hi])
    while hi < len(days) - 1:
        n = min(4, len(days) - 1 - hi)
        added = pairs_of_days(spark, root, "enb", days[hi + 1], days[hi + n])
        dropped = pairs_of_days(spark, root, "enb", days[lo], days[lo + n - 1])
        state = slide_pairs(state, added, dropped).checkpoint(eager=True)
        lo, hi = lo + n, hi + n
    pairs = state.withColumnRenamed("id", "current_enodeb_id")
    return coverage_from_pairs(pairs, "current_enodeb_id", 3, 1000, date_td=DATE_TD)


def q_subscriber_sketches(spark, sf_dir):
    """Distinct subscribers at 10 km from stored sketches, held against the exact counts:
    an estimate may be off by three standard errors (1.04 / sqrt(4096) each) and one."""
    root = _day_states(spark, sf_dir)
    exact, close = (kpi_from_states(spark, root, *ALL_DAYS, exact_distinct=e, precision=1).select(
        "gridid", "env_tag", F.col("unique_imsi_cnt").alias(n)).alias(n)
        for e, n in ((True, "n_exact"), (False, "n_sketch")))
    both = exact.join(close, F.col("n_exact.gridid").eqNullSafe(F.col("n_sketch.gridid"))
                      & (F.col("n_exact.env_tag") == F.col("n_sketch.env_tag")))
    off = F.abs(F.col("n_sketch") - F.col("n_exact"))
    return both.select("n_exact.gridid", "n_exact.env_tag", F.col("n_exact").alias("unique_imsi_cnt"),
                       (off <= F.col("n_exact") * 0.04875 + 1).alias("sketch_is_close"))


def q_grid_of_points(spark, sf_dir):
    calls = _calls(spark, sf_dir).select("event_id", "end_latitude", "end_longitude")
    return with_mgrs(calls, "end_latitude", "end_longitude",
                     {"g5": 5, "g3": 3, "g2": 2, "g1": 1})


def q_grid_coarsen(spark, sf_dir):
    calls = _calls(spark, sf_dir).select("event_id", "end_latitude", "end_longitude")
    fine = with_mgrs(calls, "end_latitude", "end_longitude", {"g5": 5})
    return fine.select("event_id", *[coarsen("g5", p, 5).alias(f"g{p}") for p in (3, 2, 1)])


def q_polar_grid_ids(spark, sf_dir):
    """Ids of points around both poles, some of them on the meridians that part squares."""
    points = _table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE event_id % 4 WHEN 0 THEN 84D + ((event_id * 37) % 6001) / 1000D"
        " WHEN 1 THEN -80D - ((event_id * 41) % 10001) / 1000D"
        " WHEN 2 THEN 90D - ((event_id * 43) % 977) / 100000D"
        " ELSE -90D + ((event_id * 47) % 89) * 0.25D END AS lat",
        "CASE WHEN event_id % 5 = 0 THEN ((event_id div 5) % 9) * 45D - 180D"
        " ELSE ((event_id * 7919) % 360001) / 1000D - 180D END AS lon")
    fine = with_mgrs(points, "lat", "lon", {"g5": 5, "g3": 3})
    return fine.withColumns({f"g{p}": coarsen("g3", p) for p in (2, 1)})


def q_cast_all_except(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    text = ev.select(
        F.col("event_id").cast("string").alias("event_id"), "ts",
        F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.col("value").cast("string").alias("value"), "props",
        F.regexp_extract("props", "[0-9]+", 0).alias("k_text"))
    return cast_all_except(text, keep=["ts", "event_type"])


def q_cast_losses(spark, sf_dir):
    """Texts of three columns that are no numbers, counted while the numbers are written."""
    ev = _table(spark, sf_dir, "events")
    k = F.col("event_id")
    text = ev.select(
        "event_type", k.cast("string").alias("event_id"),
        F.when(k % 7 == 0, "n/a").when(k % 11 == 0, None).when(k % 13 == 0, "")
        .otherwise(F.col("value").cast("string")).alias("value"),
        F.when(k % 5 == 0, F.concat(F.lit("u"), "user_id")).otherwise(
            F.concat(F.lit(" "), "user_id")).alias("user_id"))
    typed, seen = cast_all_except_counted(text, ["event_type"])
    write_parquet(typed, staging_path(spark, "typed_events"))
    return spark.createDataFrame([(c, *n) for c, n in cast_losses(seen).items()],
                                 "column_name string, n_present long, n_lost long")


def q_env_tag_counts(spark, sf_dir):
    calls = _calls(spark, sf_dir)
    located = calls.filter(F.col("end_latitude").isNotNull() & F.col("end_longitude").isNotNull())
    return located.groupBy(env_tag("indoor_outdoor_indicator_name").alias("env_tag"),
                           "indoor_outdoor_indicator_name").agg(F.count(F.lit(1)).alias("n"))


def q_date_range_scan(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    root = staging_path(spark, "events_by_day")
    write_csv(ev.withColumn("UTC_date", day_str("ts")), root, partition_by=["UTC_date"])
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    text = scan_days(spark, root, SCAN_DAYS, columns=cols)
    return text.select(
        F.col("event_id").try_cast("bigint").alias("event_id"),
        F.col("ts").try_cast("timestamp_ntz").alias("ts"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        "event_type",
        F.col("value").try_cast("double").alias("value"),
        "props", "UTC_date")


def q_missing_day_report(spark, sf_dir):
    """Which days of the scan list have a folder of events?"""
    ev = _table(spark, sf_dir, "events")
    root = staging_path(spark, "event_days")
    # only the folders count: one row per day
    write_csv(ev.select(day_str("ts").alias("UTC_date"), F.lit("x").alias("x")).distinct(), root,
              partition_by=["UTC_date"])
    return day_report(spark, root, SCAN_DAYS)


def q_missing_hours(spark, sf_dir):
    """Hours without events: some are left out, and some days have no hour folders."""
    ev = _table(spark, sf_dir, "events").select(
        "event_id", day_str("ts").alias("UTC_date"), F.hour("ts").alias("h"), F.dayofmonth("ts").alias("d"))
    root = staging_path(spark, "event_hours")
    flat = F.col("d") % 5 == 0
    kept = ev.where((F.col("d") + F.col("h")) % 7 != 0)
    hourly = kept.where(~flat).withColumn("UTC_hour", F.lpad(F.col("h").cast("string"), 2, "0"))
    write_parquet(hourly.drop("h", "d"), root, partition_by=["UTC_date", "UTC_hour"])
    write_parquet(kept.where(flat).drop("h", "d"), root, partition_by=["UTC_date"], mode="append")
    return hour_report(spark, root, SCAN_DAYS, rows=True).where("state <> 'present'")


def q_weekly_window_counts(spark, sf_dir):
    windows = [(v, weekly_window(AS_OF, v)) for v in ("kpi", "enb", "gnb")]
    windows.append(("trailing_9", trailing_days(AS_OF, 9)))
    days = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("window_name"), arr.alias("days")) for name, arr in windows
    ])).alias("w")).select("w.window_name", F.explode("w.days").alias("day"))
    # the windows' first and last day are constants, which reach the scan
    bounds = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    ev = _table(spark, sf_dir, "events").filter(
        (F.col("ts") >= F.lit(bounds.lo)) & (F.col("ts") < F.lit(bounds.hi + timedelta(days=1))))
    daily = ev.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_events"))
    return (days.join(daily, "day", "left")
            .select("window_name", day_str("day").alias("day"),
                    F.coalesce("n_events", F.lit(0)).alias("n_events")))


def q_access_burst(spark, sf_dir):
    ev = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return access_bursts(ev, "user_id", "ts", n=3, within_seconds=3600, order=["event_id"])


def q_burst_witnesses(spark, sf_dir):
    ev = _table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return burst_witnesses(ev, "user_id", "ts", n=3, within_seconds=3600, order=["event_id"])


def q_clock_text(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    hhmm = F.date_format("ts", "HHmm")
    return ev.select("event_id", hhmm.alias("hhmm"),
                     clock_minutes(hhmm).alias("minute_of_day"),
                     clock_decimal_hours(hhmm).alias("decimal_hours"),
                     clock_to_timestamp(F.to_date("ts"), hhmm).alias("ts_minute"))


def q_clock_bad_text(spark, sf_dir):
    """Clock text with bad values mixed in: only 0000 to 2359 counts."""
    ev = _table(spark, sf_dir, "events")
    k = F.col("event_id") % 7
    text = (F.when(k == 0, "2460").when(k == 1, "549").when(k == 2, "-1-5").when(k == 3, "2400")
            .when(k == 4, " 930").otherwise(F.date_format("ts", "HHmm")))
    return ev.select("event_id", text.alias("hhmm"),
                     clock_minutes(text).alias("minute_of_day"),
                     clock_decimal_hours(text).alias("decimal_hours"),
                     clock_to_timestamp(F.to_date("ts"), text).alias("ts_minute"))


def q_grid_bad_points(spark, sf_dir):
    """Grid ids of coordinates that are infinite, huge, NaN or no number."""
    calls = _calls(spark, sf_dir).select("event_id", "end_latitude", "end_longitude")
    k = F.col("event_id") % 9
    lat = F.when(k == 0, "NaN").when(k == 1, "north").otherwise(
        F.col("end_latitude").cast("string"))
    lon = (F.when(k == 2, "1e20").when(k == 3, "Infinity").when(k == 4, "-Infinity")
           .when(k == 5, "180.5").otherwise(F.col("end_longitude").cast("string")))
    points = calls.select("event_id", lat.alias("lat"), lon.alias("lon"))
    return with_mgrs(points, "lat", "lon", {"gridid": 3}).select(
        "event_id", "gridid", mgrs("lat", "lon", 1).alias("coarse"))


def q_burst_big_keys(spark, sf_dir):
    """Bursts of keys above 2^53, some of them NULL."""
    ev = _table(spark, sf_dir, "events")
    key = F.when(F.col("user_id") % 10 == 0, None).otherwise(
        F.lit(9007199254740992).cast("bigint") + F.col("user_id"))
    return access_bursts(ev.select(key.alias("big_id"), "ts", "event_id"), "big_id", "ts", n=3,
                         within_seconds=3600, order=["event_id"])


def q_id_reconcile(spark, sf_dir):
    """Customers against the customers of all orders, duplicates counted."""
    def ids(table, column):
        return _table(spark, sf_dir, table).select(
            F.lpad(F.col(column).cast("string"), 8, "0").alias("id"))

    return reconcile(ids("customer", "c_custkey"), ids("orders", "o_custkey"), "id")


def q_freshness_gaps(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    return day_gaps(ev, F.to_date("ts"), by=["user_id"])


def q_data_freshness(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    return freshness(ev, F.to_date("ts"), as_of="2024-01-31", delay_days=1,
                     floor_day="2023-01-01", by=["user_id"])


def q_stale_sources(spark, sf_dir):
    """Freshness with a floor after some users' last day: they stay, with NULLs."""
    ev = _table(spark, sf_dir, "events")
    early = ev.filter((F.col("user_id") % 3 != 0) | (F.col("ts") < F.lit("2024-01-10")))
    return freshness(early, F.to_date("ts"), as_of="2024-01-31", delay_days=1,
                     floor_day="2024-01-15", by=["user_id"])


def q_gaps_in_window(spark, sf_dir):
    """Missing days in a fixed window; users without a row in it miss all days."""
    ev = _table(spark, sf_dir, "events")
    early = ev.filter((F.col("user_id") % 3 != 0) | (F.col("ts") < F.lit("2024-01-10")))
    return day_gaps(early, F.to_date("ts"), by=["user_id"], start="2024-01-12", end="2024-01-25")


def q_order_day_gaps(spark, sf_dir):
    return day_gaps(_table(spark, sf_dir, "orders"), F.to_date("o_orderdate"))


def q_sample_md5(spark, sf_dir):
    """Sample by a key that is NULL on some rows; those are sampled one by one."""
    ev = _table(spark, sf_dir, "events").withColumn(
        "group_id", F.when(F.col("event_id") % 5 == 0, None).otherwise(F.col("event_id") % 1000))
    return sample_by_hash(ev, ["group_id"], 0.1, rows_without_key=["event_id"])


def q_sample_k_per_type(spark, sf_dir):
    """Twenty events of each type, and of those without one."""
    ev = _table(spark, sf_dir, "events").withColumn(
        "kind", F.when(F.col("event_id") % 9 != 0, F.col("event_type")))
    return sample_k(ev, ["kind"], ["user_id", "event_id"], 20)


def q_table_profile(spark, sf_dir):
    return profile(_calls(spark, sf_dir),
                   distinct_cols=["subscriber_id", "current_enodeb_id", "serving_nr_cell_id"],
                   null_cols=["serving_nr_cell_id", "end_latitude",
                              "indoor_outdoor_indicator_name"])


def q_doc_token_counts(spark, sf_dir):
    return doc_token_counts(_table(spark, sf_dir, "documents"))


def q_corpus_token_counts(spark, sf_dir):
    return corpus_token_counts(_table(spark, sf_dir, "documents"))


def q_dedup_keys(spark, sf_dir):
    """The latest event of each user and type."""
    return dedup_keys(_table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])


COVER_SCHEMA = ("date_td string, cnt bigint, enb string, gridid string, pct double, "
                "rank int, is_other boolean")


def q_parquet_round_trip(spark, sf_dir):
    path = staging_path(spark, "enb_cover_1000_parquet")
    write_parquet(_cover("current_enodeb_id", "enb", 1000)(spark, sf_dir), path, files=4)
    return spark.read.parquet(path)


def _csv_round_trip(gzip: bool):
    def run(spark, sf_dir):
        path = staging_path(spark, "enb_cover_1000_csv" + ("_gz" if gzip else ""))
        write_csv(_cover("current_enodeb_id", "enb", 1000)(spark, sf_dir), path, files=4,
                  gzip=gzip)
        return read_csv(spark, path, COVER_SCHEMA)
    return run


PREFIX = "04QFJ5"


def q_grid_prefix_read(spark, sf_dir):
    """eNB coverage at 100 m, written in ranges of grid id and rank; one prefix is read."""
    path = staging_path(spark, "enb_cover_100_ranged")
    write_ranged(_cover("current_enodeb_id", "enb", 100)(spark, sf_dir), path,
                 ["gridid", "is_other", "rank"], files=16)
    return read_prefix(spark, path, "gridid", PREFIX)


def alerts_from_calls(calls: DataFrame) -> DataFrame:
    """Alert-shaped text records per (eNB, day), derived from call rows."""
    day = F.to_date("ts")
    enb = F.col("current_enodeb_id")
    g = calls.groupBy(enb.alias("enodeb"), day.alias("day")).agg(
        F.count_if(F.col("rsrp_dbm") < -82.0).alias("abnormal"),
        F.count_if(F.col("indoor_outdoor_indicator_name") == "Indoor").alias("nrb"),
        F.count_if(F.col("indoor_outdoor_indicator_name").isNull()).alias("w360"))
    return g.select(
        "enodeb",
        F.concat(F.lit("site_"), "enodeb").alias("site"),
        F.concat(F.lit("region_"), (F.col("enodeb").cast("int") % 4).cast("string"))
        .alias("region"),
        F.date_format(F.date_add("day", 1), "yyyy-MM-dd").alias("alert_day"),
        F.date_format("day", "yyyy-MM-dd").alias("event_day"),
        F.col("abnormal").cast("string").alias("abnormal_kpi_count"),
        F.col("nrb").cast("string").alias("nrb_ticket_counts"),
        F.col("w360").cast("string").alias("w360_ticket_counts"),
        F.when(F.col("enodeb").cast("int") % 2 == 0, F.lit("vendor_a"))
        .otherwise(F.lit("vendor_b")).alias("vendor"),
    )


def q_json_alerts(spark, sf_dir):
    path = staging_path(spark, "alerts_json")
    alerts_from_calls(_calls(spark, sf_dir)).select(*ALERT_FIELDS).write.mode("overwrite").json(path)
    return read_alerts(spark, path)


def q_json_alerts_broken(spark, sf_dir):
    """Alert lines of which some are cut short: their text is kept apart."""
    path = staging_path(spark, "alerts_broken")
    lines = alerts_from_calls(_calls(spark, sf_dir)).select(
        F.to_json(F.struct(*ALERT_FIELDS)).alias("line"))
    cut = F.pmod(F.length("line"), F.lit(3)) == 0
    lines.select(F.when(cut, F.substring("line", 1, 40)).otherwise(F.col("line"))).write.text(path)
    return read_alerts(spark, path, keep_corrupt=True)


def q_preview_20(spark, sf_dir):
    return preview(_table(spark, sf_dir, "events"), 20, order_by=["ts", "event_id"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for r in (100, 1000, 10000):
        q[f"enb_cover_{r}"] = _cover("current_enodeb_id", "enb", r)
        q[f"gnb_cover_{r}"] = _cover("serving_nr_cell_id", "gnb", r)
    q["enb_cover_all"] = _cover_all("current_enodeb_id", "enb")
    q["gnb_cover_all"] = _cover_all("serving_nr_cell_id", "gnb")
    q.update({
        "nation_top_customers": q_nation_top_customers,
        "grid_kpi": q_grid_kpi,
        "kpi_from_day_states": q_kpi_from_day_states,
        "kpi_coarse_from_day_states": q_kpi_coarse_from_day_states,
        "enb_cover_slid": q_enb_cover_slid,
        "subscriber_sketches": q_subscriber_sketches,
        "grid_of_points": q_grid_of_points,
        "grid_coarsen": q_grid_coarsen,
        "polar_grid_ids": q_polar_grid_ids,
        "cast_all_except": q_cast_all_except,
        "env_tag_counts": q_env_tag_counts,
        "date_range_scan": q_date_range_scan,
        "weekly_window_counts": q_weekly_window_counts,
        "access_burst": q_access_burst,
        "burst_witnesses": q_burst_witnesses,
        "clock_text": q_clock_text,
        "id_reconcile": q_id_reconcile,
        "freshness_gaps": q_freshness_gaps,
        "data_freshness": q_data_freshness,
        "order_day_gaps": q_order_day_gaps,
        "sample_md5": q_sample_md5,
        "sample_k_per_type": q_sample_k_per_type,
        "cast_losses": q_cast_losses,
        "missing_hours": q_missing_hours,
        "table_profile": q_table_profile,
        "doc_token_counts": q_doc_token_counts,
        "corpus_token_counts": q_corpus_token_counts,
        "dedup_keys": q_dedup_keys,
        "parquet_round_trip": q_parquet_round_trip,
        "csv_round_trip": _csv_round_trip(False),
        "csv_gzip_round_trip": _csv_round_trip(True),
        "grid_prefix_read": q_grid_prefix_read,
        "json_alerts": q_json_alerts,
        "preview_20": q_preview_20,
        "missing_day_report": q_missing_day_report,
        "clock_bad_text": q_clock_bad_text,
        "grid_bad_points": q_grid_bad_points,
        "burst_big_keys": q_burst_big_keys,
        "stale_sources": q_stale_sources,
        "gaps_in_window": q_gaps_in_window,
        "json_alerts_broken": q_json_alerts_broken,
    })
    if llm_queries:
        q.update(llm_queries.queries())
    return q


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    for r, p in ((100, 3), (1000, 2), (10000, 1)):
        o[f"enb_cover_{r}"] = osql.coverage("current_enodeb_id", "enb", p, DATE_TD)
        o[f"gnb_cover_{r}"] = osql.coverage("serving_nr_cell_id", "gnb", p, DATE_TD)
    o["enb_cover_all"] = osql.coverage_all("current_enodeb_id", "enb", DATE_TD)
    o["gnb_cover_all"] = osql.coverage_all("serving_nr_cell_id", "gnb", DATE_TD)
    o.update(osql.other_queries(AS_OF, SCAN_DAYS, KPI_WEEK, DATE_TD))
    if llm_queries:
        o.update(llm_queries.oracle_sql())
    return o
