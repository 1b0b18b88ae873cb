import os

import pytest
from pyspark.sql import functions as F

from gridtally.operators.cover import coverage
from gridtally.operators.kpi import grid_kpi
from gridtally.plans.jobs import DEFAULT_FILES, coverage_job, days_between, kpi_job
from gridtally.plans.session import staging_path
from gridtally.sources.calls import CALL_COLUMNS, calls_from_events
from gridtally.sources.sinks import read_csv, write_csv
from tests.conftest import SF01

COVER_SCHEMA = ("date_td string, cnt bigint, gnb string, gridid string, pct double, "
                "rank int, is_other boolean")


def _stage_calls(spark):
    """Call records as the jobs expect them: text CSV per UTC day, 85 columns."""
    calls = calls_from_events(spark.read.parquet(f"{SF01}/events.parquet"))
    have = set(calls.columns)
    text = calls.select(*[F.col(c).cast("string").alias(c) if c in have
                          else F.lit(None).cast("string").alias(c) for c in CALL_COLUMNS],
                        "UTC_date")
    root = staging_path(spark, "trc")
    write_csv(text, root, partition_by=["UTC_date"])
    return root, calls


def test_weekly_jobs_end_to_end(spark):
    root, calls = _stage_calls(spark)
    as_of = "2024-01-17"  # KPI week Jan 8-14; gNB window Jan 14-17
    out = staging_path(spark, "kpi")
    kpi_job(spark, root, as_of, out, files=2)
    got = spark.read.parquet(out)
    week = calls.filter(F.col("UTC_date").between("20240108", "20240114"))
    want = grid_kpi(week, start_week="20240108", end_week="20240114")
    assert sorted(got.columns) == sorted(want.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0

    paths = coverage_job(spark, root, as_of, staging_path(spark, "cover"), kind="gnb",
                         files={100: 3, 1000: 2, 10000: 1})
    days = days_between("20240114", "20240117")
    wcalls = calls.filter(F.col("UTC_date").isin(days))
    want = coverage(wcalls, id_col="serving_nr_cell_id", id_name="gnb", date_td="20240117")
    for r, p in paths.items():
        assert not any(n.endswith(".gz") for n in os.listdir(p))
        back = read_csv(spark, p, COVER_SCHEMA)
        assert back.exceptAll(want[r]).count() == 0 and want[r].exceptAll(back).count() == 0


def test_trailing_window_sample_and_file_order(spark):
    from gridtally.operators.quality import sample_by_hash

    root, calls = _stage_calls(spark)
    out = staging_path(spark, "kpi_trailing")
    kpi_job(spark, root, "2024-01-20", out, trailing=3, sample_fraction=0.5)
    got = spark.read.parquet(out)
    part = sample_by_hash(calls.filter(F.col("UTC_date").between("20240118", "20240120")),
                          ["subscriber_id"], 0.5)  # no subscriber is NULL here
    want = grid_kpi(part, start_week="20240118", end_week="20240120")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0

    paths = coverage_job(spark, root, "2024-01-20", staging_path(spark, "cov_sorted"),
                         kind="enb", resolutions=(1000,), files={1000: 2})
    for p in paths.values():
        files = sorted(f for f in os.listdir(p) if f.endswith(".csv.gz"))
        assert len(files) == 2
        for f in files:
            rows = spark.read.schema(COVER_SCHEMA.replace("gnb", "enb")).option(
                "header", True).csv(os.path.join(p, f)).collect()
            keys = [(r.gridid or "", r.is_other, r.rank or 0) for r in rows]
            assert keys == sorted(keys)


def test_cli_runs_a_coverage_job(spark):
    from gridtally.plans.__main__ import main

    root, _ = _stage_calls(spark)
    out = staging_path(spark, "cli")
    assert main(["gnb", "--root", root, "--as-of", "2024-01-17", "--out", out,
                 "--resolutions", "10000", "--keep-going", "--reference-layout",
                 "--files", "2"]) == 0
    folder = f"{out}/gnb_cover_10000"
    back = spark.read.option("header", True).csv(folder)
    assert back.columns == ["date_td", "cnt", "gnb", "gridid", "pct"] and back.count() > 0
    parts = sorted(f for f in os.listdir(folder) if f.endswith(".csv"))
    assert len(parts) == 2
    for f in parts:  # each file ordered by grid cell
        cells = [r.gridid or "" for r in spark.read.option("header", True)
                 .csv(os.path.join(folder, f)).collect()]
        assert cells == sorted(cells)


def test_missing_days_fail_and_leave_the_old_output(spark):
    root, _ = _stage_calls(spark)
    out = staging_path(spark, "kpi_kept")
    kpi_job(spark, root, "2024-01-17", out)
    before = spark.read.parquet(out).count()
    assert before > 0
    for allow in (False, True):  # no day of that window exists
        with pytest.raises(FileNotFoundError, match="20250106"):
            kpi_job(spark, root, "2025-01-15", out, allow_missing=allow)
        with pytest.raises(FileNotFoundError):
            coverage_job(spark, root, "2025-01-15", out, allow_missing=allow)
    assert spark.read.parquet(out).count() == before
    # the data begin on 1 January: a window from 30 December has some of its days
    cover = staging_path(spark, "cover_partial")
    with pytest.raises(FileNotFoundError, match="20231230"):
        coverage_job(spark, root, "2024-01-03", cover, resolutions=(10000,))
    paths = coverage_job(spark, root, "2024-01-03", cover, resolutions=(10000,),
                         files={10000: 1}, allow_missing=True)
    assert spark.read.option("header", True).csv(paths[10000]).count() > 0


def test_file_counts_follow_the_resolution():
    from gridtally.plans.__main__ import file_counts

    assert file_counts(None, [100]) is None
    assert file_counts("3", [100, 1000]) == {100: 3, 1000: 3}
    assert file_counts("100=200,1000=20", [100, 1000]) == {100: 200, 1000: 20}
    assert DEFAULT_FILES["gnb"][100] == 500 and DEFAULT_FILES["enb"][10000] == 2


def test_kpi_job_prints_texts_that_are_no_numbers(spark, capsys):
    calls = calls_from_events(spark.read.parquet(f"{SF01}/events.parquet")).where("UTC_date < '20240103'")
    text = calls.select(*[F.col(c).cast("string").alias(c) if c in calls.columns
                          else F.lit("?").alias(c) for c in CALL_COLUMNS], "UTC_date").withColumn(
        "rsrp_dbm", F.when(F.col("subscriber_id") == "7", "bad").otherwise(F.col("rsrp_dbm")))
    root, n = staging_path(spark, "trc"), calls.where("subscriber_id = '7'").count()
    write_csv(text, root, partition_by=["UTC_date"])
    kpi_job(spark, root, "2024-01-02", staging_path(spark, "kpi"), trailing=2)
    assert capsys.readouterr().out == f"rsrp_dbm: {n} of {calls.count()} texts are no numbers\n" and n
