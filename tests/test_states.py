"""Day states: windows merged from stored days, without scanning them again."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from gridtally.operators import states
from gridtally.operators.cover import pair_counts
from gridtally.operators.kpi import KPI_MEASURES, grid_kpi
from gridtally.operators.states import (
    add_days, kpi_from_states, pairs_of_days, read_states, slide_pairs, stored_days,
)
from gridtally.plans.jobs import ID_COLUMN, kpi_state_job
from gridtally.plans.session import staging_path
from gridtally.sources.calls import CALL_COLUMNS, calls_from_events
from gridtally.sources.sinks import write_csv
from tests.conftest import SF001

OUT = ["gridid", "env_tag", *[o for _, _, o in KPI_MEASURES], "unique_imsi_cnt", "records_cnt"]


@pytest.fixture(scope="module")
def calls(spark):
    """Calls of a few days, some without a subscriber, some cells with no subscriber at all."""
    df = calls_from_events(spark.read.parquet(f"{SF001}/events.parquet"))
    return df.withColumn("subscriber_id", F.when(F.col("event_id") % 6 != 0, F.col("subscriber_id"))).cache()


def _rows(df, columns=OUT):
    return sorted(map(str, df.select(*columns).collect()))


def test_any_window_equals_the_table_from_the_calls(spark, calls):
    root = staging_path(spark, "t-states")
    days = sorted(r[0] for r in calls.select("UTC_date").distinct().collect())
    assert add_days(calls, root, days[:5], ID_COLUMN) == days[:5]
    assert add_days(calls, root, days[3:9], ID_COLUMN) == days[5:9]  # the others are there
    assert stored_days(spark, root) == days[:9]
    for lo, hi in ((0, 8), (2, 6), (4, 4)):
        window = calls.where(F.col("UTC_date").between(days[lo], days[hi]))
        assert _rows(kpi_from_states(spark, root, days[lo], days[hi])) == _rows(grid_kpi(window))
    coarse = kpi_from_states(spark, root, days[0], days[8], precision=1)
    window = calls.where(F.col("UTC_date") <= days[8])
    assert _rows(coarse) == _rows(grid_kpi(window, precision=1))
    assert kpi_from_states(spark, root, "19990101", "19990107").count() == 0


def test_a_window_opens_its_own_days_only(spark, calls):
    root = staging_path(spark, "t-states")
    days = sorted(r[0] for r in calls.select("UTC_date").distinct().collect())[:4]
    add_days(calls, root, days, ID_COLUMN)
    files = read_states(spark, root, "measures", days[1], days[2]).inputFiles()
    assert files and all(days[1] in f or days[2] in f for f in files)


def test_a_half_stored_day_is_made_again(spark, calls, monkeypatch):
    root = staging_path(spark, "t-states")
    days = sorted(r[0] for r in calls.select("UTC_date").distinct().collect())[:2]
    rename, seen = states._rename, []

    def dies(spark_, old, new):
        if "/measures/" in new:
            raise OSError("the driver dies")
        seen.append(new)
        rename(spark_, old, new)

    monkeypatch.setattr(states, "_rename", dies)
    with pytest.raises(OSError):
        add_days(calls, root, days, ID_COLUMN)
    assert seen and stored_days(spark, root) == []
    monkeypatch.undo()
    assert add_days(calls, root, [*days, "20500101"], ID_COLUMN) == [*days, "20500101"]
    window = calls.where(F.col("UTC_date").isin(days))
    assert _rows(kpi_from_states(spark, root, days[0], "20500101")) == _rows(grid_kpi(window))
    assert stored_days(spark, root) == [*days, "20500101"]  # a day without rows is known
    assert not [x for x in os.listdir(root.removeprefix("file:")) if x.startswith(".new")]


def test_the_second_window_scans_only_new_days(spark, calls, tmp_path):
    """The folders of stored days are taken away: nothing reads them."""
    root, state_root = str(tmp_path / "trc"), str(tmp_path / "states")
    text = calls.select(*[(F.col(c) if c in calls.columns else F.lit(None)).cast("string").alias(c)
                          for c in CALL_COLUMNS], "UTC_date")
    write_csv(text, root, partition_by=["UTC_date"])
    out = str(tmp_path / "out")
    new = kpi_state_job(spark, root, state_root, "2024-01-07", out, trailing=5)
    assert new == [f"202401{d:02d}" for d in range(3, 8)]
    for d in range(3, 8):
        shutil.rmtree(f"{root}/UTC_date=202401{d:02d}")
    assert kpi_state_job(spark, root, state_root, "2024-01-09", out, trailing=5) == ["20240108", "20240109"]
    window = calls.where(F.col("UTC_date").between("20240105", "20240109"))
    assert _rows(spark.read.parquet(out)) == _rows(grid_kpi(window))
    shutil.rmtree(f"{root}/UTC_date=20240110")
    with pytest.raises(FileNotFoundError):  # a day that is neither stored nor there
        kpi_state_job(spark, root, state_root, "2024-01-10", out, trailing=3)
    assert _rows(spark.read.parquet(out)) == _rows(grid_kpi(window))


def test_sliding_equals_counting_again_and_refuses_other_days(spark, calls):
    root = staging_path(spark, "t-states")
    days = sorted(r[0] for r in calls.select("UTC_date").distinct().collect())[:8]
    add_days(calls, root, days, ID_COLUMN)
    for kind, column in ID_COLUMN.items():
        state = pairs_of_days(spark, root, kind, days[0], days[3])
        for k in range(4):
            state = slide_pairs(state, pairs_of_days(spark, root, kind, days[4 + k], days[4 + k]),
                                pairs_of_days(spark, root, kind, days[k], days[k]))
        cells = read_states(spark, root, "pairs", days[4], days[7]).where(F.col("kind") == kind)
        again = cells.groupBy("gridid", "id").agg(F.sum("cnt").alias("cnt"))
        assert _rows(state, ["gridid", "id", "cnt"]) == _rows(again, ["gridid", "id", "cnt"])
        raw = calls.where(F.col("UTC_date").between(days[4], days[7]))
        assert state.agg(F.sum("cnt")).first()[0] == raw.count()
        assert sorted(map(str, pair_counts(raw, "UTC_date", column).groupBy(column).agg(
            F.sum("cnt").alias("cnt")).collect())) == sorted(map(str, state.groupBy(
                F.col("id").alias(column)).agg(F.sum("cnt").alias("cnt")).collect()))
    with pytest.raises(Exception, match="does not hold"):
        empty = state.limit(0)
        slide_pairs(empty, empty, state).collect()


def test_sketches_follow_the_exact_counts(spark):
    """Up to 20,000 subscribers of one cell over three days."""
    rows = spark.range(60_000).selectExpr(
        "cast(id % 20000 as string) subscriber_id", "21.3 end_latitude", "-157.8 end_longitude",
        "'Indoor' indoor_outdoor_indicator_name", "concat('2024010', 1 + id % 3) UTC_date",
        "'1' current_enodeb_id", "'2' serving_nr_cell_id",
        *[f"1.5D {src}" for src, _, _ in KPI_MEASURES])
    root = staging_path(spark, "t-states")
    add_days(rows, root, ["20240101", "20240102", "20240103"], ID_COLUMN)
    for last, exact in (("20240101", 20_000), ("20240103", 20_000)):
        one = kpi_from_states(spark, root, "20240101", last, exact_distinct=False).first()
        n = kpi_from_states(spark, root, "20240101", last).first().unique_imsi_cnt
        assert n == exact and abs(one.unique_imsi_cnt - n) <= 3 * 1.04 / 64 * n
