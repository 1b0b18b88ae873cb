"""Whole weekly jobs: scan a window of day folders, compute, write.

Paths, dates and sizes are parameters; nothing here names a cluster.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.functions.columns import cast_all_except, cast_all_except_counted, cast_losses
from gridtally.functions.dates import window_bounds
from gridtally.operators.quality import sample_by_hash
from gridtally.operators.cover import RESOLUTIONS, grid_pairs, rank_resolutions
from gridtally.operators.kpi import KPI_MEASURES, grid_kpi
from gridtally.operators.states import add_days, kpi_from_states, stored_days
from gridtally.plans.session import shared_dir
from gridtally.sources.calls import DATE_COLUMNS, STRING_COLUMNS
from gridtally.sources.scan import DAY_PARTITION, missing_days, scan_days
from gridtally.sources.sinks import write_csv, write_parquet

ID_COLUMN = {"enb": "current_enodeb_id", "gnb": "serving_nr_cell_id"}

# ---- fixed values: output files per resolution (metres)
DEFAULT_FILES = {"enb": {100: 200, 1000: 20, 10000: 2}, "gnb": {100: 500, 1000: 50, 10000: 5}}


def days_between(start: str, end: str) -> list[str]:
    """``yyyyMMdd`` days from start to end inclusive."""
    a = dt.datetime.strptime(start, "%Y%m%d").date()
    b = dt.datetime.strptime(end, "%Y%m%d").date()
    return [(a + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range((b - a).days + 1)]


def job_days(as_of: str, variant: str, trailing: int | None = None) -> tuple[str, str]:
    """First and last day: the variant's weekly window, or the ``trailing``
    days ending at as_of."""
    if trailing:
        end = dt.date.fromisoformat(str(as_of))
        return ((end - dt.timedelta(days=trailing - 1)).strftime("%Y%m%d"),
                end.strftime("%Y%m%d"))
    return window_bounds(as_of, variant)


def _sampled(calls: DataFrame, fraction: float | None, key: str) -> DataFrame:
    # Whole subscribers are kept or dropped, so distinct counts stay meaningful
    # and the same rows are picked on every run. Rows without subscriber are
    # sampled one by one.
    if fraction is None:
        return calls
    others = [c for c in calls.columns if c != key]
    return sample_by_hash(calls, [key], fraction, rows_without_key=others)


def window_days(spark: SparkSession, root: str, start: str, end: str,
                allow_missing: bool) -> tuple[list[str], list[str]]:
    """The window's days that exist and those that do not.

    Fails if none exists, so that old output is never replaced by nothing, and
    if one is missing unless ``allow_missing``.
    """
    days = days_between(start, end)
    absent = missing_days(spark, root, days)
    if absent and (not allow_missing or len(absent) == len(days)):
        raise FileNotFoundError(f"no data under {root} for {', '.join(absent)}")
    return [d for d in days if d not in absent], absent


def kpi_job(spark: SparkSession, root: str, as_of: str, out: str,
            files: int | None = None, exact_distinct: bool = True,
            allow_missing: bool = False, trailing: int | None = None,
            sample_fraction: float | None = None) -> DataFrame:
    """Grid KPI table of last Monday-Sunday week (or ``trailing`` days up to
    as_of), written as Parquet. ``sample_fraction`` keeps that share of
    subscribers. Fails, with the old output intact, if a day of the window is
    missing; ``allow_missing`` accepts that as long as one day is there.
    Prints how many texts of the columns it uses were no numbers, counted in the same
    pass. Returns the (lazy) result; the write is the only action.
    """
    start, end = job_days(as_of, "kpi", trailing)
    days, _ = window_days(spark, root, start, end, allow_missing)
    calls = _sampled(scan_days(spark, root, days), sample_fraction, "subscriber_id")
    kept = [*STRING_COLUMNS, *DATE_COLUMNS, DAY_PARTITION]
    used = sorted({src for src, _, _ in KPI_MEASURES}) + ["end_latitude", "end_longitude"]
    counted, seen = cast_all_except_counted(calls, kept, counted=used)
    kpi = grid_kpi(counted, start_week=start, end_week=end, exact_distinct=exact_distinct,
                   subscribers_of=cast_all_except(calls, kept))
    write_parquet(kpi, out, files=files)
    for column, (present, lost) in cast_losses(seen).items():
        if lost:
            print(f"{column}: {lost} of {present} texts are no numbers")
    return kpi


def kpi_state_job(spark: SparkSession, root: str, state_root: str, as_of: str, out: str,
                  files: int | None = None, exact_distinct: bool = True, allow_missing: bool = False,
                  trailing: int | None = None) -> list[str]:
    """``kpi_job`` from stored day states: only days that are not stored yet are scanned.

    Returns those days. The states (``operators.states``) hold the pair counts of both
    coverage jobs as well. A day of the window must be stored or have a folder, unless
    ``allow_missing``.
    """
    start, end = job_days(as_of, "kpi", trailing)
    window = days_between(start, end)
    wanted = sorted(set(window) - set(stored_days(spark, state_root)))
    absent = missing_days(spark, root, wanted)
    if absent and (not allow_missing or len(absent) == len(window)):
        raise FileNotFoundError(f"no data under {root} for {', '.join(absent)}")
    new = [d for d in wanted if d not in absent]
    if new:
        typed = cast_all_except(scan_days(spark, root, new),
                                [*STRING_COLUMNS, *DATE_COLUMNS, DAY_PARTITION])
        add_days(typed, state_root, new, ID_COLUMN)
    kpi = kpi_from_states(spark, state_root, start, end, exact_distinct)
    write_parquet(kpi, out, files=files)
    return new


def coverage_job(spark: SparkSession, root: str, as_of: str, out_root: str,
                 kind: str = "enb", resolutions: Sequence[int] = (100, 1000, 10000),
                 n: int = 10, files: dict[int, int] | None = None, gzip: bool | None = None,
                 stamp: str | None = None, keep_unlocated: bool = True,
                 allow_missing: bool = False, trailing: int | None = None,
                 sample_fraction: float | None = None,
                 sort_within: Sequence[str] = ("gridid", "is_other", "rank"),
                 keep_going: bool = False, reference_layout: bool = False) -> dict[int, str]:
    """eNB or gNB coverage of the job's weekly window at each resolution.

    The window's rows are scanned and shuffled once: pair counts at the finest
    precision are checkpointed to the shared folder (reliable storage, so a
    lost executor does not send the later steps back to the raw scan), all
    resolutions are ranked from them in one pass and checkpointed (at most
    n + 1 rows per cell), and each resolution is written as CSV
    (``<out_root>/<kind>_cover_<r>``). ``stamp`` defaults to the window's
    first day for eNB and its last day for gNB. Rows are ordered by grid and
    rank (``sort_within``) inside each output file, and files hold ranges of that order,
    so a cell's rows are in one file or in neighbours. With ``keep_going`` a
    failed resolution does not stop the others; the first error is raised
    after all were attempted. ``reference_layout`` writes only the original
    five columns (``date_td, cnt, <kind>, gridid, pct``) for readers of the
    old files. ``files`` defaults to the original jobs' file counts
    (``DEFAULT_FILES``); missing days are handled as in ``kpi_job``. Returns
    the output paths.
    """
    start, end = job_days(as_of, kind, trailing)
    stamp = stamp or (start if kind == "enb" else end)
    gzip = (kind == "enb") if gzip is None else gzip
    id_col = ID_COLUMN[kind]
    days, _ = window_days(spark, root, start, end, allow_missing)
    calls = _sampled(scan_days(spark, root, days), sample_fraction, "subscriber_id")
    files = DEFAULT_FILES[kind] if files is None else files
    finest = max(RESOLUTIONS[r] for r in resolutions)
    shared_dir(spark)  # make sure a checkpoint folder is set
    base = grid_pairs(calls, id_col, finest, keep_unlocated).checkpoint(eager=True)
    ranked = rank_resolutions(base, id_col, finest, resolutions, n, stamp, kind) \
        .checkpoint(eager=True)
    paths, errors = {}, []
    for r in resolutions:
        path = f"{out_root.rstrip('/')}/{kind}_cover_{r}"
        try:
            df = ranked.filter(F.col("resolution_m") == r).drop("resolution_m")
            n_files = files.get(r)
            if reference_layout:
                # shape and order the files first, then keep the five columns
                if n_files and sort_within:
                    df = df.repartitionByRange(n_files, *sort_within)
                elif n_files:
                    df = df.repartition(n_files)
                df = df.sortWithinPartitions(*sort_within) if sort_within else df
                write_csv(df.select("date_td", "cnt", kind, "gridid", "pct"), path, gzip=gzip)
            else:
                write_csv(df, path, files=n_files, gzip=gzip, sort_within=sort_within, ranges=True)
            paths[r] = path
        except Exception as e:  # noqa: BLE001 - reported after the other resolutions
            if not keep_going:
                raise
            errors.append((r, e))
    if errors:
        raise RuntimeError(f"coverage failed for resolutions {[r for r, _ in errors]}") \
            from errors[0][1]
    return paths
