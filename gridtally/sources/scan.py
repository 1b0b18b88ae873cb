"""Day-partitioned CSV scans of call records.

Layout: ``<root>/UTC_date=<yyyyMMdd>/`` (on some days with ``UTC_hour=`` folders
below), headered CSV, all text. Files are taken by their own header: one Spark job
reads the first line of every file, many files a task, and counts headers by folder;
folders are grouped by header and depth, and each group is one scan, so columns are
never mixed up, whether headers differ between days, between hours or between files. A
source whose layout never changes is one scan. The driver sees one row for each folder
and header in it, and files by name only where a folder holds several headers.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.sources.calls import CALL_COLUMNS

DAY_PARTITION = "UTC_date"


def text_schema(columns: Sequence[str] = CALL_COLUMNS) -> T.StructType:
    """All-text schema of the source columns, in file order."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def day_path(root: str, day: str) -> str:
    return f"{root.rstrip('/')}/{DAY_PARTITION}={day}"


def _filesystem(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _filesystem(spark, path)
    return fs.exists(p)


def missing_days(spark: SparkSession, root: str, days: Iterable[str]) -> list[str]:
    """Days of the list with no folder under ``root`` (metadata only)."""
    return [d for d in days if not _exists(spark, day_path(root, d))]


def day_report(spark: SparkSession, root: str, days: Sequence[str]) -> DataFrame:
    """``(day, present, latest_day)`` for each listed day.

    ``latest_day`` is the last present day of the list up to that day, NULL if
    there is none.
    """
    days = sorted(set(days))
    absent, rows, latest = set(missing_days(spark, root, days)), [], None
    for d in days:
        latest = latest if d in absent else d
        rows.append((d, d not in absent, latest))
    return spark.createDataFrame(rows, "day string, present boolean, latest_day string")


#: Each file is one split of its own, of which only the first line is asked for.
_FIRST_LINE_CONF = {
    "spark.sql.files.maxPartitionBytes": str(1 << 60),
    "spark.sql.files.openCostInBytes": str(1 << 60),
    "spark.sql.adaptive.enabled": "false",
}
#: Files that a task opens; a reader is closed when its task ends.
_FILES_A_TASK = 256


def _first_of_each_partition(df: DataFrame) -> DataFrame:
    """The first row of every partition: the limit that Spark puts below a global one.

    The DataFrame API has no name for it by itself. A task stops reading at its row.
    """
    spark = df.sparkSession
    local = df.limit(1)._jdf.logicalPlan().child()  # the global limit's child
    rows = spark.sparkContext._jvm.org.apache.spark.sql.classic.Dataset.ofRows(
        spark._jsparkSession, local)
    return DataFrame(rows, spark)


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(folder, name, line): the first line of every data file below ``paths``.

    Hidden and empty files are left out. A task takes many files, one after the other,
    and reads no further than a buffer into each.
    """
    apart = spark.newSession()  # its settings are for this scan alone
    for k, v in _FIRST_LINE_CONF.items():
        apart.conf.set(k, v)
    lines = apart.read.option("recursiveFileLookup", True).text(list(paths))
    first = _first_of_each_partition(lines.select(F.col("_metadata.file_path").alias("path"), "value"))
    files = first._jdf.queryExecution().toRdd().getNumPartitions()
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-files // _FILES_A_TASK))
    return first.coalesce(tasks).select(
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"),
        F.regexp_extract("path", "([^/]*)$", 1).alias("name"), F.col("value").alias("line"))


def _one_file_a_folder(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The first data file by name of every folder below ``paths`` (metadata only)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    found = files.where("length > 0").select("path").groupBy(
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).agg(F.min("path").alias("path"))
    return [r["path"] for r in found.collect()]


def _parsed(line: str) -> tuple[str, ...]:
    """Column names of a CSV header line."""
    return tuple(next(csv.reader([line.removeprefix("\ufeff")]), ()))


def _glob(name: str) -> str:
    return "".join("\\" + c if c in "\\*?[]{}," else c for c in name)


def layouts(spark: SparkSession, paths: Sequence[str],
            same_in_folder: bool = False) -> dict[tuple, list[str]]:
    """(column names, partition keys of the path) -> paths to read with that header.

    A path is a folder whose files share the header, or else a pattern of file names.
    ``same_in_folder`` is the caller's word that all files of a folder have the same
    header: one file a folder is opened. A column named twice in a header is an error.
    """
    if not paths:
        return {}
    opened = _one_file_a_folder(spark, paths) if same_in_folder else paths
    if not opened:
        return {}
    lines = _first_lines(spark, opened)
    headers = defaultdict(list)
    for r in lines.groupBy("folder", "line").agg(F.min("name").alias("name")).collect():
        headers[unquote(r["folder"])].append((r["line"], r["name"]))
    for folder, found in headers.items():
        for line, name in found:
            names = _parsed(line)
            if len(set(names)) < len(names):
                raise ValueError(f"{folder}/{unquote(name)}: a column is named twice")

    parents = {f.rsplit("/", k)[0] for f in headers for k in range(1, f.count("/"))}
    groups: dict[tuple, list[str]] = defaultdict(list)

    def add(folder: str, line: str, path: str) -> None:
        keys = tuple(x.split("=")[0] for x in folder.split("/") if "=" in x)
        groups[_parsed(line), keys].append(path)

    # a folder is read as one unless it has several headers or data folders below
    mixed = [f for f, found in headers.items() if len(found) > 1 or f in parents]
    for folder in headers.keys() - set(mixed):
        add(folder, headers[folder][0][0], folder)
    if mixed:
        by_name = defaultdict(list)
        inside = set(mixed)
        for r in _first_lines(spark, mixed).collect():
            if unquote(r["folder"]) in inside:
                by_name[unquote(r["folder"]), r["line"]].append(unquote(r["name"]))
        for (folder, line), names in by_name.items():
            add(folder, line, folder + "/{" + ",".join(map(_glob, sorted(names))) + "}")
    return {k: sorted(v) for k, v in groups.items()}


def scan_days(spark: SparkSession, root: str, days: Iterable[str],
              columns: Sequence[str] = CALL_COLUMNS, same_in_folder: bool = False) -> DataFrame:
    """Rows of the listed days, all text, plus ``UTC_date``.

    Columns are found by header name; a column that a file does not have is NULL
    there, and columns that were not asked for are ignored. ``UTC_hour=``
    folders are read and need not exist on every day. Days without a folder
    give no rows (see ``missing_days``). A column named twice in one header is
    an error. ``same_in_folder``: see ``layouts``.
    """
    root = root.rstrip("/")
    present = [day_path(root, d) for d in dict.fromkeys(days) if _exists(spark, day_path(root, d))]
    groups = layouts(spark, present, same_in_folder)
    out = spark.createDataFrame([], text_schema(columns).add(DAY_PARTITION, T.StringType()))
    for n, ((header, _), members) in enumerate(sorted(groups.items())):
        raw = (spark.read.schema(text_schema(header)).option("header", True)
               .option("enforceSchema", False).option("basePath", root).csv(members))
        one = raw.select(*[F.col(f"`{c}`") if c in header else
                           F.lit(None).cast("string").alias(c) for c in columns],
                         F.col(DAY_PARTITION).cast("string"))
        out = one if n == 0 else out.unionByName(one)
    return out


def hour_report(spark: SparkSession, root: str, days: Sequence[str],
                rows: bool = False) -> DataFrame:
    """``(day, hour, state, n)`` of an expected day-by-hour grid.

    A day with ``UTC_hour=`` folders gives 24 rows, ``present`` or ``missing``; a day
    whose files lie in the day folder gives one row ``no hour folders`` and a day without
    data files one row ``no data``, both with a NULL hour. A day that has both kinds of
    files gives both. ``n`` is the number of bytes, from one listing; with ``rows`` the
    files are Parquet, and it is the number of rows, from their footers. Hidden and
    empty files do not count.
    """
    days = sorted(set(days))
    present = [day_path(root, d) for d in days if _exists(spark, day_path(root, d))]
    schema = "day string, hour int, n long"
    if not present:
        found = spark.createDataFrame([], schema)
    else:
        kind = "parquet" if rows else "binaryFile"
        reader = spark.read.format(kind).option("recursiveFileLookup", True)
        if rows:
            # no column is asked for, so a file gives its footer's count
            files = reader.schema("_none string").load(present).groupBy(
                F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
        else:
            files = reader.load(present).where("length > 0").select("path", F.col("length").alias("n"))
        hour = F.regexp_extract("path", "/UTC_hour=([0-9]+)/", 1)
        found = files.select(
            F.regexp_extract("path", f"/{DAY_PARTITION}=([^/]+)/", 1).alias("day"),
            hour.try_cast("int").alias("hour"), "n").groupBy("day", "hour").agg(F.sum("n").alias("n"))
    asked = spark.createDataFrame([(d,) for d in days], "day string")
    kinds = asked.join(found.groupBy("day").agg(
        F.max(F.col("hour").isNotNull()).alias("hours"), F.max(F.col("hour").isNull()).alias("flat")),
        "day", "left")
    hours = kinds.where("hours").select("day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    hourly = hours.join(found, ["day", "hour"], "left").select(
        "day", "hour", F.when(F.col("n").isNull(), "missing").otherwise("present").alias("state"),
        F.coalesce("n", F.lit(0)).alias("n"))
    flat = found.where("hour is null").select(
        "day", "hour", F.lit("no hour folders").alias("state"), "n")
    none = kinds.where("hours is null").select(
        "day", F.lit(None).cast("int").alias("hour"), F.lit("no data").alias("state"),
        F.lit(0).cast("long").alias("n"))
    return hourly.unionByName(flat).unionByName(none)


def read_day(spark: SparkSession, root: str, day: str,
             columns: Sequence[str] = CALL_COLUMNS) -> DataFrame:
    """One day's rows, text columns taken by header name."""
    return scan_days(spark, root, [day], columns)


def scan_range(spark: SparkSession, root: str, start: str, end: str,
               columns: Sequence[str] = CALL_COLUMNS) -> DataFrame:
    """Rows with ``start <= UTC_date <= end``: the root's folder names are listed
    once, and only the days in range are opened."""
    p, fs = _filesystem(spark, root)
    prefix = f"{DAY_PARTITION}="
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    days = sorted(x.removeprefix(prefix) for x in names if x.startswith(prefix))
    return scan_days(spark, root, [d for d in days if start <= d <= end], columns)
