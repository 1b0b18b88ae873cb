"""Parquet, CSV and gzip CSV sinks, and a bounded preview.

``files`` sets the number of output files with a round-robin repartition
(one extra shuffle, evenly sized files whatever the key skew). Leave it
unset to write the partitions AQE has already sized. Writes go through
Spark's commit protocol, so a lost executor's task is simply retried.

``mode="overwrite"`` replaces the output only when the new one is complete: it is
written to a hidden folder beside it and takes its place by two renames, so a job that
dies while it writes leaves the old rows as they were. A driver that dies between the
renames leaves the old output under its hidden name; the next write, or
``restore``, puts it back. (On stores without a folder rename these are copies.)

``write_ranged`` keeps an order across files: each holds one range of the sort
columns, and a table of bounds lets ``read_prefix`` open only the files that a prefix of
the first one touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _shaped(df: DataFrame, files: int | None, sort_within: Sequence[str] = (),
            ranges: bool = False) -> DataFrame:
    if files and ranges and sort_within:
        out = df.repartitionByRange(files, *sort_within)
    else:
        out = df.repartition(files) if files else df
    # Order inside each file; across files only where ranges were asked for.
    return out.sortWithinPartitions(*sort_within) if sort_within else out


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _beside(path: str, kind: str, tag: str = "") -> str:
    """A hidden name beside ``path``, which readers of the parent folder skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{kind}-{tag}" if parent else f".{name}.{kind}-{tag}"


def _rename(spark: SparkSession, old: str, new: str) -> None:
    p, fs = _fs(spark, old)
    if not fs.rename(p, _fs(spark, new)[0]):
        raise OSError(f"cannot rename {old} to {new}")


def restore(spark: SparkSession, path: str) -> bool:
    """Put the old output back if a driver died between the two renames; was it so?"""
    p, fs = _fs(spark, path)
    if fs.exists(p):
        return False
    pattern, _ = _fs(spark, _beside(path, "old", "*"))
    kept = fs.globStatus(pattern) or []
    if len(kept) != 1:
        return False
    _rename(spark, kept[0].getPath().toString(), path)
    return True


def replace_output(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write(folder)`` fills a fresh folder, which then takes the place of ``path``.

    If ``write`` fails, ``path`` stays as it is. An output that is being replaced may
    itself be read by ``write``.
    """
    path = path.rstrip("/")
    restore(spark, path)
    tag = uuid.uuid4().hex[:12]
    fresh, old = _beside(path, "new", tag), _beside(path, "old", tag)
    p, fs = _fs(spark, path)
    try:
        write(fresh)
        if not fs.exists(_fs(spark, fresh)[0]):
            raise OSError(f"nothing was written to {fresh}")
        if fs.exists(p):
            _rename(spark, path, old)
            try:
                _rename(spark, fresh, path)
            except Exception:
                _rename(spark, old, path)
                raise
            fs.delete(_fs(spark, old)[0], True)
        else:
            _rename(spark, fresh, path)
    finally:
        fs.delete(_fs(spark, fresh)[0], True)  # there only if something failed


def _save(df: DataFrame, path: str, mode: str, partition_by: Sequence[str], kind: str,
          options: dict) -> None:
    def write(folder: str, how: str = "errorifexists") -> None:
        w = df.write.mode(how).options(**options)
        (w.partitionBy(*partition_by) if partition_by else w).format(kind).save(folder)

    if mode == "overwrite":
        replace_output(df.sparkSession, path, write)
    else:
        write(path, mode)


def write_parquet(df: DataFrame, path: str, files: int | None = None,
                  partition_by: Sequence[str] = (), mode: str = "overwrite",
                  sort_within: Sequence[str] = (), ranges: bool = False) -> None:
    """``ranges`` deals ``files`` by ranges of ``sort_within`` instead of round-robin."""
    _save(_shaped(df, files, sort_within, ranges), path, mode, partition_by, "parquet", {})


# Microsecond timestamps in text sinks (Spark's CSV default keeps milliseconds).
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _csv_options(gzip: bool) -> dict:
    return {"header": True, "timestampFormat": TIMESTAMP_TEXT,
            "timestampNTZFormat": TIMESTAMP_TEXT, **({"compression": "gzip"} if gzip else {})}


def write_csv(df: DataFrame, path: str, files: int | None = None, gzip: bool = False,
              partition_by: Sequence[str] = (), mode: str = "overwrite",
              sort_within: Sequence[str] = (), ranges: bool = False) -> None:
    """As ``write_parquet``, with a header; ``gzip`` compresses the files."""
    _save(_shaped(df, files, sort_within, ranges), path, mode, partition_by, "csv",
          _csv_options(gzip))


#: Sub-folder of a ranged output with a row for each file; hidden from readers.
BOUNDS = "_bounds"


def write_ranged(df: DataFrame, path: str, by: Sequence[str], files: int) -> None:
    """Parquet in ``files`` files whose ranges of ``by`` follow each other.

    Spark samples the borders; files are of even size however the first column is
    spread, so a value that holds a third of all rows spans several files. Rows are sorted
    within a file. ``<path>/_bounds`` lists every file with its number of rows and the
    first and last value of ``by[0]`` (which is text). Replaces an earlier output whole.
    """
    if dict(df.dtypes)[by[0]] != "string":
        raise ValueError(f"{by[0]} must be text")
    spark = df.sparkSession

    def write(folder: str) -> None:
        order = [F.col(c).asc_nulls_first() for c in by]
        df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(folder)
        name = F.regexp_extract(F.col("_metadata.file_path"), "([^/]*)$", 1)
        bounds = spark.read.parquet(folder).groupBy(name.alias("file")).agg(
            F.min(by[0]).alias("first"), F.max(by[0]).alias("last"),
            F.count_if(F.col(by[0]).isNull()).alias("nulls"), F.count(F.lit(1)).alias("rows"))
        bounds.coalesce(1).write.parquet(f"{folder}/{BOUNDS}")

    replace_output(spark, path, write)


def _reached(prefix: str | None) -> Column:
    """Bounds of files that may hold a value starting with ``prefix`` (None: NULLs)."""
    if prefix is None:
        return F.col("nulls") > 0
    return (F.substring("first", 1, len(prefix)) <= prefix) & (F.col("last") >= prefix)


def files_of_prefix(spark: SparkSession, path: str, prefix: str | None) -> list[str]:
    """Files of a ranged output that may hold values starting with ``prefix``."""
    bounds = spark.read.parquet(f"{path.rstrip('/')}/{BOUNDS}")
    return sorted(r.file for r in bounds.where(_reached(prefix)).select("file").collect())


def read_prefix(spark: SparkSession, path: str, column: str, prefix: str | None) -> DataFrame:
    """Rows of a ranged output whose ``column`` (its first sort column) starts with
    ``prefix``, or is NULL for None. Only the files that the bounds name are opened."""
    names = files_of_prefix(spark, path, prefix)
    if not names:
        return spark.read.parquet(path).limit(0)
    rows = spark.read.parquet(*[f"{path.rstrip('/')}/{n}" for n in names])
    c = F.col(column)
    return rows.where(c.isNull() if prefix is None else c.startswith(prefix))


def read_csv(spark, path: str, schema) -> DataFrame:
    """Read back a CSV sink with its declared schema (gzip is detected)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows; with ``order_by`` a deterministic top-n (Spark plans
    it as a per-task top-n followed by one small merge)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
