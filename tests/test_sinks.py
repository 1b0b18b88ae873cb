"""Outputs that are replaced only when complete, and outputs that keep an order."""

import os

import pytest
from pyspark.sql import functions as F

from gridtally.plans.session import staging_path
from gridtally.sources.sinks import (
    files_of_prefix, read_csv, read_prefix, replace_output, restore, write_csv, write_parquet,
    write_ranged,
)

SINKS = {"parquet": write_parquet, "csv": write_csv,
         "gzip": lambda df, path, **k: write_csv(df, path, gzip=True, **k)}


def _read(spark, kind, path):
    df = spark.read.parquet(path) if kind == "parquet" else read_csv(spark, path, "id bigint")
    return sorted(r.id for r in df.collect())


def _local(path):
    return path.removeprefix("file:")


@pytest.mark.parametrize("kind", SINKS)
def test_a_job_that_dies_in_its_write_leaves_the_old_rows(spark, kind):
    path = staging_path(spark, "t-replace")
    SINKS[kind](spark.range(10), path, files=2)
    dies = spark.range(0, 100, 1, 4).withColumn(
        "id", F.when(F.col("id") == 99, F.raise_error(F.lit("dies here")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="dies here"):
        SINKS[kind](dies, path)
    assert _read(spark, kind, path) == list(range(10))
    name = os.path.basename(path)
    assert [x for x in os.listdir(os.path.dirname(_local(path))) if name in x and x != name] == []
    SINKS[kind](spark.range(5, 8), path)
    assert _read(spark, kind, path) == [5, 6, 7]
    SINKS[kind](spark.range(1), path, mode="append")
    assert _read(spark, kind, path) == [0, 5, 6, 7]


def test_an_output_may_be_rewritten_from_itself(spark):
    path = staging_path(spark, "t-replace")
    write_parquet(spark.range(6), path)
    write_parquet(spark.read.parquet(path).where("id % 2 = 0"), path)
    assert _read(spark, "parquet", path) == [0, 2, 4]


def test_a_driver_that_dies_between_the_renames(spark):
    path = staging_path(spark, "t-replace")
    write_parquet(spark.range(3), path)
    parent, name = os.path.split(_local(path))
    os.rename(_local(path), f"{parent}/.{name}.old-abc")
    assert restore(spark, path) and _read(spark, "parquet", path) == [0, 1, 2]
    assert not restore(spark, path)
    os.rename(_local(path), f"{parent}/.{name}.old-abc")
    with pytest.raises(RuntimeError):
        replace_output(spark, path, lambda folder: (_ for _ in ()).throw(RuntimeError("no")))
    assert _read(spark, "parquet", path) == [0, 1, 2]  # restored before the write


def test_partitioned_output_is_replaced_whole(spark):
    path = staging_path(spark, "t-replace")
    rows = spark.range(10).withColumn("k", F.col("id") % 2)
    write_parquet(rows, path, partition_by=["k"])
    write_parquet(rows.where("k = 1"), path, partition_by=["k"])
    assert {r.k for r in spark.read.parquet(path).collect()} == {1}


@pytest.fixture(scope="module")
def ranged(spark):
    """Ids of 40 cells, one of which holds a third of the rows; some have none."""
    cell = (F.when(F.col("id") % 3 == 0, "04QFJ50").when(F.col("id") % 97 == 1, None)
            .otherwise(F.concat(F.lit("04Q"), F.chr(65 + F.col("id") % 4), F.lit("J"),
                                F.lpad((F.col("id") % 40).cast("string"), 2, "0"))))
    df = spark.range(0, 6000, 1, 5).select(cell.alias("gridid"), (F.col("id") * 7919 % 6000).alias("rank"))
    path = staging_path(spark, "t-ranged")
    write_ranged(df, path, ["gridid", "rank"], files=12)
    return df.collect(), path


def test_ranges_of_files_are_disjoint_and_even(spark, ranged):
    rows, path = ranged
    bounds = spark.read.parquet(f"{path}/_bounds").orderBy(F.col("first").asc_nulls_first(), "file").collect()
    assert len(bounds) == 12 and sum(b.rows for b in bounds) == len(rows)
    assert max(b.rows for b in bounds) < 3 * len(rows) / 12
    spans = sorted((b["first"] or "", b["last"] or "") for b in bounds)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert len(files_of_prefix(spark, path, "04QFJ50")) >= 3  # the hot cell
    back = spark.read.parquet(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows))
    for f in back.select(F.col("_metadata.file_path").alias("f")).distinct().collect():
        inside = [(r.gridid or "", r["rank"]) for r in spark.read.parquet(f.f).collect()]
        assert inside == sorted(inside)


@pytest.mark.parametrize("prefix", ["04QA", "04QFJ50", "04QDJ39", "04Q", "", "3", None])
def test_a_prefix_opens_few_files(spark, ranged, prefix):
    rows, path = ranged
    got = read_prefix(spark, path, "gridid", prefix)
    want = [r for r in rows if (r.gridid is None if prefix is None
                                else r.gridid is not None and r.gridid.startswith(prefix))]
    assert sorted(map(str, got.collect())) == sorted(map(str, want))
    opened = len(files_of_prefix(spark, path, prefix))
    assert opened <= {"04QA": 4, "04QFJ50": 6, "04QDJ39": 2, "3": 0, None: 1}.get(prefix, 12)


def test_a_ranged_output_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "out")
    one = spark.createDataFrame([("a", 1)], "g string, n int")
    write_ranged(one, path, ["g"], files=3)
    write_ranged(one.limit(0), path, ["g"], files=3)
    assert read_prefix(spark, path, "g", "a").count() == 0
    with pytest.raises(ValueError):
        write_ranged(one, path, ["n"], files=3)
