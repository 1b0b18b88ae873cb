"""Embedding rows as exact whole numbers, shared by the operators on vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(vector: str) -> Column:
    """True where the vector is not null and all its entries are finite numbers."""
    x = F.col(vector).cast("array<double>")
    # NaN is larger than any number in Spark's ordering, so this catches it too
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def scaled(vector: str, scale: float) -> Column:
    """``floor(scale * c)`` of every entry, as long."""
    return F.transform(F.col(vector).cast("array<double>"),
                       lambda c: F.floor(c * F.lit(float(scale))).cast("long"))


@dataclass
class Extent:
    """Shape of a table of whole-number vectors: entries a vector, smallest and largest entry."""

    dim: int
    low: int
    high: int
    rows: int


def extent(df: DataFrame, vector: str, scale: float) -> Extent | None:
    """The extent of the usable rows of the most frequent length (ties: the longer one).

    None without such a row. One aggregation, one row a length.
    """
    x = F.col(vector).cast("array<double>")
    sizes = df.where(usable(vector)).groupBy(F.size(x).alias("dim")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(F.floor(F.array_min(x) * F.lit(float(scale)))).alias("low"),
        F.max(F.floor(F.array_max(x) * F.lit(float(scale)))).alias("high"))
    best = sizes.orderBy(F.desc("rows"), F.desc("dim")).first()
    if best is None or not best["dim"]:
        return None
    return Extent(best["dim"], best["low"], best["high"], best["rows"])


def packed_rows(df: DataFrame, columns: list[Column], vector: str, scale: float,
                shape: Extent) -> DataFrame:
    """``columns`` and ``x``: the row's whole numbers as little-endian bytes.

    The width of a number follows the table's extent, so equal vectors have equal bytes.
    Rows that are not usable or of another length are left out.
    """
    kept = df.where(usable(vector) & (F.size(vector) == shape.dim)).select(
        *columns, scaled(vector, scale).alias("x"))
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("x", T.BinaryType())])
    width, dim = number_type(shape), shape.dim

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            col = batch.column(batch.num_columns - 1)
            raw = np.ascontiguousarray(col.flatten().to_numpy().astype(width))
            step = raw.dtype.itemsize * dim
            offsets = np.arange(len(col) + 1, dtype=np.int32) * step
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(col), [
                None, pa.py_buffer(offsets), pa.py_buffer(raw)])
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)] + [packed]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "x"])

    return kept.mapInArrow(run, schema)


def number_type(shape: Extent) -> str:
    """The narrowest little-endian integer that holds every entry."""
    for width, bits in (("<i1", 7), ("<i2", 15), ("<i4", 31)):
        if -(1 << bits) <= shape.low and shape.high < 1 << bits:
            return width
    return "<i8"


def unpacked_numbers(column, width: str, dim: int):
    """An Arrow binary column of ``packed_rows`` as a matrix of int64, one row a vector."""
    import numpy as np

    step = np.dtype(width).itemsize * dim
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:]
    start = int(offsets[0]) if len(column) else 0
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8, len(column) * step, start) if len(column) else b""
    return np.frombuffer(raw, width).reshape(-1, dim).astype(np.int64)
