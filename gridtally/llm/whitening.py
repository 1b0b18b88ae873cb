"""PCA whitening of embeddings with Spark MLlib's BlockMatrix.

Rows become whole-number vectors. The distinct vectors are numbered within their
checkpointed partitions, centred and cut into blocks of a distributed BlockMatrix B;
the transpose times B, with the shared dimension split over tasks, is the scatter,
whose eigenvectors numpy finds on the driver (one number for each pair of entries).
A second BlockMatrix holds all rows. Times the whitening matrix it projects
them: its blocks are laid out as a square grid and the whitening matrix as the grid's
diagonal blocks, because MLlib deals the blocks of a product out by rows and columns
and a single block column would go to the square root of the tasks.

Blocks are made where the rows are, without a shuffle, so a partition's last block has
fewer rows than the others; the products used here do not mind.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm.common import cut
from gridtally.llm.vectors import Extent, extent, number_type, packed_rows, unpacked_numbers

#: Rows of a block: 4 MB with 64 entries. The driver sees two numbers a block.
BLOCK_ROWS = 8192


def _numbered(df: DataFrame) -> DataFrame:
    """Checkpointed, with ``at``: partition << 33, plus the row's place in it."""
    return cut(df.withColumn("at", F.monotonically_increasing_id()))


def _blocks_before(numbered: DataFrame) -> dict[int, int]:
    """Partition -> number of blocks in the partitions before it (one entry a partition)."""
    counts = numbered.groupBy(F.shiftright("at", 33).alias("p")).count().orderBy("p").collect()
    out, n = {}, 0
    for r in counts:
        out[r["p"]] = n
        n += -(-r["count"] // BLOCK_ROWS)
    out[-1] = n  # all blocks
    return out


def _block_matrix(numbered: DataFrame, before: dict[int, int], shape: Extent, n: int, total: list[int],
                  columns: int):
    """MLlib's BlockMatrix of the centred rows, its blocks in a grid ``columns`` wide."""
    from pyspark.mllib.common import callMLlibFunc
    from pyspark.mllib.linalg import MatrixUDT

    place = T.StructType([T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])
    schema = T.StructType([T.StructField("place", place), T.StructField("block", MatrixUDT())])
    width, dim = number_type(shape), shape.dim
    held = numbered.sparkSession.sparkContext.broadcast((before, total))

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        before, total = held.value
        # exact sums may be wider than a double: divide whole numbers
        mean = np.array([s / n for s in total])
        kind = pa.struct([("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()),
                          ("colPtrs", pa.list_(pa.int32())), ("rowIndices", pa.list_(pa.int32())),
                          ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())])

        def block(at, x):
            b = before[int(at) >> 33] + (int(at) & ((1 << 33) - 1)) // BLOCK_ROWS
            values = pa.ListArray.from_arrays(pa.array([0, x.size], pa.int32()),
                                              pa.array(x.T.ravel()))  # by column
            none = pa.nulls(1, pa.list_(pa.int32()))
            matrix = pa.StructArray.from_arrays(
                [pa.array([1], pa.int8()), pa.array([len(x)], pa.int32()),
                 pa.array([dim], pa.int32()), none, none, values, pa.array([False])],
                fields=list(kind))
            ij = pa.StructArray.from_arrays([pa.array([b // columns]), pa.array([b % columns])],
                                            ["i", "j"])
            return pa.RecordBatch.from_arrays([ij, matrix], ["place", "block"])

        at, rows, count = None, [], 0
        for batch in batches:
            x = unpacked_numbers(batch.column(0), width, dim) - mean
            first, done = batch.column(1)[0].as_py() if len(x) else 0, 0
            while done < len(x):
                if not count:
                    at = first + done
                part = x[done:done + BLOCK_ROWS - count]
                rows.append(part)
                count, done = count + len(part), done + len(part)
                if count == BLOCK_ROWS:
                    yield block(at, np.concatenate(rows))
                    rows, count = [], 0
        if count:
            yield block(at, np.concatenate(rows))

    blocks = numbered.select("x", "at").mapInArrow(run, schema)
    deep = -(-before[-1] // columns)
    return callMLlibFunc("createBlockMatrix", blocks, BLOCK_ROWS, dim, deep * BLOCK_ROWS,
                         columns * dim)


def _gram(matrix, tasks: int):
    """matrix^T matrix as a numpy array; the shared dimension is split over ``tasks``."""
    from pyspark import SparkContext
    from pyspark.mllib.common import callJavaFunc

    product = matrix.transpose().multiply(matrix, tasks)
    return callJavaFunc(SparkContext._active_spark_context, product.toLocalMatrix).toArray()


def _diagonal(spark, block, columns: int):
    """A BlockMatrix with ``block`` at each of ``columns`` places of the diagonal."""
    from pyspark.mllib.linalg import DenseMatrix
    from pyspark.mllib.linalg.distributed import BlockMatrix

    n, k = block.shape
    one = DenseMatrix(n, k, block.T.ravel().tolist())
    cells = spark.sparkContext.parallelize(range(columns), min(columns, 8)).map(
        lambda j: ((j, j), one))
    return BlockMatrix(cells, n, k, columns * n, columns * k)._java_matrix_wrapper._java_model


def _projected(matrix, weights) -> DataFrame:
    """(place, block) of matrix x weights."""
    from pyspark.mllib.common import callMLlibFunc

    return callMLlibFunc("getMatrixBlocks", matrix.multiply(weights)).toDF("place", "block")


def _values(cell):
    """An Arrow matrix cell as a numpy array."""
    import numpy as np

    m = cell.as_py()
    order = "C" if m["isTransposed"] else "F"
    return np.array(m["values"]).reshape((m["numRows"], m["numCols"]), order=order)


def _row_values(projected: DataFrame, before: dict[int, int], columns: int) -> DataFrame:
    """(at, z): the projected rows again, by the number of ``_numbered``."""
    starts = sorted((n, p) for p, n in before.items() if p >= 0)
    held = projected.sparkSession.sparkContext.broadcast(starts)

    def run(batches: Iterator):
        import bisect

        import numpy as np
        import pyarrow as pa

        firsts = [n for n, _ in held.value]
        for batch in batches:
            for row in range(batch.num_rows):
                place = batch.column(0)[row].as_py()
                b = place["_1"] * columns + place["_2"]
                n, p = held.value[bisect.bisect_right(firsts, b) - 1]
                z = _values(batch.column(1)[row])
                at = (p << 33) + (b - n) * BLOCK_ROWS + np.arange(len(z))
                cells = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(at), cells], ["at", "z"])

    return projected.mapInArrow(run, "at long, z array<double>")


def _covariance(projected: DataFrame, n: int, k: int):
    """Covariance (divisor n) of the projected rows, centred before multiplying.

    Blocks give their count, mean and centred products; they are merged pairwise in a
    tree of tasks.
    """
    import numpy as np

    def moments(batches: Iterator):
        import pyarrow as pa

        acc = None
        for batch in batches:
            for row in range(batch.num_rows):
                z = _values(batch.column(1)[row])
                mean = z.mean(0)
                acc = merge(acc, (len(z), mean, (z - mean).T @ (z - mean)))
        if acc:
            yield pa.RecordBatch.from_arrays(
                [pa.array([acc[0]]), pa.array([acc[1].tolist()]), pa.array([acc[2].ravel().tolist()])],
                ["n", "mean", "products"])

    def merge(a, b):
        if a is None or b is None:
            return a or b
        n, d = a[0] + b[0], b[1] - a[1]
        return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)

    parts = projected.mapInArrow(moments, "n long, mean array<double>, products array<double>")
    whole = parts.rdd.map(lambda r: (r.n, np.array(r.mean), np.array(r.products).reshape(k, k)))
    return whole.treeReduce(merge)[2] / n


def whiten(df: DataFrame, columns: list[Column], vector: str, scale: float = 256,
           components: int = 4) -> DataFrame:
    """Whitened coordinates of every usable row on the leading principal components.

    ``x = floor(scale * c)``; the covariance V is that of the distinct x, each counted
    once (n of them, sums S). Returns ``kept`` (a struct of ``columns``, so no name
    can clash), component (from 1, by falling eigenvalue e of V), n, deviation (the sum
    of ``(n x - S)^2``, exact, as decimal text of any length), whitened ((x - S/n) on
    the unit eigenvector, over sqrt(e)), explained (e over the trace of V) and
    identity_error (largest absolute entry of the covariance of the distinct vectors'
    whitened coordinates less the identity).

    Rows whose vector is null, holds a null or non-finite entry, or is not of the length
    that most have are left out; repeated rows stay, and count once in V. Components
    whose eigenvalue is zero to rounding have no coordinates and are left out, so a table
    that is empty or holds one distinct vector gives no row. An eigenvector's sign is
    numpy's; equal eigenvalues share a plane, any basis of which is right.
    """
    import numpy as np

    spark = df.sparkSession
    given = df.select(F.struct(*columns).alias("kept"), F.col(vector).alias("v"))
    out = T.StructType([given.schema["kept"], *T.StructType.fromDDL(
        "component int, n long, deviation string, whitened double, explained double, "
        "identity_error double").fields])
    shape = extent(given, "v", scale)
    if shape is None:
        return spark.createDataFrame([], out)
    rows = _numbered(packed_rows(given, [F.col("kept")], "v", scale, shape))
    fit = _numbered(rows.select("x").distinct())
    n, total = _sums(fit, shape)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    before = _blocks_before(fit)
    centred = _block_matrix(fit, before, shape, n, total, 1)
    scatter = _gram(centred, max(1, min(tasks, before[-1])))
    values, vectors = np.linalg.eigh(scatter / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values[:components] > values[0] * shape.dim * np.finfo(float).eps).sum())
    if not k or values[0] <= 0:
        return spark.createDataFrame([], out)
    weights = vectors[:, :k] / np.sqrt(values[:k])

    side = max(1, int(np.ceil(np.sqrt(before[-1]))))
    centred = _block_matrix(fit, before, shape, n, total, side)
    spread = _covariance(_projected(centred, _diagonal(spark, weights, side)), n, k)
    error = float(np.abs(spread - np.eye(k)).max())

    before = _blocks_before(rows)
    side = max(1, int(np.ceil(np.sqrt(before[-1]))))
    everything = _block_matrix(rows, before, shape, n, total, side)
    coordinates = _row_values(_projected(everything, _diagonal(spark, weights, side)), before, side)
    share = F.array(*[F.lit(float(v)) for v in values[:k] / values.sum()])
    return _deviations(rows, shape, n, total).join(coordinates, "at").select(
        "kept", "deviation", F.posexplode("z").alias("j", "whitened")).select(
        "kept", (F.col("j") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", share[F.col("j")].alias("explained"), F.lit(error).alias("identity_error"))


def _sums(fit: DataFrame, shape: Extent) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each entry; one row an entry and task."""
    width, dim = number_type(shape), shape.dim

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        n, total = 0, [0] * dim
        for batch in batches:
            x = unpacked_numbers(batch.column(0), width, dim)
            n += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, dim)), pa.array([str(v) for v in (n, *total)])], ["j", "s"])

    parts = fit.select("x").mapInArrow(run, "j long, s string")
    sums = parts.groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {r["j"]: int(r["s"]) for r in sums.collect()}
    return found[-1], [found[j] for j in range(dim)]


def _deviations(rows: DataFrame, shape: Extent, n: int, total: list[int]) -> DataFrame:
    """(kept, at, deviation): the exact sum of (n x - S)^2 as text."""
    width, dim = number_type(shape), shape.dim
    schema = T.StructType([rows.schema["kept"], rows.schema["at"],
                           T.StructField("deviation", T.StringType())])
    # the largest |n x - S| decides whether 64 bits hold the sum
    far = max([abs(n * x - s) for x in (shape.low, shape.high) for s in total])
    exact = dim * far * far < 1 << 63

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        s = np.array(total, np.int64 if exact else object)
        for batch in batches:
            x = unpacked_numbers(batch.column(1), width, dim)
            gap = (x if exact else x.astype(object)) * n - s
            sums = (gap * gap).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([str(v) for v in sums.tolist()], pa.string())],
                ["kept", "at", "deviation"])

    return rows.select("kept", "x", "at").mapInArrow(run, schema)
