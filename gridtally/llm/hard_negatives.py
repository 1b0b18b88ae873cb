"""Hard-negative mining with Kronecker-packed products.

Vectors are whole numbers. Entries are biased to be non-negative, and the entries of
several candidates at one place are put into separate bit fields of one wide number;
one product of it with the anchor's entry at that place multiplies them all, and the
sum over the places holds every candidate's product with the anchor in a field of its
own, wide enough that nothing carries into the next. Fields are unpacked and the bias
is taken off: scores are exact. Where two or more fields fit into the 53 exact bits of
a double, the wide number is one, so that a matrix product does the multiplying; else
it is a Python integer of any width with as many fields.

Anchors are a query set that grows with the table, so they are not broadcast: anchors
go in groups of ``ANCHORS``, candidates in shards, and every (group, shard) cell of
the grid is one key that two streams of thin rows are dealt and sorted by. A task
holds one group of anchors and a batch of candidates, whatever the size of the table
or of a class, and sends on at most ``k`` rows an anchor and cell.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm.common import cut
from gridtally.llm.vectors import Extent, extent, number_type, packed_rows, unpacked_numbers

#: Anchors of a group: with 64 entries of 8 bytes, 8 MB in a task.
ANCHORS = 1 << 14
#: Candidates of a shard, at most on average.
CANDIDATES = 1 << 18
#: Anchors scored against a batch of candidates at once.
TILE = 256
#: Fields of a Python integer.
WIDE_FIELDS = 64


def field_bits(shape: Extent) -> int:
    """Bits of a field: the largest sum of products of biased entries fits in."""
    return max(1, (shape.dim * (shape.high - shape.low) ** 2).bit_length())


class Packed:
    """Candidates packed into wide numbers, for exact products with anchors."""

    def __init__(self, x, shape: Extent):
        import numpy as np

        self.n, self.shape, self.bits = len(x), shape, field_bits(shape)
        y = x - shape.low
        self.sums = y.sum(1)
        self.in_double = 2 * self.bits <= 53
        self.fields = 53 // self.bits if self.in_double else WIDE_FIELDS
        width = -(-self.n // self.fields) or 1
        y = np.concatenate([y, np.zeros((width * self.fields - self.n, shape.dim), np.int64)])
        # field f holds the f-th run of ``width`` candidates
        y = y.reshape(self.fields, width, shape.dim)
        if self.in_double:
            self.wide = sum(y[f] << (f * self.bits) for f in range(self.fields)).T.astype(float)
        else:
            self.wide = sum(y[f].astype(object) << (f * self.bits) for f in range(self.fields)).T

    def scores(self, anchors):
        """Inner products, one row an anchor and one column a candidate (int64, exact)."""
        import numpy as np

        low, y = self.shape.low, anchors - self.shape.low
        mask = (1 << self.bits) - 1
        if self.in_double:
            z = (y.astype(float) @ self.wide).astype(np.int64)
            parts = [z >> (f * self.bits) & mask for f in range(self.fields)]
        else:
            z = y.astype(object) @ self.wide
            parts = [z >> (f * self.bits) & mask for f in range(self.fields)]
        raw = np.concatenate(parts, axis=1)[:, :self.n]
        # x.a = sum (y + low)(b + low)
        base = low * y.sum(1)[:, None] + self.shape.dim * low * low
        return (raw + (low * self.sums)[None, :] + base).astype(np.int64)


class Tops:
    """The best ``k`` candidates of each of ``n`` slots: higher score, then smaller id."""

    def __init__(self, n: int, k: int):
        import numpy as np

        self.k = k
        self.score = np.zeros((n, k), np.int64)
        self.ident = np.zeros((n, k), np.int64)
        self.held = np.zeros((n, k), bool)

    def floor(self, slots):
        """A score below this cannot enter a slot any more."""
        import numpy as np

        return np.where(self.held[slots, -1], self.score[slots, -1], np.iinfo(np.int64).min)

    def offer(self, slots, scores, ids) -> None:
        """Candidates (flat arrays) that may enter their slots."""
        import numpy as np

        if not len(slots):
            return
        touched, where = np.unique(slots, return_inverse=True)
        old = self.held[touched]
        rows = np.concatenate([where, np.nonzero(old)[0]])
        s = np.concatenate([scores, self.score[touched][old]])
        i = np.concatenate([ids, self.ident[touched][old]])
        order = np.lexsort((i, -s, rows))
        rows, s, i = rows[order], s[order], i[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < self.k
        rows, place, s, i = touched[rows[keep]], place[keep], s[keep], i[keep]
        self.held[touched] = False
        self.score[rows, place], self.ident[rows, place], self.held[rows, place] = s, i, True


def _grid(rows: DataFrame, anchors: DataFrame, n_rows: int, extra: list[str]) -> DataFrame:
    """Anchors and candidates of every (group, shard) cell, dealt and sorted by cell.

    Both are thin rows; ``kind`` 0 are a cell's anchors, which come first.
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_anchors = anchors.count()
    groups = max(1, -(-n_anchors // ANCHORS))
    shards = max(1, -(-n_rows // CANDIDATES), -(-width // groups))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    none = [F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in extra]
    mine = anchors.select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("g"),
                          F.lit(0).alias("kind"), "id", "label", "x", *extra)
    mine = mine.select("g", every(shards).alias("s"), "kind", "id", "label", "x", *extra)
    theirs = rows.select(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int").alias("s"),
                         F.lit(1).alias("kind"), "id", "label", "x", *none)
    theirs = theirs.select(every(groups).alias("g"), "s", "kind", "id", "label", "x", *extra)
    both = mine.unionByName(theirs)
    return both.repartition(max(width, min(groups * shards, 1 << 16)), "g", "s") \
        .sortWithinPartitions("g", "s", "kind")


def _scan(batches: Iterator, shape: Extent, start, meet, end) -> Iterator:
    """Walk a sorted partition of ``_grid``.

    ``start(anchor table)`` opens a cell's state, ``meet(state, candidate batch, packed,
    scores of tile)`` adds candidates, ``end(state)`` gives the cell's Arrow arrays.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    width = number_type(shape)
    cell, waiting, state = None, [], None

    def opened():
        table = pa.Table.from_batches(waiting).combine_chunks()
        return start(table, unpacked_numbers(table.column("x").chunk(0), width, shape.dim))

    for batch in batches:
        done = 0
        while done < batch.num_rows:
            rest = batch.slice(done)
            here = (rest.column(0)[0].as_py(), rest.column(1)[0].as_py())
            if here != cell:
                if state is not None:
                    yield from end(state)
                cell, waiting, state = here, [], None
            same = pc.and_(pc.equal(rest.column(0), here[0]), pc.equal(rest.column(1), here[1]))
            n = pc.sum(same).as_py()  # sorted, so the cell's rows come first
            kinds = rest.column(2).slice(0, n)
            first = n - pc.sum(kinds).as_py()
            if first:
                waiting.append(rest.slice(0, first))
            if n > first and waiting:
                state = state or opened()
                meet(state, rest.slice(first, n - first),
                     Packed(unpacked_numbers(rest.column(5).slice(first, n - first), width,
                                             shape.dim), shape))
            done += n
    if state is not None:
        yield from end(state)


def _best_positives(grid: DataFrame, shape: Extent, k: int) -> DataFrame:
    """(id, score, other): a cell's best ``k`` rows of the anchor's label."""
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        def start(table, x):
            return {"id": table.column("id").to_numpy(), "label": table.column("label").to_numpy(),
                    "x": x, "tops": Tops(len(x), k)}

        def meet(state, batch, packed):
            ids, labels = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            for a in range(0, len(state["x"]), TILE):
                slots = np.arange(a, min(a + TILE, len(state["x"])))
                scores = packed.scores(state["x"][slots])
                fit = state["label"][slots][:, None] == labels[None, :]
                fit &= state["id"][slots][:, None] != ids[None, :]
                fit &= scores >= state["tops"].floor(slots)[:, None]
                r, c = np.nonzero(fit)
                state["tops"].offer(slots[r], scores[r, c], ids[c])

        def end(state):
            t = state["tops"]
            r, _ = np.nonzero(t.held)
            yield pa.RecordBatch.from_arrays([pa.array(state["id"][r]), pa.array(t.score[t.held]),
                                              pa.array(t.ident[t.held])], ["id", "score", "other"])

        yield from _scan(batches, shape, start, meet, end)

    return grid.mapInArrow(run, "id long, score long, other long")


def _best_negatives(grid: DataFrame, shape: Extent, k: int, band: tuple[int, int]) -> DataFrame:
    """(id, nth, score, other): a cell's best ``k`` rows of other labels in the band of the
    anchor's ``nth`` positive."""
    low, high = band

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        def start(table, x):
            scores = table.column("positives").to_pylist()
            most = max(map(len, scores))
            floor, roof = (np.full((len(x), most), v, np.int64) for v in (0, -1))
            for r, row in enumerate(scores):
                for p, s in enumerate(row):  # exact bounds of a whole-number score
                    floor[r, p], roof[r, p] = -(-low * s // 100), high * s // 100
            return {"id": table.column("id").to_numpy(), "label": table.column("label").to_numpy(),
                    "x": x, "floor": floor, "roof": roof,
                    "tops": [Tops(len(x), k) for _ in range(most)]}

        def meet(state, batch, packed):
            ids, labels = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            for a in range(0, len(state["x"]), TILE):
                slots = np.arange(a, min(a + TILE, len(state["x"])))
                scores = packed.scores(state["x"][slots])
                other = state["label"][slots][:, None] != labels[None, :]
                for p, tops in enumerate(state["tops"]):
                    floor = np.maximum(state["floor"][slots, p], tops.floor(slots))
                    fit = (scores >= floor[:, None]) & (scores <= state["roof"][slots, p][:, None])
                    r, c = np.nonzero(fit & other)
                    tops.offer(slots[r], scores[r, c], ids[c])

        def end(state):
            for p, t in enumerate(state["tops"]):
                r, _ = np.nonzero(t.held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(state["id"][r]), pa.array(np.full(len(r), p + 1, np.int32)),
                     pa.array(t.score[t.held]), pa.array(t.ident[t.held])],
                    ["id", "nth", "score", "other"])

        yield from _scan(batches, shape, start, meet, end)

    return grid.mapInArrow(run, "id long, nth int, score long, other long")


def mine_hard_negatives(df: DataFrame, id_col: str, vector: str, label: Column, anchor: Column,
                        positives: int = 5, negatives: int = 3, band: tuple[int, int] = (50, 95),
                        scale: float = 256) -> DataFrame:
    """Hard negatives of every anchor row and each of its best positives.

    A score is the inner product of two rows' whole-number vectors ``floor(scale * c)``;
    higher scores come first, then smaller ids. An anchor's positives are its first
    ``positives`` other rows of the same label; a positive's negatives are the first
    ``negatives`` rows of another label whose score is between ``band[0]`` and ``band[1]``
    hundredths of the positive's. Returns (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score); pairs without a negative have no row.

    ``label`` (whole number) and ``anchor`` (boolean) are expressions over ``df``; extra
    columns are ignored. Rows without id, label or vector take no part, nor those with a
    null or non-finite entry or of another length than most rows; nor anything in an
    empty table. Of the rows of one id, the one with the smallest label, then the
    smallest bytes, counts; it is an anchor if any of them is. An entry times ``scale``
    must fit in 31 bits.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                     F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull())
    out = T.StructType.fromDDL("anchor_id long, positive_id long, rank int, negative_id long, "
                               "positive_score long, negative_score long")
    shape = extent(rows, "v", scale)
    if shape is None:
        return df.sparkSession.createDataFrame([], out)
    if field_bits(shape) > 62:
        raise ValueError("scores may not fit in 63 bits")
    packed = packed_rows(rows, [F.col("id"), F.col("label"), F.col("anchor")], "v", scale, shape)
    packed = cut(packed.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r"),
                                          F.max("anchor").alias("anchor"))
                 .select("id", "r.label", "r.x", "anchor"))
    anchors = packed.where("anchor").select("id", "label", "x")

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other")
        return found.withColumn("nth_best", F.row_number().over(order)).where(
            F.col("nth_best") <= k)

    best = cut(first(_best_positives(_grid(packed, anchors, shape.rows, []), shape, positives),
                     ["id"], positives).select("id", F.col("nth_best").alias("nth"), "score",
                                               "other"))
    scores = best.groupBy("id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("nth", "score"))), lambda p: p["score"]).alias("positives"))
    asked = anchors.join(scores, "id")
    found = first(_best_negatives(_grid(packed, asked, shape.rows, ["positives"]), shape, negatives,
                                  band), ["id", "nth"], negatives)
    b, f = best.alias("b"), found.alias("f")
    return b.join(f, (F.col("b.id") == F.col("f.id")) & (F.col("b.nth") == F.col("f.nth"))).select(
        F.col("b.id").alias("anchor_id"), F.col("b.other").alias("positive_id"),
        F.col("f.nth_best").alias("rank"), F.col("f.other").alias("negative_id"),
        F.col("b.score").alias("positive_score"), F.col("f.score").alias("negative_score"))
