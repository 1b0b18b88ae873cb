"""SimHash near-duplicate detection with BK-trees.

Every text gets a 64-bit SimHash over word shingles. Texts are near copies when
their fingerprints differ in at most ``max_distance`` bits; classes are the
connected components of that relation.

1. Fingerprints are reduced to the distinct ones before anything is paired, so
   a million equal copies are one point.
2. Points are dealt to shards. A shard fixes a set of bit positions (its mask)
   and their values. The 64 positions are cut into ``max_distance + 2`` blocks;
   two points at distance <= ``max_distance`` agree on at least two blocks, so
   they meet in the shard of those two.
3. A shard with more than ``shard_bound`` points is dealt anew by the same rule
   over its free positions, level by level, until every shard is small. At two
   free bits a shard has at most four points, so this ends, and no pair is lost
   at any level.
4. Each shard becomes a BK-tree: children are keyed by the integer Hamming
   distance to their parent, and a search follows only the edges within the
   radius. A shard links a point only when that joins two so far separate
   parts, so it emits fewer links than it has points.

The trees are not broadcast to all tasks: together they hold every fingerprint,
which has no size bound. Each tree is built in the task that holds its shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm.common import cut, free_names, id_or_lowest, map_text, row_hash
from gridtally.llm.components import connected_components, join_own

BITS = 64


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a UTF-8 text (see ``with_fingerprint``)."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    while chunk := [digest(g, seed) for g in islice(grams, 1 << 15)]:
        bits = np.unpackbits(np.array(chunk, dtype="<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
        total += len(chunk)
    packed = np.packbits(2 * ones > total, bitorder="little")
    return int.from_bytes(packed.tobytes(), "little")


def with_fingerprint(df: DataFrame, text_col: str, keep: list, shingle: int = 3,
                     seed: int = 42, out: str = "fp") -> DataFrame:
    """``keep`` columns plus the SimHash of ``text_col`` as a signed long.

    A-Z are lower-cased; words are runs of anything but ASCII white space;
    shingles are ``shingle`` words joined by a space, repeats counted. A text
    of fewer words is one shingle; a text without words (null, empty, blank)
    has fingerprint 0. Whole texts, any length: hashes are counted in chunks.
    """
    def start():
        return lambda text: (_signed(simhash(text, shingle, seed)),)

    return map_text(df, keep, text_col, start, [T.StructField(out, T.LongType())])


class BKTree:
    """Codes under the Hamming metric; children keyed by distance to the parent."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, code: int) -> None:
        new = len(self.codes)
        self.codes.append(code)
        self.children.append({})
        at = 0
        while at != new:
            at = self.children[at].setdefault((self.codes[at] ^ code).bit_count(), new)

    def within(self, code: int, radius: int) -> list[int]:
        """Positions of all codes at distance <= radius."""
        found, todo = [], [0] if self.codes else []
        while todo:
            at = todo.pop()
            d = (self.codes[at] ^ code).bit_count()
            if d <= radius:
                found.append(at)
            edges = self.children[at]
            if len(edges) <= 2 * radius + 1:
                todo += [child for k, child in edges.items() if d - radius <= k <= d + radius]
            else:
                todo += [edges[k] for k in range(d - radius, d + radius + 1) if k in edges]
        return found


def shard_links(codes: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join all codes of a shard which are reachable within it."""
    tree, parent, links = BKTree(), [], []

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for n, code in enumerate(codes):
        parent.append(n)
        for at in tree.within(code, radius):
            a, b = top(at), top(n)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((codes[at], code))
        tree.add(code)
    return links


def _refined(mask: int, radius: int) -> list[int]:
    """Masks that also fix two of ``radius + 2`` blocks of the free bits."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    parts = radius + 2
    blocks = [sum(1 << b for b in free[len(free) * i // parts:len(free) * (i + 1) // parts])
              for i in range(parts)]
    return sorted({mask | a | b for a, b in combinations(blocks, 2)})


def _deal(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Rows (mask, fp) to (mask, key, fp), once for each refined mask.

    The table of masks is broadcast. Each level halves the free bits, so there
    are at most six levels and, for radius 2, 6^5 masks before the last.
    """
    if len(masks) == 1:  # all rows have that mask
        finer = F.array(*[F.lit(_signed(m)).cast("long") for m in next(iter(masks.values()))])
        dealt = rows.select("fp", F.explode(finer).alias("mask"))
    else:
        pairs = [(_signed(old), _signed(m)) for old, new in masks.items() for m in new]
        table = rows.sparkSession.createDataFrame(pairs, "mask long, finer long")
        dealt = rows.join(F.broadcast(table), "mask").select("fp", F.col("finer").alias("mask"))
    return dealt.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def near_links(points: DataFrame, max_distance: int = 2, shard_bound: int = 2048) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the distance.

    ``points`` has distinct fingerprints in a long column ``fp``.
    """
    if not 0 <= max_distance <= BITS - 2:
        raise ValueError("max_distance must be between 0 and 62")
    rows = points.select("fp", F.lit(0).cast("long").alias("mask"))
    level, ready = {0: _refined(0, max_distance)}, []
    while True:
        dealt = _deal(rows, level)
        masks = sorted({m for new in level.values() for m in new})
        sizes = dealt.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
        hot = cut(sizes.where(F.col("n") > shard_bound).select("mask", "key"))
        # at most as many rows as there are masks
        over = {m & (1 << BITS) - 1 for m, in hot.select("mask").distinct().collect()}
        if not over:
            ready.append(dealt)
            break
        ready.append(dealt.join(hot, ["mask", "key"], "left_anti"))
        rows = cut(dealt.join(hot, ["mask", "key"], "left_semi").select("fp", "mask"))
        level = {m: _refined(m, max_distance) for m in masks if m in over}
    shards = ready[0]
    for more in ready[1:]:
        shards = shards.unionByName(more)
    shards = shards.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")

    def link(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        def solved(fps):
            return shard_links([int(x) & (1 << BITS) - 1 for x in fps], max_distance)

        tail = None  # rows of the last, maybe unfinished shard
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(3)]
            if tail is not None:
                cols = [np.concatenate(x) for x in zip(tail, cols)]
            mask, key, fp = cols
            if not len(fp):
                continue
            starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            tail = [c[starts[-1]:] for c in cols]
            links = []
            ends = starts[1:]
            for i in np.flatnonzero(ends - starts[:-1] > 1):
                links += solved(fp[starts[i]:ends[i]])
            yield _links(pa, links)
        if tail is not None and len(tail[2]) > 1:
            yield _links(pa, solved(tail[2]))

    return shards.mapInArrow(link, "a long, b long")


def _links(pa, links):
    return pa.RecordBatch.from_arrays(
        [pa.array([_signed(x[i]) for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])


def fingerprint_classes(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """(fp, root) for every distinct fingerprint; root names its class."""
    points = fps.select("fp").distinct()
    roots = connected_components(near_links(points, max_distance))
    return points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(df: DataFrame, id_col: str, text_col: str, shingle: int = 3,
                       max_distance: int = 2) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component id.

    The component id is the smallest document id reachable over links, the
    document itself included. Repeated rows stay repeated. A document without
    id belongs to its class, but never names it; a class in which no document
    has an id has component id null. An empty table gives no rows.
    """
    fps = cut(with_fingerprint(df, text_col, [F.col(id_col).alias(id_col)], shingle))
    classes = cut(fingerprint_classes(fps, max_distance))
    firsts = fps.groupBy("fp").agg(F.min(id_col).alias("first"))
    named = firsts.join(classes, "fp")
    best = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = join_own(classes, best, "root").select("fp", "component_id")
    return join_own(fps, by_fp, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(df: DataFrame, id_col: str, text_col: str, shingle: int = 3,
               max_distance: int = 2) -> DataFrame:
    """The rows of ``df``, one of each class: that of the smallest id.

    Rows without id come before all others. Among rows with one id the smallest
    row hash decides; of rows equal in every column one stays. Columns may have any
    names; an empty table gives no rows, and texts are read whole, however long.
    """
    ident, row = free_names(df, "_gt_id", "_gt_row")
    keyed = [id_or_lowest(id_col).alias(ident), row_hash(df).alias(row)]
    fps = cut(with_fingerprint(df, text_col, keyed, shingle))
    classes = fingerprint_classes(fps, max_distance)
    firsts = fps.groupBy("fp").agg(F.min(F.struct(ident, row)).alias("first"))
    best = firsts.join(classes, "fp").groupBy("root").agg(F.min("first").alias("first"))
    keepers = cut(best.select(f"first.{ident}", f"first.{row}"))
    rows = df.withColumns({ident: id_or_lowest(id_col), row: row_hash(df)})
    kept = rows.join(keepers, [ident, row], "left_semi")
    return kept.dropDuplicates([ident, row]).select(*[f"`{c}`" for c in df.columns])
