"""Line dedup over sharded cuckoo filters and exact reference counts.

A line's key is the line without ASCII white space at both ends, A-Z
lower-cased; it is stored as its 128-bit XXH3 digest. ``LineIndex`` holds

* ``postings`` (hi, lo, doc): every key of at least ``min_chars`` code points
  with each document that holds it, exact;
* ``refs`` (hi, lo, shard, n_docs, last_doc): exact reference counts;
* ``filters`` (shard, n, cells): one cuckoo filter per shard with the keys that
  are held by ``min_docs`` documents or more.

``insert`` and ``delete`` touch only the keys of the documents that come or go:
their counts are taken anew from the postings, and a key that crosses
``min_docs`` is inserted into or deleted from its shard's filter. Both are exact
inverses of each other, so deleting a document brings back every line that was
dropped because of it. The filters only tell which lines cannot be repeated
ones; whatever passes is joined with the exact counts, so a false positive
costs a row of that join and never a line.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm.common import cut, id_or_lowest, map_text

SALTS = 32  # a shard's lookups are dealt to so many tasks; each gets the filter
SHARD_KEYS = 1 << 14  # repeated keys per shard when an index is made
SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The digest of a line's key, None if the key is too short."""
    import xxhash

    key = line.strip(SPACE)
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.lower())  # bytes.lower: A-Z only


class CuckooFilter:
    """Buckets of four 16-bit marks; a key's mark is in one of two buckets.

    Holds each key at most once, which the exact counts guarantee.
    """

    def __init__(self, n_keys: int = 0, cells=None) -> None:
        import numpy as np

        buckets = 1 << max(4, (max(1, n_keys) * 2 // 4).bit_length())
        self.cells = np.zeros((buckets, 4), dtype="<u2") if cells is None else cells

    @classmethod
    def of_bytes(cls, raw: bytes) -> CuckooFilter:
        import numpy as np

        return cls(cells=np.frombuffer(raw, dtype="<u2").reshape(-1, 4).copy())

    @classmethod
    def of_keys(cls, hi, lo) -> CuckooFilter:
        """A filter of these keys, made larger until all have found a place."""
        room = len(hi)
        while True:
            made = cls(room)
            if all(made.insert(h, x) for h, x in zip(hi.tolist(), lo.tolist())):
                return made
            room = 2 * room + 1

    def places(self, hi, lo):
        """Mark and both buckets of keys (arrays of signed longs)."""
        import numpy as np

        hi, lo = np.asarray(hi, np.int64).view(np.uint64), np.asarray(lo, np.int64).view(np.uint64)
        mask = np.uint64(len(self.cells) - 1)
        mark = np.maximum(lo & np.uint64(0xFFFF), np.uint64(1))  # zero means free
        first = (hi >> np.uint64(16)) & mask
        return mark, first, first ^ self._jump(mark, mask)

    @staticmethod
    def _jump(mark, mask):
        import numpy as np

        mixed = np.asarray(mark, np.uint64) * np.uint64(0x9E3779B1) + np.uint64(1)
        return ((mixed >> np.uint64(7)) | np.uint64(1)) & mask

    def contains(self, hi, lo):
        """Which keys may be held: always true for those that are."""
        mark, one, two = self.places(hi, lo)
        return ((self.cells[one] == mark[:, None]) | (self.cells[two] == mark[:, None])).any(axis=1)

    def insert(self, hi: int, lo: int) -> bool:
        """False if no place was found; the filter must then be made anew."""
        import numpy as np

        mark, one, two = (int(x[0]) for x in self.places([hi], [lo]))
        at, mask = one, np.uint64(len(self.cells) - 1)
        for bucket in (one, two):
            free = np.flatnonzero(self.cells[bucket] == 0)
            if len(free):
                self.cells[bucket, free[0]] = mark
                return True
        for kick in range(500):
            slot = kick & 3
            mark, self.cells[at, slot] = int(self.cells[at, slot]), mark
            at ^= int(self._jump(np.uint64(mark), mask))
            free = np.flatnonzero(self.cells[at] == 0)
            if len(free):
                self.cells[at, free[0]] = mark
                return True
        return False

    def delete(self, hi: int, lo: int) -> bool:
        """Take out one mark of a key that was inserted."""
        import numpy as np

        mark, one, two = (int(x[0]) for x in self.places([hi], [lo]))
        for bucket in (one, two):
            held = np.flatnonzero(self.cells[bucket] == mark)
            if len(held):
                self.cells[bucket, held[0]] = 0
                return True
        return False


@dataclass
class LineIndex:
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    n_shards: int
    min_docs: int
    min_chars: int


def line_postings(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Distinct (hi, lo, doc) of all lines whose key is long enough."""
    def start():
        def keys(text):
            found = {k for k in (line_key(x, min_chars) for x in text.split(b"\n")) if k}
            return (sorted(found),)
        return keys

    lists = map_text(df, [id_or_lowest(id_col).alias("doc")], text_col, start,
                     [T.StructField("keys", T.ArrayType(T.BinaryType()))])
    one = lists.select("doc", F.explode("keys").alias("k"))
    half = [F.conv(F.hex(F.substring("k", i, 8)), 16, -10).cast("long") for i in (1, 9)]
    return one.select(half[0].alias("hi"), half[1].alias("lo"), "doc").distinct()


def _refs(postings: DataFrame, n_shards: int) -> DataFrame:
    return postings.groupBy("hi", "lo").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("last_doc")).withColumn(
        "shard", F.pmod(F.xxhash64("hi"), F.lit(n_shards)).cast("int"))


def build_index(df: DataFrame, id_col: str, text_col: str, min_docs: int = 3,
                min_chars: int = 20) -> LineIndex:
    """Insert all documents of ``df`` into an empty index."""
    postings = cut(line_postings(df, id_col, text_col, min_chars))
    many = postings.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= min_docs).count()
    n_shards = -(-max(1, many) // SHARD_KEYS)
    refs = cut(_refs(postings, n_shards))
    spark = df.sparkSession
    empty = spark.createDataFrame([], "shard int, n long, cells binary")
    filters = _updated(empty, refs.where(F.col("n_docs") >= min_docs).select(
        "shard", "hi", "lo", F.lit(1).alias("step")))
    return LineIndex(postings, refs, cut(filters), n_shards, min_docs, min_chars)


def _updated(filters: DataFrame, changes: DataFrame) -> DataFrame:
    """Filters after changes (shard, hi, lo, step: 1 inserts, -1 deletes).

    A shard's filter comes first, then its changes: about ``SHARD_KEYS`` keys.
    A filter without room comes back with cells null; ``_remade`` fills it.
    """
    rows = filters.select("shard", F.lit(0).alias("step"), F.lit(0).cast("long").alias("hi"),
                          F.lit(0).cast("long").alias("lo"), "n", "cells")
    rows = rows.unionByName(changes.select(
        "shard", "step", "hi", "lo", F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("binary").alias("cells")))
    # deletions first, so that places become free before others are sought
    rows = rows.withColumn("rank", F.abs("step") * (2 + F.col("step")))
    rows = rows.repartition("shard").sortWithinPartitions("shard", "rank", "hi", "lo")

    def update(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        def finished(shard, base, new):
            hi, lo, step = (np.concatenate(x) for x in zip(*new)) if new else (np.zeros(0, int),) * 3
            if base is None:
                made, n = CuckooFilter.of_keys(hi, lo), len(hi)
            else:
                made, n = CuckooFilter.of_bytes(base[0]), base[1] + int(step.sum())
                for h, x, s in zip(hi.tolist(), lo.tolist(), step.tolist()):
                    if not (made.insert(h, x) if s > 0 else made.delete(h, x)):
                        made = None
                        break
            cells = None if made is None else made.cells.tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([n], pa.int64()),
                 pa.array([cells], pa.binary())], names=["shard", "n", "cells"])

        at, base, new = None, None, []
        for batch in batches:
            shard, step, hi, lo, n = (batch.column(i).to_numpy() for i in range(5))
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else []
            for a, b in zip(cuts, [*cuts[1:], len(shard)]):
                if at is not None and shard[a] != at:
                    yield finished(at, base, new)
                    base, new = None, []
                at = int(shard[a])
                if step[a] == 0:
                    base, a = (batch.column(5)[int(a)].as_py(), int(n[a])), a + 1
                new.append((hi[a:b], lo[a:b], step[a:b]))
        if at is not None:
            yield finished(at, base, new)

    return rows.drop("rank").mapInArrow(update, "shard int, n long, cells binary")


def _changed(index: LineIndex, postings: DataFrame, touched: DataFrame) -> LineIndex:
    """The index with these postings; only ``touched`` keys may differ."""
    postings, keys = cut(postings), ["hi", "lo"]
    old = index.refs.join(touched, keys, "left_semi")
    new = cut(_refs(postings.join(touched, keys, "left_semi"), index.n_shards))
    refs = cut(index.refs.join(touched, keys, "left_anti").unionByName(new))
    was, now = (x.where(F.col("n_docs") >= index.min_docs).select("shard", "hi", "lo")
                for x in (old, new))
    steps = now.join(was, ["shard", *keys], "left_anti").withColumn("step", F.lit(1)).unionByName(
        was.join(now, ["shard", *keys], "left_anti").withColumn("step", F.lit(-1)))
    filters = cut(_updated(index.filters, steps))
    full = filters.where("cells IS NULL").select("shard")
    remade = _updated(index.filters.limit(0), refs.where(
        F.col("n_docs") >= index.min_docs).join(full, "shard", "left_semi").select(
        "shard", "hi", "lo", F.lit(1).alias("step")))
    filters = cut(filters.where("cells IS NOT NULL").unionByName(remade))
    return LineIndex(postings, refs, filters, index.n_shards, index.min_docs, index.min_chars)


def insert(index: LineIndex, df: DataFrame, id_col: str, text_col: str) -> LineIndex:
    """The index with the documents of ``df`` added."""
    new = cut(line_postings(df, id_col, text_col, index.min_chars))
    touched = new.select("hi", "lo").distinct()
    return _changed(index, index.postings.unionByName(new).distinct(), touched)


def delete(index: LineIndex, ids: DataFrame, id_col: str) -> LineIndex:
    """The index without the documents whose ids are in ``ids``."""
    gone = ids.select(id_or_lowest(id_col).alias("doc")).distinct()
    touched = cut(index.postings.join(gone, "doc", "left_semi").select("hi", "lo").distinct())
    return _changed(index, index.postings.join(gone, "doc", "left_anti"), touched)


def _maybe_repeated(index: LineIndex) -> DataFrame:
    """Postings whose key passes its shard's filter."""
    shard = F.pmod(F.xxhash64("hi"), F.lit(index.n_shards)).cast("int")
    nothing = F.lit(None).cast("binary")
    rows = index.postings.select(
        shard.alias("shard"), F.pmod(F.hash("doc"), F.lit(SALTS)).alias("salt"),
        F.lit(1).alias("kind"), "hi", "lo", "doc", nothing.alias("cells"))
    zero = F.lit(0).cast("long")
    rows = rows.unionByName(index.filters.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
        F.lit(0).alias("kind"), zero.alias("hi"), zero.alias("lo"), zero.alias("doc"), "cells"))
    rows = rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")

    def probe(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        held, group = None, None
        for batch in batches:
            shard, salt, kind, hi, lo, doc = (batch.column(i).to_numpy() for i in range(6))
            if not len(shard):
                continue
            new = (kind[1:] == 0) | (shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1])
            cuts = np.flatnonzero(np.r_[True, new])
            keep = np.zeros(len(shard), dtype=bool)
            for a, b in zip(cuts, [*cuts[1:], len(shard)]):
                if (shard[a], salt[a]) != group:
                    held, group = None, (shard[a], salt[a])
                if kind[a] == 0:
                    held, a = CuckooFilter.of_bytes(batch.column(6)[int(a)].as_py()), a + 1
                if held is not None and b > a:
                    keep[a:b] = held.contains(hi[a:b], lo[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (shard, hi, lo, doc)],
                names=["shard", "hi", "lo", "doc"])

    return rows.mapInArrow(probe, "shard int, hi long, lo long, doc long")


def dropped_keys(index: LineIndex) -> DataFrame:
    """(doc, keys): the key digests whose lines a document loses."""
    repeated = index.refs.where(F.col("n_docs") >= index.min_docs)
    lost = _maybe_repeated(index).join(repeated, ["shard", "hi", "lo"]).where("doc < last_doc")
    key = F.concat(*[F.unhex(F.lpad(F.hex(c), 16, "0")) for c in ("hi", "lo")])
    return lost.select("doc", key.alias("key")).groupBy("doc").agg(
        F.collect_list("key").alias("keys"))


def drop_repeated_lines(df: DataFrame, index: LineIndex, id_col: str, text_col: str,
                        keep: list, out: tuple[str, str, str]) -> DataFrame:
    """``keep`` columns, then lines before, lines dropped and the kept text.

    A document loses every line whose key is held by ``min_docs`` documents or
    more, unless it is the one with the largest id among them. Null and empty
    texts are one empty line. Rows of one id are one document; rows without id
    are one document with an id below all others. A document outside the index
    loses nothing.
    """
    lost = dropped_keys(index)
    names = [f"_gt_k{i}" for i in range(len(keep))]
    rows = df.select(*[c.alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("_gt_text"),
                     id_or_lowest(id_col).alias("doc"))
    # the lists go as one binary: sixteen bytes a key
    flat = lost.select("doc", F.unhex(F.array_join(
        F.transform("keys", lambda k: F.hex(k)), "")).alias("_gt_lost"))
    rows = rows.join(flat, "doc", "left").drop("doc")
    min_chars = index.min_chars

    def rewrite(text: bytes, lost: bytes | None):
        lines = text.split(b"\n")
        if not lost:
            return len(lines), 0, text.decode("utf-8", "replace")
        gone = {lost[i:i + 16] for i in range(0, len(lost), 16)}
        left = [x for x in lines if line_key(x, min_chars) not in gone]
        return len(lines), len(lines) - len(left), b"\n".join(left).decode("utf-8", "replace")

    packed = F.struct(F.coalesce(F.col("_gt_text").cast("binary"), F.lit(b"")).alias("t"),
                      F.col("_gt_lost").alias("k"))
    given = rows.select(*names, packed.alias("_gt_in"))
    fields = [T.StructField(out[0], T.LongType()), T.StructField(out[1], T.LongType()),
              T.StructField(out[2], T.StringType())]
    titles = [f.name for f in df.select(*keep).schema.fields]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in
                           zip(names, df.select(*keep).schema.fields)] + fields)

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            pairs = batch.column(batch.num_columns - 1)
            texts, lists = pairs.field(0), pairs.field(1)
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            start, size, cells = 0, 0, []
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                cells.append(rewrite(text, lists[i].as_py()))
                size += len(text)
                if size >= 8 << 20 or i == batch.num_rows - 1:
                    n = i + 1 - start
                    kinds = (pa.int64(), pa.int64(), pa.string())
                    arrays = [x.slice(start, n) for x in rest]
                    arrays += [pa.array([c[k] for c in cells], kinds[k]) for k in range(3)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
                    start, size, cells = i + 1, 0, []

    done = given.mapInArrow(run, schema)
    return done.select(*[F.col(n).alias(t) for n, t in zip(names, titles)], *out)


def dedup_lines(df: DataFrame, id_col: str, text_col: str, keep: list,
                out: tuple[str, str, str] = ("n_lines", "n_dropped", "kept"),
                min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """Index all documents, then drop their repeated lines."""
    index = build_index(df, id_col, text_col, min_docs, min_chars)
    return drop_repeated_lines(df, index, id_col, text_col, keep, out)
