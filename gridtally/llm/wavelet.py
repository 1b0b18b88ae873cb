"""Token-id shards: one wavelet matrix a file.

``write_shards`` sorts documents by their key, encodes them and writes shards of a
bounded number of tokens, one compressed file each, through Spark's commit protocol
(a Parquet file whose one row holds the image, so that any store Spark writes to will
do). ``read_shards`` decodes the files back; ``count_token`` and ``find_token``
answer from rank and select without decoding.

A wavelet matrix keeps one bit a token and plane: plane 0 holds the highest bit of
every id in text order, then zeros go left and ones right, both in order, and plane 1
holds the next bit in that order, and so on. A directory of the ones before each 512
bits makes rank one lookup and at most 64 bytes of popcounts, and select one
binary search.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm.word_bpe import WordEncoder, check

MAGIC = b"GTWAVE01"
BLOCK = 64  # bytes of a plane for each entry of its directory
#: Tokens of a shard; a longer document has a shard of its own.
SHARD_TOKENS = 1 << 21
#: Bytes of text that are encoded in one go.
SLICE_BYTES = 4 << 20


class WaveletMatrix:
    """Access, rank and select over a sequence of small integers."""

    def __init__(self, n: int, zeros, planes, directory):
        self.n, self.zeros, self.planes, self.directory = n, zeros, planes, directory
        self.levels = len(planes)

    @staticmethod
    def build(values) -> WaveletMatrix:
        import numpy as np

        n = len(values)
        levels = max(1, int(values.max()).bit_length()) if n else 1
        size = -(-n // (8 * BLOCK)) * BLOCK
        planes = np.zeros((levels, size), np.uint8)
        zeros = np.zeros(levels, np.int64)
        v, rest = values.copy(), np.empty_like(values)
        for k in range(levels):
            bit = (v & values.dtype.type(1 << (levels - 1 - k))).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            planes[k, :len(packed)] = packed
            ones, none = np.flatnonzero(bit), np.flatnonzero(~bit)
            z = zeros[k] = len(none)
            np.take(v, none, out=rest[:z], mode="clip")
            np.take(v, ones, out=rest[z:], mode="clip")
            v, rest = rest, v
        return WaveletMatrix(n, zeros, planes, _directory(planes))

    def decode(self, dtype):
        """The whole sequence: planes are undone from the last to the first."""
        import numpy as np

        # ids of at most 16 bits: half the bytes to move
        out = np.zeros(self.n, np.uint16 if self.levels <= 16 else dtype)
        for k in range(self.levels - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            z, before = self.zeros[k], np.empty_like(out)
            before[np.flatnonzero(~bit)] = out[:z]
            before[np.flatnonzero(bit)] = out[z:] | out.dtype.type(1 << (self.levels - 1 - k))
            out = before
        return out.astype(dtype, copy=False)

    def _rank1(self, k: int, at):
        """Ones of plane ``k`` before each position of ``at``."""
        import numpy as np

        block, bits = at >> 9, at & 511
        if not len(self.planes[k]):
            return np.zeros_like(at)
        inside = np.minimum(block, len(self.planes[k]) // BLOCK - 1)
        rows = self.planes[k].reshape(-1, BLOCK)[inside]
        left = np.clip(bits[:, None] - 8 * np.arange(BLOCK), 0, 8)
        masked = rows & ((1 << left) - 1).astype(np.uint8)
        some = np.bitwise_count(masked).sum(1, dtype=np.int64)
        return self.directory[k][block] + np.where(block > inside, 0, some)

    def _select(self, k: int, nth, ones: bool):
        """Positions in plane ``k`` of the ``nth`` (from 0) ones or zeros."""
        import numpy as np

        steps = self.directory[k]
        if not ones:
            steps = np.arange(len(steps)) * (8 * BLOCK) - steps
        block = np.searchsorted(steps, nth, side="right") - 1
        rows = self.planes[k].reshape(-1, BLOCK)[block]
        bits = np.unpackbits(rows if ones else ~rows, axis=1, bitorder="little")
        left = (nth - steps[block])[:, None] + 1
        return block * (8 * BLOCK) + (np.cumsum(bits, axis=1, dtype=np.int64) >= left).argmax(1)

    def access(self, at):
        """The ids at the positions ``at`` (an integer array)."""
        import numpy as np

        at, out = np.array(at, np.int64), np.zeros(len(at), np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("position outside the sequence")
        for k in range(self.levels):
            bit = self.planes[k][at >> 3] >> (at & 7) & 1
            ones = self._rank1(k, at)
            out = out << 1 | bit
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the last plane's order holds the token's occurrences in [lo, hi)."""
        import numpy as np

        if token < 0 or token >> self.levels or not self.n:
            return 0, 0
        ends = np.array([lo, hi], np.int64)
        for k in range(self.levels):
            ones = self._rank1(k, ends)
            ends = self.zeros[k] + ones if token >> (self.levels - 1 - k) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def rank(self, token: int, stop: int | None = None, start: int = 0) -> int:
        """Occurrences of a token in [start, stop)."""
        lo, hi = self._range(token, start, self.n if stop is None else stop)
        return hi - lo

    def select(self, token: int, nth=None):
        """Positions, rising, of the ``nth`` (from 0) occurrences of a token; all by default."""
        import numpy as np

        lo, hi = self._range(token, 0, self.n)
        at = lo + (np.arange(hi - lo) if nth is None else np.asarray(nth, np.int64))
        if len(at) and (at.min() < lo or at.max() >= hi):
            raise IndexError("no such occurrence")
        for k in range(self.levels - 1, -1, -1):
            one = bool(token >> (self.levels - 1 - k) & 1)
            pieces = [self._select(k, part - self.zeros[k] if one else part, one)
                      for part in np.array_split(at, max(1, len(at) >> 14))]
            at = np.concatenate(pieces)
        return at

    def to_bytes(self) -> bytes:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        parts = [pack(self.zeros.astype("<i8").tobytes()), pack(self.planes.tobytes()),
                 pack(self.directory.astype("<i8").tobytes())]
        sizes = struct.pack("<QQQQQ", self.n, self.levels, *map(len, parts[:2]), len(parts[2]))
        return MAGIC + sizes + b"".join(parts)

    @staticmethod
    def from_bytes(image) -> WaveletMatrix:
        import numpy as np
        import zstandard

        image = memoryview(image)
        if image[:8] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        n, levels, *sizes = struct.unpack("<QQQQQ", image[8:48])
        parts, at = [], 48
        for s in sizes:
            parts.append(zstandard.ZstdDecompressor().decompress(image[at:at + s]))
            at += s
        planes = np.frombuffer(parts[1], np.uint8).reshape(levels, -1)
        return WaveletMatrix(n, np.frombuffer(parts[0], "<i8"), planes,
                             np.frombuffer(parts[2], "<i8").reshape(levels, -1))


def _directory(planes):
    """Ones before each block of a plane, and in all of it."""
    import numpy as np

    blocks = np.bitwise_count(planes).reshape(len(planes), -1, BLOCK).sum(2, dtype=np.int64)
    return np.concatenate([np.zeros((len(planes), 1), np.int64), np.cumsum(blocks, 1)], 1)


def write_shards(docs: DataFrame, text: str, key: str, path: str, tokenizer_json: str, end_id: int,
                 shard_tokens: int = SHARD_TOKENS, partitions: int | None = None) -> None:
    """Write the token ids of ``docs`` to ``path`` in ascending order of ``key``.

    Every document's ids are followed by ``end_id``. A null text is an empty one; a
    null key comes first; documents of one key are in the order of a hash of their
    text, so a hot key spreads over ranges. Extra columns are ignored, whatever their
    names; a table without rows makes no shard. A text is encoded whole, however long;
    a document is never split, so a shard exceeds ``shard_tokens`` only if it holds
    one document. ``path`` must not exist; a failed job leaves no shard behind.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = spark.sparkContext.broadcast(tokenizer_json)
    if check(tokenizer_json) <= end_id:
        raise ValueError("end_id is not an id of the tokenizer")
    rows = docs.select(F.col(key).alias("key"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("key").asc_nulls_first(), "tie", "row"]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("key", "text")
    schema = "part int, seq int, n_docs long, n_tokens long, columns binary, image binary"

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        encoder = _encoder(held.value)
        ids, sizes, keys, size = [], [], [], 0

        def shard():
            n_tokens = np.concatenate(sizes)
            cols = pa.table({"key": pa.concat_arrays(keys), "n_tokens": n_tokens})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, cols.schema, options=pa.ipc.IpcWriteOptions(
                    compression="zstd")) as w:
                w.write_table(cols)
            image = WaveletMatrix.build(np.concatenate(ids)).to_bytes()
            row = [part, seq, len(n_tokens), int(n_tokens.sum()), sink.getvalue().to_pybytes(),
                   image]
            return pa.RecordBatch.from_pylist([dict(zip(
                ("part", "seq", "n_docs", "n_tokens", "columns", "image"), row))], schema=out)

        out = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
                         ("n_tokens", pa.int64()), ("columns", pa.binary()),
                         ("image", pa.binary())])
        for batch in batches:
            for piece in _slices(batch, batch.column(1)):
                flat, counts = encoder.encode(piece.column(1))
                ends = np.cumsum(counts)
                # end marks go in behind each document's ids
                flat, counts = np.insert(flat, ends, flat.dtype.type(end_id)), counts + 1
                ends = np.cumsum(counts)
                start = 0
                while start < len(counts):
                    base = ends[start] - counts[start]
                    room = base + shard_tokens - size
                    stop = int(np.searchsorted(ends, room, side="right"))
                    if stop <= start and not size:  # one document fills a shard
                        stop = start + 1
                    if stop > start:
                        ids.append(flat[base:ends[stop - 1]])
                        sizes.append(counts[start:stop])
                        keys.append(piece.column(0).slice(start, stop - start))
                        size += int(ends[stop - 1] - base)
                        start = stop
                    if start < len(counts):
                        yield shard()
                        ids, sizes, keys, size, seq = [], [], [], 0, seq + 1
        if sizes:
            yield shard()

    dealt.mapInArrow(run, schema).write.option("maxRecordsPerFile", 1).option(
        "compression", "uncompressed").parquet(path)


def _encoder(tokenizer_json: str) -> WordEncoder:
    """One encoder a worker process, so that the words it has met serve later tasks.

    It hangs on a module that workers import: this one reaches them by value, task by task.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import pyspark

    kept = pyspark.__dict__.setdefault("_gt_word_encoders", {})
    if tokenizer_json not in kept:
        kept.clear()
        kept[tokenizer_json] = WordEncoder(tokenizer_json)
    return kept[tokenizer_json]


def _slices(batch, texts) -> Iterator:
    """Pieces of a batch of about SLICE_BYTES of text, or of one longer text."""
    import numpy as np
    import pyarrow.compute as pc

    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(total):
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _opened(row):
    """(document columns, wavelet matrix) of a shard row."""
    import pyarrow as pa

    return pa.ipc.open_stream(row["columns"]).read_all(), WaveletMatrix.from_bytes(row["image"])


def _map_shards(shards: DataFrame, func, schema: T.StructType) -> DataFrame:
    """``func(shard row)`` -> Arrow table, for every file, one at a time."""
    def run(batches: Iterator):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from pa.table(func(row), schema=out).to_batches(max_chunksize=4096)

    return shards.mapInArrow(run, schema)


def shard_table(spark: SparkSession, path: str) -> DataFrame:
    """One row a shard file: part, seq, n_docs, n_tokens and the two images."""
    return spark.read.parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, shard_start): the tokens of all shards before.

    Parts are summed first, so no task holds more than one row a part or the shards
    of one part.
    """
    from pyspark.sql import Window

    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("t")).select(
        F.col("part").alias("p"), (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq"))
    return sizes.join(parts, F.col("part") == F.col("p")).select(
        "part", "seq", (F.col("before") + inside - F.col("n_tokens")).alias("shard_start"))


def read_shards(spark: SparkSession, path: str, key_type: str = "long",
                out: Column | None = None) -> DataFrame:
    """Documents decoded from the files: key, start, n_tokens, ids.

    ``start`` counts the tokens of all documents before; ``ids`` holds the ids as
    little-endian unsigned 32-bit integers. ``out``, an expression over ``ids``, is
    returned in their stead, and they are not shuffled then. A shard is decoded whole
    by one task.
    """
    shards = shard_table(spark, path)
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
                           T.StructField("key", T._parse_datatype_string(key_type)),
                           T.StructField("offset", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def decode(row):
        import numpy as np

        docs, matrix = _opened(row)
        raw = matrix.decode(np.dtype("<u4"))
        n = docs.column("n_tokens").to_numpy()
        starts = np.cumsum(n) - n
        return {"part": np.full(len(n), row["part"], np.int32), "seq": np.full(len(n), row["seq"], np.int32),
                "key": docs.column("key").combine_chunks(), "offset": starts, "n_tokens": n,
                "ids": [raw[a:a + b].tobytes() for a, b in zip(starts.tolist(), n.tolist())]}

    rows = _map_shards(shards, decode, schema).select(
        "part", "seq", "key", "offset", "n_tokens", F.col("ids") if out is None else out)
    starts = shard_starts(shards)
    return rows.join(starts, ["part", "seq"]).select(
        "key", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", rows.columns[-1])


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, seq, n): occurrences of a token id in each shard, by rank alone."""
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
                           T.StructField("n", T.LongType())])
    return _map_shards(shard_table(spark, path), lambda row: {
        "part": [row["part"]], "seq": [row["seq"]],
        "n": [WaveletMatrix.from_bytes(row["image"]).rank(token)]}, schema)


def find_token(spark: SparkSession, path: str, token: int, key_type: str = "long") -> DataFrame:
    """(key, position): every occurrence of a token id, by select; positions count
    from 0 in their document."""
    schema = T.StructType([T.StructField("key", T._parse_datatype_string(key_type)),
                           T.StructField("position", T.LongType())])

    def find(row):
        import numpy as np

        docs, matrix = _opened(row)
        ends = np.cumsum(docs.column("n_tokens").to_numpy())
        at = matrix.select(token)
        doc = np.searchsorted(ends, at, side="right")
        starts = np.concatenate([[0], ends])[doc]
        return {"key": docs.column("key").take(doc).combine_chunks(), "position": at - starts}

    return _map_shards(shard_table(spark, path), find, schema)
