"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is split by the tokenizer's pattern; each match is encoded on its own.
A match longer than ``LEAF`` bytes is cut into leaves that are merged directly,
and neighbours are joined up a tree: the tokens at the boundary are taken back
into bytes and encoded anew over a window that grows on both sides until its
first and last token stand in valid pairs with the tokens left outside.
BPE merges are local: a token sequence is the encoding of its bytes exactly if
every neighbouring pair is the encoding of its own two tokens. So once the two
seams are valid nothing outside the window can change, and the join is exact.

Joining is associative with the empty sequence as identity, so the tree's shape
does not matter, and equal nodes of a level are joined once. A window is merged
with a heap in O(w log w). In most text windows are a few tokens wide. In a run
(one letter or a short period repeated) they grow to the whole node, as merging
moves the odd bytes to the run's end; there nearly all nodes of a level are
equal, so the whole tree costs about as much as merging the run a few times.
The worst case, windows as wide as their nodes and no equal ones, is
O(n log^2 n) for a match of n bytes. Decoding concatenates the tokens' bytes up
a tree.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm.common import kept_beside, map_text

LEAF = 24  # bytes: shorter matches are merged directly
SCAN = 256  # bytes up to which looking for the lowest pair beats a heap
CACHE = 200_000  # matches whose tokens a task remembers before it starts over


def read_ranks(path: str) -> bytes:
    """The vocabulary file: one ``base64-token rank`` a line."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


class Monoid:
    """Token sequences of byte strings under joining."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self._valid: dict[tuple[int, int], bool] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Tokens by always merging the leftmost pair of the lowest rank."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > SCAN:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        none = 1 << 62  # above every rank
        pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """``merge`` over a linked list, the pairs in a heap by rank and place."""
        ranks, n = self.ranks, len(piece)
        parts: list = [piece[i:i + 1] for i in range(n)]
        after = list(range(1, n + 1))  # start of the next part
        before = list(range(-1, n - 1))
        width = n.bit_length()
        place = (1 << width) - 1
        # the rank of the pair that starts here; a heap entry that differs is stale
        pairs: list = [ranks.get(piece[i:i + 2]) for i in range(n - 1)] + [None]
        heap = [rank << width | i for i, rank in enumerate(pairs) if rank is not None]
        heapify(heap)
        while heap:
            best = heappop(heap)
            at = best & place
            if pairs[at] != best >> width:
                continue
            gone = after[at]
            right = after[gone]
            parts[at] = both = parts[at] + parts[gone]
            parts[gone] = pairs[gone] = None
            after[at] = right
            if right < n:
                before[right] = at
                pairs[at] = rank = ranks.get(both + parts[right])
                if rank is not None:
                    heappush(heap, rank << width | at)
            else:
                pairs[at] = None
            left = before[at]
            if left >= 0:
                pairs[left] = rank = ranks.get(parts[left] + both)
                if rank is not None:
                    heappush(heap, rank << width | left)
        return [ranks[p] for p in parts if p is not None]

    def stands(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens are the encoding of their bytes."""
        held = self._valid.get((a, b))
        if held is None:
            if len(self._valid) > CACHE:
                self._valid.clear()
            held = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
            self._valid[a, b] = held
        return held

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the joined bytes, from those of the two sides."""
        if not left or not right:
            return left or right
        if self.stands(left[-1], right[0]):
            return left + right
        i, j = 1, 1  # tokens taken back on either side
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            outer, inner = left[:len(left) - i], right[j:]
            span = b"".join(map(self.tokens.__getitem__, left[len(left) - i:] + right[:j]))
            middle = self.merge(span)
            bad_left = outer and not self.stands(outer[-1], middle[0])
            bad_right = inner and not self.stands(middle[-1], inner[0])
            if not bad_left and not bad_right:
                return outer + middle + inner
            # a window that stays open is most likely in a run: grow faster
            step = 2 if len(span) <= SCAN else 8
            i, j = step * i if bad_left else i, step * j if bad_right else j

    def encode(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF:
            return self.merge(piece) if piece else []
        made: list[list[int]] = []  # the tokens of a level's distinct nodes
        known: dict = {}
        level: list[int] = []  # the level's nodes, as places in made
        for at in range(0, len(piece), LEAF):
            leaf = piece[at:at + LEAF]
            node = known.setdefault(leaf, len(made))
            if node == len(made):
                made.append(self.merge(leaf))
            level.append(node)
        while len(level) > 1:
            below, made, known, up = made, [], {}, []
            for at in range(0, len(level), 2):
                pair = tuple(level[at:at + 2])
                node = known.setdefault(pair, len(made))
                if node == len(made):
                    made.append(self.join(below[pair[0]], below[pair[1]])
                                if len(pair) > 1 else below[pair[0]])
                up.append(node)
            level = up
        return made[level[0]]

    def decode(self, ids: list[int]) -> bytes:
        """Bytes, concatenated pairwise up a tree over leaves of 1024 tokens."""
        level = [b"".join(map(self.tokens.__getitem__, ids[i:i + 1024]))
                 for i in range(0, len(ids), 1024)]
        while len(level) > 1:
            level = [b"".join(level[i:i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


class Known(dict):
    """Packed tokens of the matches met last, made when they are asked for."""

    def __init__(self, monoid: Monoid) -> None:
        self.monoid = monoid

    def __missing__(self, match: str) -> bytes:
        from array import array

        if len(self) >= CACHE:
            self.clear()
        packed = array("i", self.monoid.encode(match.encode("utf-8"))).tobytes()
        if len(match) <= 64:
            self[match] = packed
        return packed


def text_encoder(monoid: Monoid, pattern: str):
    """A function from UTF-8 bytes to the tokens as packed 32-bit integers."""
    import regex

    find, known = regex.compile(pattern).findall, Known(monoid)

    def encode(text: bytes) -> bytes:
        return b"".join(map(known.__getitem__, find(text.decode("utf-8", "replace"))))

    return encode


def _of_worker(raw_ranks: bytes, pattern: str | None = None):
    """The vocabulary of a worker process, or its encoder for ``pattern``; one of each.

    Tasks that built their own left theirs behind in a worker that serves many, as
    functions sent by value are freed by a full garbage collection only. It hangs on a
    module that workers import: this one reaches them by value, task by task.
    """
    import pyspark

    kept = pyspark.__dict__.setdefault("_gt_byte_bpe", {})
    if kept.get("ranks") != raw_ranks:
        kept.clear()
        kept.update(ranks=raw_ranks, monoid=Monoid(parse_ranks(raw_ranks)))
    if pattern is None:
        return kept["monoid"]
    if kept.get("pattern") != pattern:
        kept.update(pattern=pattern, encode=text_encoder(kept["monoid"], pattern))
    return kept["encode"]


def bpe_encode(df: DataFrame, text_col: str, keep: list, raw_ranks: bytes, pattern: str,
               out: str = "ids") -> DataFrame:
    """``keep`` columns plus the token ids of every whole text.

    Null and empty texts have no tokens. Special tokens' strings are ordinary
    text. The vocabulary (its file's bytes, under a megabyte here) is broadcast
    to the executors, which need no file.
    """
    ranks = df.sparkSession.sparkContext.broadcast(raw_ranks)

    def start():
        import numpy as np

        encode = _of_worker(ranks.value, pattern)
        return lambda text: (np.frombuffer(encode(text), dtype="<i4"),)

    return map_text(df, keep, text_col, start,
                    [T.StructField(out, T.ArrayType(T.IntegerType()))])


def bpe_decode(df: DataFrame, ids_col: str, raw_ranks: bytes, out: str = "decoded") -> DataFrame:
    """All columns of ``df`` (but for one called ``out``) plus the bytes of the ids.

    Null ids decode to no bytes; an id outside the vocabulary is an error.
    """
    df = df.select(*kept_beside(df, [F.col(f"`{c}`") for c in df.columns], out))
    ranks = df.sparkSession.sparkContext.broadcast(raw_ranks)
    at, titles = df.columns.index(ids_col), df.columns
    df = df.toDF(*[f"_gt_c{i}" for i in range(len(titles))])  # names without dots
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator):
        import pyarrow as pa

        monoid = None
        for batch in batches:
            monoid = monoid or _of_worker(ranks.value)
            lists, start = batch.column(at), 0
            while start < batch.num_rows:
                # a few rows at a time: ids and bytes of long texts stay bounded
                piece = batch.slice(start, 64)
                made = [monoid.decode(x.values.to_numpy(zero_copy_only=False).tolist()
                                      if x.is_valid else [])
                        for x in lists.slice(start, 64)]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(made, pa.binary())], names=schema.names)
                start += 64

    return df.mapInArrow(run, schema).toDF(*titles, out)


def token_digests(ids_col: str = "ids", decoded_col: str = "decoded") -> list:
    """n_tokens, ids_sha256 and decoded_sha256 as columns."""
    # "[1,2]" without its brackets: no string object for each id
    text = F.to_json(ids_col)
    text = F.substring(text, F.lit(2), F.length(text) - 2)
    return [F.size(ids_col).cast("long").alias("n_tokens"),
            F.sha2(text.cast("binary"), 256).alias("ids_sha256"),
            F.sha2(F.col(decoded_col), 256).alias("decoded_sha256")]
