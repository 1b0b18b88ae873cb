"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` consecutive words of every benchmark
item (an item of fewer words is one window). The alphabet of the search is the
word and a block is two neighbouring words. For each window length the tables
are

* shift: how far the search may jump when a block ends at the current word; a
  block that no window holds allows the largest jump,
* buckets: for a block that may end a window, the windows that it ends.

The search looks at one block, jumps, and only at shift zero compares the
bucket's windows with the text, word by word (a bucket is sorted by a hash of the
windows, so only windows of the text's hash are compared).

Items are cut into pieces of at most ``PIECE`` bytes, which overlap by a window
less one word, and the pieces are dealt by hash to parts of about ``part_bytes``
bytes. The driver holds one part at a time and broadcasts its tables. Words are
numbers there and windows are places in one array, so the tables take about 20
times the part's bytes (a test measures them). One part is searched in a single
pass without a shuffle. With more parts the texts are written once to the shared
folder, each part is a pass of its own over them that ends before the next part's
tables are made, and only the rows with hits are joined in the end.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.llm.common import cut, kept_beside, shipped, unpacked, utf8

PIECE = 1 << 16  # bytes of an item that go to one part together
HASH_BASE = 0x9E3779B97F4A7C15  # odd; windows of one hash are compared
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
HITS = [T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType()))]

# Lower-cases A-Z, keeps digits, a-z and all bytes of non-ASCII characters;
# every other byte becomes a space.
_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else
                    b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def item_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


class WuManber:
    """Search tables for windows of one length.

    ``chunks`` are (place in ``items``, word numbers); ``vocab`` numbers the words.
    """

    def __init__(self, length: int, chunks: list[tuple], vocab: dict[bytes, int],
                 items: list) -> None:
        import numpy as np

        self.length, self.vocab, self.items = length, vocab, items
        self.block = min(2, length)
        self.longest = length - self.block + 1
        last = length - self.block
        self.flat = np.concatenate([x for _, x in chunks])
        sizes = np.array([len(x) for _, x in chunks])
        owner = np.repeat(np.array([i for i, _ in chunks], np.int32), sizes)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        end = first + np.repeat(sizes, sizes)
        place = np.arange(len(self.flat))

        # Blocks and how far each place is from ending a window of its chunk.
        at = place[place + self.block <= end]
        code = self.flat[at].astype(np.int64)
        if self.block == 2:
            code = code * len(vocab) + self.flat[at + 1]
        far = np.maximum(0, last - (at - first[at]))
        order = np.lexsort((far, code))
        heads = order[np.r_[True, np.diff(code[order]) != 0]]

        # Windows by bucket (the code of their last block), hash and item.
        start = place[place + length <= end]
        mark = np.zeros(len(start), np.uint64)
        for j in range(length):
            mark = mark * np.uint64(HASH_BASE) + self.flat[start + j].astype(np.uint64)
        mine = self.flat[start + last].astype(np.int64)
        if self.block == 2:
            mine = mine * len(vocab) + self.flat[start + last + 1]
        rows = np.lexsort((owner[start], mark, mine))
        a, b = rows[1:], rows[:-1]
        same = (mine[a] == mine[b]) & (mark[a] == mark[b]) & (owner[start[a]] == owner[start[b]])
        for j in range(length):  # in place: no matrix of all windows
            same &= self.flat[start[a] + j] == self.flat[start[b] + j]
        rows = rows[np.r_[True, ~same]]  # a window that an item repeats counts once
        self.start = start[rows]
        self.mark, self.owner, mine = mark[rows], owner[self.start], mine[rows]

        # block -> how far to jump, or minus one less the place of its bucket
        codes = code[heads]
        jump = far[heads]
        self.low = np.searchsorted(mine, codes[jump == 0], "left")
        self.high = np.searchsorted(mine, codes[jump == 0], "right")
        value = jump.copy()
        value[jump == 0] = -1 - np.arange((jump == 0).sum())
        self.blocks = dict(zip(codes.tolist(), value.tolist()))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(first word, items) for each window that occurs."""
        n, length, longest = len(words), self.length, self.longest
        number, blocks, size = self.vocab.get, self.blocks, len(self.vocab)
        end = length
        while end <= n:
            block = number(words[end - 1])
            if block is not None and self.block == 2:
                before = number(words[end - 2])
                block = None if before is None else before * size + block
            jump = longest if block is None else blocks.get(block, longest)
            if jump > 0:
                end += jump
                continue
            items = self._compare(-1 - jump, words[end - length:end])
            if items:
                yield end - length, items
            end += 1

    def _compare(self, bucket: int, window: list[bytes]) -> set:
        """The items of those windows of a bucket that equal ``window``."""
        mark, numbers = 0, []
        for word in window:
            word = self.vocab.get(word)
            if word is None:
                return set()
            numbers.append(word)
            mark = mark * HASH_BASE + word & (1 << 64) - 1
        low, high = int(self.low[bucket]), int(self.high[bucket])
        low += int(self.mark[low:high].searchsorted(self.mark.dtype.type(mark)))
        found = set()
        while low < high and int(self.mark[low]) == mark:
            at = int(self.start[low])
            if self.flat[at:at + self.length].tolist() == numbers:
                found.add(self.items[self.owner[low]])
            low += 1
        return found


def tables_of(items: list[tuple], window: int) -> list[WuManber]:
    """Search tables of (id, text) items, one for each window length."""
    import numpy as np

    vocab: dict[bytes, int] = {}
    chunks: dict[int, list] = {}
    names: dict = {}
    for key, text in items:
        words = item_words(text)
        if words:
            numbers = np.array([vocab.setdefault(w, len(vocab)) for w in words], np.int32)
            chunks.setdefault(min(window, len(words)), []).append(
                (names.setdefault(key, len(names)), numbers))
    return [WuManber(n, chunks[n], vocab, list(names)) for n in sorted(chunks)]


def item_pieces(text: bytes, window: int, size: int) -> Iterator[bytes]:
    """Pieces of an item of about ``size`` bytes (a window at least) with all its windows."""
    words = item_words(text)
    start = 0
    while start < len(words):
        stop, held = start, 0
        while stop < len(words) and (held < size or stop - start < window):
            held += len(words[stop]) + 1
            stop += 1
        yield b" ".join(words[start:stop])
        if stop == len(words):
            return
        start = stop - window + 1


def _pieces(benchmark: DataFrame, item_col: str, text_col: str, window: int,
            size: int) -> DataFrame:
    given = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             utf8(text_col).alias("text"))

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            for item, text in zip(*(batch.column(i) for i in (0, 1))):
                made = list(item_pieces(text.as_py(), window, size))
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item.as_py()] * len(made), pa.string()),
                         pa.array(made, pa.binary())], names=["item", "text"])

    return given.mapInArrow(run, "item string, text binary").distinct()


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str,
                       item_text_col: str, keep: list, window: int = 10,
                       part_bytes: int = 4 << 20) -> DataFrame:
    """``keep`` columns of every row of ``docs`` plus the hits in its whole text.

    Columns: ``n_words``, ``spans`` (disjoint, sorted word ranges [start, end)
    that some window covers) and ``items`` (ids, as strings, of the items of
    which a window occurs, sorted). Null, empty and wordless texts have no
    words and no hits; such items have no windows. Items with one id count
    once; an item without id marks words, but names no item. ``docs`` may be
    empty, and so may ``benchmark``: then nothing is hit. Texts and items may be
    of any length. Kept columns called like a result column give way.
    """
    keep = kept_beside(docs, keep, "n_words", "spans", "items")
    names = [f"_gt_k{i}" for i in range(len(keep))]
    titles = [f.name for f in docs.select(*keep).schema.fields] if keep else []
    rows = docs.select(*[c.alias(n) for c, n in zip(keep, names)], utf8(text_col).alias("_gt_text"))
    pieces = cut(_pieces(benchmark, item_col, item_text_col, window, min(PIECE, part_bytes)))
    total = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    if parts == 1:
        found = _search(rows, names, _shipped_part(pieces, window))
    else:
        found = _search_parts(rows, names, pieces, window, parts)
    return found.select(*[F.col(n).alias(t) for n, t in zip(names, titles)],
                        "n_words", "spans", "items")


def _shipped_part(pieces: DataFrame, window: int):
    """Broadcast tables of some pieces: about ``part_bytes`` bytes of them."""
    return shipped(pieces.sparkSession, tables_of(
        [(r.item, bytes(r.text)) for r in pieces.collect()], window))


def _search(rows: DataFrame, names: list[str], part, only_hits: bool = False) -> DataFrame:
    kinds = rows.select(*names).schema.fields if names else []
    schema = T.StructType([*kinds, *HITS])
    return rows.select(*names, "_gt_text").mapInArrow(_searcher(part, only_hits), schema)


def _search_parts(rows: DataFrame, names: list[str], pieces: DataFrame, window: int,
                  parts: int) -> DataFrame:
    """One pass for each part; the rows' number in the written table joins their hits."""
    base = cut(rows.withColumn("_gt_row", F.monotonically_increasing_id()))
    passes = []
    for part in range(parts):
        held = _shipped_part(
            pieces.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part), window)
        passes.append(cut(_search(base, ["_gt_row"], held, only_hits=True)))
        held.unpersist()
    hits = passes[0]
    for more in passes[1:]:
        hits = hits.unionByName(more)
    hits = hits.groupBy("_gt_row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    none = shipped(rows.sparkSession, [])
    counted = _search(base, [*names, "_gt_row"], none).select(*names, "_gt_row", "n_words")
    joined = counted.join(hits, "_gt_row", "left").select(
        *names, "n_words", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    at = len(names) + 1

    def unite(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            spans = [[{"start": a, "end": b} for a, b in
                      merged([(s["start"], s["end"]) for s in x])]
                     for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(spans, batch.schema.field(at).type) if i == at else batch.column(i)
                 for i in range(batch.num_columns)], names=batch.schema.names)

    return joined.mapInArrow(unite, joined.schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint, sorted ranges that cover the same words."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _searcher(part, only_hits: bool):
    def run(batches: Iterator):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_type

        spans_type, items_type = (to_arrow_type(f.dataType) for f in HITS[1:])
        tables = None
        for batch in batches:
            if tables is None:
                # a worker keeps its broadcast values, and the tables with them
                tables = getattr(part, "_gt_tables", None)
                if tables is None:
                    tables = part._gt_tables = unpacked(part)
            texts = batch.column(batch.num_columns - 1)
            counts, spans, items = [], [], []
            for text in texts:
                words = item_words(text.as_py())
                hit: list[tuple[int, int]] = []
                ids: set = set()
                for table in tables:
                    for start, found in table.search(words):
                        if hit and hit[-1][0] <= start <= hit[-1][1]:
                            hit[-1] = (hit[-1][0], max(hit[-1][1], start + table.length))
                        else:
                            hit.append((start, start + table.length))
                        ids |= found
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged(hit)])
                items.append(sorted(x for x in ids if x is not None))
            made = pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(spans, spans_type),
                 pa.array(items, items_type)],
                names=[*batch.schema.names[:-1], "n_words", "spans", "items"])
            yield made.filter(pa.array([bool(x) for x in spans])) if only_hits else made

    return run


def contamination_summary(found: DataFrame) -> DataFrame:
    """Digest columns of ``find_contamination``'s rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"),
                        lambda acc, s: acc + (s["end"] - s["start"]).cast("long"))
    cols = [c for c in found.columns if c not in ("n_words", "spans", "items")]
    return found.select(
        *cols, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))
