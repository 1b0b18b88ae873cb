"""Word-level BPE encoding with a public tokenizer, each distinct word once.

The tokenizers library spends most of its time on normalising and splitting. A
text is cut at spaces, tabs and line ends, which no token of a word-ended BPE
crosses, and Arrow numbers the distinct pieces of a batch. Pieces of ASCII and Latin-1
letters are lower-cased and split by the tokenizer's own pattern, written for that
alphabet; words that the worker has not met go to the library's BPE model in one
call, and the ids are cut apart at the tokens that end a word. All other pieces, and
those that might hold a special token, take the library's whole path.

Exact for tokenizers of this kind only: NFC, white space to a space, lower case,
the split pattern below, byte level, and a BPE with word ends (``check`` refuses
others).
"""

from __future__ import annotations

import json
import re

#: Pieces and words that a worker keeps: the half met last, and one half that was met
#: before; what is met again changes over, the rest goes (memory only).
KEPT = 1 << 20

# ---- fixed values: the split pattern that the vocabulary was made for
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ---------------------------------------------------------------------------
#: The same over lower-cased ASCII and Latin-1 letters without white space.
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")
_PLAIN = re.compile("[\x00-\x08\x0e-\x1f!-~\x7fÀ-ÖØ-öø-ÿ]*")


def check(tokenizer_json: str) -> int:
    """The number of ids of a tokenizer that this module encodes exactly."""
    spec = json.loads(tokenizer_json)
    steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
    split = spec["pre_tokenizer"]["pretokenizers"]
    model = spec["model"]
    if (steps != ["NFC", "Replace", "Lowercase"] or split[0]["pattern"].get("Regex") != PATTERN
            or model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>"
            or any(" " in x["content"] for x in spec["added_tokens"])
            or not all(x["content"].startswith("<|") for x in spec["added_tokens"])):
        raise ValueError("not a lower-casing BPE with word ends and the known split pattern")
    return 1 + max([*model["vocab"].values(), *(x["id"] for x in spec["added_tokens"])])


class WordEncoder:
    """``encode(texts)``: ids and the number of ids of each text, as numpy arrays."""

    def __init__(self, tokenizer_json: str):
        import numpy as np
        from tokenizers import Tokenizer, pre_tokenizers

        size = check(tokenizer_json)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.whole = Tokenizer.from_str(tokenizer_json)
        # words only: the model without normaliser, on words parted by spaces
        self.words_only = Tokenizer(self.whole.model)
        self.words_only.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(size, bool)
        for token, i in self.whole.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        # of pieces and words: a word by itself is a piece of that one word
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        """Ids of words not met before, from one call to the library."""
        import numpy as np

        # without the places in the text, which nothing reads
        made, = self.words_only.encode_batch_fast([" ".join(new)], add_special_tokens=False)
        ids = np.array(made.ids, self.dtype)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(new):
            raise ValueError("the vocabulary does not end every word with </w>")
        raw, start = ids.tobytes(), 0
        for w, stop in zip(new, (stops * self.dtype.itemsize).tolist()):
            self.known[w] = raw[start:stop]
            start = stop

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        import numpy as np

        if len(self.known) > KEPT // 2:
            self.known, self.before = {}, self.known
        before = self.before
        known, got = self.known, list(map(self.known.get, pieces))
        words, places, mixed, cuts, rest, unknown = [], [], [], [], [], {}

        def meet(w: str) -> None:
            if (ids := before.get(w)) is None:
                unknown[w] = None
            else:
                known[w] = ids

        for at, (p, ids) in enumerate(zip(pieces, got)):
            if ids is not None:
                continue
            if (ids := before.get(p)) is not None:
                got[at] = known[p] = ids
            elif p.isascii() and p.isalpha():  # a word of letters needs no splitting
                w = p.lower()
                if w not in known:
                    meet(w)
                words.append(w)
                places.append(at)
            # printable ASCII is plain
            elif "<|" not in p and (p.isascii() and p.isprintable() or _PLAIN.fullmatch(p)):
                ws = _WORDS.findall(p.lower())
                for w in ws:
                    if w not in known:
                        meet(w)
                cuts.append(ws)
                mixed.append(at)
            else:
                rest.append(at)
        if unknown:
            self._learn(list(unknown))
        for at, w in zip(places, words):
            got[at] = known[pieces[at]] = known[w]
        for at, ws in zip(mixed, cuts):
            got[at] = known[pieces[at]] = b"".join([known[w] for w in ws])
        for at, made in zip(rest, self.whole.encode_batch_fast(
                [pieces[at] for at in rest], add_special_tokens=False)):
            got[at] = known[pieces[at]] = np.array(made.ids, self.dtype).tobytes()
        return got

    def encode(self, texts):
        """An Arrow string array without nulls -> (ids of all texts in a row, how many a text).

        How texts are batched does not matter for the ids.
        """
        import numpy as np
        import pyarrow.compute as pc

        for gap in "\n\t\r":
            texts = pc.replace_substring(texts, gap, " ")
        cut = pc.split_pattern(texts, " ")
        # the pieces of these texts alone, whether or not the array is a slice
        offsets = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets -= offsets[0]
        found = self._pieces(coded.dictionary.to_pylist())
        lens = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        flat, starts = np.frombuffer(b"".join(found), self.dtype), np.cumsum(lens) - lens
        where = coded.indices.to_numpy()
        per_piece = lens[where]
        ends = np.concatenate([[0], np.cumsum(per_piece)])
        # of each piece, where it starts among the distinct ones, less where it goes
        short = np.int32 if ends[-1] < 1 << 31 else np.int64  # less memory to move
        shift = np.repeat((starts[where] - ends[:-1]).astype(short), per_piece)
        shift += np.arange(len(shift), dtype=short)
        return flat.take(shift), np.diff(ends[offsets])
