"""Plain, slow versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def fingerprint(text: str | None) -> int:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(docs: list[tuple]) -> list[tuple]:
    """docs (id, text) to (id, hex, component): all pairs of distinct codes."""
    fps = [fingerprint(t) for _, t in docs]
    codes = sorted(set(fps))
    top = {c: c for c in codes}

    def find(c):
        while top[c] != c:
            c = top[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= 2:
                top[find(a)] = find(b)
    first: dict = {}
    for (key, _), f in zip(docs, fps):
        if key is not None:
            first[find(f)] = min(key, first.get(find(f), key))
    return [(key, f"{f:016x}", first.get(find(f))) for (key, _), f in zip(docs, fps)]


def line_dedup(docs: list[tuple], min_docs: int = 3, min_chars: int = 20) -> list[tuple]:
    """docs (id, text) to (id, lines, dropped, kept text)."""
    low = -(1 << 63)

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(low if d is None else d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        own = low if d is None else d
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs
                or max(holders[key(x)]) == own]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def contamination(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """docs and items (id, text) to (id, words, hits, items, sha, contaminated)."""
    windows = defaultdict(set)
    for key, text in items:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i:i + n])].add(key)
    out = []
    for d, t in docs:
        words = ITEM_WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                ids = windows.get(tuple(words[i:i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        found = sorted(str(x) for x in found if x is not None)
        out.append((d, len(words), len(hit), len(found), sha(",".join(found)), bool(hit)))
    return out


def rule_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    covered = {j for i, g in enumerate(grams) if many[g] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def tokenizer(path: str, pattern: str):
    import base64

    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def bpe(docs: list[tuple], encoding) -> list[tuple]:
    """docs (id, text) to (id, tokens, ids' sha, bytes' sha)."""
    out = []
    for d, t in docs:
        ids = encoding.encode_ordinary(t or "")
        out.append((d, len(ids), sha(",".join(map(str, ids))), sha((t or "").encode())))
    return out
