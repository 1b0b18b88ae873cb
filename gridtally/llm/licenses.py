"""Licence scan: Dice coefficient over word bigrams against licence templates.

A document is cut into lines, paragraphs (runs of lines with a word) and its
whole text. Each such passage is normalised like the templates (A-Z lower-cased,
words of ASCII letters, digits and non-ASCII characters) and compared by
``2 * common / (bigrams of one + bigrams of the other)``, bigrams counted with
repeats. For a threshold t no pair scores that high unless the smaller side has
at least t / (2 - t) times the bigrams of the larger one; so a passage meets
only the templates within those size bounds, and most passages meet none.

A notice may share its line or paragraph with other words. So every place of the
text is compared too: windows of each template's size range slide over all word
bigrams. The best window of a spot starts and ends with a bigram of the template
(others only lower its score), and a text meets only the templates of which it
holds as many bigrams as the threshold asks for; counts grow bigram by bigram.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridtally.llm.common import map_text
from gridtally.llm.decontaminate import item_words

# The wording of public licence notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
}


def dice(a: Counter, n_a: int, b: Counter, n_b: int) -> float:
    """Dice coefficient of two bags of ``n_a`` and ``n_b`` bigrams."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    common = sum(min(n, large[g]) for g, n in small.items() if g in large)
    return 2 * common / (n_a + n_b) if n_a + n_b else 0.0


class TemplateSet:
    """Templates sorted by size, for lookups within the size bounds."""

    def __init__(self, templates: dict[str, list[str]], threshold: float) -> None:
        self.threshold = threshold
        self.known = []
        for name, texts in templates.items():
            for text in texts:
                words = item_words(text.encode("utf-8"))
                bag = Counter(zip(words, words[1:]))
                if bag:
                    self.known.append((len(words) - 1, name, bag))
        self.known.sort(key=lambda x: x[:2])
        self.ratio = threshold / (2 - threshold)
        sizes = [n for n, _, _ in self.known] or [0]
        self.least, self.most = sizes[0] * self.ratio, sizes[-1] / self.ratio
        self.holders: dict[tuple, list[int]] = {}
        for k, (_, _, grams) in enumerate(self.known):
            for g in grams:
                self.holders.setdefault(g, []).append(k)

    def best(self, words: list[bytes]) -> tuple[float, str] | None:
        """Highest score of a passage and its licence; ties: the first name."""
        n = len(words) - 1
        if n < 1 or not self.least <= n <= self.most:
            return None
        bag, found = None, None
        for size, name, grams in self.known:
            if not size * self.ratio <= n <= size / self.ratio:
                continue
            bag = bag or Counter(zip(words, words[1:]))
            score = dice(bag, n, grams, size)
            if score >= self.threshold and (found is None or (-score, name) < (-found[0], found[1])):
                found = (score, name)
        return found

    def windows(self, words: list[bytes]) -> list[tuple[int, int, str, float]]:
        """(first word, last word, licence, score): the best windows that do not overlap.

        Higher scores go first, then earlier, shorter ones and names.
        """
        places: dict[int, list[int]] = {}
        shared = [(i, g) for i, g in enumerate(zip(words, words[1:])) if g in self.holders]
        for i, g in shared:
            for k in self.holders[g]:
                places.setdefault(k, []).append(i)
        found = []
        for k, at in places.items():
            size, name, grams = self.known[k]
            # the smallest window allowed needs so many common bigrams
            needed = self.threshold * (size + size * self.ratio) / 2 - 1e-9
            if len(at) < needed:
                continue
            most = size / self.ratio + 1e-9
            for s, start in enumerate(at):
                # as many places must follow within the longest window
                if (last := s + int(-(-needed // 1)) - 1) >= len(at) or at[last] - start >= most:
                    continue
                seen, common = Counter(), 0
                for end in at[s:]:
                    n = end - start + 1
                    if n > most:
                        break
                    g = words[end], words[end + 1]
                    seen[g] += 1
                    common += seen[g] <= grams[g]
                    score = 2 * common / (n + size)
                    if score >= self.threshold:
                        found.append((-score, start, end + 1, name))
        taken, out = Spans(), []
        for score, start, last, name in sorted(found):
            if taken.add(start, last):
                out.append((start, last, name, -score))
        return sorted(out)

    def scan(self, text: bytes) -> list[tuple[int, int, str, float]]:
        """(first line, lines, licence, score) of every passage that matches, then
        of every window that shares no word with a passage of the same licence."""
        hits, block, at = [], [], 0
        spans: dict[str, Spans] = {}  # words of the matching passages

        lines = [item_words(x) for x in text.split(b"\n")]
        starts = [0, *accumulate(map(len, lines))]
        everything = [w for x in lines for w in x]

        def look(first, count, words):
            found = self.best(words)
            if found:
                hits.append((first, count, found[1], found[0]))
                spans.setdefault(found[1], Spans()).join(starts[first], starts[first + count] - 1)

        for i, words in enumerate([*lines, []]):
            if words:
                look(i, 1, words)
                block.append(words)
                continue
            if len(block) > 1 and (at, i) != (0, len(lines)):
                look(at, len(block), [w for x in block for w in x])
            block, at = [], i + 1
        if sum(map(bool, lines)) > 1:
            look(0, len(lines), everything)
        for start, last, name, score in self.windows(everything):
            if name not in spans or not spans[name].meets(start, last):
                first, end = (bisect_right(starts, w) - 1 for w in (start, last))
                hits.append((first, end - first + 1, name, score))
        return hits


class Spans:
    """Disjoint spans of words, both ends included."""

    def __init__(self) -> None:
        self.firsts: list[int] = []
        self.lasts: list[int] = []

    def meets(self, first: int, last: int) -> bool:
        """Does a span share a word with this one?"""
        k = bisect_right(self.firsts, last) - 1
        return k >= 0 and self.lasts[k] >= first

    def add(self, first: int, last: int) -> bool:
        """Add a span unless it meets one."""
        if self.meets(first, last):
            return False
        k = bisect_right(self.firsts, first)
        self.firsts.insert(k, first)
        self.lasts.insert(k, last)
        return True

    def join(self, first: int, last: int) -> None:
        """Add a span, united with those that it meets."""
        while self.meets(first, last):
            k = bisect_right(self.firsts, last) - 1
            first, last = min(first, self.firsts.pop(k)), max(last, self.lasts.pop(k))
        self.add(first, last)


def scan_licenses(df: DataFrame, text_col: str, keep: list, threshold: float = 0.8,
                  templates: dict[str, list[str]] | None = None) -> DataFrame:
    """``keep`` columns plus the licences found in every whole text.

    ``license`` is the best match's (highest score, then name), null if none;
    ``score`` its Dice coefficient, 0 if none; ``matches`` lists every passage
    that matches, and every window that is no part of one of the same licence:
    first line, number of lines, licence, score. Null and empty texts match
    nothing. One pass, no shuffle.
    """
    chosen = TEMPLATES if templates is None else templates

    def start():
        known = TemplateSet(chosen, threshold)

        def look(text):
            hits = known.scan(text)
            best = min(hits, key=lambda h: (-h[3], h[2]), default=(0, 0, None, 0.0))
            rows = [{"line": a, "lines": b, "license": c, "score": d} for a, b, c, d in hits]
            return best[2], best[3], rows

        return look

    match = T.StructType([T.StructField("line", T.IntegerType()),
                          T.StructField("lines", T.IntegerType()),
                          T.StructField("license", T.StringType()),
                          T.StructField("score", T.DoubleType())])
    return map_text(df, keep, text_col, start, [
        T.StructField("license", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("matches", T.ArrayType(match))])
