from __future__ import annotations

import random

import pytest

from tests.conftest import SF01

LONG = "x" * 70_000


def odd_documents() -> list[tuple]:
    """(id, text): nulls, blanks, ties, repeated rows, long texts, near copies."""
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma.", "déjà", "über", "naïve", "日本語", "x1", "#tag", "the"]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + str(rng.randrange(60)) for _ in range(n))

    base = prose(300)
    copies = [base, base, base.replace(" ", "  "), base.upper(), base + " tail", base[:-6]]
    lines = ["A shared line that many documents hold", "  a SHARED line that many documents hold\t",
             "short", "", "another line found in a few documents only"]
    docs = [(i, t) for i, t in enumerate(copies)]
    docs += [(10, None), (11, ""), (12, " \n\t \x0b"), (13, "one"), (14, "one two"),
             (15, "One  TWO"), (16, LONG), (17, LONG + " " + LONG), (None, "no id at all here"),
             (None, base), (18, "x\x00y\x1cz a\x85b c d e\xa0f"), (19, "line\r\nline\r\n\r\n")]
    docs += [(20 + i, "\n".join([prose(5), lines[i % 2], lines[4] if i < 4 else lines[2], prose(3),
                                 lines[0] if i == 3 else ""])) for i in range(6)]
    docs += [(21, docs[-5][1]), (3, base), (3, "another text under the same id")]
    docs += [(40 + i, prose(rng.randrange(1, 400))) for i in range(25)]
    docs += [(70, ("ab " * 5 + "cd ef gh ") * 900), (71, "a b c a b c a b"), (72, "!" * 500),
             (73, "<|endoftext|> don't we'LL  \n\n 12345 \U0001f600\U0001f600")]
    return docs


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents with every usual column and some that clash."""
    rows = [(d, t, "en", None if i % 7 == 0 else "src0", None if t is None else len(t), i, "k",
             [1, None]) for i, (d, t) in enumerate(odd_documents())]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
        "fp int, `shard` string, `n.words` array<int>")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet")


@pytest.fixture(scope="session")
def pairs(documents):
    return [tuple(r) for r in documents.select("doc_id", "text").collect()]
