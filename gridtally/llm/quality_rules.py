"""Quality rules as weak supervision, in DataFrame functions only.

Each rule looks at a document's counts and votes: 1 (keep), -1 (reject) or 0
(abstain). Which rules are right how often is not known beforehand. The votes of
all documents are counted by pattern (at most 3^rules patterns, whatever the
table's size), and expectation-maximisation on those counts estimates the share
of good documents and, per rule, how often it votes each way on good and on bad
ones. A document's posterior probability of being good, a sum of log odds over
its votes, replaces the all-must-pass filter.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import cut, kept_beside

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: name and measures (numerator, denominator, low, high). A rule rejects if a
#: measure is above ``high``, keeps if all are at most ``low``, else abstains.
#: Measures of one defect share a rule, as rules should err independently.
RULES = (
    ("symbols", (("n_symbols", "n_words", 0.02, 0.15),)),
    ("redundancy", (("n_repeat_words", "n_words", 0.25, 0.45),
                    ("n_dup_lines", "n_lines", 0.1, 0.35))),
    ("shouting", (("n_upper", "word_chars", 0.25, 0.5), ("n_marks", "n_words", 0.05, 0.3))),
    ("word_length", (("word_chars", "n_words", 11.0, 15.0), ("n_words", "word_chars", 0.4, 0.55))),
    ("length", (("1", "n_words", 0.02, 0.034),)),
)

#: A rule that rejects is right at least so often, and so is the view that a
#: text which no rule rejects is good. Without these bounds the estimate may call
#: a defect that only one rule sees a habit of good texts.
MIN_PRECISION = 0.95

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
          "n_upper", "n_marks")


def with_counts(df: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` columns plus the counts of every whole text, as ``_gt_<count>``.

    ``n_words`` words ``[^\\x20\\x09-\\x0D]+``; ``word_chars`` code points in
    words; ``n_symbols`` characters of ``[#*$%&|<>]``; ``n_lines`` lines with a
    word; ``n_dup_lines`` those equal to an earlier line; ``n_repeat_words``
    words inside 3-word windows found twice or more in the text; ``n_upper``
    and ``n_marks``, A-Z and exclamation marks. A null text counts as empty.

    Everything stays within the row: repeated windows are found by sorting the
    64-bit hashes of the text's windows, so nothing is exploded or shuffled.
    """
    names = [f"_gt_k{i}" for i in range(len(keep))]
    titles = df.select(*keep).columns
    rows = df.select(*[c.alias(n) for c, n in zip(keep, names)],
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_gt_text"))
    spaced = F.translate("_gt_text", SPACES, " " * len(SPACES))
    rows = rows.withColumns({
        "_gt_words": F.array_remove(F.split(spaced, " "), ""),
        "_gt_lines": F.filter(F.split("_gt_text", "\n"),
                              lambda x: F.length(F.translate(x, SPACES, "")) > 0),
    })
    n = F.size("_gt_words")
    windows = F.transform(
        F.slice("_gt_words", 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get("_gt_words", i + 1),
                                         F.get("_gt_words", i + 2)).alias("h"), i.alias("i")))
    rows = rows.withColumn("_gt_windows", F.sort_array(windows))
    at = F.col("_gt_windows")
    again = F.filter(at, lambda x, k: F.get(at, k + 1)["h"].eqNullSafe(x["h"])
                     | F.get(at, k - 1)["h"].eqNullSafe(x["h"]))
    covered = F.array_distinct(F.flatten(F.transform(
        again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    total = F.length("_gt_text")
    counts = {
        "n_words": n,
        "word_chars": F.length(F.translate("_gt_text", SPACES, "")),
        "n_symbols": total - F.length(F.translate("_gt_text", SYMBOLS, "")),
        "n_lines": F.size("_gt_lines"),
        "n_dup_lines": F.size("_gt_lines") - F.size(F.array_distinct("_gt_lines")),
        "n_repeat_words": F.size(covered),
        "n_upper": total - F.length(F.translate("_gt_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")),
        "n_marks": total - F.length(F.translate("_gt_text", "!", "")),
    }
    return rows.select(*[F.col(k).alias(t) for k, t in zip(names, titles)],
                       *[counts[k].cast("long").alias(f"_gt_{k}") for k in COUNTS])


def votes() -> Column:
    """The rules' votes as an array of 1, -1 and 0 (also where nothing can be divided)."""
    def share(top: str, bottom: str) -> Column:
        numerator = F.lit(1) if top == "1" else F.col(f"_gt_{top}")
        return F.try_divide(numerator.cast("double"), F.col(f"_gt_{bottom}").cast("double"))

    ballot = []
    for _, measures in RULES:
        high, low = F.lit(False), F.lit(True)
        for top, bottom, least, most in measures:
            high, low = high | (share(top, bottom) > most), low & (share(top, bottom) <= least)
        ballot.append(F.when(high, -1).when(low, 1).otherwise(0))
    return F.array(*ballot)


@dataclass(frozen=True)
class RuleModel:
    """Share of good documents; per rule P(reject | it votes, good) and (.. bad)."""

    prior: float
    alarm: tuple[float, ...]
    recall: tuple[float, ...]

    def weights(self) -> list[tuple[float, float]]:
        """Log odds for good that a rule's keep and reject vote add."""
        return [(log((1 - a) / (1 - r)), log(a / r)) for a, r in zip(self.alarm, self.recall)]

    def posterior(self, ballot) -> float:
        """Probability of good for one document's votes."""
        total = log(self.prior / (1 - self.prior)) + sum(
            keep if v > 0 else reject if v < 0 else 0.0
            for v, (keep, reject) in zip(ballot, self.weights()))
        return 1 / (1 + exp(-max(-500.0, min(500.0, total))))


def fit_rules(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> RuleModel:
    """Expectation-maximisation over (votes, number of documents) patterns.

    Starts from "good unless some rule rejects". Rates are smoothed by one vote
    each way; ``MIN_PRECISION`` bounds precisions as said there. No
    documents: prior 1/2, and every rule at its bound.
    """
    total = sum(n for _, n in patterns)
    good_part = [0.01 if min(ballot) < 0 else 0.99 for ballot, _ in patterns]
    model = None
    for _ in range(rounds):
        prior = (sum(p * n for p, (_, n) in zip(good_part, patterns)) + 1) / (total + 2)
        alarm, recall = [], []
        for k in range(len(RULES)):
            cast = [(p, n, ballot[k]) for p, (ballot, n) in zip(good_part, patterns) if ballot[k]]
            good = sum(p * n for p, n, _ in cast) + 2
            bad = sum((1 - p) * n for p, n, _ in cast) + 2
            wrong = sum(p * n for p, n, v in cast if v < 0) + (1 - MIN_PRECISION)
            right = sum((1 - p) * n for p, n, v in cast if v < 0) + MIN_PRECISION
            rejected = wrong + right
            wrong = min(wrong, (1 - MIN_PRECISION) * rejected)
            alarm.append(wrong / good)
            recall.append(min(0.95, max(wrong / good, (rejected - wrong) / bad)))
        new = RuleModel(prior, tuple(alarm), tuple(recall))
        if new == model:
            break
        model = new
        good_part = [p if min(ballot) < 0 else max(p, MIN_PRECISION) for p, ballot in
                     ((model.posterior(ballot), ballot) for ballot, _ in patterns)]
    return model


def learn_rules(counted: DataFrame) -> RuleModel:
    """Count the vote patterns of all rows and fit the model on them."""
    by = counted.groupBy(votes().alias("ballot")).agg(F.count(F.lit(1)).alias("n"))
    return fit_rules(sorted((tuple(r.ballot), r.n) for r in by.collect()))


def posterior(model: RuleModel) -> Column:
    """A row's probability of being good under the model."""
    total, ballot = F.lit(log(model.prior / (1 - model.prior))), votes()
    for k, (keep, reject) in enumerate(model.weights()):
        v = ballot.getItem(k)
        total = total + F.when(v > 0, keep).when(v < 0, reject).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    n, again = F.col("_gt_n_words"), F.col("_gt_n_repeat_words")
    return (n < 50) | (100 * again > 50 * n)


def judge(df: DataFrame, text_col: str, keep: list[Column], min_posterior: float = 0.5) -> DataFrame:
    """``keep`` columns, ``counts``, ``base_failed``, ``posterior`` and ``kept`` per row.

    The counts are checkpointed: a few longs per document, so that texts are
    read and counted once. Equal texts get equal verdicts; empty tables none. Kept
    columns that are called like a result column give way.
    """
    keep = kept_beside(df, keep, "counts", "base_failed", "posterior", "kept")
    held = [F.struct(*keep).alias("_gt_kept")] if keep else []
    counted = cut(with_counts(df, text_col, held))
    model = learn_rules(counted)
    packed = F.struct(*[F.col(f"_gt_{k}").alias(k) for k in COUNTS]).alias("counts")
    own = ["_gt_kept.*"] if keep else []
    verdict = ~base_failed() & (posterior(model) >= min_posterior)
    return counted.select(*own, packed, base_failed().alias("base_failed"),
                          posterior(model).alias("posterior"), verdict.alias("kept"))


def keep_good(df: DataFrame, text_col: str, min_posterior: float = 0.5) -> DataFrame:
    """The rows of ``df`` that pass, all columns unchanged.

    Counts are taken twice, for the votes and for the verdicts, so that texts
    are neither copied nor shuffled.
    """
    counted = cut(with_counts(df, text_col, []))
    model = learn_rules(counted)
    rows = with_counts(df, text_col, [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_gt_kept")])
    passed = ~base_failed() & (posterior(model) >= min_posterior)
    # Catalyst pushes a filter below deterministic columns and would write the
    # counts out again for each of their uses in it; a row number among them
    # keeps it above, so that texts are counted once.
    rows = rows.withColumn("_gt_row", F.monotonically_increasing_id())
    return rows.filter(passed & (F.col("_gt_row") >= 0)).select("_gt_kept.*")
