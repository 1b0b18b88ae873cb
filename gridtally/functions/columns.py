"""Scalar Column helpers: casts, tags, clock text, whitespace tokens."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def cast_all_except(df: DataFrame, keep: Iterable[str], to: str = "double") -> DataFrame:
    """Cast every column not in ``keep`` to ``to``; order and names are kept.

    Uses ``try_cast``: text that is not a number becomes NULL instead of
    failing the job under ANSI mode.
    """
    keep = set(keep)
    return df.select([F.col(c) if c in keep else F.col(c).try_cast(to).alias(c)
                      for c in df.columns])


def cast_all_except_counted(df: DataFrame, keep: Iterable[str], to: str = "double",
                            counted: Iterable[str] | None = None) -> tuple[DataFrame, Observation]:
    """``cast_all_except`` that also counts the texts it could not read.

    The counts are metrics of the same pass (``DataFrame.observe``): once an action has
    run on the result, ``cast_losses`` turns the observation into (present, lost) by
    column. ``counted`` names the columns (default: all that are cast); only these are
    read in addition to what the action needs. Rows that a limit or a retry reads
    more than once, or not at all, count accordingly.
    """
    keep = set(keep)
    names = [c for c in df.columns if c not in keep] if counted is None else list(counted)
    seen = Observation()
    if not names:
        return cast_all_except(df, keep, to), seen
    metrics = []
    for k, c in enumerate(names):
        metrics += [F.count(F.col(c)).alias(f"present_{k}"),
                    F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(to).isNull()).alias(f"lost_{k}")]
    seen._gt_names = names
    return cast_all_except(df.observe(seen, *metrics), keep, to), seen


def cast_losses(seen: Observation) -> dict[str, tuple[int, int]]:
    """Column -> (texts present, texts that became NULL), after an action has run."""
    names = getattr(seen, "_gt_names", [])
    found = seen.get if names else {}
    return {c: (found[f"present_{k}"], found[f"lost_{k}"]) for k, c in enumerate(names)}


def env_tag(indicator, indoor: str = "Indoor", outdoor: str = "Outdoor") -> Column:
    """``Indoor`` when the indicator equals it, else ``Outdoor`` (NULL too)."""
    c = F.col(indicator) if isinstance(indicator, str) else indicator
    return F.when(c == indoor, F.lit(indoor)).otherwise(F.lit(outdoor))


def _clock(hhmm) -> Column:
    """``HHMM`` text from 0000 to 2359; anything else gives NULL."""
    c = F.col(hhmm) if isinstance(hhmm, str) else hhmm
    return F.when(c.rlike("^([01][0-9]|2[0-3])[0-5][0-9]\\z"), c)


def clock_minutes(hhmm) -> Column:
    """Minutes after midnight of an ``HHMM`` text (int); bad text gives NULL."""
    c = _clock(hhmm)
    return (F.substring(c, 1, 2).cast("int") * 60 + F.substring(c, 3, 2).cast("int"))


def clock_decimal_hours(hhmm) -> Column:
    """``HH + round(MM / 60, 2)`` of an ``HHMM`` text; bad text gives NULL."""
    c = _clock(hhmm)
    return F.substring(c, 1, 2).cast("int") + F.round(F.substring(c, 3, 2).cast("int") / 60.0, 2)


def clock_to_timestamp(day, hhmm) -> Column:
    """Timestamp (without time zone) of ``HHMM`` text on a date column.

    NULL where the text is bad or the date NULL.
    """
    d = F.col(day) if isinstance(day, str) else day
    m = clock_minutes(hhmm)
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                F.floor(m / 60).cast("int"), (m % 60).cast("int"), F.lit(0))


# ---- fixed values: the characters Python's str.split() treats as whitespace
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ---------------------------------------------------------------------------
WHITESPACE_CLASS = "[" + WHITESPACE_CHARS + "]"


def whitespace_tokens(text) -> Column:
    """``text.split()`` as an array column: tokens are the maximal runs of
    non-whitespace characters, so blank text gives an empty array.

    Every whitespace character is first mapped to a plain space with
    ``translate`` (a per-character table lookup), then the text is split on
    runs of spaces; only the empty strings of leading or trailing blanks need
    removing. A regex class holding the non-ASCII whitespace was 7 times
    slower on long documents.
    """
    c = F.col(text) if isinstance(text, str) else text
    spaced = F.translate(c, WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))
    return F.array_remove(F.split(spaced, " +"), "")
