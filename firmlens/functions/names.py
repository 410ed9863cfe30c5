"""Company-name cleaning and cache keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms and generic words removed from a name anywhere in it.
STRONG_SUFFIXES = (
    r"plc", r"ltd", r"llc", r"inc\.?", r"corp\.?", r"co\.?", r"s\.a\.b?\.?", r"ag", r"gmbh",
    r"bv", r"nv", r"pty", r"holdings?", r"group", r"international", r"industries",
    r"enterprises", r"limited", r"incorporated", r"associates", r"partners",
)
# The shorter list used by the keyword gate.
LIGHT_SUFFIXES = (r"plc", r"ltd", r"llc", r"inc\.?", r"corp\.?", r"group", r"holdings?")


def _suffix_pattern(words: tuple[str, ...]) -> str:
    # (?U): \b and \w follow Unicode, not ASCII.
    return r"(?iuU)\b(?:" + "|".join(words) + r")\b\.?"


def squeeze(col: Column) -> Column:
    """Runs of whitespace to one blank, none at the ends."""
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def clean_name(col: Column) -> Column:
    """Strong form: suffix words out, punctuation to blanks. May come out empty."""
    bare = F.regexp_replace(col, _suffix_pattern(STRONG_SUFFIXES), "")
    return squeeze(F.regexp_replace(bare, r"(?U)[^\w\s]", " "))


def clean_name_light(col: Column) -> Column:
    """Light form: a few suffix words out, punctuation kept."""
    return F.trim(F.regexp_replace(col, _suffix_pattern(LIGHT_SUFFIXES), ""))


def normalise_words(col: Column) -> Column:
    """Lower case, punctuation to blanks: puts a text on the same footing as a cleaned name."""
    return F.trim(F.regexp_replace(F.lower(col), r"[^\p{L}\p{M}\p{N}_]+", " "))


def truncate(col: Column, n: int) -> Column:
    return F.substring(col, 1, n)


def week_bucket(day: Column) -> Column:
    """Year and Monday-based week number, week 00 before the first Monday."""
    week = F.floor((F.dayofyear(day) + F.lit(6) - F.weekday(day)) / F.lit(7))
    return F.concat(F.date_format(day, "yyyy"), F.lit("-W"),
                    F.lpad(week.cast("string"), 2, "0"))


def cache_key(company: Column, day: Column, stage: Column | None = None) -> Column:
    """Sixteen hex digits naming a company's fetch in one week (and stage, when given)."""
    parts = [F.lower(F.trim(company)), week_bucket(day)] + ([stage] if stage is not None else [])
    return F.substring(F.sha2(F.concat_ws("::", *parts), 256), 1, 16)
