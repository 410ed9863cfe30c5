"""Tolerant reading of model answers and of stored JSON, on the VARIANT type."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _as_object(text: Column) -> Column:
    """VARIANT of a JSON object; NULL for anything else. Valid JSON that opens with a brace is
    an object."""
    return F.when(text.startswith("{"), F.try_parse_json(text))


def parse_answer(raw: Column) -> Column:
    """Object in a model answer: code fence off the ends, then the whole text, then the span
    from the first to the last brace."""
    text = F.regexp_replace(strip(raw), r"\A```(?:json)?\s*", "")
    text = F.regexp_replace(strip(text), r"\s*```\z", "")
    return let(text, lambda t: F.coalesce(
        _as_object(t), _as_object(F.regexp_extract(t, r"(?s)\{.*\}", 0))))


def parse_score_answer(raw: Column) -> Column:
    """Object in a short answer: fences and backticks off, then up to the first closing brace
    (so a nested object does not parse)."""
    text = strip(F.regexp_replace(raw, r"```(?:json)?", ""))
    text = F.regexp_replace(text, r"\A`+|`+\z", "")
    return _as_object(F.regexp_extract(text, r"(?s)\{.*?\}", 0))


def read_answers(answers: DataFrame, fields: Mapping[str, Callable[[Column], Column]],
                 keep: Sequence[str], unreadable: bool = False) -> DataFrame:
    """`keep` columns plus fields of each row's parsed `raw`; rows that do not parse are dropped,
    or kept with NULL fields.

    The fields leave through a generator. Filters on them stay above it, so that every answer
    is parsed once: pushed into the scan, each condition would parse it again.
    """
    objects = F.filter(F.array(parse_answer(F.col("raw"))), lambda o: o.isNotNull())
    rows = F.transform(objects, lambda o: F.struct(*[f(o).alias(n) for n, f in fields.items()]))
    return answers.select(*keep, F.inline_outer(rows) if unreadable else F.inline(rows))


def text_field(obj: Column, name: str) -> Column:
    """Field as text; missing or null gives an empty string."""
    return F.coalesce(F.try_variant_get(obj, f"$.{name}", "string"), F.lit(""))


#: Texts that mean no where a yes or no is asked for.
NO_TEXTS = ("", "false", "no", "0")


def truth(value: Column, plain: bool = False) -> Column:
    """A JSON value read as a yes or no; NULL where there is none. True, numbers but 0, lists and
    objects with something in them, and texts other than `NO_TEXTS` are a yes (`plain`: all texts
    but the empty one)."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    yes = text != "" if plain else ~F.lower(F.trim(text)).isin(*NO_TEXTS)
    return (F.when(value.isNull(), F.lit(None).cast("boolean"))
            .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
            .when(kind == "VOID", False).when(kind == "STRING", yes)
            .when(kind.rlike("^(ARRAY|OBJECT)"), ~F.to_json(value).isin("[]", "{}"))
            .otherwise(F.coalesce(F.try_variant_get(value, "$", "double") != 0, F.lit(False))))


def flag_field(obj: Column, name: str, plain: bool = False) -> Column:
    """Field as a yes or no; missing is a no."""
    value = F.try_variant_get(obj, f"$.{name}", "variant")
    return F.coalesce(truth(value, plain), F.lit(False))


def newest_answers(answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One answer (keys, raw) per key: the newest by `answered_at`, if there is such a column, and of
    answers of one time the last by its text. A retried call leaves several."""
    order = [c for c in ("answered_at",) if c in answers.columns]
    return (answers.groupBy(*keys).agg(F.max(F.struct(*order, "raw")).alias("_a"))
            .select(*keys, "_a.raw"))


def int_field(obj: Column, name: str) -> Column:
    """Field as an integer: numbers truncate, digit strings convert, all else is NULL."""
    value = F.try_variant_get(obj, f"$.{name}", "variant")
    text = F.try_variant_get(value, "$", "string")
    digits = F.when(text.rlike(r"\A\s*[+-]?\d+\s*\z"), F.trim(text).try_cast("int"))
    number = F.try_variant_get(value, "$", "double").try_cast("int")
    return F.when(F.schema_of_variant(value) == "STRING", digits).otherwise(number)


def encode_list(col: Column) -> Column:
    return F.to_json(F.coalesce(col, F.array().cast("array<string>")))


def decode_list(col: Column) -> Column:
    """Stored list of strings; anything unreadable gives an empty list."""
    value = F.try_variant_get(F.try_parse_json(col), "$", "array<string>")
    return F.coalesce(value, F.array().cast("array<string>"))
