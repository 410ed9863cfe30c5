"""Date horizon, year terms and raw feed dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HORIZONS = (6, 12, 24)


def horizon_months(months: int) -> int:
    return months if months in HORIZONS else 12


def horizon_start(end: Column, months: int) -> Column:
    """`months` before `end`, the day clamped to the month's last."""
    return F.add_months(end, -horizon_months(months))


def horizon_label(end: Column, months: int) -> Column:
    m = horizon_months(months)
    return F.concat(F.date_format(horizon_start(end, m), "yyyy-MM-dd"), F.lit(" – "),
                    F.date_format(end, "yyyy-MM-dd"), F.lit(f" ({m} months)"))


def year_terms(start: Column, end: Column) -> Column:
    """Every year from start to end, joined for a search query."""
    years = F.sequence(F.year(start), F.year(end))
    return F.array_join(F.transform(years, lambda y: y.cast("string")), " OR ")


def parse_published(raw: Column) -> Column:
    """Feed dates of the known shapes as a UTC timestamp; NULL where none fits."""
    return F.coalesce(
        F.try_to_timestamp(F.substring(raw, 1, 8), F.lit("yyyyMMdd")),
        F.try_to_timestamp(F.substring(raw, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")),
        F.try_to_timestamp(F.substring(raw, 1, 10), F.lit("yyyy-MM-dd")),
        # RFC 822: the weekday name is dropped, it adds nothing and may be wrong.
        F.try_to_timestamp(F.regexp_extract(raw, r"(\d{1,2} \w{3} \d{4} \d{2}:\d{2}:\d{2})", 1),
                           F.lit("d MMM yyyy HH:mm:ss")),
    )


def runtime_label(seconds: Column) -> Column:
    whole = F.floor(seconds)
    return F.format_string("%dm %ds", F.floor(whole / 60), whole % 60)
