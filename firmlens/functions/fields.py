"""Result-row fields: totals, summary, labels, item text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import COUNTED_SIGNALS, DETAIL_COLUMNS, USA_REGIONS


def filled(col: Column) -> Column:
    """NULL for an empty text."""
    return F.nullif(col, F.lit(""))


def count_signals(prefix: str = "") -> Column:
    """Number of counted flags set in a result row."""
    total = F.lit(0)
    for name in COUNTED_SIGNALS:
        total = total + F.coalesce(F.col(prefix + name), F.lit(False)).cast("int")
    return total


def compose_summary(limit: int = 500) -> Column:
    """`label: detail` of every filled detail, in fixed order."""
    parts = [F.concat(F.lit(f"{label}: "), filled(F.col(column)))
             for column, label in DETAIL_COLUMNS.values()]
    return F.substring(F.concat_ws("; ", *parts), 1, limit)


def merge_ops(ops: Column, shutdown: Column) -> Column:
    return F.concat_ws(" | ", filled(ops), filled(shutdown))


def is_usa_region(col: Column) -> Column:
    return F.coalesce(col.isin(*USA_REGIONS), F.lit(False))


def tick(flag: Column) -> Column:
    return F.when(flag, "✓").otherwise("—")


# Tags of the feeds whose items show a date, and of those that do not.
DATED_TAGS = {"google_news": "GOOGLE NEWS", "guardian": "GUARDIAN",
              "prnewswire": "PR NEWSWIRE", "businesswire": "BUSINESS WIRE",
              "brave": "BRAVE WEB", "brave_news": "BRAVE NEWS"}
UNDATED_TAGS = {"wikipedia": "WIKIPEDIA", "tavily": "TAVILY"}


def section_text(source: Column, title: Column, raw_date: Column, url: Column,
                 snippet: Column, domain: Column) -> Column:
    """Text block of one item, laid out per source; expects the snippet already cut."""
    tags = {**DATED_TAGS, **UNDATED_TAGS}
    tag = F.try_element_at(F.create_map(*[F.lit(x) for pair in tags.items() for x in pair]),
                           source)
    date = F.when(source.isin(*DATED_TAGS), F.concat(F.lit(" ("), raw_date, F.lit(")"))
                  ).otherwise("")
    filing = F.concat(  # the filing's form type travels in `domain`
        F.lit("[SEC EDGAR "), F.coalesce(filled(domain), F.lit("8-K")), F.lit("] "), title,
        F.lit(" — "), raw_date, F.lit("\n"), snippet, F.lit("\n"), url)
    listed = F.concat(F.lit("[GDELT] "), title, F.lit(" ("), raw_date, F.lit(") — "), domain,
                      F.lit("\n"), url)
    told = F.concat(F.lit("["), tag, F.lit("] "), title, date, F.lit("\n"), url, F.lit("\n"),
                    snippet)
    return F.when(source == "edgar", filing).when(source == "gdelt", listed).otherwise(told)
