"""The feeds' own searches over landed items: a company's name as a phrase, any of some words, a
section, a form type and a date window, per feed and query as rows of a rule table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import horizon_start, parse_published
from ..functions.names import normalise_words
from ..params import FILING_FORM, NEWS_WORDS, Params
from ..sources.search_index import SearchIndex
from .mentions import name_keys

RULE_TYPE = ("source string, query_rank int, any_of array<string>, with_years boolean, "
             "section string, form string, windowed boolean")


@dataclass(frozen=True)
class Rule:
    """One query of a feed. `any_of`: words or phrases of which the item must hold one; the years of
    the window count among them with `with_years`. `section`, `form`: fixed values, a form by its
    beginning; items without one pass. `windowed`: only items of the window, or without a date."""

    source: str
    query_rank: int = 1
    any_of: tuple[str, ...] = ()
    with_years: bool = False
    section: str | None = None
    form: str | None = None
    windowed: bool = True


def _words(*names: str) -> tuple[str, ...]:
    return tuple(w for w in NEWS_WORDS if w in names)


# What each feed's queries ask for.
NEWS_RULES = (
    Rule("edgar", form=FILING_FORM),
    Rule("google_news", 1, _words("merger", "acquisition", "bankruptcy", "shutdown", "restructuring",
                                  "rebranding", "renamed", "relocated"), with_years=True),
    Rule("google_news", 2, with_years=True),
    Rule("gdelt", any_of=_words("merger", "acquisition", "bankruptcy", "shutdown", "restructuring",
                                "renamed", "rebranded", "relocated", "spinoff", "headquarters", "new name")),
    Rule("guardian", any_of=_words("merger", "acquisition", "bankruptcy", "restructuring", "renamed",
                                   "redomicile", "spinoff", "shutdown", "new name"), section="business"),
)


def rule_table(spark: SparkSession, rules: Sequence[Rule] = NEWS_RULES) -> DataFrame:
    return spark.createDataFrame(
        [(r.source, r.query_rank, list(r.any_of), r.with_years, r.section, r.form, r.windowed)
         for r in rules], RULE_TYPE)


def search_landed(index: SearchIndex, companies: DataFrame, as_of: Column,
                  rules: DataFrame | None = None, params: Params = Params(),
                  days: tuple[str, str] | None = None) -> DataFrame:
    """Landed items of the searched feeds, once for each company and query that finds them: the
    index's item columns, with company and query_rank set by the search.

    Item columns read here: source, raw_date, and, for rules that name them, section and domain (the
    form). The rule table is as small as the feeds are few; nothing else is assumed to be small."""
    rules = rule_table(index.spark) if rules is None else rules
    names = name_keys(companies).select("company", normalise_words(F.col("key")).alias("phrase"))
    day = F.to_date(as_of)
    since = horizon_start(day, params.horizon_months)
    years = F.transform(F.sequence(F.year(since), F.year(day)), lambda y: y.cast("string"))
    terms = F.concat("any_of", F.when(F.col("with_years"), years).otherwise(
        F.array().cast("array<string>")))
    rules = rules.withColumn("terms", F.transform(terms, normalise_words)).select(
        F.col("source").alias("r_source"), F.col("query_rank").alias("r_rank"), "terms",
        F.col("section").alias("r_section"), "form", "windowed")

    hits = index.phrases(names, days)
    items = index.items(days)
    for column in ("section", "domain"):
        if column not in items.columns:
            items = items.withColumn(column, F.lit(None).cast("string"))
    when = F.to_date(parse_published(F.col("raw_date")))
    section, form = F.coalesce("section", F.lit("")), F.coalesce("domain", F.lit(""))
    found = items.drop("company", "query_rank").join(
        F.broadcast(rules), (F.col("source") == F.col("r_source"))
        & (~F.col("windowed") | when.isNull() | when.between(since, day))
        & (F.col("r_section").isNull() | (section == "") | (section == F.col("r_section")))
        & (F.col("form").isNull() | (form == "") | form.startswith(F.col("form"))))
    found = found.join(hits, "item")
    # Only what a name and the fixed values let through is asked for words.
    free = found.where(F.size("terms") == 0).drop("terms")
    asked = found.where(F.size("terms") > 0)
    words = index.phrases(rules.select(F.explode("terms").alias("phrase")), days)
    held = (rules.select("r_source", "r_rank", F.explode("terms").alias("phrase"))
            .join(words, "phrase").select("r_source", "r_rank", "item").distinct())
    asked = asked.join(held, ["r_source", "r_rank", "item"], "left_semi").drop("terms")
    rows = free.unionByName(asked.select(*free.columns)).join(names, "phrase")
    kept = [c for c in index.items(days).columns if c not in ("company", "query_rank", "item", "day")]
    return rows.select("company", F.col("r_rank").alias("query_rank"), *kept)
