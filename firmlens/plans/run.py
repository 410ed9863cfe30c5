"""Whole runs: companies and landed tables in, result rows out.

Lazy up to the append; the model steps are tables (or `score_batch` outputs) handed in, so
Catalyst sees one plan from scan to result.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import horizon_start, parse_published
from ..functions.text import sanitise
from ..operators.evidence import (add_sections, assemble, cut_snippets, dedupe_capped,
                                  dedupe_then_cap, drop_short_extracts, known_feeds, merge_deep)
from ..operators.extraction import classify
from ..operators.lifecycle import todo
from ..operators.mentions import attach_companies
from ..operators.screening import decide
from ..params import FILING_FORM, HORIZON_FEEDS, LAYERED_SOURCES, Params
from ..sources import cache as fetch_cache
from ..sources.companies import first_companies

# Fields of a cached fetch. The calls are the searches of the paid feeds whose items landed.
RECORD = ("headline_text", "context", "chunks", "sources", "char_count", "source_breakdown",
          "tavily_calls", "brave_calls")
RECORD_TYPE = ("struct<headline_text:string,context:string,chunks:array<string>,"
               "sources:array<string>,char_count:bigint,source_breakdown:map<string,bigint>,"
               "tavily_calls:int,brave_calls:int>")


def paid_calls(items: DataFrame) -> DataFrame:
    """(company, tavily_calls, brave_calls): how many of each paid feed's queries handed items over."""
    per_query = items.filter(F.col("source").isin("tavily", "brave")).select(
        "company", "source", "query_rank").distinct()
    return per_query.groupBy("company").agg(
        F.count_if(F.col("source") == "tavily").cast("int").alias("tavily_calls"),
        F.count_if(F.col("source") == "brave").cast("int").alias("brave_calls"))


def select_work(companies: DataFrame, results: DataFrame | None, params: Params = Params(),
                limit: int | None = None, resume: bool = True) -> DataFrame:
    """Companies to process now. The limit applies to what is left to do; with `compat` it
    applies first, so that a limited rerun may find nothing to do."""
    if not resume or results is None:
        return first_companies(companies, limit)
    if params.compat:
        return todo(first_companies(companies, limit), results, retry_errors=False)
    return first_companies(todo(companies, results), limit)


def base_contexts(companies: DataFrame, items: DataFrame, params: Params = Params(),
                  exact_caps: bool = True) -> DataFrame:
    """One context per company from its base feeds; companies without items get an empty one."""
    base = tuple(s for s in params.sources if s.name not in ("brave", "tavily"))
    mine = drop_short_extracts(known_feeds(items, params.sources), params.encyclopedia_min_chars)
    mine = cut_snippets(mine.filter(F.col("source").isin([s.name for s in base])), base)
    # Ranks look at one company only, so they come first and bound every company's items; the join
    # then meets no hot company.
    kept = (dedupe_capped if exact_caps else dedupe_then_cap)(mine, base).join(
        companies.select("company").distinct(), "company", "left_semi")
    packed = assemble(add_sections(kept, base), replace(params, sources=base))
    none = F.array().cast("array<string>")
    return companies.select("company").distinct().join(packed, "company", "left").select(
        "company", F.coalesce("headline_text", F.lit("")).alias("headline_text"),
        F.coalesce("context", F.lit("")).alias("context"),
        F.coalesce("sources", none).alias("sources"),
        F.coalesce("char_count", F.lit(0)).alias("char_count"),
        F.coalesce("source_breakdown", F.create_map().cast("map<string,bigint>"))
        .alias("source_breakdown"))


def attributed(items: DataFrame, companies: DataFrame, words: bool = False) -> DataFrame:
    """Items with a company as they are; those of the press feeds, which have none yet, once for
    each company that their title and snippet mention."""
    loose = attach_companies(items.filter(F.col("company").isNull()), "item_rank",
                             companies.select("company").distinct(), words=words)
    return items.filter(F.col("company").isNotNull()).unionByName(loose)


def _published() -> Column:
    return parse_published(F.col("raw_date"))


def in_horizon(items: DataFrame, as_of: Column, params: Params = Params()) -> DataFrame:
    """What the feeds' own searches let through: items of the searched feeds from the last
    `horizon_months` before `as_of`, and of the filings one form type. Undated items stay
    (`horizon_counts` tells how many there are), and so do items without a feed: they are for
    `known_feeds` to report."""
    day = F.to_date(as_of)
    when = F.to_date(_published())
    inside = when.isNull() | when.between(horizon_start(day, params.horizon_months), day)
    feed = F.coalesce("source", F.lit(""))
    form = (feed != "edgar") | (F.coalesce("domain", F.lit("")) == "") | (
        F.col("domain").startswith(FILING_FORM))
    return items.filter((~feed.isin(*HORIZON_FEEDS) | inside) & form)


def horizon_counts(items: DataFrame) -> DataFrame:
    """(company, source, items, undated)."""
    return items.groupBy("company", "source").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(_published().isNull()).alias("undated"))


def with_sector(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """Rows with the sector of their company's first line in the list, where the list has any."""
    if "sector" not in companies.columns:
        return rows
    order = ["input_pos"] if "input_pos" in companies.columns else []
    sectors = companies.groupBy("company").agg(
        F.min(F.struct(*order, "sector"))["sector"].alias("sector"))
    return rows.join(sectors, "company", "left")


def run_feeds(companies: DataFrame, items: DataFrame, screen_answers: DataFrame,
              answers: DataFrame, as_of: Column, params: Params = Params(),
              deep: bool = True) -> DataFrame:
    """A whole run from landed feeds: companies are found in the press feeds, the date horizon is
    applied, and result rows carry their sector."""
    mine = in_horizon(attributed(items, companies), as_of, params)
    rows = run_results(companies, mine, screen_answers, answers, params, deep)
    return with_sector(rows, companies)


def run_results(companies: DataFrame, items: DataFrame, screen_answers: DataFrame,
                answers: DataFrame, params: Params = Params(),
                deep: bool = True) -> DataFrame:
    """Evidence → context → gate → deep evidence → answers → one result row per company."""
    base = base_contexts(companies, items, params)
    if deep:
        # The gate adds its columns to the base rows, so the evidence is assembled once.
        contexts = merge_deep(decide(base, screen_answers, params),
                              items.filter(F.col("source") == "tavily"), params)
    else:
        contexts = base
    return classify(contexts, answers, params)


def layered_items(items: DataFrame) -> DataFrame:
    """Items as the cached path shows them: titles and snippets sanitised, feed dates cut,
    filings all under one form type."""
    source = F.col("source")
    feeds = source.isin("google_news", "prnewswire", "businesswire")
    return items.withColumns({
        "title": F.when(source == "wikipedia", F.col("title"))
                  .otherwise(sanitise(F.col("title"))),
        "snippet": sanitise(F.col("snippet")),
        "raw_date": F.when(feeds, F.substring("raw_date", 1, 22)).otherwise(F.col("raw_date")),
        "domain": F.when(source == "edgar", "8-K").otherwise(F.col("domain"))})


def layered_fetch(companies: DataFrame, cache: DataFrame, items: DataFrame, as_of: Column,
                  params: Params = Params(), stage2: bool = False) -> DataFrame:
    """The cached path: fresh cache entries as they are, every other company assembled from
    landed items, with paragraph chunks. `payload` of a cache entry is the record (RECORD)."""
    sources = LAYERED_SOURCES if stage2 else tuple(
        s for s in LAYERED_SOURCES if s.name not in ("brave", "tavily"))
    p = replace(params, sources=sources)
    names = companies.select("company").distinct()
    stage = "2" if stage2 else "1"
    hits = fetch_cache.lookup(names, cache, as_of, p, stage).select(
        "company", *[F.col(f"payload.{c}").alias(c) for c in RECORD], "from_cache")
    missing = fetch_cache.misses(names, cache, as_of, p, stage).select("company")
    mine = drop_short_extracts(known_feeds(items, LAYERED_SOURCES), params.encyclopedia_min_chars)
    mine = mine.filter(F.col("source").isin([s.name for s in sources]))
    # Caps need keys alone, so they come before the company join and before any text is cleaned.
    kept = dedupe_capped(mine, sources).join(missing, "company", "left_semi")
    kept = cut_snippets(layered_items(kept), sources)
    packed = assemble(add_sections(kept, sources, at_sentence=True), p,
                      headers=False, first_lines=True, chunks=True)
    none = F.array().cast("array<string>")
    empty = {"headline_text": F.lit(""), "context": F.lit(""), "chunks": none, "sources": none,
             "char_count": F.lit(0).cast("long"),
             "source_breakdown": F.create_map().cast("map<string,bigint>"),
             "tavily_calls": F.lit(0), "brave_calls": F.lit(0)}
    live = missing.join(packed, "company", "left").join(
        paid_calls(mine), "company", "left").select(
        "company", *[F.coalesce(c, empty[c]).alias(c) for c in RECORD],
        F.lit(False).alias("from_cache"))
    return hits.unionByName(live)


def fetch_log(fetched: DataFrame) -> DataFrame:
    """Fetches as the log that `fetch_usage` adds up; an answer from the cache costs nothing."""
    def cost(calls: str) -> Column:
        return F.when(F.col("from_cache"), 0).otherwise(F.col(calls))

    return fetched.select("company", "from_cache", cost("tavily_calls").alias("deep_calls"),
                          cost("brave_calls").alias("web_calls"))


def cache_records(fetched: DataFrame, as_of: Column, stage2: bool = False) -> DataFrame:
    """Fresh fetches as cache entries."""
    live = fetched.filter(~F.col("from_cache"))
    return (fetch_cache.with_key(live, as_of, "2" if stage2 else "1")
            .select("key", "company", F.struct(*RECORD).alias("payload"),
                    as_of.cast("timestamp").alias("fetched_at")))
