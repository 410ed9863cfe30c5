"""Evidence items: union of feeds, URL dedupe, caps, sections and contexts.

Item columns: company, source, source_rank, query_rank, item_rank, url, title, snippet, domain,
raw_date. Ranks define the order in which feeds and their items are taken.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fields import section_text
from ..functions.names import clean_name
from ..functions.text import first_headlines, headline_lines, paragraph_chunks, shorten
from ..params import SOURCES, Params, Source

ITEM_ORDER = ("source_rank", "query_rank", "item_rank", "url")
# Fixed value: characters of a snippet from the news tab of the web search.
NEWS_TAB_CHARS = 400
_ITEM_DEFAULTS = {
    "query_rank": 1, "url": "", "title": "", "snippet": "",
    "domain": "", "raw_date": "",
}


def per_source(sources: Iterable[Source], value, default=None, source: str = "source") -> Column:
    """Column holding `value(s)` of the row's source."""
    out = None
    for s in sources:
        hit = F.col(source) == s.name
        out = F.when(hit, F.lit(value(s))) if out is None else out.when(hit, F.lit(value(s)))
    return out.otherwise(F.lit(default))


def union_feeds(feeds: Mapping[str, DataFrame],
                sources: Sequence[Source] = SOURCES) -> DataFrame:
    """One item table from per-source frames; absent columns get their defaults."""
    ranks = {s.name: s.rank for s in sources}

    def conform(name: str, df: DataFrame) -> DataFrame:
        missing = {c: F.lit(v) for c, v in _ITEM_DEFAULTS.items() if c not in df.columns}
        return df.withColumns(missing).select(
            "company", F.lit(name).alias("source"), F.lit(ranks[name]).alias("source_rank"),
            F.col("query_rank").cast("int").alias("query_rank"),
            F.col("item_rank").cast("long").alias("item_rank"),
            "url", "title", "snippet", "domain", "raw_date")

    return reduce(DataFrame.unionByName, [conform(n, df) for n, df in feeds.items()])


def cut_snippets(items: DataFrame, sources: Sequence[Source] = SOURCES) -> DataFrame:
    """Snippets cut to what their sections can show, and one character more to tell that there
    was more. Done before any shuffle, so that whole texts never travel."""
    limit = per_source(sources, lambda s: 2 ** 30 if s.snippet_chars is None else s.snippet_chars,
                       2 ** 30)
    return items.withColumn("snippet", F.substring(F.col("snippet"), F.lit(1), limit + 1))


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], limit: int,
            extra: Column | None = None) -> DataFrame:
    """Rows ranked 1..limit within `keys`. The literal limit lets Spark cut each input
    partition before the shuffle, so a hot key moves at most `limit` rows per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    keep = F.col("_rank") <= limit
    return (df.withColumn("_rank", F.row_number().over(w))
            .filter(keep if extra is None else keep & extra).drop("_rank"))


def drop_empty_urls(items: DataFrame, sources: Sequence[Source] = SOURCES) -> DataFrame:
    skips = [s.name for s in sources if s.skip_empty]
    return items.filter(~(F.col("source").isin(skips) & (F.col("url") == "")))


def known_feeds(items: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """The items, once each one's feed is among the sources; another feed is an error, since caps
    and pages say nothing about it.

    The error sits in the column itself. Later filters on the feed are made of it, so none of them
    can be handed to a file reader that would skip the rows in question."""
    known = F.coalesce(F.col("source").isin([s.name for s in sources]), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("no such feed among the sources: "),
                                   F.coalesce("source", F.lit("NULL")))).cast("string")
    return items.withColumn("source", F.when(known, F.col("source")).otherwise(wrong))


def drop_short_extracts(items: DataFrame, minimum: int) -> DataFrame:
    """Items without the encyclopedia's stubs: extracts of fewer than `minimum` characters. They
    neither count nor mark their URL as seen."""
    stub = (F.col("source") == "wikipedia") & (F.length(F.coalesce("snippet", F.lit(""))) < minimum)
    return items.filter(~F.coalesce(stub, F.lit(False)))


def first_seen(items: DataFrame) -> DataFrame:
    """One row per (company, url): the one that comes first in source and item order."""
    return _ranked(items, ("company", "url"), ITEM_ORDER, 1)


def top_per_source(items: DataFrame, k: int,
                   order: Sequence[str | Column] = ("query_rank", "item_rank", "url"),
                   ) -> DataFrame:
    """The first k items of every company and source."""
    return _ranked(items, ("company", "source"), order, k)


def cap_per_source(items: DataFrame, sources: Sequence[Source] = SOURCES) -> DataFrame:
    """Per-source limits on an already deduped table (the fast mode). Sources without a cap of
    their own are bounded by what their queries hand over."""
    def bound(s: Source) -> int:
        return s.cap if s.cap is not None else s.page * s.queries
    cap = per_source(sources, bound, 0)
    return _ranked(known_feeds(items, sources), ("company", "source"), ("query_rank", "item_rank", "url"),
                   max(bound(s) for s in sources), F.col("_rank") <= cap)


def dedupe_then_cap(items: DataFrame, sources: Sequence[Source] = SOURCES) -> DataFrame:
    """Fast mode: differs from `dedupe_capped` only when an item past one source's cap comes
    again in a later source."""
    return cap_per_source(first_seen(drop_empty_urls(items, sources)), sources)


def _most(s: Source) -> int:
    """Most items a source can contribute to one company."""
    if s.cap is None:
        return s.page * s.queries
    return s.cap + (s.queries - 1 if s.overrun else 0)


def dedupe_capped(items: DataFrame, sources: Sequence[Source] = SOURCES) -> DataFrame:
    """Exact mode: sources take turns in rank order; an item is kept if its URL was not kept
    before and its source has room; an item past the room is *not* remembered.

    The turn-taking needs a company's items in one place, so they are first cut to those that
    can matter. With T items kept before a query at most, and room for R, the query is over
    within its first T + R + 1 distinct URLs: at most T of them can be repeats. That bound
    (under a hundred) holds whatever the size of the group, and loses nothing.
    """
    sources = sorted(sources, key=lambda s: s.rank)
    items = known_feeds(items, sources)
    query = ("company", "source", "query_rank")
    bounds, before = {}, 0
    for s in sources:
        before += _most(s)
        bounds[s.name] = before + 1

    def of(group: Sequence[Source]) -> DataFrame:
        return items.filter(F.col("source").isin([s.name for s in group]))

    paged = [s for s in sources if s.page is not None]
    open_ended = [s for s in sources if s.page is None]
    parts = []
    if paged:
        page = per_source(paged, lambda s: s.page, 0)
        part = _ranked(of(paged), query, ("item_rank", "url"), max(s.page for s in paged),
                       F.col("_rank") <= page)
        parts.append(_drop_taken(drop_empty_urls(part, sources), items, paged, sources))
    if open_ended:
        bound = per_source(open_ended, lambda s: bounds[s.name], 0)
        part = _drop_taken(drop_empty_urls(of(open_ended), sources), items, open_ended, sources)
        part = _ranked(part, (*query, "url"), ("item_rank",), 1)
        parts.append(_ranked(part, query, ("item_rank", "url"),
                             max(bounds[s.name] for s in open_ended), F.col("_rank") <= bound))
    candidates = reduce(DataFrame.unionByName, parts)

    rest = [c for c in items.columns if c not in ("company", *ITEM_ORDER)]
    grouped = candidates.groupBy("company").agg(
        F.sort_array(F.collect_list(F.struct(*ITEM_ORDER, *rest))).alias("_all"))
    return (grouped.withColumn("_kept", _take_turns(F.col("_all"), sources))
            .select("company", F.inline(F.transform("_kept", lambda i: F.get("_all", i))))
            .select(*items.columns))


def _drop_taken(part: DataFrame, items: DataFrame, group: Sequence[Source],
                sources: Sequence[Source]) -> DataFrame:
    """The group's items without those whose URL an earlier marks_all source handed over."""
    for m in (s for s in sources if s.marks_all):
        later = [s.name for s in group if s.rank > m.rank]
        if later:
            taken = (items.filter(F.col("source") == m.name).select("company", "url").distinct()
                     .select("company", "url",
                             F.explode(F.array(*map(F.lit, later))).alias("source")))
            part = part.join(taken, ["company", "url", "source"], "left_anti")
    return part


def _take_turns(ordered: Column, sources: Sequence[Source]) -> Column:
    """Positions of the kept items of one company's ordered, bounded item array."""
    def attribute(rank: Column, value, kind: str) -> Column:
        table = F.create_map(*[F.lit(v) for s in sources for v in (s.rank, value(s))])
        return F.try_element_at(table, rank).cast(kind)

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("rank"), F.lit(0).alias("query"),
                     F.lit(0).alias("of_source"), F.lit(0).alias("of_query"),
                     F.array().cast("array<string>").alias("seen"),
                     F.array().cast("array<int>").alias("kept"))
    unlimited = 2 ** 31 - 1

    def step(s: Column, x: Column) -> Column:
        same_source = s["rank"] == x["source_rank"]
        of_source = F.when(same_source, s["of_source"]).otherwise(0)
        of_query = F.when(same_source & (s["query"] == x["query_rank"]),
                          s["of_query"]).otherwise(0)
        cap = attribute(x["source_rank"],
                        lambda o: unlimited if o.cap is None else o.cap, "int")
        overrun = attribute(x["source_rank"], lambda o: o.overrun, "boolean")
        checks = attribute(x["source_rank"], lambda o: o.checks, "boolean")
        take = (((of_source < cap) | (overrun & (of_query == 0)))
                & (~checks | ~F.array_contains(s["seen"], x["url"])))
        one = take.cast("int")
        return F.struct(
            (s["at"] + 1).alias("at"), x["source_rank"].cast("int").alias("rank"),
            x["query_rank"].cast("int").alias("query"), (of_source + one).alias("of_source"),
            (of_query + one).alias("of_query"),
            F.when(take, F.array_append(s["seen"], x["url"])).otherwise(s["seen"]).alias("seen"),
            F.when(take, F.array_append(s["kept"], s["at"])).otherwise(s["kept"]).alias("kept"))

    return F.aggregate(ordered, start, step, lambda s: s["kept"])


def add_sections(items: DataFrame, sources: Sequence[Source] = SOURCES,
                 at_sentence: bool = False) -> DataFrame:
    """Text block of each item, its snippet cut to the source's length (at a sentence end, if
    asked)."""
    # One cut with a length per source; no limit means the whole snippet.
    text, whole = F.col("snippet"), 2 ** 30
    limit = F.when((F.col("source") == "brave") & (F.col("domain") == "news"),
                   F.lit(NEWS_TAB_CHARS)).otherwise(per_source(
                       sources, lambda s: whole if s.snippet_chars is None else s.snippet_chars,
                       whole))
    shown = F.substring(text, F.lit(1), limit)
    if at_sentence:
        hard = [s.name for s in sources if not s.at_sentence or not s.snippet_chars]
        shown = F.when(F.col("source").isin(hard), shown).otherwise(shorten(text, limit))
    layout = F.when((F.col("source") == "brave") & (F.col("domain") == "news"),
                    F.lit("brave_news")).otherwise(F.col("source"))
    return items.withColumn("section", section_text(
        layout, F.col("title"), F.col("raw_date"), F.col("url"), shown, F.col("domain")))


def source_breakdown(sections: DataFrame, joined: bool = True) -> DataFrame:
    """(company, source, chars): characters per source, counting the blank lines between
    sections (joined) or not."""
    n_chars = F.sum(F.length("section"))
    if joined:
        n_chars = n_chars + 2 * (F.count(F.lit(1)) - 1)
    return sections.groupBy("company", "source").agg(n_chars.alias("chars"))


def source_list(urls: Column, limit: int = 15) -> Column:
    """Distinct URLs in order of first appearance, empty ones left as they come."""
    return F.slice(F.array_distinct(urls), 1, limit)


def cited(items: DataFrame, limit: int = 15) -> DataFrame:
    """(company, sources): the source lists of capped items, from their keys alone; what `assemble` lists
    beside the contexts."""
    keys = items.groupBy("company").agg(F.sort_array(F.collect_list(F.struct(*ITEM_ORDER))).alias("_k"))
    return keys.select("company", source_list(F.transform("_k", lambda x: x["url"]), limit).alias("sources"))


def assemble(sections: DataFrame, params: Params = Params(), headers: bool = True,
             first_lines: bool = False, chunks: bool = False) -> DataFrame:
    """One context per company from its (capped, hence bounded) sections.

    headers      a `=== SOURCE ===` line opens each source's block
    first_lines  the headline text takes one line per section, not every opening line
    chunks       add the whole text packed into paragraph chunks
    """
    head = per_source(params.sources, lambda s: s.header, None)
    src = sections.withColumn("_header", F.coalesce(head, F.upper(F.col("source"))))
    packed = src.groupBy("company").agg(F.sort_array(F.collect_list(F.struct(
        *ITEM_ORDER, "source", "_header", "section"))).alias("_items"))
    items = F.col("_items")

    def block(x: Column, i: Column) -> Column:
        opens = (i == 0) | (F.get(items, i - 1)["source"] != x["source"])
        return F.when(opens, F.concat(F.lit("=== "), x["_header"], F.lit(" ===\n"),
                                      x["section"])).otherwise(x["section"])

    texts = F.transform(items, lambda x: x["section"])
    full = F.array_join(F.transform(items, block) if headers else texts, "\n\n")
    chars = F.map_from_entries(F.transform(
        F.array_distinct(F.transform(items, lambda x: x["source"])),
        lambda s: F.struct(s, _chars_of(items, s, joined=headers))))
    limit = params.max_context_chars
    return (
        packed
        .withColumn("_full", full)
        .select(
            "company",
            (first_headlines(texts) if first_lines else headline_lines(F.col("_full")))
            .alias("headline_text"),
            F.substring("_full", 1, limit).alias("context"),
            source_list(F.transform(items, lambda x: x["url"]),
                        params.max_sources).alias("sources"),
            F.length("_full").cast("long").alias("char_count"),
            chars.alias("source_breakdown"),
            *([paragraph_chunks(F.col("_full"), params.chunk_chars, params.max_chunks,
                                params.chunk_overlap).alias("chunks")] if chunks else []),
        )
    )


def _chars_of(items: Column, source: Column, joined: bool) -> Column:
    mine = F.filter(items, lambda x: x["source"] == source)
    total = F.aggregate(mine, F.lit(0).cast("long"), lambda a, x: a + F.length(x["section"]))
    return total + 2 * (F.size(mine) - 1) if joined else total


def merge_deep(base: DataFrame, deep: DataFrame, params: Params = Params(),
               source: str = "tavily") -> DataFrame:
    """Base contexts (with their gate's `passed`), extended with deep-search sections where the
    gate let the company through.

    Deep items whose URL is in the base's source list, or came before among the deep items,
    are dropped. With `compat` the deep block follows a base already cut to the limit, so it
    may vanish; otherwise the base gives way to up to `deep_reserve_chars` of it.
    """
    tag = next(s for s in params.sources if s.name == source)
    # The page bound first: it keeps a company's group small however many rows were landed.
    handed = _ranked(deep, ("company", "query_rank"), ("item_rank", "url"), tag.page)
    fresh = _ranked(handed.filter(F.col("url") != ""), ("company", "url"), ITEM_ORDER, 1)
    packed = (add_sections(fresh, params.sources).groupBy("company")
              .agg(F.sort_array(F.collect_list(F.struct(*ITEM_ORDER, "section"))).alias("_d")))
    new = F.filter("_d", lambda x: ~F.array_contains("sources", x["url"]))
    joined = (base.join(packed, "company", "left")
              .withColumn("_new", F.when(F.col("passed"), new))
              .withColumn("_has", F.coalesce(F.size("_new") > 0, F.lit(False)))
              .withColumn("_t", F.array_join(F.transform("_new", lambda x: x["section"]),
                                             "\n\n")))
    extra = F.concat(F.lit(f"\n\n=== {tag.header} ===\n"), F.col("_t"))
    has = F.col("_has")
    limit = params.max_context_chars
    room = F.lit(limit) if params.compat else (
        F.lit(limit) - F.least(F.length(extra), F.lit(params.deep_reserve_chars)))
    head = F.substring(F.col("context"), F.lit(1), room)
    urls = F.concat("sources", F.transform("_new", lambda x: x["url"]))
    return joined.select(
        "company", "headline_text",
        F.when(has, F.substring(F.concat(head, extra), 1, limit))
        .otherwise(F.col("context")).alias("context"),
        F.when(has, source_list(urls, params.max_sources))
        .otherwise(F.col("sources")).alias("sources"),
        F.when(has, (F.length("context") + F.length(extra)).cast("long"))
        .otherwise(F.col("char_count")).alias("char_count"),
        F.when(has, F.map_concat("source_breakdown", F.create_map(
            F.lit(source), F.length("_t").cast("long"))))
        .otherwise(F.col("source_breakdown")).alias("source_breakdown"),
    )


# Query texts per purpose; {years} and {window} are filled in per run.
DEEP_QUERIES = (
    "corporate changes {window}",
    "merger acquisition spinoff divestiture takeover {years}",
    "headquarters relocation redomicile incorporated {years}",
    "bankruptcy shutdown liquidation closure restructuring {years}",
    "renamed rebranded sector pivot new name {years}",
)
NEWS_QUERIES = (
    "merger OR acquisition OR bankruptcy OR shutdown OR restructuring OR rebranding OR "
    "renamed OR relocated {years}",
    "{years}",
)


def fetch_plan(companies: DataFrame, years: str, window: str) -> DataFrame:
    """(company, source, query_rank, query): the searches to run for each company."""
    plan = [("google_news", i, q) for i, q in enumerate(NEWS_QUERIES, 1)]
    plan += [("tavily", i, q) for i, q in enumerate(DEEP_QUERIES, 1)]
    rows = F.array(*[
        F.struct(F.lit(s).alias("source"), F.lit(i).alias("query_rank"),
                 F.lit(q.format(years=years, window=window)).alias("terms"))
        for s, i, q in plan])
    return (
        companies.select("company", clean_name(F.col("company")).alias("_name"))
        .select("company", "_name", F.inline(rows))
        .select("company", "source", "query_rank",
                F.concat(F.lit('"'), F.col("_name"), F.lit('" '), F.col("terms")).alias("query"))
    )
