"""Queries over evidence items: dedupe, caps, sections, contexts, deep merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.evidence import (add_sections, assemble, cap_per_source, cited, cut_snippets,
                                  dedupe_capped, drop_empty_urls, fetch_plan, first_seen, merge_deep,
                                  source_breakdown, top_per_source, union_feeds)
from ..params import SOURCES, Params
from .inputs import (CAPPED_SQL, FIRST_SEEN_SQL, ITEMS_SQL, NON_EMPTY_ITEMS_SQL,
                     PARTY_NAMES_SQL, items, party_names, sections_sql, table, texts)

KEYS = ("company", "source", "source_rank", "query_rank", "item_rank", "url")
_KEYS = ", ".join(KEYS)


def evidence_union(spark, sf):
    """Documents, pages and conversations as three differently shaped feeds."""
    docs = texts(spark, sf).select(
        F.col("lang").alias("company"), F.col("doc_id").alias("item_rank"),
        F.concat(F.lit("doc:"), "doc_id").alias("url"),
        F.col("text").alias("title"), F.col("source").alias("domain"))
    pages = table(spark, sf, "pages").select(
        F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("company"),
        F.col("page_id").alias("item_rank"), "url",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    talks = table(spark, sf, "conversations").select(
        F.col("role").alias("company"), F.col("turn").alias("item_rank"),
        (F.col("turn") % 5 + 1).alias("query_rank"),
        F.concat(F.lit("conv:"), "conv_id", F.lit("/"), "turn").alias("url"),
        F.substring_index("text", ".", 1).alias("title"), F.col("text").alias("snippet"))
    feeds = union_feeds({"gdelt": docs, "brave": pages, "tavily": talks})
    return feeds.select(*KEYS, "title", F.length("snippet").alias("snippet_chars"), "domain")


EVIDENCE_UNION = """
  SELECT lang AS company, 'gdelt' AS source, 3 AS source_rank, 1 AS query_rank,
    doc_id AS item_rank, 'doc:' || doc_id AS url, text AS title,
    0 AS snippet_chars, source AS domain FROM documents
  UNION ALL
  SELECT regexp_extract(html, 'lang="([a-z]+)"', 1), 'brave', 8, 1, page_id, url,
    regexp_extract(html, '<title>([^<]*)</title>', 1), 0, '' FROM pages
  UNION ALL
  SELECT role, 'tavily', 9, turn % 5 + 1, turn, 'conv:' || conv_id || '/' || turn,
    split_part(text, '.', 1), length(text), '' FROM conversations
"""


def url_dedupe(spark, sf):
    return first_seen(drop_empty_urls(items(spark, sf))).select(*KEYS)


def url_dedupe_capped(spark, sf):
    # Grouped rows carry what they are given, so they are given the keys alone.
    return dedupe_capped(items(spark, sf).select(*KEYS))


def without_stubs(rows: str) -> str:
    return f"SELECT * FROM ({rows}) WHERE NOT (source = 'wikipedia' AND length(snippet) < 50)"


# The turn-taking again, source by source: each level keeps what the earlier levels did not.
def capped_levels(sources=SOURCES, stubs: bool = True) -> str:
    """Without `stubs`, the encyclopedia's short extracts are no items."""
    rows = ITEMS_SQL if stubs else without_stubs(ITEMS_SQL)
    parts = [f"WITH it AS (SELECT {_KEYS} FROM ({rows})), k0 AS (SELECT * FROM it WHERE false)"]
    prev = "k0"
    for s in sources:
        for q in range(1, s.queries + 1):
            name = f"k{s.rank}_{q}"
            raw = f"SELECT * FROM it WHERE source = '{s.name}' AND query_rank = {q}"
            if s.page is not None:
                raw += (" QUALIFY row_number() OVER (PARTITION BY company ORDER BY item_rank)"
                        f" <= {s.page}")
            if s.skip_empty:
                raw = f"SELECT * FROM ({raw}) WHERE url <> ''"
            if s.checks:
                raw = f"""SELECT * FROM ({raw}) r
                  WHERE NOT EXISTS (SELECT 1 FROM {prev} p
                                    WHERE p.company = r.company AND p.url = r.url)
                  QUALIFY row_number() OVER (PARTITION BY company, url ORDER BY item_rank) = 1"""
            for m in sources:
                if m.marks_all and m.rank < s.rank:
                    raw = f"""SELECT * FROM ({raw}) r WHERE NOT EXISTS (SELECT 1 FROM it b
                      WHERE b.source = '{m.name}' AND b.company = r.company AND b.url = r.url)"""
            if s.cap is not None:
                left = (f"{s.cap} - coalesce((SELECT count(*) FROM {prev} p WHERE p.source = "
                        f"'{s.name}' AND p.company = r.company), 0)")
                if s.overrun:
                    left = f"greatest({left}, 1)"
                raw = f"""SELECT {_KEYS} FROM (SELECT *, row_number() OVER (PARTITION BY company
                  ORDER BY item_rank) AS n, {left} AS room FROM ({raw}) r) WHERE n <= room"""
            parts.append(f"{name} AS MATERIALIZED (SELECT * FROM {prev} UNION ALL ({raw}))")
            prev = name
    return ",\n".join(parts) + f"\nSELECT * FROM {prev}"


def topk_per_source(spark, sf):
    newest = top_per_source(items(spark, sf), 5, (F.desc("raw_date"), "item_rank"))
    return newest.select(*KEYS, "raw_date")


TOPK = f"""
  SELECT {_KEYS}, raw_date FROM ({ITEMS_SQL}) QUALIFY row_number() OVER (
    PARTITION BY company, source ORDER BY raw_date DESC, item_rank) <= 5
"""


def capped(spark, sf):
    return cap_per_source(first_seen(drop_empty_urls(cut_snippets(items(spark, sf)))))


def sections(spark, sf):
    return add_sections(capped(spark, sf))


_SECTIONS = sections_sql(CAPPED_SQL)


def section_format(spark, sf):
    return add_sections(items(spark, sf)).select("source", "item_rank", "section")


def breakdown(spark, sf):
    """Both ways of counting: with the blank lines between sections, and without."""
    s = add_sections(drop_empty_urls(items(spark, sf)))
    joined = source_breakdown(s, joined=True).withColumnRenamed("chars", "joined_chars")
    return joined.join(source_breakdown(s, joined=False), ["company", "source"])


BREAKDOWN = f"""
  SELECT company, source, CAST(sum(length(section)) + 2 * (count(*) - 1) AS BIGINT)
    AS joined_chars, CAST(sum(length(section)) AS BIGINT) AS chars
  FROM ({sections_sql(NON_EMPTY_ITEMS_SQL)}) GROUP BY company, source
"""

_HEADERS = "CASE source " + " ".join(f"WHEN '{s.name}' THEN '{s.header}'" for s in SOURCES) + " END"
_CONTEXTS = f"""
  SELECT company, string_agg(block, chr(10) || chr(10) ORDER BY source_rank) AS full_text,
    sum(n) AS n FROM (
    SELECT company, source_rank, '=== ' || {_HEADERS} || ' ===' || chr(10) || string_agg(section,
      chr(10) || chr(10) ORDER BY query_rank, item_rank, url) AS block, count(*) AS n
    FROM ({_SECTIONS}) GROUP BY company, source, source_rank) GROUP BY company
"""


def contexts(spark, sf):
    return assemble(sections(spark, sf))


def context_assembly(spark, sf):
    return contexts(spark, sf).select("company", "context", "char_count")


CONTEXT_ASSEMBLY = f"""
  SELECT company, substr(full_text, 1, 15000) AS context, length(full_text) AS char_count
  FROM ({_CONTEXTS})
"""


def context_breakdown(spark, sf):
    return contexts(spark, sf).select("company", F.explode("source_breakdown").alias(
        "source", "chars"))


CONTEXT_BREAKDOWN = f"""
  SELECT company, source, CAST(sum(length(section)) + 2 * (count(*) - 1) AS BIGINT) AS chars
  FROM ({_SECTIONS}) GROUP BY company, source
"""


def source_lists(spark, sf):
    kept = cap_per_source(first_seen(drop_empty_urls(items(spark, sf).select(*KEYS))))
    return cited(kept).select("company", F.posexplode("sources").alias("pos", "url"))


SOURCE_LISTS = f"""
  SELECT company, CAST(row_number() OVER (PARTITION BY company ORDER BY first_at) - 1 AS INTEGER)
    AS pos, url FROM (
    SELECT company, url, min(ord) AS first_at FROM (
      SELECT company, url, row_number() OVER (PARTITION BY company
        ORDER BY source_rank, query_rank, item_rank) AS ord FROM ({CAPPED_SQL}))
    GROUP BY company, url)
  QUALIFY pos < 15
"""

_OPENING = r"regexp_replace(line, '^\s+|\s+$', '', 'g')"


def headline_all(spark, sf):
    return contexts(spark, sf).select("company", "headline_text")


HEADLINE_ALL = rf"""
  SELECT company, string_agg(line, chr(10) ORDER BY i) AS headline_text FROM (
    SELECT company, i, {_OPENING} AS line FROM (
      SELECT company, unnest(string_split(full_text, chr(10))) AS line,
        generate_subscripts(string_split(full_text, chr(10)), 1) AS i FROM ({_CONTEXTS})))
  WHERE starts_with(line, '[') OR starts_with(line, '===') GROUP BY company
"""


def headline_first(spark, sf):
    return assemble(sections(spark, sf), headers=False, first_lines=True).select(
        "company", "headline_text")


HEADLINE_FIRST = rf"""
  SELECT company, string_agg(list_filter(list_transform(string_split(section, chr(10)),
      lambda line: {_OPENING}), lambda l: starts_with(l, '['))[1], chr(10)
      ORDER BY source_rank, query_rank, item_rank, url) AS headline_text
  FROM ({_SECTIONS}) GROUP BY company
"""


def stage2_merge(spark, sf):
    """Base from all feeds but the deep one; English and German pass the gate."""
    all_items = cut_snippets(items(spark, sf))
    base_items = cap_per_source(first_seen(drop_empty_urls(
        all_items.filter("source <> 'tavily'"))))
    base = assemble(add_sections(base_items))
    gated = base.withColumn("passed", F.col("company").isin("en", "de"))
    merged = merge_deep(gated, all_items.filter("source = 'tavily'"), Params(compat=True))
    return merged.select("company", "context", "char_count",
                         F.array_join("sources", " ").alias("sources"),
                         F.coalesce(F.try_element_at("source_breakdown", F.lit("tavily")),
                                    F.lit(0)).alias("deep_chars"))


_BASE_ITEMS = f"""
  SELECT * FROM (SELECT * FROM ({NON_EMPTY_ITEMS_SQL}) WHERE source <> 'tavily'
    QUALIFY row_number() OVER (PARTITION BY company, url
                               ORDER BY source_rank, query_rank, item_rank) = 1)
  QUALIFY row_number() OVER (PARTITION BY company, source ORDER BY query_rank, item_rank, url)
    <= (SELECT [5, 12, 10, 5, 4, 4, 1, 8])[source_rank]
"""
STAGE2_MERGE = f"""
  WITH sec AS ({sections_sql(_BASE_ITEMS)}),
  base AS (
    SELECT company, string_agg(block, chr(10) || chr(10) ORDER BY source_rank) AS full_text FROM (
      SELECT company, source_rank, '=== ' || {_HEADERS} || ' ===' || chr(10) || string_agg(section,
        chr(10) || chr(10) ORDER BY query_rank, item_rank, url) AS block
      FROM sec GROUP BY company, source, source_rank) GROUP BY company),
  known AS (
    SELECT company, url, ord FROM (SELECT company, url, row_number() OVER (PARTITION BY company
      ORDER BY source_rank, query_rank, item_rank) AS ord FROM sec) QUALIFY row_number() OVER (
      PARTITION BY company ORDER BY ord) <= 15),
  handed AS (
    SELECT * FROM ({ITEMS_SQL}) WHERE source = 'tavily' QUALIFY row_number() OVER (
      PARTITION BY company, query_rank ORDER BY item_rank) <= 5),
  deep AS (
    SELECT * FROM handed h WHERE url <> '' AND company IN ('en', 'de')
      AND NOT EXISTS (SELECT 1 FROM known k WHERE k.company = h.company AND k.url = h.url)
    QUALIFY row_number() OVER (PARTITION BY company, url ORDER BY query_rank, item_rank) = 1),
  block AS (
    SELECT company, string_agg(section, chr(10) || chr(10) ORDER BY query_rank, item_rank) AS t,
      list(url ORDER BY query_rank, item_rank) AS urls
    FROM ({sections_sql("SELECT * FROM deep")}) GROUP BY company),
  lists AS (SELECT company, list(url ORDER BY ord) AS urls FROM known GROUP BY company)
  SELECT base.company,
    CASE WHEN t IS NULL THEN substr(full_text, 1, 15000) ELSE substr(substr(full_text, 1, 15000)
      || chr(10) || chr(10) || '=== TAVILY DEEP SEARCH ===' || chr(10) || t, 1, 15000) END
      AS context,
    CASE WHEN t IS NULL THEN length(full_text)
      ELSE length(substr(full_text, 1, 15000)) + 29 + length(t) END AS char_count,
    array_to_string(list_slice(list_concat(lists.urls, coalesce(block.urls, [])), 1, 15), ' ')
      AS sources,
    coalesce(length(t), 0) AS deep_chars
  FROM base JOIN lists USING (company) LEFT JOIN block USING (company)
"""


def plan(spark, sf):
    return fetch_plan(party_names(spark, sf).select("company"), "2025 OR 2026",
                      "2025-01-01 – 2026-01-01 (12 months)")


_PLAN_ROWS = """
  ('google_news', 1, 'merger OR acquisition OR bankruptcy OR shutdown OR restructuring OR rebranding OR renamed OR relocated 2025 OR 2026'),
  ('google_news', 2, '2025 OR 2026'),
  ('tavily', 1, 'corporate changes 2025-01-01 – 2026-01-01 (12 months)'),
  ('tavily', 2, 'merger acquisition spinoff divestiture takeover 2025 OR 2026'),
  ('tavily', 3, 'headquarters relocation redomicile incorporated 2025 OR 2026'),
  ('tavily', 4, 'bankruptcy shutdown liquidation closure restructuring 2025 OR 2026'),
  ('tavily', 5, 'renamed rebranded sector pivot new name 2025 OR 2026')
"""


def _plan_sql() -> str:
    from .names_and_dates import STRONG
    return rf"""
  SELECT company, source, query_rank, '"' || trim(regexp_replace(regexp_replace(regexp_replace(
    company, '{STRONG}', '', 'g'), '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')) || '" ' || terms
    AS query
  FROM ({PARTY_NAMES_SQL}), (VALUES {_PLAN_ROWS}) t(source, query_rank, terms)
"""


QUERIES = {
    "evidence_union": (evidence_union, EVIDENCE_UNION),
    "url_dedupe": (url_dedupe, f"SELECT {_KEYS} FROM ({FIRST_SEEN_SQL})"),
    "url_dedupe_capped": (url_dedupe_capped, capped_levels()),
    "topk_per_source": (topk_per_source, TOPK),
    "section_format": (section_format,
                       f"SELECT source, item_rank, section FROM ({sections_sql(ITEMS_SQL)})"),
    "source_breakdown": (breakdown, BREAKDOWN),
    "context_assembly": (context_assembly, CONTEXT_ASSEMBLY),
    "context_breakdown": (context_breakdown, CONTEXT_BREAKDOWN),
    "source_list": (source_lists, SOURCE_LISTS),
    "headline_all": (headline_all, HEADLINE_ALL),
    "headline_first": (headline_first, HEADLINE_FIRST),
    "stage2_merge": (stage2_merge, STAGE2_MERGE),
    "fetch_plan": (plan, _plan_sql()),
}
