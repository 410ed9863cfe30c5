"""Whole runs: phrases looked up in documents up to one context each, and items to results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evidence import ITEM_ORDER, add_sections, assemble, first_seen, top_per_source
from ..operators.mentions import mentions_substring
from ..params import DETAIL_COLUMNS, LAYERED_SOURCES, SIGNALS, SOURCES, Params, Source
from ..functions.names import cache_key
from ..plans.run import (RECORD_TYPE, attributed, horizon_counts, in_horizon, layered_fetch, run_feeds,
                         run_results)
from .evidence import _HEADERS as HEADERS_SQL
from .evidence import capped_levels
from .extraction import _text
from .inputs import (ITEMS_SQL, LEXICON, PHRASE_KEYS_SQL, items, phrases, sections_sql, table,
                     texts)
from .mentions import _KW as KEYWORD_SQL
from .texts import sanitise_sql, shorten_sql

# The document sources as press feeds: src0 … src19, each cut to five items per company.
PRESS = tuple(Source(f"src{i}", i, f"SRC{i}", f"SRC{i}", None, 5) for i in range(20))


def mention_contexts(spark, sf) -> DataFrame:
    """One context row per company: mentioned items, first copy per URL, five per source,
    assembled; companies nobody mentions keep an empty row."""
    docs = texts(spark, sf)
    companies = phrases(spark, sf).distinct()
    # What an item needs of its text is cut out beforehand, so no whole text is shuffled.
    narrow = docs.select(
        "doc_id", "text", "source", F.substring("source", 4, 9).cast("int").alias("source_rank"),
        F.lit(1).alias("query_rank"), F.col("doc_id").alias("item_rank"),
        F.md5("text").alias("url"), F.substring_index("text", "\n", 1).alias("title"),
        F.substring("text", 1, 400).alias("snippet"))
    carried = [c for c in narrow.columns if c not in ("doc_id", "text")]
    found = mentions_substring(narrow, "doc_id", F.col("text"), companies, carry=carried)
    kept = top_per_source(first_seen(found), 5)
    section = F.concat(F.lit("["), F.upper("source"), F.lit("] "), F.col("title"), F.lit("\n"),
                       F.col("url"), F.lit("\n"), F.col("snippet"))
    packed = assemble(kept.select("company", "source", *ITEM_ORDER, section.alias("section")),
                      Params(sources=PRESS))
    return companies.join(packed, "company", "left").select(
        "company", F.coalesce("context", F.lit("")).alias("context"),
        F.coalesce("char_count", F.lit(0)).alias("char_count"),
        F.coalesce(F.array_join("sources", " "), F.lit("")).alias("sources"),
        F.coalesce(F.size("source_breakdown"), F.lit(0)).alias("source_count"))


MENTION_CONTEXTS = f"""
  WITH names AS (SELECT DISTINCT company, key FROM ({PHRASE_KEYS_SQL})),
  hit AS (
    SELECT company, source, CAST(substr(source, 4) AS INTEGER) AS r, doc_id, md5(text) AS url,
      '[' || upper(source) || '] ' || split_part(text, chr(10), 1) || chr(10) || md5(text) || chr(10)
        || substr(text, 1, 400) AS section
    FROM documents JOIN names ON key <> '' AND contains(lower(text), key)),
  kept AS (
    SELECT * FROM (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY company, url
      ORDER BY r, doc_id) = 1)
    QUALIFY row_number() OVER (PARTITION BY company, source ORDER BY doc_id) <= 5),
  block AS (
    SELECT company, r, '=== ' || upper(source) || ' ===' || chr(10) || string_agg(section,
      chr(10) || chr(10) ORDER BY doc_id) AS b, list(url ORDER BY doc_id) AS urls
    FROM kept GROUP BY company, source, r),
  ctx AS (
    SELECT company, string_agg(b, chr(10) || chr(10) ORDER BY r) AS t,
      flatten(list(urls ORDER BY r)) AS urls, count(*) AS n FROM block GROUP BY company)
  SELECT company, coalesce(substr(t, 1, 15000), '') AS context, coalesce(length(t), 0) AS char_count,
    coalesce(array_to_string(list_slice(urls, 1, 15), ' '), '') AS sources,
    coalesce(n, 0) AS source_count
  FROM names LEFT JOIN ctx USING (company)
"""


def _companies(spark, sf) -> DataFrame:
    langs = table(spark, sf, "documents").groupBy("lang").agg(F.min("doc_id").alias("input_pos"))
    return langs.select("input_pos", F.col("lang").alias("company"))


def full_run(spark, sf) -> DataFrame:
    """Items, gate, deep merge and three answer passes to result rows; a company per language,
    answers made from the documents' counts."""
    screen, answers = _counted_answers(spark, sf)
    rows = run_results(_companies(spark, sf), items(spark, sf), screen, answers, Params(roots=LEXICON))
    return rows.withColumn("sources", F.array_join("sources", " "))


def _counted_answers(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(gate's answers, passes' answers) of each language, from its number of documents."""
    per = table(spark, sf, "documents").groupBy(F.col("lang").alias("company")).agg(
        F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    screen = per.select("company", _text('{"score": ', n % 3 + 3, ', "reason": "n ', n, '"}')
                        .alias("raw"))

    def answer(which, signal, raw):
        return per.select("company", F.lit(which).alias("pass"),
                          F.lit(0).cast("long").alias("chunk_idx"), F.lit(signal).alias("signal"),
                          raw.alias("raw"))

    named = ", ".join(f'"{s}"' for s in SIGNALS)
    answers = [answer("pass1", "", _text(f'{{"detected": [{named}], "confidence": ', n % 4 + 2, "}")),
               answer("pass3", "", F.lit('{"verified": {"renaming": false}}'))]
    answers += [answer("pass2", s, _text(
        '{"confirmed": true, "detail": "', s, " ", n, '", "confidence": ', (n + i) % 5 + 1, "}"))
        for i, s in enumerate(SIGNALS)]
    return screen, reduce(DataFrame.unionByName, answers)


_BASE = tuple(s for s in SOURCES if s.name not in ("brave", "tavily"))
_BASE_KEPT = f"SELECT company, source, query_rank, item_rank FROM ({capped_levels(_BASE, stubs=False)})"
_RESULT_SIGNALS = ", ".join(f"('{s}', {i})" for i, s in enumerate(SIGNALS))
_ON = {s: f"bool_or(signal = '{s}' AND kept)" for s in SIGNALS}
_ON["operational_change"] = "bool_or(signal IN ('operational_change', 'shutdown') AND kept)"


def _detail_sql(signal: str) -> str:
    return f"max(CASE WHEN signal = '{signal}' AND kept THEN detail END)"


_DETAIL = {c: f"coalesce({_detail_sql(s)}, '')" for s, (c, _) in DETAIL_COLUMNS.items()}
_DETAIL["ops_detail"] = (f"concat_ws(' | ', {_detail_sql('operational_change')}, "
                         f"{_detail_sql('shutdown')})")
_LONG = "length(trim(coalesce(context, ''), chr(32) || chr(10) || chr(9) || chr(13))) >= 80"


def _if_long(column: str, otherwise: str) -> str:
    return f"CASE WHEN {_LONG} THEN {column} ELSE {otherwise} END AS {column}"


# The default run: exact caps, the keyword gate, deep evidence with its reserve, three passes.
FULL_RUN = rf"""
  WITH sec AS ({sections_sql(f"SELECT * FROM ({ITEMS_SQL}) SEMI JOIN ({_BASE_KEPT}) USING (company, source, query_rank, item_rank)")}),
  base AS (
    SELECT company, string_agg(block, chr(10) || chr(10) ORDER BY source_rank) AS t FROM (
      SELECT company, source_rank, '=== ' || {HEADERS_SQL} || ' ===' || chr(10) || string_agg(section,
        chr(10) || chr(10) ORDER BY query_rank, item_rank, url) AS block
      FROM sec GROUP BY company, source, source_rank) GROUP BY company),
  head AS (
    SELECT company, lower(string_agg(line, chr(10) ORDER BY i)) AS body FROM (
      SELECT company, i, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line FROM (
        SELECT company, unnest(string_split(t, chr(10))) AS line,
          generate_subscripts(string_split(t, chr(10)), 1) AS i FROM base))
    WHERE starts_with(line, '[') OR starts_with(line, '===') GROUP BY company),
  live AS (SELECT company, body FROM head WHERE length(body) >= 50 AND contains(body, company)
             AND regexp_matches(body, '{KEYWORD_SQL}')),
  piece AS (
    SELECT company, body, i,
      sum(length(p) + length(company)) OVER (PARTITION BY company ORDER BY i) AS past
    FROM (SELECT company, body, unnest(string_split(body, company)) AS p,
            generate_subscripts(string_split(body, company), 1) AS i FROM live)),
  gate AS (
    SELECT company FROM live WHERE len(list_filter(regexp_split_to_array(body, '[.
!?]'),
      lambda s: contains(s, company) AND regexp_matches(s, '{KEYWORD_SQL}'))) > 0
    UNION
    SELECT company FROM (SELECT *, CAST(past - length(company) + 1 AS BIGINT) AS pos FROM piece)
    WHERE pos <= length(body) - length(company) + 1 AND regexp_matches(substr(body,
      greatest(pos - 300, 1), pos + length(company) + 300 - greatest(pos - 300, 1)),
      '{KEYWORD_SQL}')),
  known AS (
    SELECT company, url, min(ord) AS ord FROM (SELECT company, url, row_number() OVER (
      PARTITION BY company ORDER BY source_rank, query_rank, item_rank, url) AS ord FROM sec)
    GROUP BY company, url QUALIFY row_number() OVER (PARTITION BY company ORDER BY min(ord)) <= 15),
  handed AS (
    SELECT * FROM ({ITEMS_SQL}) WHERE source = 'tavily' QUALIFY row_number() OVER (
      PARTITION BY company, query_rank ORDER BY item_rank) <= 5),
  deep AS (
    SELECT * FROM handed h WHERE url <> '' AND company IN (SELECT company FROM gate)
      AND NOT EXISTS (SELECT 1 FROM known k WHERE k.company = h.company AND k.url = h.url)
    QUALIFY row_number() OVER (PARTITION BY company, url ORDER BY query_rank, item_rank) = 1),
  block AS (
    SELECT company, chr(10) || chr(10) || '=== TAVILY DEEP SEARCH ===' || chr(10)
        || string_agg(section, chr(10) || chr(10) ORDER BY query_rank, item_rank) AS extra,
      list(url ORDER BY query_rank, item_rank) AS urls
    FROM ({sections_sql("SELECT * FROM deep")}) GROUP BY company),
  lists AS (SELECT company, list(url ORDER BY ord) AS urls FROM known GROUP BY company),
  ctx AS (
    SELECT base.company, CASE WHEN extra IS NULL THEN substr(t, 1, 15000) ELSE substr(substr(
        substr(t, 1, 15000), 1, 15000 - least(length(extra), 5000)) || extra, 1, 15000) END AS context,
      array_to_string(list_slice(list_concat(lists.urls, coalesce(block.urls, [])), 1, 15), ' ')
        AS sources
    FROM base LEFT JOIN lists USING (company) LEFT JOIN block USING (company)),
  answered AS (
    SELECT company, signal, signal || ' ' || n AS detail, CAST((n + i) % 5 + 1 AS INTEGER) AS confidence,
      signal <> 'renaming' AS kept
    FROM (SELECT lang AS company, count(*) AS n FROM documents GROUP BY lang),
      (VALUES {_RESULT_SIGNALS}) v(signal, i) WHERE (n + i) % 5 + 1 >= 2),
  folded AS (
    SELECT company, {", ".join(f"{_ON[s]} AS {s}" for s in SIGNALS)},
      {", ".join(f"{_DETAIL[c]} AS {c}" for c, _ in DETAIL_COLUMNS.values())},
      max(CASE WHEN kept THEN confidence END) AS sure FROM answered GROUP BY company),
  done AS (
    SELECT company, {", ".join(f"coalesce({s}, false) AS {s}" for s in SIGNALS)},
      {", ".join(f"coalesce({c}, '') AS {c}" for c, _ in DETAIL_COLUMNS.values())},
      {" + ".join(f"CAST(coalesce({s}, false) AS INTEGER)" for s in SIGNALS if s != "shutdown")}
        AS total_signals, coalesce(sure, 0) AS confidence_score, folded.company IS NULL AS none,
      context, sources
    FROM (SELECT DISTINCT lang AS company FROM documents) LEFT JOIN folded USING (company)
      LEFT JOIN ctx USING (company))
  SELECT company, {", ".join(_if_long(s, "false") for s in SIGNALS)}, '' AS hq_region,
    {", ".join(_if_long(c, "''") for c, _ in DETAIL_COLUMNS.values())},
    {_if_long("total_signals", "0")}, {_if_long("confidence_score", "0")},
    CASE WHEN NOT ({_LONG}) THEN 'Insufficient context to classify.'
      WHEN none THEN 'Signals detected but none confirmed after extraction.'
      WHEN total_signals = 0 THEN 'No significant corporate changes identified after verification.'
      ELSE substr(concat_ws('; ', {", ".join(f"'{label}: ' || nullif({c}, '')" for c, label in DETAIL_COLUMNS.values())}), 1, 500)
      END AS summary, coalesce(sources, '') AS sources
  FROM done
"""


# Items of the last two and a half years, one in nine undated; the press feeds' belong to no one.

def _dated_items(spark, sf) -> DataFrame:
    doc = F.col("item_rank")
    press = F.col("source").isin("prnewswire", "businesswire")
    return items(spark, sf).withColumns({
        "company": F.when(press, F.lit(None)).otherwise(F.col("company")),
        "domain": F.when((F.col("source") == "edgar") & (doc % 2 == 0), "10-K").otherwise("8-K/A"),
        "raw_date": F.when(doc % 9 == 0, "soon").otherwise(F.date_format(F.date_sub(
            F.lit("2024-06-30").cast("date"), (doc % 900).cast("int")), "yyyy-MM-dd"))})


def evidence_in_horizon(spark, sf) -> DataFrame:
    """Companies found in the press feeds, and what two horizons leave of all feeds."""
    found = attributed(_dated_items(spark, sf), _companies(spark, sf))
    as_of = F.lit("2024-06-30 08:00:00").cast("timestamp")
    return reduce(DataFrame.unionByName, [
        horizon_counts(in_horizon(found, as_of, Params(horizon_months=m)))
        .withColumn("months", F.lit(m)) for m in (6, 24)])


EVIDENCE_IN_HORIZON = f"""
  WITH d AS (
    SELECT * EXCLUDE (raw_date), CASE WHEN item_rank % 9 <> 0
      THEN DATE '2024-06-30' - CAST(item_rank % 900 AS INTEGER) END AS day FROM ({ITEMS_SQL})),
  names AS (SELECT DISTINCT lang AS company FROM documents),
  found AS (
    SELECT company, source, item_rank, day FROM d WHERE source NOT IN ('prnewswire', 'businesswire')
    UNION ALL
    SELECT n.company, source, item_rank, day FROM d JOIN names n
      ON contains(lower(title || ' ' || snippet), n.company)
    WHERE source IN ('prnewswire', 'businesswire'))
  SELECT months, company, source, count(*) AS items, count_if(day IS NULL) AS undated
  FROM found, (VALUES (6, DATE '2023-12-30'), (24, DATE '2022-06-30')) h(months, since)
  WHERE (source NOT IN ('edgar', 'google_news', 'gdelt', 'guardian') OR day IS NULL OR day >= since)
    AND NOT (source = 'edgar' AND item_rank % 2 = 0)
  GROUP BY ALL
"""


def feeds_run(spark, sf) -> DataFrame:
    """A run from landed feeds: press items found by name, one year back, one form of filings, and each
    company's sector from its first line in a list that has every company twice."""
    langs = _companies(spark, sf)
    twice = langs.select("company", F.inline(F.array(
        F.struct((F.col("input_pos") + 10 ** 9).alias("input_pos"), F.lit("later").alias("sector")),
        F.struct("input_pos", F.concat(F.lit("sector "), F.upper("company")).alias("sector")))))
    screen, answers = _counted_answers(spark, sf)
    rows = run_feeds(twice, _dated_items(spark, sf), screen, answers,
                     F.lit("2024-06-30 08:00:00").cast("timestamp"), Params(roots=LEXICON))
    return rows.withColumn("sources", F.array_join("sources", " "))


_FOUND_SQL = f"""
  WITH d AS (
    SELECT * REPLACE (CASE WHEN source = 'edgar' AND item_rank % 2 = 0 THEN '10-K' ELSE '8-K/A' END AS domain,
      CASE WHEN item_rank % 9 = 0 THEN 'soon' ELSE strftime(DATE '2024-06-30' - CAST(item_rank % 900 AS INTEGER),
        '%Y-%m-%d') END AS raw_date) FROM ({ITEMS_SQL})),
  found AS (
    SELECT * FROM d WHERE source NOT IN ('prnewswire', 'businesswire')
    UNION ALL
    SELECT d.* REPLACE (n.company AS company) FROM d JOIN (SELECT DISTINCT lang AS company FROM documents) n
      ON contains(lower(title || ' ' || snippet), n.company)
    WHERE source IN ('prnewswire', 'businesswire'))
  SELECT * FROM found
  WHERE (source NOT IN ('edgar', 'google_news', 'gdelt', 'guardian') OR item_rank % 9 = 0
      OR item_rank % 900 <= DATE '2024-06-30' - DATE '2023-06-30')
    AND NOT (source = 'edgar' AND item_rank % 2 = 0)
"""
FEEDS_RUN = (f"SELECT *, 'sector ' || upper(company) AS sector FROM "
             f"({FULL_RUN.replace(ITEMS_SQL, _FOUND_SQL)})")


def layered(spark, sf) -> DataFrame:
    """The cached path: one company's fresh record answers, the others are fetched with paragraph
    chunks; a stale record and one of another stage do not count."""
    companies = _companies(spark, sf)
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp")
    landed = F.when(F.col("company") == "es", F.lit("2023-12-01 00:00:00")).otherwise(
        "2024-01-29 09:00:00").cast("timestamp")
    record = F.struct(F.lit("cached head"), F.concat(F.lit("cached "), "company"),
                      F.array(F.lit("one"), F.lit("two")), F.array(F.lit("u1")), F.lit(9),
                      F.create_map(F.lit("gdelt"), F.lit(9)), F.lit(3), F.lit(1)).cast(RECORD_TYPE)
    stage = F.when(F.col("company") == "de", "1").otherwise("2")
    cached = companies.filter("company <> 'en'").select(
        cache_key(F.col("company"), as_of, stage).alias("key"), "company", record.alias("payload"),
        landed.alias("fetched_at"))
    out = layered_fetch(companies, cached, items(spark, sf), as_of, stage2=True)
    return out.select("company", "from_cache", "char_count", "context",
                      F.array_join("sources", " ").alias("sources"), "headline_text",
                      "tavily_calls", "brave_calls", F.size("source_breakdown").alias("feeds"),
                      (F.size("chunks") > 0).alias("chunked"))


_CUT = "CASE source WHEN 'edgar' THEN snippet WHEN 'wikipedia' THEN substr(snippet, 1, 1200) " + " ".join(
    f"WHEN '{s.name}' THEN {shorten_sql('snippet', s.snippet_chars)}"
    for s in LAYERED_SOURCES if s.snippet_chars and s.at_sentence) + " ELSE '' END"
_LAYERED_ITEMS = f"""
  SELECT * REPLACE (
    CASE WHEN source = 'wikipedia' THEN title ELSE {sanitise_sql('title')} END AS title,
    {sanitise_sql('snippet')} AS snippet,
    CASE WHEN source = 'edgar' THEN '8-K' ELSE domain END AS domain) FROM ({ITEMS_SQL})
"""
_KEPT = f"SELECT company, source, query_rank, item_rank FROM ({capped_levels(LAYERED_SOURCES, stubs=False)})"
LAYERED = rf"""
  WITH sec AS ({sections_sql(f"SELECT * FROM ({_LAYERED_ITEMS}) SEMI JOIN ({_KEPT}) USING (company, source, query_rank, item_rank)", _CUT)}),
  ctx AS (
    SELECT company, string_agg(section, chr(10) || chr(10) ORDER BY source_rank, query_rank,
        item_rank) AS t, list(url ORDER BY source_rank, query_rank, item_rank) AS urls,
      string_agg(list_filter(list_transform(string_split(section, chr(10)),
        lambda line: regexp_replace(line, '^\s+|\s+$', '', 'g')),
        lambda l: starts_with(l, '['))[1], chr(10)
        ORDER BY source_rank, query_rank, item_rank) AS headline_text
    FROM sec GROUP BY company),
  firsts AS (
    SELECT company, url, row_number() OVER (PARTITION BY company ORDER BY min(i)) AS n
    FROM (SELECT company, unnest(urls) AS url, generate_subscripts(urls, 1) AS i FROM ctx)
    GROUP BY company, url)
  SELECT company, false AS from_cache, length(t) AS char_count, substr(t, 1, 15000) AS context,
    (SELECT string_agg(url, ' ' ORDER BY n) FROM firsts f
      WHERE f.company = ctx.company AND n <= 15) AS sources, headline_text,
    (SELECT count(DISTINCT query_rank) FROM ({ITEMS_SQL}) i
      WHERE i.company = ctx.company AND source = 'tavily') AS tavily_calls,
    (SELECT count(DISTINCT query_rank) FROM ({ITEMS_SQL}) i
      WHERE i.company = ctx.company AND source = 'brave') AS brave_calls,
    (SELECT count(DISTINCT source) FROM sec WHERE sec.company = ctx.company) AS feeds,
    true AS chunked
  FROM ctx WHERE company <> 'fr'
  UNION ALL
  SELECT 'fr', true, 9, 'cached fr', 'u1', 'cached head', 3, 1, 1, true
  WHERE 'fr' IN (SELECT lang FROM documents)
"""


QUERIES = {
    "mention_contexts": (mention_contexts, MENTION_CONTEXTS),
    "evidence_in_horizon": (evidence_in_horizon, EVIDENCE_IN_HORIZON),
    "full_run": (full_run, FULL_RUN),
    "feeds_run": (feeds_run, FEEDS_RUN),
    "layered_fetch": (layered, LAYERED),
}
