"""Queries over the landed-item index, two-word names, and the request tables of the passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import requests
from ..operators.mentions import mentions_substring
from ..operators.search import Rule, rule_table, search_landed
from ..params import Params
from ..sources.search_index import SearchIndex
from .extraction import _EVENTS, _PASS1, _PASS2, _PASS3, _events, _parsed, _int, _truth
from .extraction import _pass1, _pass2, _pass3
from .inputs import phrases, table
from .sinks import _folder

# ---- landed items -------------------------------------------------------------------------

_FEEDS = ("edgar", "google_news", "gdelt", "guardian")
_FEED_LIST = "[" + ", ".join(f"'{f}'" for f in _FEEDS) + "]"
AS_OF = "2024-06-30 08:00:00"
# The feeds' rules, asking for words that the test texts have.
RULES = (
    Rule("edgar", form="8-K"),
    Rule("google_news", 1, ("licensed", "apache", "de la", "permission"), with_years=True),
    Rule("google_news", 2, with_years=True),
    Rule("gdelt", any_of=("the", "rights reserved", "in no event")),
    Rule("guardian", any_of=("of the", "license", "la"), section="business", windowed=False),
)


def _landed(spark, sf) -> DataFrame:
    """Documents as items of the searched feeds: filings of two forms, three sections (one item in
    seven without), days over two and a half years, one item in nine undated."""
    doc = F.col("doc_id")
    year = F.when(doc % 5 == 0, F.concat(F.lit("in "), (2022 + doc % 4).cast("string"))).otherwise("")
    return table(spark, sf, "documents").select(
        F.get(F.array(*map(F.lit, _FEEDS)), (doc % 4).cast("int")).alias("source"),
        doc.alias("item_rank"), F.concat(F.substring_index("text", "\n", 1), F.lit(" "), year).alias("title"),
        F.col("text").alias("snippet"),
        F.when(doc % 7 == 0, "").otherwise(F.get(F.array(*map(F.lit, ("business", "sport", "world"))),
                                                 (doc % 3).cast("int"))).alias("section"),
        F.when(doc % 3 == 0, "10-K").otherwise("8-K/A").alias("domain"),
        F.when(doc % 9 == 0, "soon").otherwise(F.date_format(F.date_sub(
            F.lit("2024-06-30").cast("date"), (doc % 900).cast("int")), "yyyy-MM-dd")).alias("raw_date"))


def _names(spark, sf) -> DataFrame:
    """Names of three words and of two."""
    return phrases(spark, sf).unionByName(pairs(spark, sf)).distinct()


def pairs(spark, sf) -> DataFrame:
    """(company): the first two words of every benchmark text."""
    words = F.split(F.col("text"), r"\s+")
    return table(spark, sf, "benchmark").select(
        F.array_join(F.slice(words, 1, 2), " ").alias("company"))


def _keys_sql(words: int) -> str:
    return rf"""
  SELECT DISTINCT company, lower(trim(regexp_replace(regexp_replace(
    company, '[^\p{{L}}\p{{M}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS key
  FROM (SELECT array_to_string(list_slice(regexp_split_to_array(text, '\s+'), 1, {words}), ' ')
          AS company FROM benchmark)"""


def landed_search(spark, sf) -> DataFrame:
    """Documents landed on two days, one of them twice, and searched by the feeds' rules."""
    index = SearchIndex(spark, _folder(spark, "index"))
    rows = _landed(spark, sf)
    odd = F.col("item_rank") % 2 == 1
    index.land(rows.filter(odd), "2024-06-29")
    index.land(rows.filter(~odd).limit(50), "2024-06-30")
    index.land(rows.filter(~odd), "2024-06-30")
    found = search_landed(index, _names(spark, sf), F.lit(AS_OF).cast("timestamp"),
                          rule_table(spark, RULES))
    return found.select("company", "source", "query_rank", F.col("item_rank").alias("doc_id"))


def _rule_sql(r: Rule) -> str:
    terms = [f"' {t} '" for t in r.any_of]
    terms += ["' 2023 '", "' 2024 '"] if r.with_years else []
    conditions = [f"source = '{r.source}'"]
    if terms:
        conditions.append("(" + " OR ".join(f"contains(words, {t})" for t in terms) + ")")
    if r.section:
        conditions.append(f"section IN ('', '{r.section}')")
    if r.form:
        conditions.append(f"starts_with(form, '{r.form}')")
    if r.windowed:
        conditions.append("(day IS NULL OR day >= DATE '2023-06-30')")
    return (f"SELECT doc_id, source, {r.query_rank} AS query_rank, words FROM d WHERE "
            + " AND ".join(conditions))


LANDED_SEARCH = rf"""
  WITH d AS (
    SELECT doc_id, ({_FEED_LIST})[1 + doc_id % 4] AS source,
      ' ' || trim(regexp_replace(lower(split_part(text, chr(10), 1) || '  ' || CASE WHEN doc_id % 5 = 0
        THEN 'in ' || (2022 + doc_id % 4) ELSE '' END || ' ' || text), '[^\p{{L}}\p{{M}}\p{{N}}_]+', ' ', 'g'))
        || ' ' AS words,
      CASE WHEN doc_id % 7 = 0 THEN '' ELSE (['business', 'sport', 'world'])[1 + doc_id % 3] END AS section,
      CASE WHEN doc_id % 3 = 0 THEN '10-K' ELSE '8-K/A' END AS form,
      CASE WHEN doc_id % 9 <> 0 THEN DATE '2024-06-30' - CAST(doc_id % 900 AS INTEGER) END AS day
    FROM documents),
  asked AS ({" UNION ALL ".join(map(_rule_sql, RULES))}),
  names AS ({_keys_sql(3)} UNION {_keys_sql(2)})
  SELECT company, source, query_rank, doc_id FROM asked JOIN names
    ON key <> '' AND contains(words, ' ' || key || ' ')
"""


def entity_mentions_pairs(spark, sf) -> DataFrame:
    """Names of two words: the first may end a word of the text, the second may begin one."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return mentions_substring(docs, "doc_id", F.col("text"), pairs(spark, sf))


ENTITY_MENTIONS_PAIRS = f"""
  SELECT doc_id, company FROM documents JOIN ({_keys_sql(2)}) ON contains(lower(text), key)
  WHERE key <> ''
"""

# ---- requests of the passes ---------------------------------------------------------------

_P = Params(chunk_chars=60, max_chunks=3)


def _request_answers(spark, sf) -> DataFrame:
    """Answers to up to three chunks, to three of four details and to two of three last questions."""
    ev = _events(spark, sf)
    third = (F.col("event_id") % 3)
    last = ev.groupBy("company", third.alias("_i")).agg(F.max(F.struct(
        "event_id", "k", "event_type", "signal")).alias("e")).select("company", "e.*")
    size = F.length(F.concat("company", "signal"))
    chunks = _pass1(last).withColumn("chunk_idx", F.col("chunk_idx") % 3)
    return reduce(DataFrame.unionByName, [
        chunks, _pass2(ev).filter(size % 4 != 0), _pass3(ev).filter(F.length("company") % 3 != 0)])


def _request_contexts(spark, sf) -> DataFrame:
    return _events(spark, sf).groupBy("company").agg(F.count(F.lit(1)).cast("int").alias("n")).select(
        "company", F.expr("repeat('evidence. ', 6 + 2 * n)").alias("context"))


def open_requests(spark, sf) -> DataFrame:
    rows = requests.open_requests(_request_contexts(spark, sf), _request_answers(spark, sf), _P)
    return rows.select("company", "pass", "chunk_idx", "signal", "prompt")


_LAST = f"""SELECT * FROM ({_EVENTS}) QUALIFY row_number() OVER (
  PARTITION BY company, event_id % 3 ORDER BY event_id DESC) = 1"""
_CHUNK_ANSWERS = (f"SELECT * REPLACE (chunk_idx % 3 AS chunk_idx) FROM "
                  f"({_PASS1.replace(_EVENTS, _LAST)})")
_CONF = f"coalesce({_int('confidence')}, 1)"
_HEAD = "substr(context, 1, 180)"
OPEN_REQUESTS = rf"""
  WITH ctx AS (SELECT company, repeat('evidence. ', 6 + 2 * CAST(count(*) AS INTEGER)) AS context
               FROM ({_EVENTS}) GROUP BY company),
  long AS (SELECT * FROM ctx WHERE length(trim(context)) >= 80),
  p1 AS (SELECT company, context, i, substr(context, CAST(60 * i + 1 AS INTEGER), 60) AS prompt FROM (
    SELECT company, context, unnest(range(least(3, CAST(ceil(length(context) / 60.0) AS INTEGER)))) AS i
    FROM long) WHERE length(trim(substr(context, CAST(60 * i + 1 AS INTEGER), 60))) > 0),
  a1 AS (SELECT company, chunk_idx, j FROM ({_parsed(_CHUNK_ANSWERS)})),
  open1 AS (SELECT p1.* FROM p1 LEFT JOIN a1 ON p1.company = a1.company AND p1.i = a1.chunk_idx
            WHERE a1.company IS NULL),
  ready1 AS (SELECT DISTINCT company FROM p1 WHERE company NOT IN (SELECT company FROM open1)),
  best AS (SELECT company FROM a1 WHERE j IS NOT NULL GROUP BY company HAVING greatest(max({_CONF}), 1) >= 2),
  live AS (
    SELECT DISTINCT company, unnest(CAST(json_extract(j, '$.detected') AS VARCHAR[])) AS signal
    FROM a1 WHERE json_type(j, '$.detected') = 'ARRAY' AND company IN (SELECT company FROM best)
      AND company IN (SELECT company FROM ready1)),
  a2 AS (SELECT * FROM ({_parsed(_PASS2)}) WHERE length(company || signal) % 4 <> 0),
  open2 AS (SELECT * FROM live ANTI JOIN a2 USING (company, signal)),
  told AS (
    SELECT company, '{{' || string_agg('"' || signal || '":"' || json_extract_string(j, '$.detail') || '"',
        ',' ORDER BY signal) || '}}' AS told
    FROM live JOIN a2 USING (company, signal)
    WHERE {_CONF} >= 2 AND {_truth("'$.confirmed'")} AND company NOT IN (SELECT company FROM open2)
    GROUP BY company),
  a3 AS (SELECT company FROM ({_PASS3}) WHERE length(company) % 3 <> 0)
  SELECT company, 'pass1' AS pass, i AS chunk_idx, '' AS signal, prompt FROM open1
  UNION ALL
  SELECT company, 'pass2', 0, signal, {_HEAD} FROM open2 JOIN long USING (company)
  UNION ALL
  SELECT company, 'pass3', 0, '', told || chr(10) || {_HEAD} FROM told JOIN long USING (company)
  WHERE company NOT IN (SELECT company FROM a3)
"""

QUERIES = {
    "landed_search": (landed_search, LANDED_SEARCH),
    "entity_mentions_pairs": (entity_mentions_pairs, ENTITY_MENTIONS_PAIRS),
    "open_requests": (open_requests, OPEN_REQUESTS),
}
