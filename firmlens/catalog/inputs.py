"""The driver's tables read as companies, items, answers and results.

Each reading exists twice: as a DataFrame for the library and as SQL text for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import SOURCES
from ..session import spread_if_few

LEXICON = ("licen[cs]e", "apache", "permission", "reserved")
SOURCE_NAMES = [s.name for s in SOURCES]
_NAME_LIST = "[" + ", ".join(f"'{n}'" for n in SOURCE_NAMES) + "]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of long texts, one task per core at least."""
    return spread_if_few(table(spark, sf_dir, name))


# ---- names with suffixes, from customers and suppliers ------------------------------------

NAME_SUFFIXES = ("", " plc", " Holdings Ltd.", " S.A.", " International Group", ", Inc.",
                 " AG", " & Co. Limited")


def party_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, company): customers, then suppliers, each with a suffix chosen by its key."""
    suffixes = F.array(*map(F.lit, NAME_SUFFIXES))

    def named(t: str, key: str, name: str, offset: int) -> DataFrame:
        suffix = F.get(suffixes, (F.col(key) % len(NAME_SUFFIXES)).cast("int"))
        return table(spark, sf_dir, t).select(
            (F.col(key) + offset).alias("pos"), F.concat(F.col(name), suffix).alias("company"))
    return named("customer", "c_custkey", "c_name", 0).unionByName(
        named("supplier", "s_suppkey", "s_name", 10 ** 12))


_SUFFIX_LIST = "[" + ", ".join(f"'{s}'" for s in NAME_SUFFIXES) + "]"
PARTY_NAMES_SQL = f"""
  SELECT c_custkey AS pos, c_name || ({_SUFFIX_LIST})[1 + c_custkey % 8] AS company FROM customer
  UNION ALL
  SELECT s_suppkey + 1000000000000, s_name || ({_SUFFIX_LIST})[1 + s_suppkey % 8] FROM supplier
"""

# ---- phrases as company names -------------------------------------------------------------


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(company): the first three words of every benchmark text."""
    words = F.split(F.col("text"), r"\s+")
    return table(spark, sf_dir, "benchmark").select(
        F.array_join(F.slice(words, 1, 3), " ").alias("company"))


PHRASES_SQL = r"""
  SELECT array_to_string(list_slice(regexp_split_to_array(text, '\s+'), 1, 3), ' ') AS company
  FROM benchmark
"""
# Cleaned key of a phrase; the test phrases hold no suffix words.
PHRASE_KEYS_SQL = rf"""
  SELECT DISTINCT company, lower(trim(regexp_replace(regexp_replace(
    company, '[^\p{{L}}\p{{M}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS key
  FROM ({PHRASES_SQL})
"""

# ---- documents as evidence items ----------------------------------------------------------


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items. The company is the language: four names share all rows, so every
    per-company step meets keys as hot as they come. URLs repeat: one in seven is the same
    front page, copies of a text share a URL, and some are empty."""
    doc = F.col("doc_id")
    rank = (F.substring("source", 4, 9).cast("int") % 9 + 1).cast("int")
    name = F.get(F.array(*map(F.lit, SOURCE_NAMES)), rank - 1)
    query = F.when(rank == 2, 1 + doc % 2).when(rank == 9, 1 + doc % 5).otherwise(1)
    url = (F.when(doc % 50 == 0, "").when(doc % 7 == 0, "https://news.example/front")
           .otherwise(F.concat(F.lit("https://news.example/"),
                               F.md5("text"))))
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("company"), name.alias("source"), rank.alias("source_rank"),
        query.cast("int").alias("query_rank"), doc.alias("item_rank"), url.alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("snippet"), F.col("source").alias("domain"),
        F.concat(F.lit("2024-01-"), F.lpad((doc % 28 + 1).cast("string"), 2, "0"))
        .alias("raw_date"))


ITEMS_SQL = f"""
  SELECT lang AS company, ({_NAME_LIST})[r] AS source, r AS source_rank,
    CAST(CASE r WHEN 2 THEN 1 + doc_id % 2 WHEN 9 THEN 1 + doc_id % 5 ELSE 1 END AS INTEGER)
      AS query_rank,
    doc_id AS item_rank,
    CASE WHEN doc_id % 50 = 0 THEN '' WHEN doc_id % 7 = 0 THEN 'https://news.example/front'
         ELSE 'https://news.example/' || md5(text) END AS url,
    split_part(text, chr(10), 1) AS title, text AS snippet, src AS domain,
    '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS raw_date
  FROM (SELECT *, source AS src, CAST(substr(source, 4) AS INTEGER) % 9 + 1 AS r
        FROM documents)
"""
_SKIPS = ", ".join(f"'{s.name}'" for s in SOURCES if s.skip_empty)
NON_EMPTY_ITEMS_SQL = f"""
  SELECT * FROM ({ITEMS_SQL}) WHERE NOT (source IN ({_SKIPS}) AND url = '')
"""
FIRST_SEEN_SQL = f"""
  SELECT * FROM ({NON_EMPTY_ITEMS_SQL})
  QUALIFY row_number() OVER (PARTITION BY company, url
                             ORDER BY source_rank, query_rank, item_rank) = 1
"""
_BOUNDS = "[" + ", ".join(
    str(s.cap if s.cap is not None else s.page * s.queries) for s in SOURCES) + "]"
CAPPED_SQL = f"""
  SELECT * FROM ({FIRST_SEEN_SQL})
  QUALIFY row_number() OVER (PARTITION BY company, source
                             ORDER BY query_rank, item_rank, url) <= ({_BOUNDS})[source_rank]
"""
_SNIPPET = "CASE source WHEN 'edgar' THEN snippet " + " ".join(
    f"WHEN '{s.name}' THEN substr(snippet, 1, {s.snippet_chars})"
    for s in SOURCES if s.snippet_chars) + " ELSE '' END"


def sections_sql(rows: str, cut: str = _SNIPPET) -> str:
    """Item rows with their section text, the snippet cut by an expression."""
    return f"""
  SELECT *, CASE source
    WHEN 'edgar' THEN '[SEC EDGAR ' || coalesce(nullif(domain, ''), '8-K') || '] ' || title
      || ' — ' || raw_date || chr(10) || cut || chr(10) || url
    WHEN 'gdelt' THEN '[GDELT] ' || title || ' (' || raw_date || ') — ' || domain || chr(10)
      || url
    WHEN 'wikipedia' THEN '[WIKIPEDIA] ' || title || chr(10) || url || chr(10) || cut
    WHEN 'tavily' THEN '[TAVILY] ' || title || chr(10) || url || chr(10) || cut
    ELSE '[' || CASE source WHEN 'google_news' THEN 'GOOGLE NEWS' WHEN 'guardian' THEN 'GUARDIAN'
         WHEN 'prnewswire' THEN 'PR NEWSWIRE' WHEN 'businesswire' THEN 'BUSINESS WIRE'
         ELSE 'BRAVE WEB' END || '] ' || title || ' (' || raw_date || ')' || chr(10) || url
      || chr(10) || cut END AS section
  FROM (SELECT *, {cut} AS cut FROM ({rows}))
"""


# ---- events as result rows ----------------------------------------------------------------


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and day: a run per day, a company per user, flags by event type.

    Every aggregate combines before the shuffle, so a busy user is no heavier than any other.
    """
    ev = table(spark, sf_dir, "events")
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")

    def has(*conditions):
        cond = conditions[0]
        for c in conditions[1:]:
            cond = cond & c
        return F.bool_or(cond)

    def detail(name: str):
        return F.coalesce(F.max(F.when(kind == name, F.concat(
            F.lit(name + " k="), F.lpad(k.cast("string"), 2, "0")))), F.lit(""))

    # The calendar day as text: timestamps without a zone print as they are stored.
    day = F.date_format("ts", "yyyy-MM-dd")
    agg = ev.groupBy("user_id", day.alias("run_id")).agg(
        has(kind == "signup").alias("sector_change"), has(kind == "click").alias("hq_change"),
        has(kind == "view").alias("ma_spinoff"), has(kind == "purchase").alias("renaming"),
        has(kind == "purchase", F.col("value") > 10).alias("operational_change"),
        has(kind == "error", F.col("value") > 10).alias("shutdown"),
        has(kind == "error", k % 3 == 0).alias("bankruptcy"),
        detail("signup").alias("sector_detail"), detail("click").alias("hq_detail"),
        detail("view").alias("ma_detail"), detail("purchase").alias("rename_detail"),
        F.coalesce(F.max(F.when((kind == "purchase") & (F.col("value") > 10), F.concat(
            F.lit("ops k="), F.lpad(k.cast("string"), 2, "0")))), F.lit("")).alias("ops_detail"),
        detail("error").alias("bankruptcy_detail"),
        F.min("event_id").alias("_first"), F.max("event_id").alias("_last"),
        F.max("ts").alias("processed_at"), F.max(k % 6).alias("confidence_score"),
        F.bool_and(kind == "error").alias("_failed"), F.max(k % 8).alias("_region"))
    regions = F.array(*map(F.lit, ("USA West", "USA New York", "USA Midwest", "USA South",
                                   "USA Boston", "USA Northeast", "Canada", "")))
    link = F.lit("https://news.example/e/")
    flags = ("sector_change", "hq_change", "ma_spinoff", "renaming", "operational_change",
             "bankruptcy")
    total = F.lit(0)
    for f in flags:
        total = total + F.col(f).cast("int")
    return agg.select(
        F.concat(F.lit("user_"), F.col("user_id")).alias("company"), *flags, "shutdown",
        F.when(F.col("hq_change"), F.get(regions, F.col("_region"))).otherwise("")
        .alias("hq_region"),
        total.alias("total_signals"), "sector_detail", "hq_detail", "ma_detail",
        "rename_detail", "ops_detail", "bankruptcy_detail",
        F.concat(F.lit("events "), F.col("_first"), F.lit(".."), F.col("_last"))
        .alias("summary"),
        F.array_distinct(F.array(F.concat(link, F.col("_first")), F.concat(link, F.col("_last"))))
        .alias("sources"),
        "processed_at", "run_id", "confidence_score",
        F.when(F.col("_failed"), F.concat(F.lit("no answer after event "), F.col("_last")))
        .alias("error"))


RESULTS_SQL = """
  SELECT 'user_' || user_id AS company, sector_change, hq_change, ma_spinoff, renaming,
    operational_change, bankruptcy, shutdown,
    CASE WHEN hq_change THEN (['USA West', 'USA New York', 'USA Midwest', 'USA South',
      'USA Boston', 'USA Northeast', 'Canada', ''])[1 + region] ELSE '' END AS hq_region,
    CAST(sector_change AS INTEGER) + CAST(hq_change AS INTEGER) + CAST(ma_spinoff AS INTEGER)
      + CAST(renaming AS INTEGER) + CAST(operational_change AS INTEGER)
      + CAST(bankruptcy AS INTEGER) AS total_signals,
    sector_detail, hq_detail, ma_detail, rename_detail, ops_detail, bankruptcy_detail,
    'events ' || first_id || '..' || last_id AS summary,
    CASE WHEN first_id = last_id THEN ['https://news.example/e/' || first_id]
         ELSE ['https://news.example/e/' || first_id, 'https://news.example/e/' || last_id]
         END AS sources,
    processed_at, run_id, confidence_score,
    CASE WHEN failed THEN 'no answer after event ' || last_id END AS error
  FROM (
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS run_id,
      bool_or(event_type = 'signup') AS sector_change,
      bool_or(event_type = 'click') AS hq_change, bool_or(event_type = 'view') AS ma_spinoff,
      bool_or(event_type = 'purchase') AS renaming,
      bool_or(event_type = 'purchase' AND value > 10) AS operational_change,
      bool_or(event_type = 'error' AND value > 10) AS shutdown,
      bool_or(event_type = 'error' AND k % 3 = 0) AS bankruptcy,
      coalesce(max(CASE WHEN event_type = 'signup' THEN 'signup k=' || kk END), '') AS sector_detail,
      coalesce(max(CASE WHEN event_type = 'click' THEN 'click k=' || kk END), '') AS hq_detail,
      coalesce(max(CASE WHEN event_type = 'view' THEN 'view k=' || kk END), '') AS ma_detail,
      coalesce(max(CASE WHEN event_type = 'purchase' THEN 'purchase k=' || kk END), '') AS rename_detail,
      coalesce(max(CASE WHEN event_type = 'purchase' AND value > 10 THEN 'ops k=' || kk END), '') AS ops_detail,
      coalesce(max(CASE WHEN event_type = 'error' THEN 'error k=' || kk END), '') AS bankruptcy_detail,
      min(event_id) AS first_id, max(event_id) AS last_id, max(ts) AS processed_at,
      max(k % 6) AS confidence_score, bool_and(event_type = 'error') AS failed,
      max(k % 8) AS region
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                 lpad(json_extract_string(props, '$.k'), 2, '0') AS kk FROM events)
    GROUP BY user_id, strftime(ts, '%Y-%m-%d'))
"""
