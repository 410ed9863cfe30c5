"""Round trips: tables written and read back by the library's sinks, scans and stream."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_published
from ..functions.names import clean_name, truncate
from ..operators.batch import spread
from ..operators.evidence import union_feeds
from ..plans import report
from ..session import checkpoint_dir
from ..sources import cache, results as stored
from ..sources.companies import load_companies
from ..sources.feeds import read_rss_files
from ..streaming.ingest import dedupe_stream, item_stream, start_ingest
from .inputs import PARTY_NAMES_SQL, RESULTS_SQL, party_names, results, table
from .lifecycle import _ASKED, _FRESH, _TTL, _as_of, _cache, _users
from .texts import _PAGES_SQL, _pages, _xml


def _folder(spark, label: str) -> str:
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def csv_scan(spark, sf) -> DataFrame:
    """Names with quoted commas and their sectors, written as CSV and scanned again."""
    path = _folder(spark, "csv")
    c = party_names(spark, sf).select(F.col("company").alias(" COMPANY_NAME "),
                                      F.concat(F.lit("s"), F.col("pos") % 7).alias("Sector"))
    c.write.csv(path, header=True)
    return load_companies(spark, path).select("company", "sector")


CSV_SCAN = f"SELECT company, 's' || (pos % 7) AS sector FROM ({PARTY_NAMES_SQL})"


def result_table(spark, sf) -> DataFrame:
    """Two runs in the result table, one of them written twice, as after a failed attempt."""
    name = f"firmlens_results_{uuid.uuid4().hex}"
    stored.create_table(spark, name, location=_folder(spark, "results"))
    rows = results(spark, sf).withColumn("company", F.concat_ws("@", "company", "run_id"))
    some = rows.filter("total_signals > 2")
    for run, part in (("some", rows), ("all", rows), ("some", some)):
        stored.append_run(part, name, run)
    back = stored.with_source_list(stored.read_results(spark, name))
    return back.select("company", "run_id", "total_signals", "ma_spinoff", "confidence_score",
                       "error", F.array_join("sources", " ").alias("sources"))


_STORED = """SELECT company || '@' || run_id AS company, '{run}' AS run_id, total_signals, ma_spinoff,
    confidence_score, error, array_to_string(sources, ' ') AS sources FROM ({rows})"""
RESULT_TABLE = (_STORED.format(run="all", rows=RESULTS_SQL) + " UNION ALL "
                + _STORED.format(run="some", rows=RESULTS_SQL) + " WHERE total_signals > 2")


def checkpoint_load(spark, sf) -> DataFrame:
    """A checkpoint of few columns, and one that was never written."""
    path = _folder(spark, "attempt")
    results(spark, sf).select("company", "total_signals", "renaming").write.parquet(path)
    both = stored.read_checkpoint(spark, path).unionByName(
        stored.read_checkpoint(spark, f"{path}-none"))
    return both.select("company", "total_signals", "renaming", "bankruptcy", "summary", "sources")


CHECKPOINT_LOAD = f"""
  SELECT company, total_signals, renaming, false AS bankruptcy, '' AS summary, '[]' AS sources
  FROM ({RESULTS_SQL})
"""


def report_views(spark, sf) -> DataFrame:
    """All eight views, written from one run and read back: (view, name, text)."""
    path = _folder(spark, "report")
    report.report_run(results(spark, sf).withColumn("renaming", F.lit(False)), path,
                      F.lit("2024-02-01"), F.lit("12 months"), F.lit(61.5))
    cells = {"dashboard": ("company", "summary"), "run_stats": ("metric", "value"),
             "hq_changes": ("company", "detail"), "operational_changes": ("company", "detail"),
             **{view: ("company", "detail") for view in report.DETAIL_VIEWS}}
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{path}/{view}").select(
            F.lit(view).alias("view"), F.col(name).alias("name"), F.col(text).alias("text"))
        for view, (name, text) in cells.items()])


_VIEWS = {**report.DETAIL_VIEWS, "hq_changes": ("hq_change", "hq_detail"),
          "operational_changes": ("operational_change OR shutdown", "ops_detail")}
_STAT_ROWS = [("Generated", "max('2024-02-01')"), ("Date Window", "max('12 months')"),
              ("Total Companies Processed", "count(*)"),
              ("Companies with Signals", "count_if(total_signals > 0)"), ("", "max('')"),
              ("— Signal Breakdown —", "max('')"),
              *[(label, "max(0)" if flag == "renaming" else f"count_if({flag})")
                for label, flag in report.STAT_LABELS], ("Pipeline Runtime", "max('1m 1s')")]
REPORT_VIEWS = " UNION ALL ".join(
    [f"SELECT 'dashboard' AS view, company AS name, summary AS text FROM ({RESULTS_SQL})"]
    + [f"SELECT '{view}', company, {detail} FROM ({RESULTS_SQL}) WHERE {flag}"
       for view, (flag, detail) in _VIEWS.items() if flag != "renaming"]
    + ["SELECT 'renaming_rebranding', 'No signals detected.', NULL"]
    + [f"SELECT 'run_stats', '{label}', CAST({value} AS VARCHAR) FROM ({RESULTS_SQL})"
       for label, value in _STAT_ROWS])


def cache_round_trip(spark, sf) -> DataFrame:
    """Records written by week, the current week forgotten for some companies, then asked for."""
    path = _folder(spark, "cache")
    cache.write_entries(_cache(spark, sf), path)
    gone = _users(spark, sf).filter("company LIKE '%3'")
    cache.rewrite_week(spark, path, gone, _as_of())
    hits = cache.lookup(_users(spark, sf), cache.read_entries(spark, path, _as_of()), _as_of(), _TTL)
    return hits.select("company", "key", "payload", "from_cache")


CACHE_ROUND_TRIP = f"""
  SELECT company, key, payload, true AS from_cache
  FROM ({_ASKED}) JOIN (SELECT key, payload, fetched_at FROM ({_FRESH})
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY fetched_at DESC) = 1) USING (key)
  WHERE company NOT LIKE '%3'
"""


def cache_probe(spark, sf) -> DataFrame:
    """The stored cache asked for the customers of one country and segment, by their keys where these
    are few, and which of them it does not answer."""
    path = _folder(spark, "cache")
    cache.write_entries(_cache(spark, sf), path)
    asked = table(spark, sf, "customer").filter(
        "c_nationkey = 7 AND c_mktsegment = 'MACHINERY'").select(
        F.concat(F.lit("user_"), F.col("c_custkey")).alias("company"))
    stored_week, few = cache.read_entries(spark, path, _as_of()), replace(_TTL, cache_probe=64)
    hits = cache.lookup(asked, stored_week, _as_of(), few).select("company", "key", "payload")
    return hits.unionByName(cache.misses(asked, stored_week, _as_of(), few).select(
        "company", "key", F.lit(None).cast("string").alias("payload")))


CACHE_PROBE = f"""
  SELECT a.company, a.key, e.payload
  FROM ({_ASKED} WHERE c_nationkey = 7 AND c_mktsegment = 'MACHINERY') a
  LEFT JOIN (SELECT key, payload FROM ({_FRESH})
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY fetched_at DESC) = 1) e ON a.key = e.key
"""


def rss_files(spark, sf) -> DataFrame:
    """Landed RSS files of a press feed, some broken off after their items, in the union of feeds."""
    path = _folder(spark, "rss")
    item = F.concat(F.lit("<item><title>"), _xml(F.col("title")), F.lit("</title><link>"),
                    _xml(F.col("url")), F.lit("</link><description>"), _xml(F.col("body")),
                    F.lit("</description><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item>"))
    # A payload is eight pages by construction, so this group is bounded.
    feeds = _pages(spark, sf).groupBy("feed").agg(F.sort_array(F.collect_list(
        F.struct("page_id", item.alias("x")))).alias("xs"))
    doc = F.concat(F.lit("<rss><channel><title>feed</title>"),
                   F.array_join(F.transform("xs", lambda x: x["x"]), "\n"),
                   F.when(F.col("feed") % 9 == 4, "").otherwise("</channel></rss>"))
    feeds.select("feed", doc.alias("value")).write.partitionBy("feed").text(path)
    items = union_feeds({"prnewswire": read_rss_files(spark, path, "prnewswire")})
    return items.select("company", "source", "source_rank", "url", "title", "snippet", "raw_date")


RSS_FILES = rf"""
  SELECT NULL AS company, 'prnewswire' AS source, 5 AS source_rank, url,
    regexp_replace(title, '^\s+|\s+$', '', 'g') AS title,
    regexp_replace(body, '^\s+|\s+$', '', 'g') AS snippet,
    'Mon, 01 Jan 2024 10:00:00 GMT' AS raw_date FROM ({_PAGES_SQL})
"""


def stream_ingest(spark, sf) -> DataFrame:
    """Documents landed in three deliveries, the newest first, through the stream's dedupe."""
    landed, out = _folder(spark, "landed"), _folder(spark, "ingested")
    doc = F.col("doc_id")
    rows = table(spark, sf, "documents").select(
        F.col("lang").alias("company"),
        F.when(doc % 4 == 0, "edgar").otherwise("gdelt").alias("source"),
        F.when(doc % 5 == 0, "").otherwise(F.md5("text")).alias("url"), "doc_id",
        F.date_sub(F.lit("2024-06-01").cast("date"), (doc % 300).cast("int")).alias("published"))
    for k in (2, 1, 0):
        rows.filter(doc % 3 == k).write.mode("append").parquet(landed)
    stream = dedupe_stream(item_stream(spark, landed, rows.schema, max_files=4))
    query = start_ingest(stream, out, _folder(spark, "ingest-state"))
    query.awaitTermination()
    return spark.read.parquet(out).groupBy("company", "url").agg(
        F.count(F.lit(1)).alias("items"))


STREAM_INGEST = """
  WITH d AS (SELECT lang AS company, doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE md5(text) END AS url
             FROM documents)
  SELECT company, url, count(DISTINCT CASE WHEN url = '' THEN doc_id END)
      + CAST(max(url) <> '' AS INTEGER) AS items
  FROM d WHERE url <> '' OR doc_id % 4 = 0 GROUP BY company, url
"""


def published_dates(spark, sf) -> DataFrame:
    """Every event's day in one of the feeds' date shapes, or in none."""
    ts, e = F.col("ts"), F.col("event_id")
    raw = (F.when(e % 5 == 0, F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"))
           .when(e % 5 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .when(e % 5 == 2, F.date_format(ts, "yyyy-MM-dd"))
           .when(e % 5 == 3, F.concat(F.lit("Xxx, "), F.date_format(ts, "d MMM yyyy HH:mm:ss"),
                                      F.lit(" GMT")))
           .otherwise("3 days ago"))
    return table(spark, sf, "events").select("event_id", F.date_format(
        parse_published(raw), "yyyy-MM-dd HH:mm:ss").alias("published"))


PUBLISHED_DATES = """
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%d 00:00:00')
    WHEN 2 THEN strftime(ts, '%Y-%m-%d 00:00:00') WHEN 4 THEN NULL
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS published FROM events
"""


def spread_names(spark, sf) -> DataFrame:
    """Cleaned and cut names after the repartition that precedes slow per-row work."""
    names = spread(party_names(spark, sf), 16)
    return names.select("pos", truncate(clean_name(F.col("company")), 9).alias("short"))


SPREAD_NAMES = f"""
  SELECT pos, substr(replace(company, '#', ' '), 1, 9) AS short FROM ({PARTY_NAMES_SQL})
"""

QUERIES = {
    "csv_scan": (csv_scan, CSV_SCAN),
    "result_table": (result_table, RESULT_TABLE),
    "checkpoint_load": (checkpoint_load, CHECKPOINT_LOAD),
    "report_views": (report_views, REPORT_VIEWS),
    "cache_round_trip": (cache_round_trip, CACHE_ROUND_TRIP),
    "cache_probe": (cache_probe, CACHE_PROBE),
    "rss_files": (rss_files, RSS_FILES),
    "stream_ingest": (stream_ingest, STREAM_INGEST),
    "published_dates": (published_dates, PUBLISHED_DATES),
    "spread_names": (spread_names, SPREAD_NAMES),
}
