"""Queries over results, runs, reports and the fetch cache."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lifecycle as life
from ..params import SIGNALS, Params
from ..plans import report
from ..sources import cache
from .inputs import RESULTS_SQL, results, table

# ---- resume: customers are the list, their orders the results -----------------------------


def _customers(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("input_pos"), F.col("c_custkey").alias("company"),
                    F.col("c_mktsegment").alias("sector"))


def _orders(spark, sf):
    """A result per order, for companies of even numbers; dear ones failed."""
    return table(spark, sf, "orders").select(
        (F.col("o_custkey") * 2).alias("company"),
        F.when(F.col("o_totalprice") > 100000, "failed").alias("error"))


def reassemble(spark, sf):
    """Each input row twice, in reverse: both copies get the row, order is the input's."""
    c = _customers(spark, sf)
    twice = c.select("company", "sector", F.explode(F.array(
        -F.col("input_pos"), F.col("input_pos") + 1)).alias("input_pos"))
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("company")).agg(
        F.count(F.lit(1)).cast("int").alias("total_signals"),
        F.max("o_orderstatus").alias("summary"),
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("renaming"))
    rows = life.reassemble(twice, o.filter("total_signals > 9"))
    return rows.select("input_pos", "company", "sector", "total_signals", "summary", "renaming")


REASSEMBLE = """
  SELECT input_pos, c.c_custkey AS company, c_mktsegment AS sector,
    coalesce(n, 0) AS total_signals, coalesce(s, '[skipped — not found in checkpoint]') AS summary,
    coalesce(urgent, false) AS renaming
  FROM (SELECT *, unnest([-c_custkey, c_custkey + 1]) AS input_pos FROM customer) c
  LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderstatus) AS s,
      bool_or(o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1 HAVING count(*) > 9)
    ON o_custkey = c_custkey
"""

# ---- runs ---------------------------------------------------------------------------------

_LATEST = f"""
  SELECT * FROM ({RESULTS_SQL}) WHERE run_id = (SELECT arg_max(run_id, (processed_at, run_id))
    FROM ({RESULTS_SQL}))
"""
_TIME = "strftime(processed_at, '%Y-%m-%d %H:%M:%S')"


def _stamp():
    return F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at")


_SUMS = ", ".join(f"CAST(sum(CAST({s} AS INTEGER)) AS BIGINT) AS {s}" for s in SIGNALS)
_KPIS = """
  SELECT count(*) AS processed, count(error) AS errors,
    count(CASE WHEN total_signals > 0 THEN 1 END) AS with_signals,
    CAST(round(100.0 * count(CASE WHEN total_signals > 0 THEN 1 END) / greatest(count(*), 1), 1)
      AS DOUBLE) AS signal_rate
"""


def kpis(spark, sf):
    """Of all runs, of the newest, and of a run that does not exist."""
    r = results(spark, sf)
    def of(run):
        return life.run_kpis(life.select_run(r, run)).withColumn("run", F.lit(run))
    return of("all").unionByName(of("latest")).unionByName(of("none"))


KPIS = f"""
  {_KPIS}, 'all' AS run FROM ({RESULTS_SQL})
  UNION ALL {_KPIS}, 'latest' FROM ({_LATEST})
  UNION ALL {_KPIS}, 'none' FROM (SELECT * FROM ({RESULTS_SQL}) WHERE run_id = 'none')
"""


def categories(spark, sf):
    r = results(spark, sf)
    empty = life.select_run(r, "none")
    return (life.category_counts(r).withColumn("run", F.lit("all"))
            .unionByName(life.category_counts(empty).withColumn("run", F.lit("empty")))
            .unionByName(life.category_counts(empty, null_when_empty=False)
                         .withColumn("run", F.lit("empty report"))))


_ZEROS = ", ".join(f"0 AS {s}" for s in SIGNALS)
_TOTAL = "CAST(sum(total_signals) AS BIGINT) AS total_signals"
CATEGORIES = f"""
  SELECT {_SUMS}, {_TOTAL}, 'all' AS run FROM ({RESULTS_SQL})
  UNION ALL SELECT {_SUMS}, {_TOTAL}, 'empty' FROM ({RESULTS_SQL}) WHERE run_id = 'none'
  UNION ALL SELECT {_ZEROS}, 0, 'empty report'
"""

CATEGORIES_LONG = " UNION ALL ".join(
    f"SELECT '{s}' AS signal, count_if({s}) AS companies FROM ({RESULTS_SQL})" for s in SIGNALS)

# ---- report -------------------------------------------------------------------------------


def _tick(c):
    return f"CASE WHEN {c} THEN '✓' ELSE '—' END AS {c}"


DASHBOARD = f"""
  SELECT company, {", ".join(_tick(c) for c in SIGNALS)}, total_signals, summary,
    CASE WHEN hq_change THEN hq_region ELSE '—' END AS hq_region, run_id FROM ({RESULTS_SQL})
"""
DETAIL = " UNION ALL ".join(
    f"SELECT '{view}' AS view, company, {detail} AS detail, "
    f"array_to_string(sources, '; ') AS sources FROM ({RESULTS_SQL}) WHERE {flag}"
    for view, (flag, detail) in report.DETAIL_VIEWS.items())


def dashboard(spark, sf):
    r = results(spark, sf)
    # Companies recur over runs: the dashboard of each run, told apart by the summary.
    return report.dashboard(r.withColumn("summary", F.concat("run_id", F.lit(" "), "summary")))


def stats(spark, sf):
    r = results(spark, sf)
    return report.stats(r, F.lit("2024-02-01 10:00"), F.lit("a – b (12 months)"), F.lit(754.9))


STATS = f"""
  SELECT position, metric, value FROM (VALUES
    (1, 'Generated', '2024-02-01 10:00'), (2, 'Date Window', 'a – b (12 months)'), (5, '', ''),
    (6, '— Signal Breakdown —', ''), (14, 'Pipeline Runtime', '12m 34s')) t(position, metric, value)
  UNION ALL SELECT 3, 'Total Companies Processed', CAST(count(*) AS VARCHAR) FROM ({RESULTS_SQL})
  UNION ALL SELECT 4, 'Companies with Signals', CAST(count_if(total_signals > 0) AS VARCHAR)
    FROM ({RESULTS_SQL})
""" + "".join(
    f" UNION ALL SELECT {i}, '{label}', CAST(count_if({flag}) AS VARCHAR) FROM ({RESULTS_SQL})"
    for i, (label, flag) in enumerate(report.STAT_LABELS, 7))


def empty_views(spark, sf):
    """Detail views of a run whose rows all failed (so they are empty) and of one that did not."""
    r = results(spark, sf)
    none = report.detail_view(r.filter("error IS NOT NULL AND NOT bankruptcy"),
                              "sector_change", "sector_detail")
    some = report.detail_view(r.filter("error IS NULL"), "bankruptcy", "bankruptcy_detail")
    return (report.or_placeholder(none).withColumn("view", F.lit("none"))
            .unionByName(report.or_placeholder(some).withColumn("view", F.lit("some"))))


EMPTY_VIEWS = f"""
  SELECT 'No signals detected.' AS company, NULL AS detail, NULL AS sources, 'none' AS view
  UNION ALL SELECT company, bankruptcy_detail, array_to_string(sources, '; '), 'some'
  FROM ({RESULTS_SQL}) WHERE error IS NULL AND bankruptcy
"""

# ---- cache: a record per user and day, asked for on a Tuesday -----------------------------

_AS_OF = "2024-01-30 12:00:00"


def _cache(spark, sf):
    """Records; those without a payload stand for unreadable ones."""
    ev = table(spark, sf, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    per = ev.groupBy("user_id", day.alias("day")).agg(
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").cast("timestamp").alias("fetched_at"),
        F.max("event_id").alias("last"))
    from ..functions.names import cache_key, week_bucket
    company = F.concat(F.lit("User_"), F.col("user_id"))
    d = F.to_date("day")
    return per.select(cache_key(company, d).alias("key"), company.alias("company"),
                      "fetched_at", F.when(F.col("last") % 5 != 0, F.concat(
                          F.lit("ctx "), F.col("last"))).alias("payload"),
                      week_bucket(d).alias("week"))


_CACHE = """
  SELECT substr(sha256('user_' || user_id || '::' || strftime(CAST(day AS DATE), '%Y-W%W')), 1, 16)
    AS key, 'User_' || user_id AS company, date_trunc('second', fetched_at) AS fetched_at,
    CASE WHEN last % 5 <> 0 THEN 'ctx ' || last END AS payload,
    strftime(CAST(day AS DATE), '%Y-W%W') AS week
  FROM (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, max(ts) AS fetched_at,
          max(event_id) AS last FROM events GROUP BY 1, 2)
"""


def _users(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.concat(F.lit("user_"), F.col("c_custkey")).alias("company"))


_ASKED = f"""
  SELECT 'user_' || c_custkey AS company, substr(sha256('user_' || c_custkey || '::'
    || strftime(TIMESTAMP '{_AS_OF}', '%Y-W%W')), 1, 16) AS key FROM customer
"""
_FRESH = f"""
  SELECT * FROM ({_CACHE}) WHERE payload IS NOT NULL
    AND fetched_at > TIMESTAMP '{_AS_OF}' - INTERVAL 96 HOUR
"""
_TTL = Params(cache_ttl_hours=96)


def _as_of():
    return F.lit(_AS_OF).cast("timestamp")


def lookup(spark, sf):
    hits = cache.lookup(_users(spark, sf), _cache(spark, sf), _as_of(), _TTL)
    return hits.select("company", "key", "payload",
                       F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"))


LOOKUP = f"""
  SELECT company, key, payload, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at
  FROM ({_ASKED}) JOIN (SELECT key, payload, fetched_at FROM ({_FRESH})
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY fetched_at DESC) = 1) USING (key)
"""


def cache_misses(spark, sf):
    return cache.misses(_users(spark, sf), _cache(spark, sf), _as_of(), _TTL).select(
        "company", "key")


def cache_invalidate(spark, sf):
    """Forget the current week of the customers of all market segments but one."""
    even = table(spark, sf, "customer").filter("c_mktsegment <> 'MACHINERY'").select(
        F.concat(F.lit("user_"), F.col("c_custkey")).alias("company"))
    kept = cache.invalidate(_cache(spark, sf), even, _as_of())
    return kept.groupBy("week").agg(F.count(F.lit(1)).alias("entries"),
                                    F.count_distinct("key").alias("keys"))


CACHE_INVALIDATE = f"""
  SELECT week, count(*) AS entries, count(DISTINCT key) AS keys FROM ({_CACHE}) c
  WHERE key NOT IN (SELECT a.key FROM ({_ASKED}) a JOIN customer
    ON a.company = 'user_' || c_custkey WHERE c_mktsegment <> 'MACHINERY')
  GROUP BY week
"""


def usage(spark, sf):
    """Events as fetches: purchases were deep, views came from the cache."""
    ev = table(spark, sf, "events").select(
        (F.col("event_type") == "view").alias("from_cache"),
        F.when(F.col("event_type") == "purchase", 5).otherwise(0).alias("deep_calls"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("web_calls"))
    return cache.fetch_usage(ev)


USAGE = """
  SELECT count(*) AS total, count_if(event_type = 'view') AS cache_hits,
    count_if(event_type <> 'view') AS fetched_live,
    5 * count_if(event_type = 'purchase') AS deep_calls,
    count_if(event_type = 'purchase') AS web_calls,
    5 * count_if(event_type = 'purchase') > 800 AS quota_warning FROM events
"""

_PICK = ("company", "run_id", "total_signals", "confidence_score")

QUERIES = {
    "resume_anti_join": (
        lambda s, d: life.todo(_customers(s, d), _orders(s, d), retry_errors=False),
        "SELECT c_custkey AS input_pos, c_custkey AS company, c_mktsegment AS sector FROM customer "
        "WHERE c_custkey NOT IN (SELECT 2 * o_custkey FROM orders)"),
    "resume_retry_errors": (
        lambda s, d: life.todo(_customers(s, d), _orders(s, d)),
        "SELECT c_custkey AS input_pos, c_custkey AS company, c_mktsegment AS sector FROM customer "
        "WHERE c_custkey NOT IN (SELECT 2 * o_custkey FROM orders WHERE o_totalprice <= 100000)"),
    "checkpoint_semi_join": (
        lambda s, d: life.restrict(_orders(s, d), _customers(s, d).filter("sector = 'BUILDING'")),
        "SELECT 2 * o_custkey AS company, CASE WHEN o_totalprice > 100000 THEN 'failed' END AS error "
        "FROM orders WHERE 2 * o_custkey IN (SELECT c_custkey FROM customer "
        "WHERE c_mktsegment = 'BUILDING')"),
    "reassemble_results": (reassemble, REASSEMBLE),
    "run_kpis": (kpis, KPIS),
    "category_counts": (categories, CATEGORIES),
    "category_counts_long": (lambda s, d: life.category_counts_long(results(s, d)),
                             CATEGORIES_LONG),
    "run_select_latest": (
        lambda s, d: life.select_run(results(s, d)).select(*_PICK, _stamp()),
        f"SELECT {', '.join(_PICK)}, {_TIME} AS processed_at FROM ({_LATEST})"),
    "latest_per_company": (
        lambda s, d: life.latest_per_company(results(s, d)).select(*_PICK, _stamp()),
        f"SELECT {', '.join(_PICK)}, {_TIME} AS processed_at FROM (SELECT * FROM ({RESULTS_SQL}) "
        "QUALIFY row_number() OVER (PARTITION BY company "
        "ORDER BY processed_at DESC, run_id DESC) = 1)"),
    "alltime_counts": (
        lambda s, d: life.alltime_counts(results(s, d)),
        f"SELECT count(*) AS row_count, count(DISTINCT company) AS company_count "
        f"FROM ({RESULTS_SQL})"),
    "flagged_companies": (
        lambda s, d: life.flagged(results(s, d)),
        f"SELECT company, total_signals FROM ({RESULTS_SQL}) WHERE total_signals > 0"),
    "export_topk": (
        lambda s, d: life.export_rows(
            life.latest_per_company(results(s, d))).select(*_PICK),
        f"SELECT {', '.join(_PICK)} FROM (SELECT * FROM ({RESULTS_SQL}) "
        "QUALIFY row_number() OVER (PARTITION BY company "
        "ORDER BY processed_at DESC, run_id DESC) = 1) WHERE total_signals > 0 "
        "ORDER BY confidence_score DESC, total_signals DESC, company LIMIT 5000"),
    "error_sample": (
        lambda s, d: life.error_sample(results(s, d)),
        f"SELECT company, error FROM ({RESULTS_SQL}) WHERE error IS NOT NULL "
        "ORDER BY company, error LIMIT 20"),
    "report_dashboard": (dashboard, f"""
        SELECT * EXCLUDE (run_id, summary), run_id || ' ' || summary AS summary
        FROM ({DASHBOARD})"""),
    "report_detail": (lambda s, d: report.detail_views(results(s, d)), DETAIL),
    "report_hq": (
        lambda s, d: report.hq_view(results(s, d)),
        f"SELECT company, coalesce(nullif(hq_region, ''), '—') AS hq_region, hq_detail AS detail, "
        f"array_to_string(sources, '; ') AS sources FROM ({RESULTS_SQL}) WHERE hq_change"),
    "report_ops": (
        lambda s, d: report.ops_view(results(s, d)),
        f"SELECT company, ops_detail AS detail, array_to_string(sources, '; ') AS sources "
        f"FROM ({RESULTS_SQL}) WHERE operational_change OR shutdown"),
    "report_stats": (stats, STATS),
    "report_empty": (empty_views, EMPTY_VIEWS),
    "cache_lookup": (lookup, LOOKUP),
    "cache_misses": (cache_misses, f"""
        SELECT company, key FROM ({_ASKED}) WHERE key NOT IN (SELECT key FROM ({_FRESH}))"""),
    "cache_invalidate": (cache_invalidate, CACHE_INVALIDATE),
    "fetch_usage": (usage, USAGE),
}
