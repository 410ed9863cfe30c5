"""Round trips of the stores: snapshots, observed totals, the report in one pass, bucketed tables,
streams with state and of raw payloads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lifecycle import todo
from ..params import SIGNALS
from ..plans import record
from ..sources import tables
from ..streaming import best, payloads
from .evidence import KEYS, _KEYS
from .inputs import FIRST_SEEN_SQL, RESULTS_SQL, items, results, table
from .mentions import DECISIONS, decisions
from .sinks import REPORT_VIEWS, _folder


def result_snapshots(spark, sf) -> DataFrame:
    """Two runs, one of them stored twice; the first version is still there to be read."""
    runs = record.run_table(spark, _folder(spark, "runs"))
    rows = results(spark, sf).withColumn("company", F.concat_ws("@", "company", "run_id"))
    record.store_run(rows, runs, "some")
    record.store_run(rows, runs, "all")
    record.store_run(rows.filter("total_signals > 2"), runs, "some")
    keep = ("company", "run_id", "total_signals", "confidence_score")
    return runs.read().select(*keep, F.lit("now").alias("as_of")).unionByName(
        runs.read(version=1).select(*keep, F.lit("first").alias("as_of")))


_RUN = f"SELECT company || '@' || run_id AS company, total_signals, confidence_score FROM ({RESULTS_SQL})"
RESULT_SNAPSHOTS = f"""
  SELECT *, 'all' AS run_id, 'now' AS as_of FROM ({_RUN})
  UNION ALL SELECT *, 'some', 'now' FROM ({_RUN}) WHERE total_signals > 2
  UNION ALL SELECT *, 'some', 'first' FROM ({_RUN})
"""


def observed_totals(spark, sf) -> DataFrame:
    """Totals that come with the write, of a run and of an empty one."""
    runs = record.run_table(spark, _folder(spark, "runs"))
    rows = results(spark, sf)
    found = [{"run": run, **record.store_run(part, runs, run)}
             for run, part in (("all", rows), ("none", rows.filter("false")))]
    counts = ("processed", "errors", "with_signals", *SIGNALS, "total_signals")
    schema = "run string, signal_rate double, " + ", ".join(f"{c} long" for c in counts)
    return spark.createDataFrame([(f["run"], f["signal_rate"], *[f[c] for c in counts]) for f in found],
                                 schema)


def _totals_sql(run: str, where: str) -> str:
    sums = ", ".join(f"count(*) FILTER ({s}) AS {s}" for s in SIGNALS)
    return f"""SELECT '{run}' AS run, round(100.0 * count(*) FILTER (total_signals > 0) / greatest(count(*), 1), 1)
      AS signal_rate, count(*) AS processed, count(error) AS errors, count(*) FILTER (total_signals > 0) AS with_signals,
      {sums}, coalesce(CAST(sum(total_signals) AS BIGINT), 0) AS total_signals FROM ({RESULTS_SQL}) WHERE {where}"""


OBSERVED_TOTALS = _totals_sql("all", "true") + " UNION ALL " + _totals_sql("none", "false")


def screening_log(spark, sf) -> DataFrame:
    """A run's decisions, logged twice, read back beside the totals of the write."""
    path = _folder(spark, "screening")
    rows = decisions(spark, sf)
    for _ in range(2):
        totals = record.log_screening(rows, path, "r1")
    log = spark.read.csv(path, header=True)
    return log.groupBy("run_id", "stage").agg(
        F.count(F.lit(1)).alias("companies"), F.sum(F.col("score").cast("long")).alias("scores")).withColumns(
        {c: F.lit(totals[c]).cast("long") for c in ("screened", "triggered", "deep_calls")})


SCREENING_LOG = f"""
  SELECT 'r1' AS run_id, stage, count(*) AS companies, CAST(sum(score) AS BIGINT) AS scores, screened,
    triggered, 5 * triggered AS deep_calls
  FROM ({DECISIONS}), (SELECT count(*) AS screened, count_if(passed) AS triggered FROM ({DECISIONS}))
  GROUP BY stage, screened, triggered
"""


def report_once(spark, sf) -> DataFrame:
    """All views from one evaluation of the results."""
    path = _folder(spark, "report")
    record.write_report_once(results(spark, sf).withColumn("renaming", F.lit(False)), path,
                             F.lit("2024-02-01"), F.lit("12 months"), F.lit(61.5))
    return record.read_views(spark, path)


def newest_by_bucket(spark, sf) -> DataFrame:
    """Each company's newest row, kept up to date run by run; and who is left to do, by a merge join."""
    name = f"firmlens_newest_{uuid.uuid4().hex}"
    rows = results(spark, sf).drop("sources")
    day = F.dayofmonth(F.to_date("run_id"))
    try:
        for k in range(3):
            tables.save_newest(rows.filter(day % 3 == k), name, 4, _folder(spark, f"newest-{k}"))
        users = table(spark, sf, "customer").select(F.concat(F.lit("user_"), F.col("c_custkey")).alias("company"))
        left = todo(users, spark.table(name)).select("company", F.lit("open").alias("run_id"),
                                                     F.lit(-1).alias("total_signals"))
        # The rows are few beside the runs': stored once more, so that the table can go.
        out = _folder(spark, "newest")
        spark.table(name).select("company", "run_id", "total_signals").unionByName(left).write.parquet(out)
        return spark.read.parquet(out)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


_NEWEST = f"""SELECT * FROM ({RESULTS_SQL}) QUALIFY row_number() OVER (PARTITION BY company
  ORDER BY processed_at DESC, run_id DESC) = 1"""
NEWEST_BY_BUCKET = f"""
  SELECT company, run_id, total_signals FROM ({_NEWEST})
  UNION ALL
  SELECT 'user_' || c_custkey, 'open', -1 FROM customer
  WHERE 'user_' || c_custkey NOT IN (SELECT company FROM ({_NEWEST}) WHERE error IS NULL)
"""


def stream_best(spark, sf) -> DataFrame:
    """Items landed in three deliveries, the best feeds last: the standing ones are the batch's."""
    landed, out = _folder(spark, "landed"), _folder(spark, "best")
    rows = items(spark, sf).select(*KEYS)
    for ranks in ((7, 8, 9), (4, 5, 6), (1, 2, 3)):
        rows.filter(F.col("source_rank").isin(*ranks)).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    best.start_best(best.keep_best(stream), out, _folder(spark, "best-state")).awaitTermination()
    found = best.best_items(spark.read.parquet(out))
    return found.filter("url <> ''").select(*KEYS)


STREAM_BEST = f"SELECT {_KEYS} FROM ({FIRST_SEEN_SQL}) WHERE url <> ''"


def payload_split(spark, sf) -> DataFrame:
    """Payloads of two feeds made of pages, some of them damaged, parsed as they land."""
    landed, out = _folder(spark, "payloads"), _folder(spark, "parsed")
    page = F.col("page_id")
    quoted = F.to_json(F.struct(F.array(F.struct(
        "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.lit("d").alias("domain"), F.lit("20240101T000000Z").alias("seendate"))).alias("articles")))
    xml = F.concat(F.lit("<rss><channel><item><title>page "), page, F.lit("</title><link>u"), page,
                   F.lit("</link></item></channel></rss>"))
    raw = F.when(page % 2 == 0, F.when(page % 10 == 4, F.substring(quoted, F.lit(1), F.length(quoted) - 2))
                 .otherwise(quoted)).otherwise(
        F.when(page % 10 == 3, F.lit("<rss><channel>")).when(page % 10 == 5, "  ").otherwise(xml))
    rows = table(spark, sf, "pages").select(
        F.when(page % 14 == 0, "nowhere").when(page % 2 == 0, "gdelt").otherwise("prnewswire").alias("source"),
        F.when(page % 2 == 0, "asked").alias("company"), raw.alias("payload"))
    rows.write.parquet(landed)
    payloads.start_payloads(payloads.payload_stream(spark, landed), out,
                            _folder(spark, "payload-state")).awaitTermination()
    good = spark.read.parquet(f"{out}/{payloads.ITEMS}").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("url").alias("urls"))
    bad = payloads.rejected_counts(spark, out).select("source", "reason", F.col("payloads").alias("n"),
                                                      F.lit(0).cast("long").alias("urls"))
    return good.select("source", F.lit("read").alias("reason"), "n", "urls").unionByName(bad)


PAYLOAD_SPLIT = """
  SELECT source, reason, count(*) AS n, CASE reason WHEN 'read' THEN count(DISTINCT url) ELSE 0 END AS urls
  FROM (SELECT CASE WHEN page_id % 14 = 0 THEN 'nowhere' WHEN page_id % 2 = 0 THEN 'gdelt'
            ELSE 'prnewswire' END AS source,
          CASE WHEN page_id % 14 = 0 THEN 'no such feed' WHEN page_id % 10 = 4 THEN 'not JSON'
            WHEN page_id % 10 = 3 THEN 'not XML' WHEN page_id % 10 = 5 THEN 'empty' ELSE 'read' END AS reason,
          CASE WHEN page_id % 2 = 0 THEN url ELSE 'u' || page_id END AS url FROM pages)
  GROUP BY source, reason
"""

QUERIES = {
    "result_snapshots": (result_snapshots, RESULT_SNAPSHOTS),
    "observed_totals": (observed_totals, OBSERVED_TOTALS),
    "screening_log": (screening_log, SCREENING_LOG),
    "report_once": (report_once, REPORT_VIEWS),
    "newest_by_bucket": (newest_by_bucket, NEWEST_BY_BUCKET),
    "stream_best": (stream_best, STREAM_BEST),
    "payload_split": (payload_split, PAYLOAD_SPLIT),
}
