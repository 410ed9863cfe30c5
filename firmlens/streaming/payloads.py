"""Raw feed payloads as a stream: landed files in, items and rejected payloads out.

Each micro-batch writes both of its outputs under its own number, so a batch that is run again after a
failure replaces what it wrote. Batches are admitted by bytes: payloads differ a thousandfold in size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.evidence import union_feeds
from ..params import SOURCES
from ..sources.feeds import _RSS_SCHEMA, _SCHEMAS, json_items, rss_items

#: A landed payload: the feed, the company it was asked for (null for press feeds), and the text.
PAYLOAD_TYPE = "source string, company string, payload string"
RSS_FEEDS = ("google_news", "prnewswire", "businesswire")
ITEMS, REJECTED = "items", "rejected"


def payload_stream(spark: SparkSession, path: str, max_bytes: int = 256 * 2 ** 20) -> DataFrame:
    """Landed Parquet files of payloads, at most about `max_bytes` of them at a time."""
    return (spark.readStream.schema(PAYLOAD_TYPE).option("maxBytesPerTrigger", max_bytes).parquet(path))


def _unreadable(source: Column, payload: Column) -> Column:
    """Why a payload gives no items; NULL if it can be read."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    xml = F.from_xml(payload, _RSS_SCHEMA, options)["_broken"].isNotNull()
    json = F.try_parse_json(payload).isNull()
    known = source.isin(*RSS_FEEDS, *_SCHEMAS)
    return (F.when(~F.coalesce(known, F.lit(False)), F.lit("no such feed"))
            .when(F.coalesce(F.trim(payload), F.lit("")) == "", F.lit("empty"))
            .when(source.isin(*RSS_FEEDS) & xml, F.lit("not XML"))
            .when(source.isin(*_SCHEMAS) & json, F.lit("not JSON")))


def split_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, rejected): the items of all readable payloads, as the union of feeds, and the rest, whole,
    with the reason."""
    told = payloads.withColumn("reason", _unreadable(F.col("source"), F.col("payload")))
    good = told.filter("reason IS NULL")
    feeds = {}
    for s in SOURCES:
        mine = good.filter(F.col("source") == s.name)
        if s.name in RSS_FEEDS:
            feeds[s.name] = rss_items(mine, "payload", ["company"])
        else:
            feeds[s.name] = json_items(mine, "payload", s.name, ["company"], company="company", page=s.page)
    return union_feeds(feeds), told.filter("reason IS NOT NULL")


def start_payloads(payloads: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write items and rejected payloads of all that has landed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, rows in zip((ITEMS, REJECTED), split_payloads(batch)):
                rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    return (payloads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def rejected_counts(spark: SparkSession, out: str) -> DataFrame:
    """(source, reason, payloads)."""
    return (spark.read.parquet(f"{out}/{REJECTED}").groupBy("source", "reason")
            .agg(F.count(F.lit(1)).alias("payloads")))
