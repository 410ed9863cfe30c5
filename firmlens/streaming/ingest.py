"""Incremental evidence ingest: landed item files in, each URL of a company once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..params import SOURCES, Source

WEEK = "7 days"


def item_stream(spark: SparkSession, path: str, schema: StructType | str,
                max_files: int | None = None) -> DataFrame:
    """Landed parquet files as a stream; the schema is given, never inferred."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def dedupe_stream(items: DataFrame, horizon: str = WEEK,
                  sources: Sequence[Source] = SOURCES) -> DataFrame:
    """Drop repeats of a company's URL that land within the horizon, with `landed_at` added.

    Time is the time of landing, not of publication: however old an item's news is, it is new when it
    lands, and nothing is ever late. State is one entry per (company, url) and expires with the
    horizon; the batch dedupe downstream, which knows the feeds' ranks, takes what comes again later.
    Items without a URL go only from the feeds that drop them (`rejected` lists those), and are
    repeats only if they are alike in everything.
    """
    names = [f"`{c}`" for c in items.columns]
    own = F.concat(F.lit("-"), F.xxhash64(F.lit(1), *names), F.lit("-"),
                   F.xxhash64(F.lit(2), *names))
    has_url = F.coalesce(F.col("url") != "", F.lit(False))
    kept = items.filter(~without_url(items, sources)) if "source" in items.columns else items
    return (kept.withColumns({"landed_at": F.current_timestamp(),
                              "_key": F.when(has_url, F.col("url")).otherwise(own)})
            .withWatermark("landed_at", horizon)
            .dropDuplicatesWithinWatermark(["company", "_key"]).drop("_key"))


def without_url(items: DataFrame, sources: Sequence[Source] = SOURCES) -> Column:
    """True for items that lack a URL and come from a feed that drops those."""
    skips = [s.name for s in sources if s.skip_empty]
    return F.coalesce(F.col("source").isin(skips), F.lit(False)) & (
        F.coalesce(F.col("url"), F.lit("")) == "")


def rejected(items: DataFrame, sources: Sequence[Source] = SOURCES) -> DataFrame:
    """(source, items): how many items of each feed the dedupe turns away."""
    return (items.filter(without_url(items, sources)).groupBy("source")
            .agg(F.count(F.lit(1)).alias("items")))


def start_ingest(items: DataFrame, out: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Append each micro-batch under its own folder. A batch that is run again after a failure
    overwrites that folder, so nothing is written twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now
            else writer.trigger(processingTime="1 minute")).start()
