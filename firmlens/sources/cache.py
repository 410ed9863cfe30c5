"""The fetch cache as a table partitioned by week."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import cache_key, week_bucket
from ..params import Params
from .snapshots import SnapshotTable

BUCKET = "week"


def with_key(companies: DataFrame, as_of: Column, stage: str | None = None) -> DataFrame:
    """Companies with their cache key for the week of `as_of`. The stage is part of the key
    when given, so that a base fetch never answers for a deep one."""
    return companies.withColumn("key", cache_key(
        F.col("company"), as_of, F.lit(stage) if stage else None))


def probed(cache: DataFrame, keys: DataFrame, most: int) -> DataFrame:
    """The entries that some keys may have. Up to `most` keys go into the scan as equalities: sorted
    files pass over row groups and pages whose key ranges or Bloom filters rule them out. More keys
    are left to the join that follows; so are any with `most` 0, which runs no job."""
    if not most:
        return cache
    asked = [r[0] for r in keys.select("key").distinct().limit(most + 1).collect()]
    if len(asked) > most:
        return cache
    return cache.filter(reduce(or_, [F.col("key") == k for k in asked], F.lit(False)))


def _fresh(cache: DataFrame, keys: DataFrame, as_of: Column, params: Params) -> DataFrame:
    """Readable entries of the asked keys that are young enough, the newest per key; of those of one
    time, always the same by a hash of the payload (records hold maps, which have no order)."""
    cache = probed(cache, keys, params.cache_probe)
    hours = (F.unix_timestamp(as_of) - F.unix_timestamp("fetched_at")) / 3600
    young = (cache.filter((hours < params.cache_ttl_hours) & F.col("payload").isNotNull())
             .join(keys, "key", "left_semi"))
    w = Window.partitionBy("key").orderBy(F.desc("fetched_at"),
                                          F.xxhash64(F.to_json(F.struct("payload"))))
    return (young.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1)
            .drop("_n"))


def lookup(companies: DataFrame, cache: DataFrame, as_of: Column,
           params: Params = Params(), stage: str | None = None) -> DataFrame:
    """Companies answered from the cache. A cache with a week column is pruned to the week."""
    if BUCKET in cache.columns:
        cache = cache.filter(F.col(BUCKET) == week_bucket(as_of))
    asked = with_key(companies, as_of, stage)
    entries = _fresh(cache, asked.select("key"), as_of, params).select("key", "payload",
                                                                       "fetched_at")
    return (asked.join(entries, "key")
            .select("company", "key", "payload", "fetched_at",
                    F.lit(True).alias("from_cache")))


def misses(companies: DataFrame, cache: DataFrame, as_of: Column,
           params: Params = Params(), stage: str | None = None) -> DataFrame:
    """Companies that must be fetched."""
    if BUCKET in cache.columns:
        cache = cache.filter(F.col(BUCKET) == week_bucket(as_of))
    asked = with_key(companies, as_of, stage)
    cache = probed(cache, asked, params.cache_probe)
    hours = (F.unix_timestamp(as_of) - F.unix_timestamp("fetched_at")) / 3600
    keys = cache.filter((hours < params.cache_ttl_hours) & F.col("payload").isNotNull()) \
        .select("key").distinct()
    return asked.join(keys, "key", "left_anti")


def invalidate(cache: DataFrame, companies: DataFrame, as_of: Column,
               stage: str | None = None) -> DataFrame:
    """The cache without the current entries of some companies."""
    keys = with_key(companies.select("company").distinct(), as_of, stage).select("key")
    return cache.join(keys, "key", "left_anti").select(*cache.columns)


def _table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, BUCKET, bloom=("key",))


def write_entries(entries: DataFrame, path: str) -> None:
    """Add whole records, each week in its own folder, sorted by key and with a Bloom filter of the keys
    in every row group, so that a lookup reads the groups that may hold what it asks for."""
    rows = entries.withColumn(BUCKET, week_bucket(F.col("fetched_at")))
    _table(entries.sparkSession, path).append(rows.sortWithinPartitions(BUCKET, "key"))


def read_entries(spark: SparkSession, path: str, as_of: Column | None = None) -> DataFrame:
    """The stored records, of one week if asked, as of one moment: a rewrite shows whole or not at all."""
    if as_of is None:
        return _table(spark, path).read()
    return _table(spark, path).read(spark.range(1).select(week_bucket(as_of)).first()[0])


def rewrite_week(spark: SparkSession, path: str, companies: DataFrame, as_of: Column,
                 stage: str | None = None) -> None:
    """Invalidate on disk: the current week's survivors are written beside it and take its place in one
    step. A failure before that leaves the week as it was."""
    table = _table(spark, path)
    bucket = spark.range(1).select(week_bucket(as_of)).first()[0]
    if any(f.endswith(f"/{BUCKET}={bucket}") for f in table.folders()):
        kept = invalidate(table.read(bucket), companies, as_of, stage)
        table.replace(kept.sortWithinPartitions("key"), bucket)


def fetch_usage(fetches: DataFrame, params: Params = Params()) -> DataFrame:
    """Totals of a fetch log (from_cache, deep_calls, web_calls)."""
    n = F.count(F.lit(1))
    hits = F.count_if("from_cache")
    deep = F.coalesce(F.sum("deep_calls"), F.lit(0))
    return fetches.agg(
        n.alias("total"), hits.alias("cache_hits"), (n - hits).alias("fetched_live"),
        deep.alias("deep_calls"),
        F.coalesce(F.sum("web_calls"), F.lit(0)).alias("web_calls"),
        (deep > params.quota_warning).alias("quota_warning"))
