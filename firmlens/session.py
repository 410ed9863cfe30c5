"""Session defaults and durable lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts are long: fewer rows per Arrow batch keeps Python workers within memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "firmlens", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster. A local session that names none gets a temporary one;
    on a cluster, no executor could read that."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return named or tempfile.mkdtemp(prefix="firmlens-checkpoint-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder, so that lost executors never force the
    steps before it (model calls above all) to run again."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def spread_if_few(df: DataFrame) -> DataFrame:
    """Give CPU-heavy text work a task per core where the input has fewer splits than cores, as
    a single small file has. Larger inputs pass through without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
