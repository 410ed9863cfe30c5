"""Evidence ingest with state: of a company's URL, the item of the best feed, whatever lands first.

The state is the best item so far of each (company, url), in the order in which the batch dedupe takes
items, as a running minimum; a better one that lands later replaces it. Time is the time of landing,
cut into spans of the horizon: state goes when its span is over, so nothing is ever late, and what lands
again in a later span starts anew there. Items without a URL go only from the feeds that drop them.

Each batch's output has the standing item of every key that the batch touched. `start_best` writes it
under the batch's number, which a repeated batch replaces, and `best_items` reads what stands from all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.evidence import ITEM_ORDER
from ..params import SOURCES, Source
from .ingest import WEEK, without_url


def keep_best(items: DataFrame, horizon: str = WEEK, sources: Sequence[Source] = SOURCES,
              landed: str | None = None) -> DataFrame:
    """The standing items of a stream of items, to be written in update mode. `landed` names a column
    with the time of landing, where the items have one. Items without a URL are told apart by their
    place in the order, as each has its own."""
    own = F.concat(F.lit("-"), F.concat_ws("-", *[c for c in ITEM_ORDER if c != "url"]))
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = [c for c in items.columns if c not in (*ITEM_ORDER, "company", "landed_at")]
    keyed = items.filter(~without_url(items, sources)).withColumns({
        "_key": F.when(url == "", own).otherwise(url),
        "landed_at": F.col(landed) if landed else F.current_timestamp()})
    best = keyed.withWatermark("landed_at", "0 seconds").groupBy(
        "company", "_key", F.window("landed_at", horizon).alias("_span")).agg(
        F.min(F.struct(*ITEM_ORDER, *rest)).alias("_best"))
    return best.select("company", "_key", F.col("_span.start").alias("span"), "_best.*")


def start_best(standing: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write the standing items of all that has landed, batch by batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (standing.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def best_items(log: DataFrame) -> DataFrame:
    """What stands of every (company, url), over all batches and spans."""
    order = Window.partitionBy("company", "_key").orderBy(*ITEM_ORDER)
    return (log.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1)
            .drop("_n", "_key", "span", "batch"))
