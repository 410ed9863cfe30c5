"""Result and company tables laid out for the joins that every run makes, and counts over all runs
from sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_by_company(rows: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store rows in buckets by company, sorted: tables of as many buckets join on it, and find their
    newest row, without a shuffle."""
    writer = rows.write.mode("overwrite").bucketBy(buckets, "company").sortBy("company")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def save_newest(rows: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Fold a run's rows into the table of each company's newest row. Only the run is shuffled, into the
    table's buckets; the new table is written beside the old one and then takes its name."""
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != "company"]
    newest = F.max(F.struct("processed_at", "run_id", *[c for c in columns
                                                        if c not in ("processed_at", "run_id")]))
    both = rows
    if spark.catalog.tableExists(table):
        both = spark.table(table).select(*rows.columns).unionByName(
            rows.repartition(buckets, "company"))
    folded = both.groupBy("company").agg(newest.alias("_n")).select(
        "company", *[F.col(f"_n.{c}").alias(c) for c in columns])
    save_by_company(folded, f"{table}_next", buckets, path)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {table}_next RENAME TO {table}")


def save_company_sketch(rows: DataFrame, path: str, run_id: str, lg_k: int = 14) -> None:
    """A run's number of rows and a sketch of its companies, a few kilobytes whatever the run's size.
    Written again, it replaces itself."""
    rows.agg(F.count(F.lit(1)).alias("row_count"), F.hll_sketch_agg("company", lg_k).alias("companies")) \
        .write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def estimated_counts(spark: SparkSession, path: str) -> DataFrame:
    """(row_count, company_count) over all runs from their sketches: rows exactly, companies within
    about two hundredths at the default size (`alltime_counts` counts exactly, from all rows)."""
    return spark.read.parquet(path).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("companies")), F.lit(0)).alias("company_count"))
