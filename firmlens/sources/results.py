"""The result table: schema, creation, append, reading back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonio import decode_list, encode_list
from ..params import SIGNALS

_TEXT = ("sector_detail", "hq_detail", "ma_detail", "rename_detail", "ops_detail",
         "bankruptcy_detail", "summary")

# 22 columns, `sources` as JSON text; partitioned by run, so a run reads only its own files.
RESULT_SCHEMA = T.StructType([
    T.StructField("company", T.StringType(), False),
    T.StructField("sector_change", T.BooleanType()),
    T.StructField("hq_change", T.BooleanType()),
    T.StructField("hq_region", T.StringType()),
    *[T.StructField(s, T.BooleanType()) for s in SIGNALS[2:]],
    T.StructField("total_signals", T.IntegerType()),
    *[T.StructField(c, T.StringType()) for c in _TEXT],
    T.StructField("sources", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("confidence_score", T.IntegerType()),
    T.StructField("error", T.StringType()),
])


def create_table(spark: SparkSession, table: str, fmt: str = "parquet",
                 location: str | None = None) -> None:
    """Create schema and table where absent. `fmt` may be any installed table format."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                        + ("" if f.nullable else " NOT NULL") for f in RESULT_SCHEMA)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt} "
              f"PARTITIONED BY (run_id){where} COMMENT 'Corporate event results per run'")


def _default(f: T.StructField) -> Column:
    """What a stored record without this field means."""
    kind = f.dataType.typeName()
    if f.name in ("processed_at", "run_id", "error"):
        return F.lit(None).cast(f.dataType)
    if f.name == "sources":
        return F.lit("[]")
    return F.lit({"boolean": False, "string": ""}.get(kind, 0)).cast(f.dataType)


def conform(df: DataFrame) -> DataFrame:
    """Any result-like frame to the table's columns: unknown ones go, missing or null ones get
    their defaults, source lists become JSON."""
    def column(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return _default(f)
        col = F.col(f.name)
        if f.name == "sources" and df.schema["sources"].dataType.typeName() == "array":
            col = encode_list(col)
        return F.coalesce(col.cast(f.dataType), _default(f))
    return df.select(*[column(f).alias(f.name) for f in RESULT_SCHEMA])


def append_run(results: DataFrame, table: str, run_id: str) -> None:
    """Write one run as its partition, which is also the run's checkpoint. Written again, it
    replaces what it wrote before; other runs are not touched."""
    stamped = results.withColumns({"run_id": F.lit(run_id),
                                   "processed_at": F.current_timestamp()})
    if "error" not in stamped.columns:
        stamped = stamped.withColumn("error", F.lit(None).cast("string"))
    spark = results.sparkSession
    order = [c for c in spark.table(table).columns if c != "run_id"]
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = :run) SELECT * FROM {{rows}}",
              args={"run": run_id}, rows=conform(stamped).select(*order))


def read_results(spark: SparkSession, table: str, run_id: str | None = None) -> DataFrame:
    df = spark.table(table)
    return df.filter(F.col("run_id") == run_id) if run_id else df


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Stored results of an earlier attempt; no such path means a fresh start. Any other trouble
    is raised: taken for an empty checkpoint, it would have all work done again."""
    try:
        return conform(spark.read.parquet(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RESULT_SCHEMA)


def with_source_list(results: DataFrame) -> DataFrame:
    """`sources` decoded to a list; unreadable text gives an empty one."""
    return results.withColumn("sources", decode_list(F.col("sources")))
