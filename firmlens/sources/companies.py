"""Company lists: reading, column choice, limits, distinct names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip

# Accepted headers, in priority order.
COMPANY_ALIASES = ("company", "company_name", "name", "entity")
SECTOR_ALIASES = ("sector", "industry", "subsector")
#: Column that `in_file_order` adds.
POSITION = "__position"


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def pick_column(columns: Sequence[str], aliases: Sequence[str], by_priority: bool) -> str | None:
    """Header matching an alias: the first in file order (headers trimmed), or, by priority,
    the one whose alias comes first (headers as they are)."""
    if by_priority:
        lowered = [c.lower() for c in columns]
        hits = [columns[lowered.index(a)] for a in aliases if a in lowered]
    else:
        hits = [c for c in columns if c.strip().lower() in aliases]
    return hits[0] if hits else None


def companies_in_file_order(df: DataFrame) -> DataFrame:
    """(input_pos, company, sector): names trimmed, blank ones dropped, duplicates kept.

    input_pos grows along the file; it orders rows, it does not count them. Spark takes the splits of
    several files, or of a large one, in the order of their size; `load_companies` numbers rows by path
    and place instead.
    """
    headers = [c for c in df.columns if c != POSITION]
    name = pick_column(headers, COMPANY_ALIASES, by_priority=False) or headers[0]
    sector = pick_column(df.columns, SECTOR_ALIASES, by_priority=False)
    sector_value = F.coalesce(strip(_quoted(sector)), F.lit("")) if sector else F.lit("")
    return (
        df.select((F.col(POSITION) if POSITION in df.columns else F.monotonically_increasing_id())
                  .alias("input_pos"), strip(_quoted(name).cast("string")).alias("company"),
                  sector_value.alias("sector"))
        .filter(F.col("company").isNotNull() & (F.col("company") != ""))
    )


def in_file_order(df: DataFrame) -> DataFrame:
    """A file scan with `POSITION`: the number of the row, files by path, rows by place.

    The hidden columns tell each row's file and split, and rows of a split keep their order, so a count
    of each split's rows, added up over the splits before it, gives every row its number. The counts are
    a row for each split."""
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    told = df.select("*", file.alias("_file"), start.alias("_start"),
                     F.monotonically_increasing_id().alias("_id"))
    splits = told.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    number = F.col("_before") + F.col("_id") - F.col("_first")
    return told.join(splits, ["_file", "_start"]).select(
        *[_quoted(c) for c in df.columns], number.alias(POSITION))


def companies_by_priority(df: DataFrame) -> DataFrame:
    """(company): distinct names as written, blank ones dropped."""
    name = pick_column(df.columns, COMPANY_ALIASES, by_priority=True) or df.columns[0]
    return (
        df.select(_quoted(name).cast("string").alias("company"))
        .filter(F.col("company").isNotNull() & (F.trim("company") != ""))
        .dropDuplicates(["company"])
    )


def read_company_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw CSV with a header. All columns stay text: inference would turn a numeric name into
    a number. A byte-order mark at the start is dropped by the reader. Lists with line ends inside
    quotes need `multi_line`, which makes each file one task."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line,
                        mode="PERMISSIVE", encoding="UTF-8", escape='"')
    if not df.columns:
        raise ValueError(f"company list is empty: {path}")
    return df


def load_companies(spark: SparkSession, path: str, by_priority: bool = False,
                   multi_line: bool = False) -> DataFrame:
    raw = read_company_csv(spark, path, multi_line)
    return companies_by_priority(raw) if by_priority else companies_in_file_order(in_file_order(raw))


def first_companies(companies: DataFrame, n: int | None, order: str = "input_pos") -> DataFrame:
    """The first n rows in input order; None, zero and negatives mean all."""
    if not n or n < 0:
        return companies
    return companies.orderBy(order).limit(n)


def distinct_companies(companies: DataFrame, order: str = "input_pos") -> DataFrame:
    """One row per name, the earliest. The limit runs inside each input partition first, so
    a name that fills a third of the list moves one row per partition."""
    w = Window.partitionBy("company").orderBy(order)
    return (companies.withColumn("_n", F.row_number().over(w))
            .filter(F.col("_n") == 1).drop("_n"))
