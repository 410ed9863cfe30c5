"""The report: eight views over one run's results, ready to be written as named tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import runtime_label
from ..functions.fields import filled, tick
from ..params import EMPTY_VIEW_TEXT

# View names, the detail views' flag and detail column, metric labels.
DETAIL_VIEWS = {
    "sector_changes": ("sector_change", "sector_detail"),
    "ma_spinoffs": ("ma_spinoff", "ma_detail"),
    "renaming_rebranding": ("renaming", "rename_detail"),
    "bankruptcy": ("bankruptcy", "bankruptcy_detail"),
}
STAT_LABELS = (
    ("Sector Changes", "sector_change"), ("HQ Changes", "hq_change"),
    ("M&A / Spinoffs", "ma_spinoff"), ("Renaming/Rebranding", "renaming"),
    ("Operational Changes", "operational_change"), ("Confirmed Shutdowns", "shutdown"),
    ("Bankruptcies", "bankruptcy"),
)
_TICKS = ("sector_change", "hq_change", "ma_spinoff", "renaming", "operational_change",
          "bankruptcy")


def _sources() -> Column:
    """Source list as one cell."""
    return F.coalesce(F.array_join("sources", "; "), F.lit("")).alias("sources")


def dashboard(results: DataFrame) -> DataFrame:
    """Every company: ticks, total, summary, region of a move, shutdown tick."""
    return results.select(
        "company", *[tick(F.col(f)).alias(f) for f in _TICKS], "total_signals", "summary",
        F.when(F.col("hq_change"), F.col("hq_region")).otherwise("—").alias("hq_region"),
        tick(F.col("shutdown")).alias("shutdown"))


def detail_view(results: DataFrame, flag: str, detail: str) -> DataFrame:
    return results.filter(F.col(flag)).select("company", F.col(detail).alias("detail"),
                                              _sources())


def detail_views(results: DataFrame) -> DataFrame:
    """The four plain detail views stacked from one scan: (view, company, detail, sources)."""
    cells = F.array(*[
        F.struct(F.lit(view).alias("view"), F.col(flag).alias("_on"),
                 F.col(detail).alias("detail"))
        for view, (flag, detail) in DETAIL_VIEWS.items()])
    return (results.select("company", _sources(), F.inline(F.filter(cells, lambda c: c["_on"])))
            .select("view", "company", "detail", "sources"))


def hq_view(results: DataFrame) -> DataFrame:
    return results.filter("hq_change").select(
        "company", F.coalesce(filled(F.col("hq_region")), F.lit("—")).alias("hq_region"),
        F.col("hq_detail").alias("detail"), _sources())


def ops_view(results: DataFrame) -> DataFrame:
    """Shutdowns show here even where the operational flag is unset."""
    return results.filter(F.col("operational_change") | F.col("shutdown")).select(
        "company", F.col("ops_detail").alias("detail"), _sources())


def stats(results: DataFrame, generated: Column, window: Column,
          runtime: Column | None = None) -> DataFrame:
    """(position, metric, value) in fixed order; the runtime row only if one is given."""
    totals = results.agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("total_signals") > 0).alias("_with"),
        *[F.count_if(F.col(f)).alias(f) for _, f in STAT_LABELS])
    rows = [("Generated", generated), ("Date Window", window),
            ("Total Companies Processed", F.col("_n")),
            ("Companies with Signals", F.col("_with")), ("", F.lit("")),
            ("— Signal Breakdown —", F.lit(""))]
    rows += [(label, F.col(f)) for label, f in STAT_LABELS]
    if runtime is not None:
        rows.append(("Pipeline Runtime", runtime_label(runtime)))
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(m).alias("metric"),
                 v.cast("string").alias("value")) for i, (m, v) in enumerate(rows, 1)])))


def or_placeholder(view: DataFrame) -> DataFrame:
    """The view, or one row saying that it is empty. Only one row is read to find out; where the
    counts are known, `placeholder` needs none."""
    first = view.columns[0]
    empty = view.limit(1).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == 0)
    return view.unionByName(empty.select(*_placeholder_row(view, first)))


def _placeholder_row(view: DataFrame, first: str) -> list[Column]:
    return [(F.lit(EMPTY_VIEW_TEXT) if c == first else F.lit(None)).cast(
        view.schema[c].dataType).alias(c) for c in view.columns]


def placeholder(view: DataFrame) -> DataFrame:
    """The row of an empty view, with its columns."""
    return view.sparkSession.range(1).select(*_placeholder_row(view, view.columns[0]))


def report(results: DataFrame, generated: Column, window: Column,
           runtime: Column | None = None) -> dict[str, DataFrame]:
    """All eight views by name. Give it a stored run (`read_results`): every view reads it once more.
    One aggregate, a row, tells which views are empty."""
    flags = {view: flag for view, (flag, _) in DETAIL_VIEWS.items()}
    ops = F.col("operational_change") | F.col("shutdown")
    n = results.agg(*[F.count_if(flag).alias(view) for view, flag in flags.items()],
                    F.count_if("hq_change").alias("hq_changes"),
                    F.count_if(ops).alias("operational_changes")).first()
    views = {view: detail_view(results, flag, detail)
             for view, (flag, detail) in DETAIL_VIEWS.items()}
    views |= {"hq_changes": hq_view(results), "operational_changes": ops_view(results)}
    filled_in = {name: view if n[name] else placeholder(view) for name, view in views.items()}
    return {"dashboard": dashboard(results), **filled_in,
            "run_stats": stats(results, generated, window, runtime)}


def write_report(views: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Each view into its own folder."""
    for name, view in views.items():
        writer = view.write.mode("overwrite").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(f"{path}/{name}")


def report_run(results: DataFrame, path: str, generated: Column, window: Column,
               runtime: Column | None = None, fmt: str = "parquet") -> None:
    """Write the report of any results: lazy ones are stored first, beside the views, so that they
    are computed once and not once a view."""
    stored = f"{path.rstrip('/')}/results"
    results.write.mode("overwrite").parquet(stored)
    spark = results.sparkSession
    write_report(report(spark.read.schema(results.schema).parquet(stored), generated, window,
                        runtime), path, fmt)
