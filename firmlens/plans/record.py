"""Storing a run, its gate's log and its report, each in one pass: the totals are observed while the
rows are written, so nothing is read again to count it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import runtime_label
from ..functions.fields import filled, tick
from ..operators.screening import screen_log
from ..params import EMPTY_VIEW_TEXT, SIGNALS, Params
from ..sources.results import RESULT_SCHEMA, conform
from ..sources.snapshots import SnapshotTable
from .report import _TICKS, DETAIL_VIEWS, STAT_LABELS, _sources

# ---- result rows --------------------------------------------------------------------------


def run_table(spark: SparkSession, path: str) -> SnapshotTable:
    """Result rows by run, as snapshots: a run written again takes the old one's place in one step."""
    schema = RESULT_SCHEMA.simpleString()[len("struct<"):-1]
    return SnapshotTable(spark, path, "run_id", schema)


def _observed(rows: DataFrame, *metrics: Column) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return rows.observe(seen, *metrics), seen


def _totals() -> list[Column]:
    counts = [F.count_if(F.col(s)).alias(s) for s in SIGNALS]
    return [F.count(F.lit(1)).alias("processed"), F.count_if(F.col("error").isNotNull()).alias("errors"),
            F.count_if(F.col("total_signals") > 0).alias("with_signals"), *counts,
            F.coalesce(F.sum("total_signals"), F.lit(0)).alias("total_signals")]


def store_run(results: DataFrame, table: SnapshotTable, run_id: str) -> dict:
    """Write a run's rows and return its totals: those of `run_kpis` and `category_counts`."""
    stamped = results.withColumns({"run_id": F.lit(run_id), "processed_at": F.current_timestamp()})
    if "error" not in stamped.columns:
        stamped = stamped.withColumn("error", F.lit(None).cast("string"))
    rows, seen = _observed(conform(stamped), *_totals())
    table.replace(rows, run_id)
    totals = seen.get
    rate = round(100.0 * totals["with_signals"] / max(totals["processed"], 1), 1)
    return totals | {"signal_rate": rate}


# ---- the gate's log -----------------------------------------------------------------------


def log_screening(decisions: DataFrame, path: str, run_id: str, params: Params = Params()) -> dict:
    """Write a run's decisions as CSV into the run's own folder, which a repeated write replaces, and
    return the totals of `screen_usage`."""
    rows, seen = _observed(screen_log(decisions), F.count(F.lit(1)).alias("screened"),
                           F.count_if("passed").alias("triggered"))
    rows.write.mode("overwrite").csv(f"{path.rstrip('/')}/run_id={run_id}", header=True)
    totals = seen.get
    return totals | {"deep_calls": totals["triggered"] * params.deep_queries}


# ---- the report ---------------------------------------------------------------------------

_ROW = ("view string, company string, detail string, hq_region string, sources string, "
        + ", ".join(f"{f} string" for f in _TICKS) + ", shutdown string, total_signals int, "
        "summary string, position int, metric string, value string")
#: The columns of each view.
VIEW_COLUMNS = {
    "dashboard": ("company", *_TICKS, "total_signals", "summary", "hq_region", "shutdown"),
    **{view: ("company", "detail", "sources") for view in DETAIL_VIEWS},
    "hq_changes": ("company", "hq_region", "detail", "sources"),
    "operational_changes": ("company", "detail", "sources"),
    "run_stats": ("position", "metric", "value"),
}
_FIELDS = [c.split()[0] for c in _ROW.split(", ")]


def _cell(view: str, on: Column, **values: Column) -> Column:
    """A row of a view, where `on`; the fields that the view lacks are NULL."""
    types = dict(c.split() for c in _ROW.split(", "))
    values["view"] = F.lit(view)
    row = F.struct(*[values.get(f, F.lit(None)).cast(types[f]).alias(f) for f in _FIELDS])
    return F.when(F.coalesce(on, F.lit(False)), row)


def write_report_once(results: DataFrame, path: str, generated: Column, window: Column,
                      runtime: Column | None = None) -> None:
    """All eight views from one evaluation of the results, each into a folder of its own.

    Every result row gives its rows of all views at once. What the totals and the notes of empty views
    need is observed on the way and added as a few rows at the end."""
    ops = F.col("operational_change") | F.col("shutdown")
    cells = [_cell("dashboard", F.lit(True), company=F.col("company"),
                   **{f: tick(F.col(f)) for f in (*_TICKS, "shutdown")},
                   total_signals=F.col("total_signals"), summary=F.col("summary"),
                   hq_region=F.when(F.col("hq_change"), F.col("hq_region")).otherwise("—"))]
    cells += [_cell(view, F.col(flag), company=F.col("company"), detail=F.col(detail),
                    sources=F.col("_cited")) for view, (flag, detail) in DETAIL_VIEWS.items()]
    cells += [_cell("hq_changes", F.col("hq_change"), company=F.col("company"), detail=F.col("hq_detail"),
                    hq_region=F.coalesce(filled(F.col("hq_region")), F.lit("—")), sources=F.col("_cited")),
              _cell("operational_changes", ops, company=F.col("company"), detail=F.col("ops_detail"),
                    sources=F.col("_cited"))]
    on = {**{view: F.col(flag) for view, (flag, _) in DETAIL_VIEWS.items()},
          "hq_changes": F.col("hq_change"), "operational_changes": ops}
    rows, seen = _observed(
        results, F.count(F.lit(1)).alias("n"), F.count_if(F.col("total_signals") > 0).alias("with"),
        *[F.count_if(flag).alias(f"view_{view}") for view, flag in on.items()],
        *[F.count_if(F.col(f)).alias(f"stat_{f}") for _, f in STAT_LABELS])
    made = rows.withColumn("_cited", _sources()).select(
        F.inline(F.filter(F.array(*cells), lambda c: c.isNotNull())))
    made.write.mode("overwrite").partitionBy("view").parquet(path)
    n = seen.get
    stats = [("Generated", generated), ("Date Window", window),
             ("Total Companies Processed", F.lit(n["n"])), ("Companies with Signals", F.lit(n["with"])),
             ("", F.lit("")), ("— Signal Breakdown —", F.lit(""))]
    stats += [(label, F.lit(n[f"stat_{f}"])) for label, f in STAT_LABELS]
    if runtime is not None:
        stats.append(("Pipeline Runtime", runtime_label(runtime)))
    few = [_cell("run_stats", F.lit(True), position=F.lit(i), metric=F.lit(m), value=v)
           for i, (m, v) in enumerate(stats, 1)]
    few += [_cell(view, F.lit(True), company=F.lit(EMPTY_VIEW_TEXT)) for view in on if not n[f"view_{view}"]]
    if not n["n"]:
        few.append(_cell("dashboard", F.lit(True), company=F.lit(EMPTY_VIEW_TEXT)))
    spark = results.sparkSession
    (spark.range(1).select(F.inline(F.array(*few))).write.mode("append").partitionBy("view").parquet(path))


def read_view(spark: SparkSession, path: str, view: str) -> DataFrame:
    """A view of a written report, with its own columns."""
    types = ", ".join(c for c in _ROW.split(", ") if not c.startswith("view "))
    return spark.read.schema(types).parquet(f"{path}/view={view}").select(*VIEW_COLUMNS[view])


def read_views(spark: SparkSession, path: str) -> DataFrame:
    """(view, name, text) of all views: what each of their rows is about, and says."""
    named = {"run_stats": ("metric", "value"), "dashboard": ("company", "summary")}
    return reduce(DataFrame.unionByName, [
        read_view(spark, path, view).select(
            F.lit(view).alias("view"), F.col(named.get(view, ("company", "detail"))[0]).alias("name"),
            F.col(named.get(view, ("company", "detail"))[1]).alias("text")) for view in VIEW_COLUMNS])
