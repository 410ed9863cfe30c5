"""Result tables across runs: resume, reassembly, selection, KPIs and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fields import count_signals
from ..params import SIGNALS, SUMMARY_SKIPPED, Params

# ---- resume -------------------------------------------------------------------------------


def todo(companies: DataFrame, results: DataFrame, retry_errors: bool = True) -> DataFrame:
    """Companies without a result. Failed ones count as open unless `retry_errors` is off."""
    done = results.filter(F.col("error").isNull()) if retry_errors else results
    return companies.join(done.select("company").distinct(), "company", "left_anti")


def restrict(checkpoint: DataFrame, companies: DataFrame) -> DataFrame:
    """Checkpoint rows of the selected companies."""
    return checkpoint.join(companies.select("company").distinct(), "company", "left_semi")


def reassemble(companies: DataFrame, results: DataFrame) -> DataFrame:
    """A row per input row, in input order; a company without a result gets defaults."""
    columns = [c for c in results.columns if c != "company"]

    def default(name: str) -> Column:
        kind = results.schema[name].dataType.typeName()
        if name == "summary":
            return F.coalesce(name, F.when(F.col("_found").isNull(), SUMMARY_SKIPPED),
                              F.lit(""))
        if name in ("processed_at", "run_id", "error"):
            return F.col(name)
        if kind == "array":
            return F.coalesce(name, F.array().cast(results.schema[name].dataType))
        zero = {"boolean": False, "string": ""}.get(kind, 0)
        return F.coalesce(name, F.lit(zero).cast(results.schema[name].dataType))

    joined = companies.join(results.withColumn("_found", F.lit(True)), "company", "left")
    kept = [c for c in companies.columns if c not in results.columns]
    return (joined.select("company", *kept, *[default(c).alias(c) for c in columns])
            .orderBy("input_pos"))


# ---- selecting rows -----------------------------------------------------------------------


def select_run(results: DataFrame, run: str = "latest") -> DataFrame:
    """Rows of one run: an id, 'all', or 'latest' (the run of the newest row)."""
    if run.lower() == "all":
        return results
    if run.lower() != "latest":
        return results.filter(F.col("run_id") == run)
    newest = results.agg(F.max_by("run_id", F.struct("processed_at", "run_id")).alias("run_id"))
    return results.join(F.broadcast(newest), "run_id").select(*results.columns)  # one row


def latest_per_company(results: DataFrame) -> DataFrame:
    """The newest row of every company over all runs."""
    w = Window.partitionBy("company").orderBy(F.desc("processed_at"), F.desc("run_id"))
    return (results.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1)
            .drop("_n"))


def export_rows(results: DataFrame, params: Params = Params()) -> DataFrame:
    """Rows with signals, surest and fullest first, up to the export limit."""
    return (results.filter(F.col("total_signals") > 0)
            .orderBy(F.desc("confidence_score"), F.desc("total_signals"), F.asc("company"))
            .limit(params.export_limit))


def error_sample(results: DataFrame, params: Params = Params()) -> DataFrame:
    return (results.filter(F.col("error").isNotNull()).select("company", "error")
            .orderBy("company", "error").limit(params.error_sample))


def flagged(results: DataFrame) -> DataFrame:
    return results.filter(F.col("total_signals") > 0).select("company", "total_signals")


def recount(results: DataFrame) -> DataFrame:
    return results.withColumn("total_signals", count_signals())


# ---- totals -------------------------------------------------------------------------------


def _category_sums(null_when_empty: bool) -> list[Column]:
    """Counts per flag; an empty run gives NULL or 0."""
    def total(flag: str) -> Column:
        n = F.sum(F.col(flag).cast("int"))
        return n if null_when_empty else F.coalesce(n, F.lit(0))
    signals = F.sum("total_signals")
    if not null_when_empty:
        signals = F.coalesce(signals, F.lit(0))
    return [*[total(s).alias(s) for s in SIGNALS], signals.alias("total_signals")]


def run_kpis(results: DataFrame) -> DataFrame:
    """Processed, failed, with signals, and the signal rate: one pass over the run."""
    with_signals = F.count_if(F.col("total_signals") > 0)
    n = F.count(F.lit(1))
    return results.agg(
        n.alias("processed"), F.count_if(F.col("error").isNotNull()).alias("errors"),
        with_signals.alias("with_signals"),
        F.round(F.lit(100.0) * with_signals / F.greatest(n, F.lit(1)), 1).alias("signal_rate"))


def category_counts(results: DataFrame, null_when_empty: bool = True) -> DataFrame:
    return results.agg(*_category_sums(null_when_empty))


def category_counts_long(results: DataFrame) -> DataFrame:
    """(signal, companies): one row per flag, from one pass."""
    sums = results.agg(*_category_sums(False))
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("signal"), F.col(s).alias("companies")) for s in SIGNALS])))


def alltime_counts(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("row_count"),
                       F.count_distinct("company").alias("company_count"))
