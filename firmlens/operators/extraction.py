"""Folding model answers into one result row per company.

answers: company, pass ('pass1' | 'pass2' | 'pass3' | 'single'), chunk_idx, signal, raw and,
optionally, answered_at; of repeated answers to one question the newest counts
contexts: company, context, sources
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import compose_summary, count_signals, filled, merge_ops
from ..functions.jsonio import (flag_field, int_field, newest_answers, read_answers, text_field,
                                truth)
from ..params import (DETAIL_COLUMNS, SIGNALS, SUMMARY_NOTHING, SUMMARY_SHORT_CONTEXT,
                      SUMMARY_UNCONFIRMED, SUMMARY_UNVERIFIED, Params)
from .screening import enough_content

DETAILS = tuple(column for column, _ in DETAIL_COLUMNS.values())
OUTPUT = ("company", *SIGNALS, "hq_region", "total_signals", *DETAILS, "summary",
          "confidence_score")


def _confidence(obj: Column) -> Column:
    return F.coalesce(int_field(obj, "confidence"), F.lit(1))


#: What tells the questions of a pass apart.
_QUESTION = {"pass1": ("company", "chunk_idx"), "pass2": ("company", "signal"),
             "pass3": ("company",), "single": ("company",)}


def _of_pass(answers: DataFrame, which: str) -> DataFrame:
    return newest_answers(answers.filter(F.col("pass") == which), _QUESTION[which])


def _text(name: str) -> Callable[[Column], Column]:
    return lambda obj: text_field(obj, name)


def _flag(name: str, params: Params) -> Callable[[Column], Column]:
    return lambda obj: flag_field(obj, name, plain=params.compat)


def _first_pass(answers: DataFrame) -> DataFrame:
    """(company, signal, confidence, named) of the chunk answers, one row per signal and one
    with a NULL signal for answers naming none.

    Both users below take all four columns from it, so that their plans share its shuffle and
    each answer is parsed once.
    """
    fields = {"_named": lambda o: F.filter(F.coalesce(
        F.try_variant_get(o, "$.detected", "array<string>"),
        F.array().cast("array<string>")), lambda x: x.isNotNull()), "_conf": _confidence}
    return (read_answers(_of_pass(answers, "pass1"), fields, ["company"])
            .select("company", "_conf", F.explode_outer("_named").alias("signal"))
            .groupBy("company", "signal")
            .agg(F.max("_conf").alias("confidence"), F.count("signal").alias("named")))


def detections(answers: DataFrame) -> DataFrame:
    """(company, signal): every signal named by any chunk's answer, once."""
    named = (F.col("named") > 0) & F.col("confidence").isNotNull()
    return _first_pass(answers).filter(named).select("company", "signal")


def best_confidence(answers: DataFrame) -> DataFrame:
    """(company, best, detected): highest confidence over the chunks, at least 1, and whether
    any chunk named a signal."""
    return _first_pass(answers).groupBy("company").agg(
        F.greatest(F.max("confidence"), F.lit(1)).alias("best"),
        (F.max("named") > 0).alias("detected"))


def _second_pass(answers: DataFrame, minimum: int, params: Params = Params()) -> DataFrame:
    fields = {"confirmed": _flag("confirmed", params), "detail": _text("detail"),
              "hq_region": _text("hq_region"), "is_shutdown": _flag("is_shutdown", params),
              "confidence": _confidence}
    return read_answers(_of_pass(answers, "pass2"), fields, ["company", "signal"]).filter(
        F.col("confidence") >= minimum)


def confident(answers: DataFrame, minimum: int) -> DataFrame:
    """Second-pass answers whose confidence reaches the minimum."""
    return _second_pass(answers, minimum).select("company", "signal", "confidence")


def extractions(answers: DataFrame, detected: DataFrame, params: Params = Params()) -> DataFrame:
    """(company, signal, detail, hq_region, is_shutdown, confidence) of confirmed signals."""
    return (_second_pass(answers, params.min_confidence, params).filter("confirmed").drop("confirmed")
            .join(detected, ["company", "signal"], "left_semi"))


def _judge(extracted: DataFrame, answers: DataFrame, params: Params = Params()) -> DataFrame:
    """Extractions with the last pass's verdict (`kept`; no verdict is a yes) and corrections
    applied."""
    checks = read_answers(_of_pass(answers, "pass3"), {
        "_verdicts": lambda o: F.transform_values(
            F.try_variant_get(o, "$.verified", "map<string,variant>"), lambda k, v: truth(v, plain=params.compat)),
        "_fixes": lambda o: F.try_variant_get(o, "$.corrections", "map<string,string>"),
    }, ["company"])
    kept = F.coalesce(F.try_element_at("_verdicts", F.col("signal")), F.lit(True))
    fixed = filled(F.try_element_at("_fixes", F.col("signal")))
    return (extracted.join(checks, "company", "left")
            .withColumns({"kept": kept, "detail": F.coalesce(fixed, F.col("detail"))})
            .drop("_verdicts", "_fixes"))


def verify(extracted: DataFrame, answers: DataFrame, params: Params = Params()) -> DataFrame:
    """Extractions less those the last pass denies, with its corrections applied.

    A signal the answer does not mention stays; a falsy verdict drops it; a correction replaces
    the detail unless it is empty.
    """
    return _judge(extracted, answers, params).filter("kept").drop("kept")


def _fold(judged: DataFrame, params: Params) -> DataFrame:
    """One row per company: flags and details. Pure partial aggregates, no grouping lists."""
    def flag(name: str) -> Column:
        return F.bool_or(F.col("kept") & (F.col("signal") == name))

    def detail(name: str, column: str = "detail") -> Column:
        mine = F.col("kept") & (F.col("signal") == name)
        return F.coalesce(F.max(F.when(mine, F.col(column))), F.lit(""))

    shut = flag("shutdown")
    # Without compat, `is_shutdown` on a kept operational change counts as a shutdown as well.
    ceased = shut | F.bool_or(F.col("kept") & F.col("is_shutdown")
                              & (F.col("signal") == "operational_change"))
    return judged.groupBy("company").agg(
        *[flag(s).alias(s) for s in SIGNALS if s not in ("operational_change", "shutdown")],
        (flag("operational_change") | shut).alias("operational_change"),
        (F.lit(False) if params.compat else ceased).alias("shutdown"),
        detail("hq_change", "hq_region").alias("hq_region"),
        *[detail(s).alias(column) for s, (column, _) in DETAIL_COLUMNS.items()
          if s != "operational_change"],
        merge_ops(detail("operational_change"), detail("shutdown")).alias("ops_detail"),
        F.max(F.when(F.col("kept"), F.col("confidence"))).alias("_confidence"),
        F.count(F.lit(1)).alias("_confirmed"))


def _complete(df: DataFrame) -> DataFrame:
    """Fill what a company without a folded row lacks."""
    flags = {s: F.coalesce(F.col(s), F.lit(False)) for s in SIGNALS}
    texts = {c: F.coalesce(F.col(c), F.lit("")) for c in (*DETAILS, "hq_region")}
    return df.withColumns({**flags, **texts}).withColumn("total_signals", count_signals())


def _three_pass(rows: DataFrame, answers: DataFrame, params: Params) -> DataFrame:
    """Rows with their result columns; each join brings at most one row per company."""
    best = best_confidence(answers)
    sure = best.filter(F.col("best") >= params.min_confidence).select("company")
    live = detections(answers).join(sure, "company", "left_semi")
    folded = _fold(_judge(extractions(answers, live, params), answers, params), params)
    done = _complete(rows.join(best, "company", "left").join(folded, "company", "left"))
    nothing = ~F.coalesce("detected", F.lit(False)) | (F.coalesce("best", F.lit(1))
                                                      < params.min_confidence)
    summary = (F.when(nothing, SUMMARY_NOTHING)
               .when(F.col("_confirmed").isNull(), SUMMARY_UNCONFIRMED)
               .when(F.col("total_signals") == 0, SUMMARY_UNVERIFIED)
               .otherwise(compose_summary()))
    score = F.lit(0) if params.compat else F.coalesce("_confidence", F.lit(0))
    return done.withColumns({"summary": summary, "confidence_score": score.cast("int")})


def _single_pass(rows: DataFrame, answers: DataFrame, params: Params) -> DataFrame:
    fields = {
        **{s: _flag(s, params) for s in SIGNALS},
        **{c: _text(c) for c in DETAILS if c != "ops_detail"},
        "ops_detail": lambda o: merge_ops(text_field(o, "ops_detail"),
                                          text_field(o, "shutdown_detail")),
        "hq_region": _text("hq_region"), "_summary": _text("summary"), "_conf": _confidence}
    read = read_answers(_of_pass(answers, "single"), fields, ["company", "raw"],
                        unreadable=True)
    ok = F.coalesce(F.col("_conf") >= params.min_confidence, F.lit(False))
    summary = (F.when(F.col("_conf").isNull(), F.concat(
                   F.lit("[parse error] "),
                   F.substring(F.coalesce("raw", F.lit("")), 1, 120)))
               .when(~ok, F.concat(F.lit("[low confidence "), F.col("_conf").cast("string"),
                                   F.lit("/5] "), F.col("_summary")))
               .otherwise(F.col("_summary")))
    score = F.lit(0) if params.compat else F.when(ok, F.col("_conf")).otherwise(0)
    done = rows.join(read, "company", "left").withColumns({
        "summary": summary, "confidence_score": score.cast("int"),
        **{c: F.when(ok, F.col(c)) for c in (*SIGNALS, *DETAILS, "hq_region")}})
    return _complete(done)


def three_pass(contexts: DataFrame, answers: DataFrame, params: Params = Params()) -> DataFrame:
    """Detect per chunk, extract per signal, verify; one row per context row."""
    return _three_pass(contexts.select("company"), answers, params).select(*OUTPUT)


def single_pass(contexts: DataFrame, answers: DataFrame, params: Params = Params()) -> DataFrame:
    """One answer holds every field; an unreadable or unsure one leaves just a note."""
    return _single_pass(contexts.select("company"), answers, params).select(*OUTPUT)


def classify(contexts: DataFrame, answers: DataFrame, params: Params = Params()) -> DataFrame:
    """Result row of every context row: too short a context is noted and nothing else; all
    others go through the chosen mode; sources are attached."""
    enough = enough_content(F.col("context"), params.context_min_chars)
    rows = contexts.select("company", "sources", enough.alias("_enough"))
    done = (_three_pass if params.three_pass else _single_pass)(rows, answers, params)
    ok = F.col("_enough")
    blank = {**{s: F.lit(False) for s in SIGNALS}, **{c: F.lit("") for c in DETAILS},
             "hq_region": F.lit(""), "total_signals": F.lit(0), "confidence_score": F.lit(0),
             "summary": F.lit(SUMMARY_SHORT_CONTEXT)}
    return done.select("company", *[F.when(ok, F.col(c)).otherwise(blank[c]).alias(c)
                                    for c in OUTPUT if c != "company"], "sources")
