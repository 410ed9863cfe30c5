"""The questions of the answer passes, in rounds, and the store of their answers.

A first-pass question is asked for each chunk of a context. Only when a company's chunks are all
answered, and surely name signals, is each of these asked for details; only when all details are in,
and some are confirmed, is the last question asked. Each round is an anti join with the store, whose
key is (company, pass, chunk_idx, signal): after a lost run, no answered question is asked again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import fixed_chunks
from ..params import Params
from .batch import score_batch, spread
from .extraction import best_confidence, classify, detections, extractions
from .screening import enough_content

KEY = ("company", "pass", "chunk_idx", "signal")
PASSES = ("pass1", "pass2", "pass3")
ANSWER_TYPE = ("company string, pass string, chunk_idx bigint, signal string, raw string, "
               "error string, answered_at timestamp")


class AnswerStore:
    """Answers as appended files. A failed call leaves a row without `raw`, which answers nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(ANSWER_TYPE).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ANSWER_TYPE)

    def append(self, answers: DataFrame) -> None:
        names = [column.split()[0] for column in ANSWER_TYPE.split(", ")]
        answers.select(*names).write.mode("append").parquet(self.path)


def _request(which: str, chunk: Column, signal: Column, prompt: Column) -> list[Column]:
    return [F.col("company"), F.lit(which).alias("pass"), chunk.cast("long").alias("chunk_idx"),
            signal.alias("signal"), prompt.alias("prompt")]


def _answered(answers: DataFrame, which: str) -> DataFrame:
    return answers.filter((F.col("pass") == which) & F.col("raw").isNotNull())


def _settled(asked: DataFrame, answers: DataFrame, which: str) -> DataFrame:
    """(company): companies of `asked` (requests of a pass) whose questions are all answered."""
    done = _answered(answers, which).select(*KEY).distinct().withColumn("_done", F.lit(1))
    return (asked.select(*KEY).join(done, list(KEY), "left").groupBy("company")
            .agg(F.bool_and(F.col("_done").isNotNull()).alias("_all")).filter("_all")
            .select("company"))


def requests_of(which: str, contexts: DataFrame, answers: DataFrame,
                params: Params = Params()) -> DataFrame:
    """All questions of a pass (company, pass, chunk_idx, signal, prompt), answered or not, that the
    answers so far allow to ask."""
    long = contexts.filter(enough_content(F.col("context"), params.context_min_chars))
    head = F.substring("context", 1, params.max_context_chars)
    none, zero = F.lit(""), F.lit(0)
    if which == "single":
        return long.select(*_request(which, zero, none, head))
    chunks = long.select("company", F.posexplode(fixed_chunks(
        F.col("context"), params.chunk_chars, params.max_chunks)).alias("_i", "_chunk"))
    first = chunks.select(*_request("pass1", F.col("_i"), none, F.col("_chunk")))
    if which == "pass1":
        return first
    known = answers.filter(F.col("raw").isNotNull())
    sure = (best_confidence(known).filter(F.col("best") >= params.min_confidence).select("company")
            .join(_settled(first, answers, "pass1"), "company", "left_semi"))
    live = detections(known).join(sure, "company", "left_semi")
    second = live.join(long.select("company", "context"), "company").select(
        *_request("pass2", zero, F.col("signal"), head))
    if which == "pass2":
        return second
    found = extractions(known, live, params).join(
        _settled(second, answers, "pass2"), "company", "left_semi")
    # A company has as many signals as its answers name, each once.
    told = found.groupBy("company").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("signal", "detail"))))).alias("_told"))
    return told.join(long.select("company", "context"), "company").select(
        *_request("pass3", zero, none, F.concat("_told", F.lit("\n"), head)))


def open_requests(contexts: DataFrame, answers: DataFrame, params: Params = Params(),
                  passes: tuple[str, ...] | None = None) -> DataFrame:
    """The questions to ask now: allowed, and not answered yet."""
    passes = passes or (PASSES if params.three_pass else ("single",))

    def of(which: str) -> DataFrame:
        done = _answered(answers, which).select(*KEY).distinct()
        return requests_of(which, contexts, answers, params).join(done, list(KEY), "left_anti")

    return reduce(DataFrame.unionByName, map(of, passes))


def ask(requests: DataFrame, setup: Callable[[], Callable[[dict], dict]],
        params: Params = Params()) -> DataFrame:
    """Answers (ANSWER_TYPE) of the requests. `setup` gives a function from a request's fields to {raw};
    where it fails, raw is NULL and error says why."""
    key = F.to_json(F.struct(*KEY)).alias("request")
    asked = spread(requests.select(key, *KEY, "prompt"), params.num_partitions)
    rows = score_batch(asked, setup, StructType([StructField("raw", StringType())]), key="request",
                       error_chars=params.error_chars)
    types = "company string, pass string, chunk_idx bigint, signal string"
    return rows.select(F.from_json("request", types).alias("_k"), "raw", "error").select(
        "_k.*", F.when(F.col("error").isNull(), F.col("raw")).alias("raw"), "error",
        F.current_timestamp().alias("answered_at"))


def answer_all(contexts: DataFrame, store: AnswerStore,
               setup: Callable[[], Callable[[dict], dict]], params: Params = Params(),
               slices: int = 4) -> DataFrame:
    """Result rows of the contexts after all passes were asked, round by round. Each round is asked in
    `slices` jobs whose answers are stored one after the other, so a lost run loses one of them."""
    for which in PASSES if params.three_pass else ("single",):
        for k in range(slices):
            mine = F.pmod(F.xxhash64(*KEY), F.lit(slices)) == k
            todo = open_requests(contexts, store.read(), params, (which,)).filter(mine)
            if not todo.isEmpty():
                store.append(ask(todo, setup, params))
    return classify(contexts, store.read().filter(F.col("raw").isNotNull()), params)
