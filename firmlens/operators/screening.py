"""The cheap gate ahead of costly steps: content, keyword near name, score."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.jsonio import int_field, let, newest_answers, parse_score_answer, text_field
from ..functions.names import clean_name_light
from ..functions.text import strip
from ..params import (REASON_NO_CONTENT, REASON_NO_KEYWORD, REASON_PARSE_ERROR, SIGNAL_ROOTS,
                      Params)
from .batch import score_batch, spread

REACH = 300
SCREEN_COLUMNS = ("company", "passed", "stage", "score", "reason")


def keyword_pattern(roots: Sequence[str] = SIGNAL_ROOTS, ascii_words: bool = False) -> str:
    """A root at a word start with the rest of its word, in group 1, for lower-case text.

    ascii_words delimits by ASCII characters only, which every regex dialect agrees on.
    """
    body = "|".join(r.replace("(", "(?:") for r in roots)
    if ascii_words:
        return rf"(?:^|[^a-z0-9_])((?:{body})[a-z0-9_]*)"
    return rf"(?U)\b((?:{body})\w*)"


def enough_content(text: Column, minimum: int) -> Column:
    return F.coalesce(F.length(strip(text)) >= minimum, F.lit(False))


def keyword_near_name(company: Column, text: Column, pattern: str | None = None) -> Column:
    """The first keyword near the company's name, lower-cased; NULL where there is none.

    First choice: the first sentence holding both. Else: the first mention of the name with a
    keyword within 300 characters on either side. A name that cleans to nothing has no
    mentions.
    """
    pattern = pattern or keyword_pattern()
    body = F.lower(F.coalesce(text, F.lit("")))
    name = F.lower(clean_name_light(company))

    def keyword(part: Column) -> Column:
        return F.regexp_extract(part, pattern, 1)

    def first_keyword(parts: Column) -> Column:
        return F.try_element_at(F.filter(F.transform(parts, keyword), lambda k: k != ""),
                                F.lit(1))

    in_sentence = first_keyword(F.filter(F.split(body, r"[.\n!?]"),
                                         lambda s: F.contains(s, name)))
    # The regex finds each mention and captures its surroundings, so long texts are read once.
    quoted = F.concat(F.lit(r"\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")),
                      F.lit(r"\E"))
    left = F.concat(F.lit("(?s)"), quoted,
                    F.lit(rf"(?<=(\A.{{0,{REACH - 1}}}|.{{{REACH}}})"), quoted, F.lit(")"))
    right = F.concat(F.lit("(?s)"), quoted, F.lit(rf"(?=(.{{0,{REACH}}}))"))
    windows = F.zip_with(F.regexp_extract_all(body, left, F.lit(1)),
                         F.regexp_extract_all(body, right, F.lit(1)),
                         lambda a, b: F.concat(a, name, b))
    both = (name != "") & F.contains(body, name) & body.rlike(pattern)
    return F.when(both, F.coalesce(in_sentence, first_keyword(windows)))


def score_of(raw: Column) -> Column:
    """(score, reason) of a short answer. Whatever cannot be read passes with a 3."""
    return let(parse_score_answer(raw), _score_fields)


def _score_fields(obj: Column) -> Column:
    given = F.try_variant_get(obj, "$.score", "variant").isNotNull()
    number = int_field(obj, "score")
    broken = obj.isNull() | (given & number.isNull())
    clamped = F.least(F.greatest(F.coalesce(number, F.lit(3)), F.lit(1)), F.lit(5))
    return F.struct(
        F.when(broken, 3).otherwise(clamped).alias("score"),
        F.when(broken, F.lit(REASON_PARSE_ERROR)).otherwise(text_field(obj, "reason"))
        .alias("reason"))


def decide(headlines: DataFrame, answers: DataFrame, params: Params = Params(),
           pattern: str | None = None, name: str = "company") -> DataFrame:
    """One decision per row of `headlines` (company, headline_text); of a company's short model
    answers in `answers` (company, raw) the newest counts. No answer passes with a 3. `name` is
    the column to look for in the text, where that is not the key itself. Other columns of
    `headlines` stay."""
    keyword = keyword_near_name(F.col(name), F.col("headline_text"),
                                pattern or keyword_pattern(params.roots))
    scored = score_of(F.col("raw"))
    gated = (
        headlines.join(newest_answers(answers, ["company"]), "company", "left")
        .withColumn("_content", enough_content(F.col("headline_text"),
                                               params.headline_min_chars))
        .withColumn("_keyword", F.when(F.col("_content"), keyword))
        .withColumn("_scored", F.when(
            F.col("raw").isNotNull(), scored).otherwise(
            F.struct(F.lit(3).alias("score"), F.lit("no answer — defaulting to pass")
                     .alias("reason"))))
    )
    no_content = ~F.col("_content")
    no_keyword = F.col("_keyword").isNull()
    passed = F.col("_scored.score") >= params.min_prescreen_score
    return gated.select(
        "company",
        F.when(no_content | no_keyword, F.lit(False)).otherwise(passed).alias("passed"),
        F.when(no_content, "no_content").when(no_keyword, "1B_keyword")
        .when(passed, "passed").otherwise("1C_llm").alias("stage"),
        F.when(no_content | no_keyword, 0).otherwise(F.col("_scored.score")).alias("score"),
        F.when(no_content, REASON_NO_CONTENT).when(no_keyword, REASON_NO_KEYWORD)
        .otherwise(F.col("_scored.reason")).alias("reason"),
        *[c for c in headlines.columns if c != "company"])


def ask_scores(headlines: DataFrame, setup: Callable[[], Callable[[dict], dict]],
               params: Params = Params(), pattern: str | None = None) -> DataFrame:
    """(company, raw): the short model's answers for `decide`. Only companies that pass the content and
    keyword gates are asked, each about the first `screen_chars` characters of its headlines. `setup`
    gives a function from {company, headlines} to {raw}; where it fails, raw is NULL, which passes."""
    text = F.col("headline_text")
    gated = headlines.filter(
        enough_content(text, params.headline_min_chars)
        & keyword_near_name(F.col("company"), text,
                            pattern or keyword_pattern(params.roots)).isNotNull())
    shown = text if params.screen_chars is None else F.substring(text, 1, params.screen_chars)
    asked = spread(gated.select("company", shown.alias("headlines")), params.num_partitions)
    answers = score_batch(asked, setup, StructType([StructField("raw", StringType())]),
                          error_chars=params.error_chars)
    return answers.select("company", F.when(F.col("error").isNull(), F.col("raw")).alias("raw"))


def screen_log(decisions: DataFrame) -> DataFrame:
    return decisions.select(*SCREEN_COLUMNS)


def write_screen_log(decisions: DataFrame, path: str) -> None:
    screen_log(decisions).write.mode("append").csv(path, header=True)


def screen_usage(decisions: DataFrame, params: Params = Params()) -> DataFrame:
    """Companies screened, let through, and the deep queries that will cost."""
    return decisions.agg(
        F.count(F.lit(1)).alias("screened"),
        F.count_if("passed").alias("triggered"),
        (F.count_if("passed") * params.deep_queries).alias("deep_calls"))


def screen_stages(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("stage").agg(F.count(F.lit(1)).alias("companies"))
