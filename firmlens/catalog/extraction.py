"""Queries over model answers: parsing, thresholds, unions, verification, whole passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fields import compose_summary, merge_ops
from ..functions.jsonio import decode_list, encode_list, int_field, parse_answer
from ..operators.batch import score_batch
from ..operators.extraction import (best_confidence, classify, confident, detections,
                                    extractions, single_pass, three_pass, verify)
from ..operators.lifecycle import recount
from ..operators.screening import score_of
from ..params import DETAIL_COLUMNS, SIGNALS
from .inputs import RESULTS_SQL, results, table, texts

# ---- answers made from events: a company per user and day ---------------------------------


def _events(spark, sf) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    return texts(spark, sf, "events").select(
        "event_id", k.alias("k"), kind,
        F.concat(F.lit("user_"), F.col("user_id"), F.lit("@"), F.date_format("ts", "MMdd"))
        .alias("company"),
        F.when(kind == "signup", "sector_change").when(kind == "click", "hq_change")
        .when(kind == "view", "ma_spinoff")
        .when((kind == "purchase") & (k % 2 == 0), "renaming")
        .when(kind == "purchase", "operational_change")
        .when(k % 3 == 0, "shutdown").when(k % 3 == 1, "bankruptcy")
        .otherwise("something_else").alias("signal"))


_EVENTS = """
  SELECT event_id, k, event_type, company, CASE event_type WHEN 'signup' THEN 'sector_change'
    WHEN 'click' THEN 'hq_change' WHEN 'view' THEN 'ma_spinoff'
    WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'renaming' ELSE 'operational_change' END
    ELSE CASE k % 3 WHEN 0 THEN 'shutdown' WHEN 1 THEN 'bankruptcy' ELSE 'something_else' END
    END AS signal
  FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    'user_' || user_id || '@' || strftime(ts, '%m%d') AS company FROM events)
"""


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _pass1(ev: DataFrame) -> DataFrame:
    """Each event is one chunk's answer, wrapped in the ways answers come."""
    k, e = F.col("k"), F.col("event_id")
    obj = _text('{"detected": ["', F.col("signal"), '"], "confidence": ', k % 7, "}")
    raw = (F.when(e % 6 == 0, _text("```json\n", obj, "\n```")).when(e % 6 == 1, obj)
           .when(e % 6 == 2, _text("Here it is: ", obj, " done"))
           .when(e % 6 == 3, F.substring(obj, F.lit(1), F.length(obj) - 3))
           .when(e % 6 == 4, _text('{"detected": ["', F.col("signal"),
                                   '", "renaming"], "confidence": "', k % 7, '"}'))
           .otherwise('{"detected": null, "confidence": null}'))
    return ev.select("company", F.lit("pass1").alias("pass"), e.alias("chunk_idx"),
                     F.lit("").alias("signal"), raw.alias("raw"))


_PASS1 = f"""
  SELECT company, 'pass1' AS pass, event_id AS chunk_idx, '' AS signal,
    CASE event_id % 6 WHEN 0 THEN '```json' || chr(10) || obj || chr(10) || '```' WHEN 1 THEN obj
      WHEN 2 THEN 'Here it is: ' || obj || ' done' WHEN 3 THEN substr(obj, 1, length(obj) - 3)
      WHEN 4 THEN '{{"detected": ["' || signal || '", "renaming"], "confidence": "' || (k % 7)
        || '"}}'
      ELSE '{{"detected": null, "confidence": null}}' END AS raw
  FROM (SELECT *, '{{"detected": ["' || signal || '"], "confidence": ' || (k % 7) || '}}' AS obj
        FROM ({_EVENTS}))
"""


# Ways in which answers say yes or no.
CONFIRMED = ("false", "true", '"yes"', "1", '"no"', '"True"', "true", '"confirmed"', "0", "true", "[1]",
             '"false"')


def _pass2(ev: DataFrame) -> DataFrame:
    per = ev.groupBy("company", "signal").agg(F.max("k").alias("k"))
    k, sig = F.col("k"), F.col("signal")
    yes = F.get(F.array(*map(F.lit, CONFIRMED)), (k % len(CONFIRMED)).cast("int"))
    shut = F.when(k % 5 == 0, "true").otherwise("false")
    conf = F.when(k % 7 == 0, _text('"', k % 6, '"')).otherwise(_text(k % 6, ".5"))
    region = F.when(sig == "hq_change", "USA West").otherwise("")
    raw = _text('```\n{"confirmed": ', yes, ', "detail": "', sig, " k=", k, '", "hq_region": "',
                region, '", "is_shutdown": ', shut, ', "confidence": ', conf, "}\n```")
    return per.select("company", F.lit("pass2").alias("pass"),
                      F.lit(0).cast("long").alias("chunk_idx"), "signal", raw.alias("raw"))


_CONFIRMED_LIST = "[" + ", ".join(f"'{c}'" for c in CONFIRMED) + "]"
_PASS2 = f"""
  SELECT company, 'pass2' AS pass, 0 AS chunk_idx, signal,
    '```' || chr(10) || '{{"confirmed": ' || ({_CONFIRMED_LIST})[1 + k % 12]
    || ', "detail": "' || signal || ' k=' || k || '", "hq_region": "'
    || CASE WHEN signal = 'hq_change' THEN 'USA West' ELSE '' END || '", "is_shutdown": '
    || CASE WHEN k % 5 = 0 THEN 'true' ELSE 'false' END || ', "confidence": '
    || CASE WHEN k % 7 = 0 THEN '"' || (k % 6) || '"' ELSE (k % 6) || '.5' END || '}}' || chr(10)
    || '```' AS raw
  FROM (SELECT company, signal, max(k) AS k FROM ({_EVENTS}) GROUP BY company, signal)
"""


def _pass3(ev: DataFrame) -> DataFrame:
    per = ev.groupBy("company").agg(F.max("k").alias("k"))
    k = F.col("k")
    raw = F.when(k % 8 == 0, "n/a").otherwise(_text(
        '{"verified": {"hq_change": ', F.when(k % 3 == 1, "true").when(k % 3 == 2, '"Yes"')
        .otherwise('"False"'),
        ', "renaming": ', F.when(k % 5 == 0, "null").otherwise("1"),
        ', "shutdown": ', F.when(k % 4 == 1, "0").otherwise("true"),
        '}, "corrections": {"ma_spinoff": "', F.when(k % 2 == 0, "").otherwise("fixed deal"),
        '", "sector_change": "fixed sector"}}'))
    return per.select("company", F.lit("pass3").alias("pass"),
                      F.lit(0).cast("long").alias("chunk_idx"), F.lit("").alias("signal"),
                      raw.alias("raw"))


_PASS3 = f"""
  SELECT company, 'pass3' AS pass, 0 AS chunk_idx, '' AS signal, CASE WHEN k % 8 = 0 THEN 'n/a'
    ELSE '{{"verified": {{"hq_change": ' || CASE k % 3 WHEN 1 THEN 'true' WHEN 2 THEN '"Yes"' ELSE '"False"' END
    || ', "renaming": ' || CASE WHEN k % 5 = 0 THEN 'null' ELSE '1' END
    || ', "shutdown": ' || CASE WHEN k % 4 = 1 THEN '0' ELSE 'true' END
    || '}}, "corrections": {{"ma_spinoff": "' || CASE WHEN k % 2 = 0 THEN '' ELSE 'fixed deal' END
    || '", "sector_change": "fixed sector"}}}}' END AS raw
  FROM (SELECT company, max(k) AS k FROM ({_EVENTS}) GROUP BY company)
"""


def answers(spark, sf) -> DataFrame:
    """Every answer, and before it a stale one to the same question, which must not count."""
    ev = _events(spark, sf)
    fresh = reduce(DataFrame.unionByName, [_pass1(ev), _pass2(ev), _pass3(ev)])
    stale = F.lit('{"detected": ["hq_change"], "confidence": 5, "confirmed": true, '
                  '"verified": {"ma_spinoff": false}}')
    return fresh.select(*[c for c in fresh.columns if c != "raw"], F.inline(F.array(
        F.struct(F.lit(1).alias("answered_at"), F.col("raw")),
        F.struct(F.lit(0).alias("answered_at"), stale.alias("raw")))))


def contexts(spark, sf) -> DataFrame:
    """A context per company, long enough for about half of them."""
    ev = _events(spark, sf).groupBy("company").agg(
        (F.count(F.lit(1)) + F.min("event_id") % 9).cast("int").alias("n"),
        F.max("event_id").alias("last"))
    return ev.select("company", F.expr("repeat('evidence.  ', n * 2)").alias("context"),
                     F.array(_text("u", F.col("last"))).alias("sources"))


_CONTEXT = f"""
  SELECT company, repeat('evidence.  ', 2 * CAST(count(*) + min(event_id) % 9 AS INTEGER))
    AS context, 'u' || max(event_id) AS sources FROM ({_EVENTS}) GROUP BY company
"""


# ---- oracle pieces ------------------------------------------------------------------------


def _parsed(rows: str) -> str:
    """Rows with `j`: the answer's object as JSON text, or NULL."""
    return rf"""
  SELECT * EXCLUDE (t), CASE WHEN json_valid(t) AND json_type(t) = 'OBJECT' THEN t
    WHEN json_valid(regexp_extract(t, '(?s)\{{.*\}}')) THEN regexp_extract(t, '(?s)\{{.*\}}')
    END AS j
  FROM (SELECT *, regexp_replace(regexp_replace(raw, '^\s*```(?:json)?\s*', ''), '\s*```\s*$', '')
          AS t FROM ({rows}))
"""


def _int(field: str) -> str:
    v = f"json_extract_string(j, '$.{field}')"
    return rf"""CASE json_type(j, '$.{field}') WHEN 'VARCHAR'
      THEN CASE WHEN regexp_full_match({v}, '\s*[+-]?\d+\s*') THEN CAST(trim({v}) AS INTEGER) END
      ELSE CAST(trunc(TRY_CAST({v} AS DOUBLE)) AS INTEGER) END"""


def _truth(path: str) -> str:
    v = f"json_extract_string(j, {path})"
    return f"""CASE json_type(j, {path}) WHEN 'BOOLEAN' THEN {v} = 'true' WHEN 'NULL' THEN false
      WHEN 'VARCHAR' THEN lower(trim({v})) NOT IN ('', 'false', 'no', '0')
      WHEN 'ARRAY' THEN json_array_length(j, {path}) > 0 ELSE CAST({v} AS DOUBLE) <> 0 END"""


_CONF = f"coalesce({_int('confidence')}, 1)"
_P1 = f"SELECT * FROM ({_parsed(_PASS1)}) WHERE j IS NOT NULL"
_DETECTED = f"""
  SELECT DISTINCT company, unnest(CAST(json_extract(j, '$.detected') AS VARCHAR[])) AS signal
  FROM ({_P1}) WHERE json_type(j, '$.detected') = 'ARRAY'
"""
_BEST = f"""
  SELECT company, greatest(max({_CONF}), 1) AS best,
    coalesce(bool_or(json_array_length(j, '$.detected') > 0), false) AS detected
  FROM ({_P1}) GROUP BY company
"""
_SURE = f"""
  SELECT company, signal, json_extract_string(j, '$.detail') AS detail,
    json_extract_string(j, '$.hq_region') AS hq_region,
    CAST(json_extract(j, '$.is_shutdown') AS BOOLEAN) AS is_shutdown,
    {_CONF} AS confidence,
    {_truth("'$.confirmed'")} AS confirmed
  FROM ({_parsed(_PASS2)}) WHERE {_CONF} >= 2
"""
_EXTRACTED = f"""
  SELECT e.* EXCLUDE (confirmed) FROM ({_SURE}) e JOIN ({_DETECTED}) d USING (company, signal)
    JOIN ({_BEST}) b USING (company) WHERE confirmed AND best >= 2
"""
_JUDGED = f"""
  SELECT e.company, e.signal, e.hq_region, e.is_shutdown, e.confidence,
    coalesce(nullif(json_extract_string(j, '$.corrections.' || signal), ''), detail) AS detail,
    CASE WHEN json_type(j, '$.verified.' || signal) IS NULL THEN true
      ELSE {_truth("'$.verified.' || signal")} END AS kept
  FROM ({_EXTRACTED}) e LEFT JOIN (SELECT company, j FROM ({_parsed(_PASS3)})) v USING (company)
"""
_RESULT_COLUMNS = ("company", *SIGNALS, "hq_region", "total_signals",
                   *[c for c, _ in DETAIL_COLUMNS.values()], "summary", "confidence_score")


def _fold_sql() -> str:
    def det(sig, col="detail"):
        return f"coalesce(max(CASE WHEN kept AND signal = '{sig}' THEN {col} END), '')"
    plain = [s for s in SIGNALS if s not in ("operational_change", "shutdown")]
    flags = ", ".join(f"bool_or(kept AND signal = '{s}') AS {s}" for s in plain)
    details = ", ".join(f"{det(s)} AS {c}" for s, (c, _) in DETAIL_COLUMNS.items()
                        if s != "operational_change")
    return f"""
  SELECT company, {flags}, {details},
    bool_or(kept AND signal IN ('operational_change', 'shutdown')) AS operational_change,
    bool_or(kept AND (signal = 'shutdown' OR (is_shutdown AND signal = 'operational_change')))
      AS shutdown,
    {det('hq_change', 'hq_region')} AS hq_region,
    concat_ws(' | ', nullif({det('operational_change')}, ''), nullif({det('shutdown')}, ''))
      AS ops_detail,
    max(CASE WHEN kept THEN confidence END) AS sure, count(*) AS confirmed
  FROM ({_JUDGED}) GROUP BY company"""


_LABELS = ", ".join(f"'{label}: ' || nullif({c}, '')" for c, label in DETAIL_COLUMNS.values())


def _three_sql(companies: str) -> str:
    flags = ", ".join(f"coalesce({s}, false) AS {s}" for s in SIGNALS)
    details = ", ".join(f"coalesce({c}, '') AS {c}" for c, _ in DETAIL_COLUMNS.values())
    counted = " + ".join(f"CAST({s} AS INTEGER)" for s in SIGNALS if s != "shutdown")
    columns = ", ".join(_RESULT_COLUMNS[:-2])
    return f"""
  SELECT {columns}, CASE WHEN NOT coalesce(detected, false) OR coalesce(best, 1) < 2
      THEN 'No significant corporate changes identified.'
    WHEN confirmed IS NULL THEN 'Signals detected but none confirmed after extraction.'
    WHEN total_signals = 0 THEN 'No significant corporate changes identified after verification.'
    ELSE substr(concat_ws('; ', {_LABELS}), 1, 500) END AS summary,
    coalesce(sure, 0) AS confidence_score
  FROM (SELECT *, {counted} AS total_signals FROM (
    SELECT c.company, {flags}, {details}, coalesce(hq_region, '') AS hq_region, sure, confirmed,
      best, detected
    FROM ({companies}) c LEFT JOIN ({_BEST}) USING (company)
      LEFT JOIN ({_fold_sql()}) USING (company)))"""


# ---- queries ------------------------------------------------------------------------------


def parse_response(spark, sf):
    a = _pass1(_events(spark, sf)).withColumn("obj", parse_answer(F.col("raw")))
    return a.select(F.col("chunk_idx").alias("event_id"), F.col("obj").isNotNull().alias("ok"),
                    int_field(F.col("obj"), "confidence").alias("confidence"))


PARSE_RESPONSE = f"""
  SELECT chunk_idx AS event_id, j IS NOT NULL AS ok, {_int('confidence')} AS confidence
  FROM ({_parsed(_PASS1)})
"""


def score_parse(spark, sf):
    ev = texts(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.get(F.array(*map(F.lit, ('"4"', "4.7", "9", "0", "null", "true", '"x"', "2"))),
                  (F.col("event_id") % 8).cast("int"))
    raw = (F.when(k % 10 == 0, "no idea").when(k % 10 == 1, '{"reason": "only"}')
           .when(k % 10 == 2, '{"score": {"a": 1}, "reason": "nested"}')
           .when(k % 10 == 3, _text("`{\"score\": ", value, "}`"))
           .otherwise(_text("```json {\"score\": ", value, ', "reason": "k', k, '"} ``` thanks')))
    return ev.select("event_id", score_of(raw).alias("s")).select("event_id", "s.*")


SCORE_PARSE = """
  SELECT event_id, CASE WHEN k % 10 IN (0, 1, 2) THEN 3 ELSE least(greatest(
      ([4, 4, 9, 0, 3, 1, 3, 2])[1 + event_id % 8], 1), 5) END AS score,
    CASE WHEN k % 10 = 1 THEN 'only'
         WHEN k % 10 IN (0, 2) OR event_id % 8 IN (4, 6)
           THEN 'parse error — defaulting to pass'
         WHEN k % 10 = 3 THEN '' ELSE 'k' || k END AS reason
  FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""


def single_answers(spark, sf) -> DataFrame:
    per = _events(spark, sf).groupBy("company").agg(
        F.max("k").alias("k"), *[F.bool_or(F.col("signal") == s).alias(s) for s in SIGNALS])
    k = F.col("k")
    body = [p for s in SIGNALS for p in (f', "{s}": ', F.when(k % 2 == 0, F.col(s).cast("string"))
                                         .otherwise(F.when(F.col(s), '"Yes"').otherwise("0")))]
    details = [p for c in (*[c for c, _ in DETAIL_COLUMNS.values()], "shutdown_detail")
               for p in (f', "{c}": "', F.when(k % 3 == 0, "").otherwise(_text(c[:4], k)), '"')]
    raw = F.when(k % 9 == 0, _text("cannot tell ", k)).otherwise(_text(
        '{"confidence": ', k % 6, *body, *details, ', "hq_region": "Canada", "summary": "sum ',
        k, '"}'))
    stale = F.lit('{"confidence": 5, "renaming": true, "summary": "zz stale"}')
    return per.select("company", F.lit("single").alias("pass"),
                      F.lit(0).cast("long").alias("chunk_idx"), F.lit("").alias("signal"),
                      F.inline(F.array(F.struct(F.lit(2).alias("answered_at"), raw.alias("raw")),
                                       F.struct(F.lit(1).alias("answered_at"),
                                                stale.alias("raw")))))


def _single_sql() -> str:
    flags = ", ".join(f"ok AND {s} AS {s}" for s in SIGNALS)
    flagged = ", ".join(f"bool_or(signal = '{s}') AS {s}" for s in SIGNALS)
    counted = " + ".join(f"CAST(ok AND {s} AS INTEGER)" for s in SIGNALS if s != "shutdown")
    details = ", ".join(
        f"CASE WHEN ok AND k % 3 <> 0 THEN '{c[:4]}' || k "
        + (f"|| ' | shut' || k " if c == "ops_detail" else "") + f"ELSE '' END AS {c}"
        for c, _ in DETAIL_COLUMNS.values())
    return f"""
  SELECT company, {flags}, {details}, CASE WHEN ok THEN 'Canada' ELSE '' END AS hq_region,
    {counted} AS total_signals,
    CASE WHEN k % 9 = 0 THEN '[parse error] cannot tell ' || k
      WHEN NOT ok THEN '[low confidence ' || (k % 6) || '/5] sum ' || k ELSE 'sum ' || k END
      AS summary, CASE WHEN ok THEN k % 6 ELSE 0 END AS confidence_score
  FROM (SELECT *, k % 9 <> 0 AND k % 6 >= 2 AS ok FROM (
    SELECT company, max(k) AS k, {flagged} FROM ({_EVENTS}) GROUP BY company))"""


def _sources_text(df):
    return df.withColumn("sources", F.array_join("sources", " "))


_DISPATCH = f"""
  SELECT c.company, {", ".join(f"coalesce({c}, {'false' if c in SIGNALS else 0 if c in ('total_signals', 'confidence_score') else repr('')}) AS {c}"
                               for c in _RESULT_COLUMNS if c not in ("company", "summary"))},
    CASE WHEN length(trim(context)) < 80 THEN 'Insufficient context to classify.'
         ELSE summary END AS summary, sources
  FROM ({_CONTEXT}) c LEFT JOIN ({_three_sql(f"SELECT company FROM ({_CONTEXT}) WHERE length(trim(context)) >= 80")}) r
    USING (company)
"""


def signal_recount(spark, sf):
    """Totals thrown away and counted again."""
    return recount(results(spark, sf).withColumn("total_signals", F.lit(-1))).select(
        "company", "run_id", "total_signals")


def summaries(spark, sf):
    return results(spark, sf).select("company", "run_id", compose_summary().alias("summary"))


SUMMARIES = f"""
  SELECT company, run_id, substr(concat_ws('; ', {_LABELS}), 1, 500) AS summary
  FROM ({RESULTS_SQL})
"""


def ops_merge(spark, sf):
    return results(spark, sf).select("company", "run_id", merge_ops(
        F.col("ops_detail"), F.col("bankruptcy_detail")).alias("merged"))


def sources_json(spark, sf):
    """Encoded, some damaged, decoded again."""
    r = results(spark, sf)
    text = encode_list(F.col("sources"))
    damaged = (F.when(F.col("confidence_score") == 5, F.substring(text, 1, 9))
               .when(F.col("confidence_score") == 4, '"text"').otherwise(text))
    return r.select("company", "run_id", text.alias("encoded"),
                    F.array_join(decode_list(damaged), "; ").alias("joined"))


SOURCES_JSON = f"""
  SELECT company, run_id, '["' || array_to_string(sources, '","') || '"]' AS encoded,
    CASE WHEN confidence_score IN (4, 5) THEN '' ELSE array_to_string(sources, '; ') END AS joined
  FROM ({RESULTS_SQL})
"""

_ECHO_SCHEMA = T.StructType([T.StructField("k", T.IntegerType()),
                             T.StructField("note", T.StringType())])


def error_capture(spark, sf):
    """A failing step per row: one in ten rows raises and comes back as an error row."""
    def reader():
        import json

        def read(row: dict) -> dict:
            k = json.loads(row["props"])["k"]
            if k % 10 == 0:
                raise ValueError(f"cannot serve {k} " + "x" * 600)
            return {"k": k, "note": f"{row['event_type']} {k}"}
        return read

    ev = table(spark, sf, "events").select("event_id", "event_type", "props")
    return score_batch(ev, reader, _ECHO_SCHEMA, key="event_id")


ERROR_CAPTURE = """
  SELECT event_id, CASE WHEN k % 10 = 0 THEN 0 ELSE k END AS k,
    CASE WHEN k % 10 = 0 THEN '' ELSE event_type || ' ' || k END AS note,
    CASE WHEN k % 10 = 0 THEN substr('cannot serve ' || k || ' ' || repeat('x', 600), 1, 500) END
      AS error
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""

QUERIES = {
    "parse_response": (parse_response, PARSE_RESPONSE),
    "score_parse": (score_parse, SCORE_PARSE),
    "confidence_filter": (
        lambda spark, sf: confident(answers(spark, sf), 2),
        f"SELECT company, signal, confidence FROM ({_SURE})"),
    "detected_union": (
        lambda spark, sf: detections(answers(spark, sf)).join(
            best_confidence(answers(spark, sf)).select("company", "best"), "company"),
        f"SELECT company, signal, best FROM ({_DETECTED}) JOIN ({_BEST}) USING (company)"),
    "verify_merge": (
        lambda spark, sf: (lambda a: verify(extractions(a, detections(a).join(
            best_confidence(a).filter("best >= 2"), "company", "left_semi")), a))(
            answers(spark, sf)),
        f"SELECT * EXCLUDE (kept) FROM ({_JUDGED}) WHERE kept"),
    "single_pass": (
        lambda spark, sf: single_pass(contexts(spark, sf), single_answers(spark, sf)),
        _single_sql()),
    "three_pass": (
        lambda spark, sf: three_pass(contexts(spark, sf), answers(spark, sf)),
        _three_sql(f"SELECT DISTINCT company FROM ({_EVENTS})")),
    "classify_dispatch": (
        lambda spark, sf: _sources_text(classify(contexts(spark, sf), answers(spark, sf))),
        _DISPATCH),
    "signal_recount": (signal_recount,
                       f"SELECT company, run_id, total_signals FROM ({RESULTS_SQL})"),
    "compose_summary": (summaries, SUMMARIES),
    "ops_merge": (ops_merge, f"""
        SELECT company, run_id, concat_ws(' | ', nullif(ops_detail, ''),
          nullif(bankruptcy_detail, '')) AS merged FROM ({RESULTS_SQL})"""),
    "sources_json": (sources_json, SOURCES_JSON),
    "error_capture": (error_capture, ERROR_CAPTURE),
}
