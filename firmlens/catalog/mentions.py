"""Queries over documents and phrases: mentions, the keyword gate and its decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.mentions import (any_word, mentions_substring, mentions_words, name_keys,
                                  news_matches)
from ..operators.screening import (decide, enough_content, keyword_near_name, keyword_pattern,
                                   screen_log, screen_stages, screen_usage)
from .inputs import LEXICON, PHRASE_KEYS_SQL, phrases, texts

PATTERN = keyword_pattern(LEXICON, ascii_words=True)
_WORDS = "|".join(LEXICON)
# The same pattern for the oracle; its dialect numbers groups alike.
_KW = rf"(?:^|[^a-z0-9_])((?:{_WORDS})[a-z0-9_]*)"


def entity_mentions(spark, sf):
    docs = texts(spark, sf).select("doc_id", "text")
    return mentions_substring(docs, "doc_id", F.col("text"), phrases(spark, sf))


ENTITY_MENTIONS = f"""
  SELECT doc_id, company FROM documents JOIN ({PHRASE_KEYS_SQL}) ON contains(lower(text), key)
  WHERE key <> ''
"""


def entity_mentions_blocked(spark, sf):
    docs = texts(spark, sf).select("doc_id", "text")
    return mentions_words(docs, "doc_id", F.col("text"), phrases(spark, sf))


_WORDS_OF_TEXT = r"trim(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_]+', ' ', 'g'))"
ENTITY_MENTIONS_BLOCKED = f"""
  SELECT doc_id, company FROM (SELECT doc_id, ' ' || {_WORDS_OF_TEXT} || ' ' AS words
                               FROM documents)
  JOIN ({PHRASE_KEYS_SQL}) ON contains(words, ' ' || key || ' ') WHERE key <> ''
"""


def news_predicate(spark, sf):
    """Phrase, any word, a date window and a fixed section (the language)."""
    docs = texts(spark, sf).select(
        "doc_id", "text", "lang",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
        .alias("published"))
    return news_matches(
        docs, "doc_id", F.col("text"), phrases(spark, sf), any_word(("the", "of", "reserved")),
        F.col("published"), F.lit("2024-02-01").cast("date"), F.lit("2024-11-30").cast("date"),
        {"lang": "en"})


NEWS_PREDICATE = f"""
  SELECT doc_id, company FROM documents JOIN ({PHRASE_KEYS_SQL}) ON contains(lower(text), key)
  WHERE key <> '' AND lang = 'en' AND regexp_matches(lower(text), 'the|of|reserved')
    AND DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER)
        BETWEEN DATE '2024-02-01' AND DATE '2024-11-30'
"""


def gate_rows(spark, sf):
    """Each document with one phrase as its company: common short words, so that both the
    sentence rule and the distance rule have work."""
    words = F.array(*map(F.lit, ("the", "and", "licensed", "of the", "La", "de la", "of Holdings",
                                 "group")))
    return texts(spark, sf).select(
        "doc_id", F.get(words, (F.col("doc_id") % 8).cast("int")).alias("company"), "text")


def keyword_gate(spark, sf):
    return gate_rows(spark, sf).select(
        "doc_id", "company",
        keyword_near_name(F.col("company"), F.col("text"), PATTERN).alias("keyword"))


_GATE_NAMES = "['the', 'and', 'licensed', 'of the', 'la', 'de la', 'of', '']"
_GATE_RAW = "['the', 'and', 'licensed', 'of the', 'La', 'de la', 'of Holdings', 'group']"
# Mentions of the name split the text; their offsets follow from the pieces' lengths.
KEYWORD_GATE = rf"""
  WITH d AS (
    SELECT doc_id, ({_GATE_RAW})[1 + doc_id % 8] AS company,
      ({_GATE_NAMES})[1 + doc_id % 8] AS name, lower(text) AS body FROM documents),
  live AS (SELECT * FROM d WHERE name <> '' AND contains(body, name)
             AND regexp_matches(body, '{_KW}')),
  sent AS (
    SELECT doc_id, list_filter(list_transform(list_filter(regexp_split_to_array(body, '[.\n!?]'),
      lambda s: contains(s, name)), lambda s: regexp_extract(s, '{_KW}', 1)),
      lambda k: k <> '')[1] AS kw FROM live),
  piece AS (
    SELECT doc_id, name, body, i,
      sum(length(p) + length(name)) OVER (PARTITION BY doc_id ORDER BY i) AS past
    FROM (SELECT doc_id, name, body, unnest(string_split(body, name)) AS p,
            generate_subscripts(string_split(body, name), 1) AS i FROM live)),
  win AS (
    SELECT doc_id, i, regexp_extract(substr(body, greatest(start - 300, 1),
        start + length(name) + 300 - greatest(start - 300, 1)), '{_KW}', 1) AS kw
    FROM (SELECT *, CAST(past - length(name) + 1 AS BIGINT) AS start FROM piece)
    WHERE start <= length(body) - length(name) + 1),
  near AS (SELECT doc_id, arg_min(kw, i) AS kw FROM win WHERE kw <> '' GROUP BY doc_id)
  SELECT d.doc_id, d.company, coalesce(sent.kw, near.kw) AS keyword
  FROM d LEFT JOIN sent USING (doc_id) LEFT JOIN near USING (doc_id)
"""


def content_gate(spark, sf):
    docs = texts(spark, sf)
    return docs.select("doc_id", *[enough_content(F.col("text"), n).alias(f"has_{n}")
                                   for n in (50, 80, 400)])


CONTENT_GATE = r"""
  SELECT doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 50 AS has_50,
    length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 80 AS has_80,
    length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 400 AS has_400 FROM documents
"""


def decisions(spark, sf):
    """Documents as headline texts of companies named 'the', answered by their id."""
    docs = texts(spark, sf)
    name = F.concat(F.lit("the"), F.when(F.col("doc_id") % 4 == 0, " zzz").otherwise(""))
    rows = docs.select("doc_id", name.alias("shown"), "text")
    score = (F.col("doc_id") % 7).cast("string")
    answers = docs.filter(F.col("doc_id") % 10 != 9).select(
        F.col("doc_id").alias("company"),
        F.when(F.col("doc_id") % 6 == 0, "not json").otherwise(F.concat(
            F.lit('```json\n{"score": '), score, F.lit(', "reason": "r'), score, F.lit('"}\n```')))
        .alias("raw"))
    # The decision is keyed by document here, while the gate needs the shown name.
    keyed = rows.select(F.col("doc_id").alias("company"), "shown",
                        F.col("text").alias("headline_text"))
    return decide(keyed, answers, pattern=PATTERN, name="shown")


_DECISIONS = rf"""
  SELECT doc_id AS company,
    CASE WHEN NOT content THEN FALSE WHEN kw IS NULL THEN FALSE ELSE score >= 3 END AS passed,
    CASE WHEN NOT content THEN 'no_content' WHEN kw IS NULL THEN '1B_keyword'
         WHEN score >= 3 THEN 'passed' ELSE '1C_llm' END AS stage,
    CASE WHEN NOT content OR kw IS NULL THEN 0 ELSE score END AS score,
    CASE WHEN NOT content THEN 'No headlines returned from free sources'
         WHEN kw IS NULL THEN 'No signal keywords near company name'
         WHEN doc_id % 10 = 9 THEN 'no answer — defaulting to pass'
         WHEN doc_id % 6 = 0 THEN 'parse error — defaulting to pass'
         ELSE 'r' || (doc_id % 7) END AS reason
  FROM (
    SELECT doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 50 AS content,
      CASE WHEN doc_id % 10 = 9 OR doc_id % 6 = 0 THEN 3
           ELSE CAST(greatest(1, least(5, doc_id % 7)) AS INTEGER) END AS score,
      CASE WHEN doc_id % 4 = 0 THEN g4.kw ELSE g.kw END AS kw
    FROM documents
    LEFT JOIN (<the>) g USING (doc_id) LEFT JOIN (<the zzz>) g4 USING (doc_id))
"""


def _near_sql(name: str) -> str:
    """Keyword near one fixed name, per document that has one."""
    n = len(name)
    return rf"""
      SELECT doc_id, coalesce(max(sent), arg_min(near, i) FILTER (near <> '')) AS kw FROM (
        SELECT doc_id, i, sent, regexp_extract(substr(body, greatest(pos - 300, 1),
          pos + {n} + 300 - greatest(pos - 300, 1)), '{_KW}', 1) AS near
        FROM (
          SELECT doc_id, body, sent, i, length(body) AS total,
            CAST(sum(length(p) + {n}) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) - {n - 1}
              AS pos
          FROM (
            SELECT doc_id, body, unnest(string_split(body, '{name}')) AS p,
              generate_subscripts(string_split(body, '{name}'), 1) AS i,
              list_filter(list_transform(list_filter(regexp_split_to_array(body, '[.\n!?]'),
                lambda s: contains(s, '{name}')), lambda s: regexp_extract(s, '{_KW}', 1)),
                lambda k: k <> '')[1] AS sent
            FROM (SELECT doc_id, lower(text) AS body FROM documents)
            WHERE contains(body, '{name}') AND regexp_matches(body, '{_KW}')))
        WHERE pos <= total - {n - 1})
      GROUP BY doc_id"""


DECISIONS = (_DECISIONS.replace("<the>", _near_sql("the"))
             .replace("<the zzz>", _near_sql("the zzz")))

QUERIES = {
    "entity_mentions": (entity_mentions, ENTITY_MENTIONS),
    "entity_mentions_blocked": (entity_mentions_blocked, ENTITY_MENTIONS_BLOCKED),
    "news_predicate": (news_predicate, NEWS_PREDICATE),
    "keyword_gate": (keyword_gate, KEYWORD_GATE),
    "content_gate": (content_gate, CONTENT_GATE),
    "prescreen_decision": (
        lambda spark, sf: decisions(spark, sf).groupBy("stage", "score", "passed").agg(
            F.count(F.lit(1)).alias("n"), F.min("company").alias("first"),
            F.sum("company").alias("ids")),
        f"SELECT stage, score, passed, count(*) AS n, min(company) AS first, "
        f"CAST(sum(company) AS BIGINT) AS ids FROM ({DECISIONS}) GROUP BY ALL"),
    "prescreen_log": (lambda spark, sf: screen_log(decisions(spark, sf)), DECISIONS),
    "prescreen_usage": (
        lambda spark, sf: screen_usage(decisions(spark, sf)),
        f"SELECT count(*) AS screened, count_if(passed) AS triggered, "
        f"count_if(passed) * 5 AS deep_calls FROM ({DECISIONS})"),
    "prescreen_stages": (
        lambda spark, sf: screen_stages(decisions(spark, sf)),
        f"SELECT stage, count(*) AS companies FROM ({DECISIONS}) GROUP BY stage"),
    "searchable_names": (
        lambda spark, sf: name_keys(phrases(spark, sf)),
        f"SELECT company, key FROM ({PHRASE_KEYS_SQL}) WHERE key <> ''"),
}
