"""License scans by diagonal voting, in DataFrame functions only.

Every pair of neighbouring words of a text (k-grams, k = 2 unless told otherwise) joins the places
of equal pairs in the templates. A hit votes for its diagonal, the place in the text less the place
in the template. Votes are summed by text, template and diagonal; a diagonal is merged with the few
after it, which words put in or left out set apart; and the merged span is verified: enough different
places of the template must be hit within it. So no phrase counts twice for being said twice, and the
span is no longer than the template and the slack.

Base phrases are templates too; their places are the diagonals with every vote. All templates
together are a bounded parameter, so they are broadcast, and texts are not shuffled: only hits are.
Null and empty texts have no words. Rows are judged one by one, so repeated ids do no harm; an empty
table gives no rows. Equal spans give their label once; very long texts are read whole. Columns of other
names are not read, so they cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# The phrases of the contract and their labels.
BASE = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"),
        ("mit", "mit license"))

# Templates of the method's own labels, lines and opening passages of public licenses.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain "
                   "a copy of the license at"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of "
                 "this software and associated documentation files the software to deal in the "
                 "software without restriction"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification "
                 "are permitted provided that the following conditions are met"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-text", "this program is free software you can redistribute it and or modify it under the "
                 "terms of the gnu general public license as published by"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-text", "this work is licensed under a creative commons attribution"),
    ("mit-line", "released under the mit license"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
)


def license_words(text: Column) -> Column:
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def _grams(words: Column, k: int) -> Column:
    """The hash of each run of `k` words; no run of fewer."""
    n = F.greatest(F.size(words) - (k - 1), F.lit(0))
    if k == 2:
        return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n),
                          lambda a, b: F.xxhash64(a, b))
    return F.transform(F.slice(words, 1, n), lambda w, i: F.xxhash64(F.slice(words, i + 1, k)))


def template_grams(spark, templates, base, k: int) -> DataFrame:
    """(t, label, is_base, n_grams, t_pos, gram, t_words) of every template place."""
    rows = [(i, label, phrase, i < len(base)) for i, (label, phrase) in
            enumerate([*base, *templates])]
    table = spark.createDataFrame(rows, "t int, label string, phrase string, is_base boolean")
    table = table.withColumn("words", license_words(F.col("phrase")))
    return (table.where(F.size("words") >= k)
            .select("t", "label", "is_base", (F.size("words") - (k - 1)).alias("n_grams"), "words",
                    F.posexplode(_grams(F.col("words"), k)).alias("t_pos", "gram"))
            .withColumn("t_words", F.slice("words", F.col("t_pos") + 1, F.lit(k))).drop("words"))


def license_spans(docs: DataFrame, templates=TEMPLATES, base=BASE, k: int = 2,
                  least_votes: float = 0.7, slack: int = 3) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): texts has row, doc_id and n_words of every document; spans has row, label,
    is_base, first and last word, and the score of every verified place."""
    scratch = Scratch(docs.sparkSession, "licenses")
    grams = F.broadcast(template_grams(docs.sparkSession, templates, base, k))
    texts = docs.select("doc_id", license_words(F.col("text")).alias("words"))
    texts = texts.withColumn("grams", F.concat(F.array(F.lit(None).cast("long")),
                                               _grams(F.col("words"), k)))
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    placed = texts.select("row", "doc_id", "words", F.posexplode("grams").alias("pos", "gram"))
    same = ((placed["gram"] == grams["gram"])
            & (F.slice(placed["words"], F.greatest(placed["pos"], F.lit(1)), F.lit(k))
               == grams["t_words"]))
    hits = (placed.join(grams, same, "left").where(F.col("t").isNotNull() | (F.col("pos") == 0))
            .select("row", "doc_id", F.when(F.col("pos") == 0, F.size("words")).alias("n_words"),
                    "t", "label", "is_base", "n_grams", "t_pos",
                    (F.col("pos") - 1 - F.col("t_pos")).alias("diagonal")))
    hits = scratch.put(hits, "hits")
    votes = (hits.where("t is not null").groupBy("row", "t", "diagonal")
             .agg(F.count("*").alias("votes"), F.min("t_pos").alias("low"),
                  F.max("t_pos").alias("high"), F.first("label").alias("label"),
                  F.first("is_base").alias("is_base"), F.first("n_grams").alias("n_grams")))
    votes = scratch.put(votes, "votes")
    exact = votes.where("is_base and votes = n_grams").select(
        "row", "label", "is_base", F.col("diagonal").alias("first"),
        (F.col("diagonal") + F.col("n_grams") + (k - 2)).alias("last"),
        F.lit(1.0).alias("score"))
    # A span is a diagonal and the `slack` after it. Only where their votes could do is it looked into.
    reach = (Window.partitionBy("row", "t").orderBy("diagonal")
             .rangeBetween(Window.currentRow, slack))
    starts = (votes.where("not is_base").withColumn("all", F.sum("votes").over(reach))
              .where(F.col("all") >= least_votes * F.col("n_grams"))
              .select("row", "t", F.col("diagonal").alias("start"), "label", "n_grams",
                      F.explode(F.sequence(F.col("diagonal"), F.col("diagonal") + slack))
                      .alias("diagonal")))
    places = (starts.join(hits.select("row", "t", "t_pos", "diagonal"), ["row", "t", "diagonal"])
              .groupBy("row", "t", "start", "t_pos")
              .agg(F.first("label").alias("label"), F.first("n_grams").alias("n_grams"),
                   F.min(F.col("diagonal") + F.col("t_pos")).alias("first"),
                   F.max(F.col("diagonal") + F.col("t_pos") + (k - 1)).alias("last")))
    # A place of the template counts once, however often its words stand in the span.
    spans = (places.groupBy("row", "t", "start")
             .agg(F.count("*").alias("held"), F.first("label").alias("label"),
                  F.first("n_grams").alias("n_grams"), F.min("first").alias("first"),
                  F.max("last").alias("last"))
             .withColumn("score", F.col("held") / F.col("n_grams"))
             .where(F.col("score") >= least_votes)
             .select("row", "label", F.lit(False).alias("is_base"), "first", "last", "score"))
    return (hits.where("n_words is not null").select("row", "doc_id", "n_words"),
            exact.unionByName(spans))


def _labels(condition: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")


def license_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every text."""
    texts, spans = license_spans(docs.select("doc_id", "text"))
    per_text = spans.groupBy(F.col("row").alias("__row")).agg(
        F.sum(F.col("is_base").cast("long")).alias("n_base"),
        F.min(F.when(F.col("is_base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("is_base"), F.col("first"))).cast("long").alias("last_word"),
        _labels(F.col("is_base")).alias("base_labels"), _labels(F.lit(True)).alias("labels"),
        F.max("score").alias("score"))
    joined = texts.join(per_text, F.col("row") == F.col("__row"), "left")
    return joined.select(
        "doc_id", F.col("n_words").cast("long"), F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def license_sql(k: int = 2, least_votes: float = 0.7, slack: int = 3) -> str:
    """The contract and the rule of a label for DuckDB, on word pairs instead of their hashes."""
    values = ", ".join(f"({i}, '{label}', '{phrase}', {i < len(BASE)})"
                       for i, (label, phrase) in enumerate([*BASE, *TEMPLATES]))
    assert k == 2
    return f"""
WITH tw AS (SELECT t, label, is_base, string_split(phrase, ' ') AS w
            FROM (VALUES {values}) v(t, label, phrase, is_base)),
tg AS (SELECT t, label, is_base, len(w) - 1 AS n_grams, p AS t_pos, w[p + 1] AS a, w[p + 2] AS b
       FROM (SELECT *, unnest(range(len(w) - 1)) AS p FROM tw)),
dw AS (SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
dg AS (SELECT doc_id, p, w[p + 1] AS a, w[p + 2] AS b
       FROM (SELECT doc_id, w, unnest(range(len(w) - 1)) AS p FROM dw WHERE len(w) > 1)),
hits AS (SELECT doc_id, t, label, is_base, n_grams, p - t_pos AS diagonal, t_pos
         FROM dg JOIN tg USING (a, b)),
starts AS (SELECT DISTINCT doc_id, t, diagonal AS start FROM hits),
spans AS (
  SELECT doc_id, any_value(label) AS label, any_value(is_base) AS is_base, start,
      count(DISTINCT t_pos)::DOUBLE / any_value(n_grams) AS score
  FROM starts JOIN hits USING (doc_id, t)
  WHERE diagonal BETWEEN start AND start + CASE WHEN is_base THEN 0 ELSE {slack} END
  GROUP BY doc_id, t, start
  HAVING count(DISTINCT t_pos) >= any_value(CASE WHEN is_base THEN 1 ELSE {least_votes} END * n_grams)),
per_text AS (
  SELECT doc_id, count(*) FILTER (is_base) AS n_base, min(start) FILTER (is_base) AS first_word,
      max(start) FILTER (is_base) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
      string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0.0)::DOUBLE AS score
FROM dw d LEFT JOIN per_text USING (doc_id)
"""
