"""Spelling variants of a corpus: reduced-alphabet generation.

Letters are hashed to a few symbols, and so are words. Words at one edit from each other (a code
point inserted, deleted or replaced) have reduced words at one edit or none, so each reduced word's
full one-edit neighbourhood over the few symbols holds the reduced words of all its words' variants.
The neighbourhoods are joined with the reduced vocabulary, by 64-bit hashes that follow from the
word's prefix and suffix hashes, so a long word costs no more than its length times the symbols. The
pairs of reduced words that exist lead to pairs of words, which are verified on the original strings
inside the join: a pair that fails leaves no row. The number of symbols grows with the seventh root
of the vocabulary, so that a neighbourhood meets a few reduced words at any size.

A word's form is its near word with the most occurrences (ties: the smallest in code-point order) if
that has at least `ratio` times its own; its root is found by following forms, by pointer doubling:
counts grow along them, so there are no circles and few rounds.

Occurrences are counted per task before they are shuffled. Null and empty texts have no words; a
null doc_id counts as the empty text where a word is hashed with it. Rows that repeat are documents
of their own. Very long texts are taken whole, very long words too. An empty table gives no rows.
Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, Scratch, byte_portions

_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_FOLD = str.maketrans(UPPER, LOWER)
_BASE, _GOLD = np.uint64(0x9DDFEA08EB382D69), np.uint64(0x9E3779B97F4A7C15)


def changed(run: str, start: int, every: int) -> str:
    """A lower-cased run, less one code point where `every` divides its hash; `start` is the crc32
    of what the document puts before it."""
    h = zlib.crc32(run.encode(), start)
    at = h % len(run)
    return run[:at] + run[at + 1:] if h % every == 0 else run


def occurrences(docs: DataFrame, least_chars: int, every: int, held: int = 200_000) -> DataFrame:
    """(word, n) of the words of all texts, summed over up to about `held` distinct words of a task."""

    def rows(words: Counter) -> pa.RecordBatch:
        kept = {w: n for w, n in words.items() if len(w) >= least_chars}
        return pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.string()),
                                           pa.array(kept.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for begin, texts in byte_portions(batch.column(1)):
                for doc, text in zip(ids[begin:begin + len(texts)], texts):
                    found: Counter = Counter()
                    for raw, n in Counter(_RUNS.findall((text or b"").decode())).items():
                        found[raw.translate(_FOLD)] += n
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word, n in found.items():
                        words[changed(word, start, every)] += n
                if len(words) > held:
                    yield rows(words)
                    words = Counter()
        yield rows(words)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")


# ---- reduced words ------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def reduced(words: list[str], symbols: int) -> list[np.ndarray]:
    """The symbols, from 1, of every word's letters."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "u4").astype("u8")
    with np.errstate(over="ignore"):
        flat = _mix(flat * _GOLD) % np.uint64(symbols) + np.uint64(1)
    return np.split(flat, np.cumsum([len(w) for w in words])[:-1]) if words else []


def neighbourhood(table: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of every row's word of `table` (n words of one length), itself first, and of all words
    at one edit from it over the symbols. The hash of a word is that of its two parts and what
    stands between them."""
    n, size = table.shape
    one = np.uint64(1)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([[one], np.full(size + 1, _BASE)]), dtype="u8")
        before = np.zeros((n, size + 1), "u8")
        behind = np.zeros((n, size + 1), "u8")
        for i in range(size):
            before[:, i + 1] = before[:, i] * _BASE + table[:, i]
            back = size - 1 - i
            behind[:, back] = table[:, back] * power[i] + behind[:, back + 1]

        def final(value: np.ndarray, length: int) -> np.ndarray:
            return _mix(value * _GOLD + np.uint64(length))

        at, after = np.arange(size), size - 1 - np.arange(size)
        out = [final(before[:, size:], size)]
        if size > 1:
            out.append(final(before[:, at] * power[after] + behind[:, at + 1], size - 1))
        gaps, rest = np.arange(size + 1), size - np.arange(size + 1)
        for symbol in range(1, symbols + 1):
            c = np.uint64(symbol)
            out.append(final(before[:, at] * power[after + 1] + c * power[after]
                             + behind[:, at + 1], size))
            out.append(final(before[:, gaps] * power[rest + 1] + c * power[rest]
                             + behind[:, gaps], size + 1))
    return np.concatenate(out, axis=1).view("i8")


def _by_length(words: list[str], symbols: int, most: int = 2_000_000):
    """(places, table) of words of one length, few enough for `most` neighbours at once."""
    codes = reduced(words, symbols)
    lengths = np.array([len(w) for w in words])
    for size in np.unique(lengths):
        places = np.flatnonzero(lengths == size)
        step = max(1, most // int(2 * symbols * (size + 1)))
        for i in range(0, len(places), step):
            some = places[i:i + step]
            yield some, np.stack([codes[k] for k in some])


def with_reduced(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, r): words with the hash of their reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.zeros(batch.num_rows, "i8")
            for places, table in _by_length(batch.column(0).to_pylist(), symbols):
                key[places] = neighbourhood(table, 0)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=["word", "n", "r"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, r long")


def neighbours(words: DataFrame, symbols: int) -> DataFrame:
    """(r, m): the reduced word of each word, and each hash of its neighbourhood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, table in _by_length(batch.column(0).to_pylist(), symbols):
                near = neighbourhood(table, symbols)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(near[:, 0], near.shape[1])), pa.array(near.reshape(-1))],
                    names=["r", "m"])

    return words.select("word").mapInArrow(run, "r long, m long")


def near_words(words: DataFrame, scratch: Scratch, symbols: int) -> DataFrame:
    """(word, n, near, near_n) of all ordered pairs of (word, n) at exactly one edit."""
    keyed = scratch.put(with_reduced(words, symbols), "keyed")
    distinct = keyed.groupBy("r").agg(F.min("word").alias("word"))
    links = scratch.put(neighbours(distinct, symbols).join(distinct.select(F.col("r").alias("m")), "m")
                        .select("r", "m").distinct(), "links")
    other = keyed.select(F.col("r").alias("m"), F.col("word").alias("near"),
                         F.col("n").alias("near_n"))
    return (links.join(keyed, "r").join(other, (links["m"] == other["m"])
                                        & (F.levenshtein("word", "near", 1) == 1))
            .select("word", "n", "near", "near_n"))


def roots(forms: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(word, root) from (word, form): each round doubles the steps that a root is away."""
    now = scratch.put(forms.select("word", F.col("form").alias("root")), "roots-0")
    for k in range(1, max_rounds + 1):
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = scratch.put(now.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), f"roots-{k}")
        scratch.drop(f"roots-{k - 1}")
        moved, now = now.where("moved"), now.drop("moved")
        if moved.isEmpty():
            return now
    raise RuntimeError(f"roots did not settle in {max_rounds} rounds")


def spelling_forms(docs: DataFrame, least_chars: int = 6, least_n: int = 5, ratio: int = 5,
                   every: int = 199, symbols: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the corpus."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.put(occurrences(docs, least_chars, every).groupBy("word")
                        .agg(F.sum("n").alias("n")).where(F.col("n") >= least_n), "words")
    if symbols is None:
        symbols = max(4, int(np.ceil(words.count() ** (1 / 7))))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("best")
    near = (near_words(words, scratch, symbols).groupBy("word")
            .agg(F.count("*").alias("n_near"), best)
            .select("word", "n_near", "best.form", (-F.col("best.minus")).alias("form_n")))
    large = F.col("form_n") >= ratio * F.col("n")
    table = scratch.put(words.join(near, "word", "left").select(
        "word", F.when(large, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("form_n")).alias("form_n")), "forms")
    ends = scratch.put(roots(table.where("form is not null"), scratch), "ends")
    scratch.keep("forms", "ends")
    return table.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: crc32 by its table: of byte values, eight steps each; then byte by byte.
SPELLING_SQL = r"""
WITH RECURSIVE t AS (
  SELECT list(v ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k:
      CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT unnest(range(256)) AS b))),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc,
      translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
counted AS (SELECT doc, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(octet_length(encode(doc || ':' || run))),
      lambda i: ('0x' || substr(hex(encode(doc || ':' || run)), (2 * i + 1)::INT, 2))::BIGINT)),
      lambda c, b: xor(c // 256, t.crc[1 + xor(c % 256, b)])), 4294967295) AS h
  FROM counted, t),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT)
        || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, n, i, substr(word, 1, i::INT) AS head, substr(word, i::INT + 2) AS tail
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a
  JOIN cut b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.head || a.tail = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.head || a.tail = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
  FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
      CASE WHEN near_n >= 5 * w.n THEN near END AS form,
      CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
paths AS (
  SELECT word, form AS root FROM forms WHERE form IS NOT NULL
  UNION ALL
  SELECT p.word, f.form FROM paths p JOIN forms f ON p.root = f.word WHERE f.form IS NOT NULL),
ends AS (
  SELECT p.word, p.root FROM paths p JOIN forms f ON p.root = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM forms f LEFT JOIN ends e ON f.word = e.word
"""
