"""Substring dedup over sliding spans of sentences.

A text is cut after sentence ends and line ends. A span is a run of at least two sentences (a very
long sentence may stand alone): from each sentence the shortest run of at least `min_words` words,
and, for a sentence that no such run ends with, the shortest run back from it. So any passage of so many words that two texts share is covered
by spans that lie within it, whatever stands around it. Spans are hashed, words lower-cased and
blanks made equal, and joined over the corpus; every span that is not in its first place costs the
sentences it covers. The first place of a span is its first in the first row that has it; rows stand in
the order of their doc_ids, null last, and those of one doc_id in the order of the table.

Null and empty texts have no sentence and stay empty. Very long texts are read whole. Ties need no rule,
as no two rows stand in one place. An empty table gives no rows; columns named as the results are replaced.
What is kept is kept byte for byte. The documents are read twice and rows are told apart by their place in
the table; a plan that shuffles has no such place, so its rows are stored first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType)

from .common import Scratch, bounded_batches, numbered, replace_columns

_END = re.compile(r"(?<=[.!?])\s+|\n\s*")
#: A sentence of so many words is a span by itself; not below any `min_words`.
LONE_WORDS = 25
#: Stands for a null doc_id in keys, after all ids.
_LAST = 2 ** 63 - 1


def sentences(text: str | None) -> list[str]:
    """The sentences with the blanks after them; joined, they are the text."""
    text = text or ""
    cuts = [0, *[m.end() for m in _END.finditer(text)]]
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def spans(parts: list[str], min_words: int) -> list[tuple[int, int, int]]:
    """(first sentence, last sentence, 128-bit hash) of every span. Sentences without a word are
    not counted, but go with the span that they lie in."""
    place, keys, upto = [], [], [0]
    for k, part in enumerate(parts):
        words = part.lower().split()
        if words:
            place.append(k)
            keys.append(" ".join(words))
            upto.append(upto[-1] + len(words))
    n, runs, end = len(keys), [], 1
    ends = set()
    for start in range(n):
        lone = upto[start + 1] - upto[start] >= LONE_WORDS
        end = max(end, start + (1 if lone else 2))
        while end <= n and upto[end] - upto[start] < min_words:
            end += 1
        if end > n:
            break
        runs.append((start, end))
        ends.add(end)
    start = 0
    for end in range(2, n + 1):
        while start + 2 < end and upto[end] - upto[start + 1] >= min_words:
            start += 1
        if end not in ends and upto[end] - upto[start] >= min_words:
            runs.append((start, end))
    return [(place[a], place[b - 1], xxhash.xxh3_128_intdigest("\n".join(keys[a:b])))
            for a, b in runs]


def _halves(h: int) -> tuple[int, int]:
    return ((h >> 64) - (1 << 63), (h & (2 ** 64 - 1)) - (1 << 63))


def span_hashes(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, row, h1, h2) of each distinct span of each row (doc_id, __row, text)."""
    schema = StructType([StructField(x, LongType()) for x in ("doc_id", "row", "h1", "h2")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, first, second = [], [], [], []

            def made():
                return pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (ids, rows, first, second)], names=schema.names)

            for doc, row, text in zip(*(c.to_pylist() for c in batch.columns)):
                for h in {h for _, _, h in spans(sentences(text), min_words)}:
                    h1, h2 = _halves(h)
                    ids.append(doc)
                    rows.append(row)
                    first.append(h1)
                    second.append(h2)
                if len(ids) > 200_000:
                    yield made()
                    ids, rows, first, second = [], [], [], []
            yield made()

    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    return docs.select(key.alias("doc_id"), "__row", "text").mapInArrow(run, schema)


def dedup_spans(docs: DataFrame, min_words: int = 20, salts: int = 8) -> DataFrame:
    """`docs` with text less its repeated sentences, n_sentences (before), n_removed and removed
    (the numbers of the sentences that went, from 0)."""
    scratch = Scratch(docs.sparkSession, "spans")
    docs = numbered(bounded_batches(docs), scratch)
    hashes = scratch.put(span_hashes(docs, min_words), "hashes")
    place = F.struct("doc_id", "row")
    shared = (hashes.groupBy("h1", "h2")
              .agg(F.min(place).alias("first"), F.max(place).alias("last"))
              .where("first <> last").select("h1", "h2", F.col("first.row").alias("first")))
    shared = scratch.put(shared, "shared")
    salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")
    spread = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    drops = (hashes.select("row", "h1", "h2", salt.alias("salt"))
             .join(spread, ["h1", "h2", "salt"]).where(F.col("row") != F.col("first"))
             .groupBy(F.col("row").alias("__at"))
             .agg(F.collect_set(F.struct("h1", "h2")).alias("__drop")))
    drops = scratch.put(drops, "drops")
    scratch.keep("drops", "rows")

    @pandas_udf(StructType([StructField("text", StringType()), StructField("n", LongType()),
                            StructField("removed", ArrayType(IntegerType()))]))
    def without(texts: pd.Series, firsts: pd.Series, seconds: pd.Series) -> pd.DataFrame:
        out = []
        for text, h1, h2 in zip(texts, firsts, seconds):
            parts, gone, met = sentences(text), set(), set()
            drop = set(zip(h1.tolist(), h2.tolist())) if h1 is not None else ()
            for a, b, h in sorted(spans(parts, min_words)):
                if h in met or _halves(h) in drop:
                    gone.update(range(a, b + 1))
                met.add(h)
            kept = text if not gone else "".join(p for k, p in enumerate(parts) if k not in gone)
            out.append((kept or "", len(parts), sorted(gone)))
        return pd.DataFrame(out, columns=["text", "n", "removed"])

    joined = docs.join(drops, F.col("__row") == F.col("__at"), "left")
    made = joined.withColumn("__kept", without("text", F.col("__drop.h1"), F.col("__drop.h2")))
    return replace_columns(
        made.drop("__row", "__at", "__drop"), text=F.col("__kept.text"), n_sentences=F.col("__kept.n"),
        n_removed=F.size("__kept.removed").cast("long"), removed=F.col("__kept.removed")
    ).drop("__kept")


def span_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text (kept), n_sentences, n_removed, removed of every document."""
    return dedup_spans(docs.select("doc_id", "text"))
