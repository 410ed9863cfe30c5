"""Ranked lexical search by the Best Position Algorithm.

One scan of the documents keeps, for each, its length and the occurrences of the items' terms. Its
totals (N, L, df) fix every impact, a whole number. A run of documents is a shard with an impact list
for each term: its entries from the largest impact on. An item's lists are read in turn, a portion
deeper each round. A document that any of them shows is scored at once, by direct access to its
entries in the item's other lists, and all those places count as seen. A list's best position is the
end of its unbroken run of seen places; nothing unseen can score more than the impacts at the best
positions together. The search of a shard ends when that sum is strictly below the item's last
place, so documents of equal scores are all met. The places of all shards meet in one ranking, cut
before it is shuffled.

A first wave, a hashed 1/`wave` of the documents, gives every item a score that its last place can't
be below; the other shards stop below that, too. Nothing else depends on it.

Shards are read where they lie: nothing but places is shuffled, whatever the documents' number. Items
are taken in blocks of `block`; what the driver and the tasks hold of them is bounded by the block.

A null or empty text has no terms: no document, and an item without places. Repeated rows are
documents of their own; equal scores go by ascending doc_id, null last. Items that repeat an item_id
are items of their own, ranked one by one. Very long texts are read whole. An empty table gives no rows.
Columns of other names are not read, so they cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, byte_portions

#: Bytes of terms, A-Z lower-cased; all others separate. Every byte of a character beyond ASCII is
#: 0x80 or more, so bytes may be taken one by one.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_BYTES).split()


def term_counts(docs: DataFrame, places: dict[bytes, int], wave: int) -> DataFrame:
    """(doc_id, n, terms, times, first): each text's length and its occurrences of known terms;
    texts without a term are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in byte_portions(batch.column(2)):
                at, sizes, known, times, ends = [], [], [], [], [0]
                for i, text in enumerate(texts, begin):
                    words = terms(text)
                    if not words:
                        continue
                    found = Counter(map(places.get, words))
                    found.pop(None, None)
                    at.append(i)
                    sizes.append(len(words))
                    known.extend(found.keys())
                    times.extend(found.values())
                    ends.append(len(known))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(known, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(times, pa.int32())),
                     batch.column(1).take(pa.array(at, pa.int64()))],
                    names=["doc_id", "n", "terms", "times", "first"])

    first = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(wave)) == 0
    return docs.select(F.col("doc_id").cast("long"), first.alias("first"), "text").mapInArrow(
        run, "doc_id long, n long, terms array<int>, times array<int>, first boolean")


def document_frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """The number of documents that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, "i8")
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    rows = (counted.select("terms").mapInArrow(run, "term long, df long").groupBy("term")
            .agg(F.sum("df").alias("df")).toPandas())
    out = np.zeros(n_terms, "i8")
    out[rows["term"].to_numpy("i8")] = rows["df"].to_numpy("i8")
    return out


class Shard:
    """The impact lists of some documents."""

    def __init__(self, sizes: np.ndarray, ends: np.ndarray, term: np.ndarray, times: np.ndarray,
                 weight: np.ndarray, n: int, total: int):
        owner = np.repeat(np.arange(len(sizes)), np.diff(ends))
        m = 75 + (25 * sizes * n) // total
        impact = weight[term] * ((1_000_000_000 * times) // (1000 * times + 12 * m[owner]))
        self.ends, self.term, self.impact = ends, term, impact
        order = np.lexsort((owner, -impact, term))
        self.listed, self.falling = owner[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(len(weight) + 1))
        self.place = np.empty(len(order), "i8")
        self.place[order] = np.arange(len(order))
        self.slot = np.full(len(weight), -1)
        self.met = np.zeros(len(sizes), bool)

    def search(self, query: np.ndarray, repeats: np.ndarray, top: int, floor: int = 0,
               portion: int = 32) -> tuple[np.ndarray, np.ndarray, int]:
        """(document, score) of all documents that can be among the `top`, and the entries read in
        turn; `floor` is a score that the last place is known to have."""
        query, repeats = query[long := np.diff(self.start)[query] > 0], repeats[long]
        begin, size = self.start[query], np.diff(self.start)[query]
        self.slot[query] = np.arange(len(query))
        first = np.cumsum(size) - size
        seen = np.zeros(int(size.sum()), bool)
        best = np.zeros(len(query), "i8")
        docs, scores, depth = [], [], 0
        found, last, entries = 0, -1, 0
        while len(query) and depth < size.max():
            upto = np.minimum(size, depth + portion)
            fresh = [self.listed[b + depth:b + u] for b, u in zip(begin, upto)]
            entries += sum(map(len, fresh))
            for f, u in zip(first, upto):
                seen[f + depth:f + u] = True
            new = np.unique(np.concatenate(fresh))
            new = new[~self.met[new]]
            depth, portion = depth + portion, portion * 2
            if len(new):
                self.met[new] = True
                lengths = self.ends[new + 1] - self.ends[new]
                at = np.arange(lengths.sum()) + np.repeat(
                    self.ends[new] - (np.cumsum(lengths) - lengths), lengths)
                slot = self.slot[self.term[at]]
                at, slot, who = at[slot >= 0], slot[slot >= 0], np.repeat(
                    np.arange(len(new)), lengths)[slot >= 0]
                seen[first[slot] + self.place[at] - begin[slot]] = True
                score = np.zeros(len(new), "i8")
                np.add.at(score, who, repeats[slot] * self.impact[at])
                docs.append(new)
                scores.append(score)
                found += len(new)
            bound = 0
            for j in range(len(query)):
                ahead = seen[first[j] + best[j]:first[j] + size[j]]
                gap = int(ahead.argmin()) if len(ahead) else 0
                best[j] += gap if len(ahead) and not ahead[gap] else len(ahead)
                if best[j] < size[j]:
                    bound += repeats[j] * self.falling[begin[j] + best[j] - 1]
            if found >= top:
                everyone = np.concatenate(scores)
                last = int(np.partition(everyone, found - top)[found - top])
            if bound < max(last, floor):
                break
        self.slot[query] = -1
        if not docs:
            return np.zeros(0, "i8"), np.zeros(0, "i8"), entries
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        self.met[docs] = False
        good = scores >= max(last, floor, 1)
        return docs[good], scores[good], entries


def searched(counted: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]],
             weight: np.ndarray, n: int, total: int, top: int, shard: int,
             floors: dict[int, int]) -> DataFrame:
    """(item, doc_id, score) of the places of every shard of at most `shard` documents."""

    def places(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        ids = pc.fill_null(rows["doc_id"], 2 ** 63 - 1).to_numpy()
        lists = rows["terms"].combine_chunks()
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype("i8")
        held = Shard(rows["n"].to_numpy(), ends, lists.flatten().to_numpy(),
                     rows["times"].combine_chunks().flatten().to_numpy().astype("i8"),
                     weight, n, total)
        out = []
        for item, query, repeats in queries:
            docs, scores, _ = held.search(query, repeats, top, floors.get(item, 0))
            ordered = np.lexsort((ids[docs], -scores))[:top]
            out.append((np.full(len(ordered), item), docs[ordered], scores[ordered]))
        item, docs, scores = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), rows["doc_id"].combine_chunks().take(pa.array(docs)),
             pa.array(scores)], names=["item", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for begin in range(0, batch.num_rows, shard):
                part = batch.slice(begin, shard)
                if held + part.num_rows > shard:
                    yield places(parts)
                    parts, held = [], 0
                parts.append(part)
                held += part.num_rows
        if parts:
            yield places(parts)

    return counted.select("doc_id", "n", "terms", "times").mapInArrow(
        run, "item long, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = 20, shard: int = 16_384, wave: int = 16,
           block: int = 1000) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `top` documents with a score above 0."""
    scratch = Scratch(docs.sparkSession, "search")
    items = items.select(F.col("item_id").cast("long"), "text")
    blocks = max(1, math.ceil(items.count() / block))
    dealt = scratch.put(items.withColumn("block", F.floor(F.rand(5) * blocks)), "items")
    results = []
    for b in range(blocks):
        rows = dealt.where(F.col("block") == b).select(
            "item_id", F.col("text").cast("binary").alias("text")).collect()
        counts = [Counter(terms(r["text"] and bytes(r["text"]))) for r in rows]
        places = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        queries = [(i, np.array([places[t] for t in c], "i8"), np.array(list(c.values()), "i8"))
                   for i, c in enumerate(counts) if c]
        if not queries:
            continue
        counted = scratch.put(term_counts(docs, places, wave), f"counted-{b}")
        n, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n:
            continue
        often = document_frequencies(counted, len(places))
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1)))
                           for df in often], "i8")
        how = (weight, n, total, top, shard)
        early = scratch.put(_ranked(searched(counted.where("first"), queries, *how, {}), top),
                            f"early-{b}")
        floors = {r["item"]: r["score"] for r in early.where(F.col("rank") == top).collect()}
        late = searched(counted.where("not first"), queries, *how, floors)
        ids = docs.sparkSession.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(rows)], "item long, item_id long")
        best = _ranked(early.drop("rank").unionByName(late), top)
        results.append(scratch.put(best.join(F.broadcast(ids), "item")
                                   .select("item_id", "rank", "doc_id", "score"), f"best-{b}"))
        scratch.drop(f"counted-{b}")
        scratch.drop(f"early-{b}")
    if not results:
        return docs.sparkSession.createDataFrame(
            [], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row, translate(unnest(regexp_extract_all(text,
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM documents),
counted AS (SELECT row, doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
sizes AS (SELECT row, sum(tf)::BIGINT AS n FROM counted GROUP BY row),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, total GROUP BY term, nn),
items AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, translate(unnest(regexp_extract_all(text,
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark)
  GROUP BY ALL),
scored AS (
  SELECT i.item_id, c.row, c.doc_id, sum(i.times * w.w * ((1000000000 * c.tf)
      // (1000 * c.tf + 12 * (75 + (25 * s.n * t.nn) // t.ll))))::BIGINT AS score
  FROM items i JOIN weights w ON i.term = w.term JOIN counted c ON i.term = c.term
  JOIN sizes s ON c.row = s.row CROSS JOIN total t GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
