"""Line dedup with levelled sorted runs of line hashes.

The state is a set of runs: tables of (h1, h2, docs, top), bucketed and sorted by the 128-bit hash
of a line's key, no hash in two of them. A batch of documents becomes a table of its distinct
hashes, dealt into the same buckets. It merge-joins the runs without moving them: hashes that no run
has (the anti join) become a run of level 0 of their own; hashes that one has are noted as repeats.
When a level has `fanout` runs, they are merged into one of the next level. So each hash is
rewritten as often as there are levels, a logarithm of the number of batches.

A key that at least `min_docs` documents hold is then either a run's entry with so many documents
or among the repeats; it loses its lines in all documents but the one of the largest id. A null
doc_id is a document that comes before all others; rows with the same doc_id are one document.
Null and empty texts are one empty line. Lines with short keys stay, whatever they are.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import LOWER, UPPER, Scratch, bounded_batches

#: Rows of a batch that are Python objects at a time.
_ROWS = 500
_BLANKS = " \t\n\x0b\x0c\r"
_FOLD = str.maketrans(UPPER, LOWER)
_KEYS = StructType([StructField("doc_id", LongType()), StructField("h1", LongType()),
                    StructField("h2", LongType())])


def line_key(line: str) -> str:
    return line.strip(_BLANKS).translate(_FOLD)


def key_hash(key: str) -> bytes:
    return hashlib.md5(key.encode(), usedforsecurity=False).digest()


def _halves(digest: bytes) -> tuple[int, int]:
    return (int.from_bytes(digest[:8], "big", signed=True),
            int.from_bytes(digest[8:], "big", signed=True))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h1, h2) of each distinct key of at least `min_chars` code points of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                ids, first, second = [], [], []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    keys = {k for k in map(line_key, (text or "").split("\n"))
                            if len(k) >= min_chars}
                    for h1, h2 in map(_halves, map(key_hash, keys)):
                        ids.append(doc)
                        first.append(h1)
                        second.append(h2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (ids, first, second)], names=_KEYS.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _KEYS)


class LineRuns:
    """The levelled runs, as bucketed tables in the shared folder."""

    def __init__(self, scratch: Scratch, buckets: int, fanout: int = 3):
        self.spark, self.scratch = scratch.spark, scratch
        self.buckets, self.fanout = buckets, fanout
        self.levels: list[list[str]] = []
        self.repeats: list[DataFrame] = []

    def _write(self, df: DataFrame) -> str:
        """A new run: one sorted file for each bucket."""
        name = f"line_run_{uuid.uuid4().hex}"
        (df.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .option("path", f"{self.scratch.path}/{name}").saveAsTable(name))
        return name

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.scratch.drop(name)

    def add(self, batch: DataFrame) -> None:
        """Take in (doc_id, h1, h2) rows of a batch; a document's rows are all in one batch."""
        own = (batch.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
               .groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("top"))
               .repartition(self.buckets, "h1", "h2"))
        names = [name for level in self.levels for name in level]
        for k, name in enumerate(names):
            run = self.spark.table(name).select("h1", "h2", F.lit(True).alias(f"in_{k}"))
            own = own.join(run.hint("merge"), ["h1", "h2"], "left")
        known = F.coalesce(*[F.col(f"in_{k}") for k in range(len(names))], F.lit(False))
        found = self.scratch.put(own.select("h1", "h2", "docs", "top", known.alias("known")),
                                 f"batch-{uuid.uuid4().hex}", by="known")
        self.repeats.append(found.where("known").drop("known"))
        fresh = found.where("not known").drop("known")
        self._level_up(self._write(fresh.repartition(self.buckets, "h1", "h2")), 0)

    def _level_up(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) < self.fanout:
            return
        old, self.levels[level] = self.levels[level], []
        merged = self.spark.table(old[0])
        for other in old[1:]:
            merged = merged.unionByName(self.spark.table(other))
        self._level_up(self._write(merged.repartition(self.buckets, "h1", "h2")), level + 1)
        for each in old:
            self._remove(each)

    def shared(self, min_docs: int) -> DataFrame:
        """(h1, h2, docs, top) of the hashes that at least `min_docs` documents hold."""
        repeats = None
        for part in self.repeats:
            repeats = part if repeats is None else repeats.unionByName(part)
        runs = None
        for name in (name for level in self.levels for name in level):
            part = self.spark.table(name).select("h1", "h2", "docs", "top")
            runs = part if runs is None else runs.unionByName(part)
        again = repeats.groupBy("h1", "h2").agg(F.sum("docs").alias("more"),
                                                F.max("top").alias("later"))
        return (runs.join(again, ["h1", "h2"], "left")
                .select("h1", "h2", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"),
                        F.greatest("top", "later").alias("top"))
                .where(F.col("docs") >= min_docs))

    def close(self) -> None:
        for level in self.levels:
            for name in level:
                self._remove(name)
        self.levels = []


def _without(joined: DataFrame, docs: DataFrame) -> DataFrame:
    """`docs` with its texts less the lines whose hashes are in `__drop`, and the counts."""
    counts = ("n_lines", "n_dropped")
    kept = [f for f in docs.schema.fields if f.name.lower() not in counts]
    schema = StructType([*[f if f.name != "text" else StructField("text", StringType())
                           for f in kept], *[StructField(c, LongType()) for c in counts]])
    source = joined.select(*[F.col(f"`{f.name}`") for f in kept], F.col("__drop"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = [f.name for f in kept].index("text")
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                texts, before, dropped = [], [], []
                for text, drop in zip(part.column(at).to_pylist(), part.columns[-1].to_pylist()):
                    lines = (text or "").split("\n")
                    gone = set(drop or ())
                    stay = lines
                    if gone:
                        stay = [x for x in lines if key_hash(line_key(x)) not in gone]
                    texts.append("\n".join(stay))
                    before.append(len(lines))
                    dropped.append(len(lines) - len(stay))
                columns = part.columns[:-1]
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(before, pa.int64()), pa.array(dropped, pa.int64())],
                    names=schema.names)

    return source.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4,
                buckets: int | None = None, salts: int = 8) -> DataFrame:
    """`docs` with text less its repeated lines, n_lines (before) and n_dropped.

    Batches are dealt by doc_id. Distinct line hashes of a document meet the shared ones in a join
    salted `salts` ways, so that a line that a third of all documents hold is spread."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    docs = bounded_batches(docs)
    if buckets is None:
        buckets = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    batch = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(batches)).cast("int")
    lines = scratch.put(line_hashes(docs, min_chars).withColumn("batch", batch), "lines",
                        by="batch")
    runs = LineRuns(scratch, buckets)
    for k in range(batches):
        runs.add(lines.where(F.col("batch") == k).drop("batch"))
    shared = scratch.put(runs.shared(min_docs), "shared")
    runs.close()
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
    spread = shared.select("h1", "h2", "top",
                           F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    digest = F.unhex(F.concat(F.lpad(F.hex("h1"), 16, "0"), F.lpad(F.hex("h2"), 16, "0")))
    drops = (lines.drop("batch").withColumn("salt", salt).join(spread, ["h1", "h2", "salt"])
             .where(~F.col("doc_id").eqNullSafe(F.col("top")))
             .groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_set(digest).alias("__drop")))
    drops = scratch.put(drops, "drops")
    scratch.keep("drops")
    joined = docs.join(drops,
                       docs["doc_id"].cast("long").eqNullSafe(F.col("__doc")), "left")
    return _without(joined, docs)


def line_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    kept = dedup_lines(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


LINE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, n, line, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS n FROM d)),
shared AS (
  SELECT key, max(doc_id) AS top FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
kept AS (
  SELECT l.doc_id, l.n, l.line, s.key IS NULL OR s.top = l.doc_id AS stays
  FROM lines l LEFT JOIN shared s ON l.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (stays), '')) AS kept_sha256
FROM kept GROUP BY doc_id
"""
