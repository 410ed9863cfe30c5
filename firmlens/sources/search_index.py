"""Landed items as a persisted inverted index, so that new companies do not read all texts again.

Two tables under one path, both partitioned by landing day, which a repeated landing replaces:

items     item (16-byte key of the row's content), with the item's columns other than its texts
postings  word, run, places, in buckets by word; and for each run its items, in a bucket of their own

A run is a few megabytes of texts. What is shuffled, sorted and written is a row for each word of a
run, with all its places there, not one for each place, and the 16-byte keys are written once.

A phrase is found on the postings alone. Only the buckets of its words are read. Its rarest word
gives the candidates; its other words are looked up in the runs that have some, an equality on
(word, run), so a frequent word is no hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import normalise_words

ITEMS, POSTINGS = "items", "postings"
TEXTS = ("title", "snippet")
#: A row of the postings: a word of a run, or (without a word) the items of a run, each with the number
#: of words before it. A place is the text's number in its run, times 2^32, and the words before in the run.
POSTING = "word string, run long, places array<long>, items array<binary>, begins array<long>"
_NAMES = ["word", "run", "places", "items", "begins"]
_TEXT = 32


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def _nth(place: Column) -> Column:
    return F.shiftright(place, _TEXT).cast("int")


def item_key(columns: list[str]) -> Column:
    """A row's key from its content: rows alike in everything are one item."""
    return F.unhex(F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")))


def _runs(batches: Iterator[pa.RecordBatch], most: int = 8_000_000) -> Iterator[pa.Table]:
    """The rows (item, text) of `batches` in runs of about `most` bytes of text."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype="i8")
        begin = taken = 0
        while begin < len(ends):
            end = max(int(np.searchsorted(ends, taken + most - size, "right")), begin + 1)
            held.append(batch.slice(begin, end - begin))
            size += int(ends[end - 1]) - taken
            begin, taken = end, int(ends[end - 1])
            if size >= most or begin < len(ends):
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _posting_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The postings of texts (item, text) whose words are parted by single blanks."""
    for run in _runs(batches):
        items = run.column(0).combine_chunks().cast(pa.binary())
        cut = pc.split_pattern(run.column(1).combine_chunks(), " ")
        # Named by its items, a run is the same one wherever it is made.
        name = int.from_bytes(hashlib.blake2b(b"".join(items.to_pylist()), digest_size=8).digest(),
                              "little", signed=True)
        size = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype("i8")
        owner = np.repeat(np.arange(len(size)), size)
        place = (owner << _TEXT) + np.arange(len(owner))
        words = cut.flatten().dictionary_encode()
        code = words.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(code, kind="stable")
        # By word, then as they came; the words are numbered by their first places.
        ends = np.append(0, np.cumsum(np.bincount(code, minlength=len(words.dictionary))))
        n = len(words.dictionary)
        lists = pa.RecordBatch.from_arrays(
            [words.dictionary.cast(pa.string()), pa.array(np.full(n, name, "i8")),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[order])),
             pa.nulls(n, pa.list_(pa.binary())), pa.nulls(n, pa.list_(pa.int64()))], names=_NAMES)
        yield lists.filter(pc.not_equal(lists.column(0), ""))
        whole = pa.array([0, len(items)], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.string()), pa.array([name], pa.int64()), pa.nulls(1, pa.list_(pa.int64())),
             pa.ListArray.from_arrays(whole, items),
             pa.ListArray.from_arrays(whole, pa.array(np.cumsum(size) - size))], names=_NAMES)


class SearchIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, parts: int = 4):
        """`buckets` is fixed for a path. Within a landing, a bucket has up to `parts` files, so a word
        that every item has is not one task's."""
        self.spark, self.path, self.buckets, self.parts = spark, path.rstrip("/"), buckets, parts

    def _write(self, rows: DataFrame, name: str, by: str) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(by).parquet(f"{self.path}/{name}"))

    def land(self, items: DataFrame, day: str) -> None:
        """Add what landed on a day; done again, it replaces that day's. The items are written last:
        a landing that broke off between the two tables has postings without items, which no search
        returns."""
        keyed = items.withColumn("item", item_key(items.columns)).dropDuplicates(["item"])
        text = normalise_words(F.concat_ws(" ", *TEXTS))
        lists = keyed.select("item", text.alias("text")).mapInArrow(_posting_lists, POSTING)
        bucket = F.when(F.col("word").isNull(), self.buckets).otherwise(_bucket(F.col("word"), self.buckets))
        lists = lists.repartition(bucket, F.pmod(F.xxhash64("run"), F.lit(self.parts)))
        # Each bucket sorted by word: a reader of one word skips the row groups of others. The day is
        # in the path: the writer would sort by a column of it again, and lose the order of the words.
        self._write(lists.withColumn("bucket", bucket).sortWithinPartitions("bucket", "word"),
                    f"{POSTINGS}/day={quote(day, safe=' ')}", "bucket")
        self._write(keyed.drop(*TEXTS).withColumn("day", F.lit(day)), ITEMS, "day")

    def _read(self, name: str, days: tuple[str, str] | None) -> DataFrame:
        rows = self.spark.read.option("recursiveFileLookup", "false").parquet(f"{self.path}/{name}")
        rows = rows.withColumn("day", F.col("day").cast("string"))
        return rows.where(F.col("day").between(*days)) if days else rows

    def items(self, days: tuple[str, str] | None = None) -> DataFrame:
        return self._read(ITEMS, days)

    def _lists(self, words: DataFrame, days: tuple[str, str] | None) -> DataFrame:
        """(word, run, places) of some words (word): only their buckets are read."""
        words = words.select("word").distinct()
        asked = [r[0] for r in words.select(_bucket(F.col("word"), self.buckets)).distinct().collect()]
        rows = self._read(POSTINGS, days).where(F.col("bucket").isin(asked))
        return rows.select("word", "run", "places").join(words, "word", "left_semi")

    def _keyed(self, rows: DataFrame, days: tuple[str, str] | None) -> DataFrame:
        """Rows (run, nth) with the item for them, and the number of words before it (begin)."""
        runs = self._read(POSTINGS, days).where(F.col("bucket") == self.buckets)
        named = runs.dropDuplicates(["run"]).select("run", F.posexplode(F.arrays_zip(
            F.col("items").alias("item"), F.col("begins").alias("begin"))).alias("nth", "of"))
        return rows.join(named.select("run", "nth", "of.*"), ["run", "nth"]).drop("run", "nth")

    def postings(self, words: DataFrame, days: tuple[str, str] | None = None) -> DataFrame:
        """(word, item, at) of some words (word): only their buckets are read."""
        places = (self._lists(words, days).dropDuplicates(["word", "run"])
                  .select("word", "run", F.explode("places").alias("place")))
        before = F.col("place").bitwiseAND(F.lit((1 << _TEXT) - 1))
        return self._keyed(places.select("word", "run", _nth(F.col("place")).alias("nth"), before.alias("before")),
                           days).select("word", "item", (F.col("before") - F.col("begin")).cast("int").alias("at"))

    def phrases(self, phrases: DataFrame, days: tuple[str, str] | None = None) -> DataFrame:
        """(phrase, item): the items that hold the words of a phrase (phrase) in a row."""
        words = (phrases.select("phrase").distinct()
                 .select("phrase", F.split(normalise_words(F.col("phrase")), " ").alias("words"))
                 .select("phrase", F.size("words").alias("size"), F.posexplode("words").alias("i", "word"))
                 .where("word <> ''"))
        found = self._lists(words, days)
        often = found.groupBy("word").agg(F.sum(F.size("places")).alias("often"))
        # A phrase with a word that nothing holds has no rarest word, and no hits.
        known = words.join(often, "word")
        rarest = (known.groupBy("phrase", "size").agg(
            F.count(F.lit(1)).alias("known"), F.min(F.struct("often", "i", "word")).alias("r"))
            .where("known = size").select("phrase", "size", F.col("r.word").alias("word"),
                                          F.col("r.i").alias("i")))
        first = found.join(rarest, "word").select("phrase", "size", "run", "i", F.transform(
            "places", lambda p: p - F.col("i")).alias("starts"))
        others = words.select("phrase", F.col("i").alias("j"), "word")
        wanted = first.join(others, "phrase").where("i <> j").select(
            "phrase", "size", "run", "j", "word", F.transform("starts", lambda s: s + F.col("j")).alias("asked"))
        # A run that landed on several days has each of its places as often.
        whole = (wanted.join(found, ["word", "run"])
                 .select("phrase", "size", "run", "j", F.explode(F.array_intersect("places", "asked")).alias("place"))
                 .groupBy("phrase", "size", "run", (F.col("place") - F.col("j")).alias("start"))
                 .agg(F.collect_set("j").alias("js")).where("size(js) = size - 1")
                 .select("phrase", "run", _nth(F.col("start")).alias("nth")))
        single = first.where("size = 1").select("phrase", "run", F.explode(F.array_distinct(
            F.transform("starts", _nth))).alias("nth"))
        return self._keyed(single.unionByName(whole).distinct(), days).select("phrase", "item").distinct()
