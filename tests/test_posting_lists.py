"""The index's runs of texts: a row for each word of a run, and the places as they are."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from firmlens.sources.search_index import SearchIndex, _posting_lists, _runs

ITEMS = "n long, title string, snippet string"


def _landed(spark, path, rows, *days):
    index = SearchIndex(spark, str(path), buckets=4, parts=2)
    for day in days:
        index.land(spark.createDataFrame(rows, ITEMS).coalesce(1), day)
    return index


def _rows(n=60, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["", None, "a b", "C, a!"]), " ".join(rng.choices("abcd", k=rng.randint(0, 30))))
            for i in range(n)]
    return [*rows, (n, None, None), (n + 1, "a", "b c d e")]


def _words(row):
    return "".join(c if c.isalpha() else " " for c in f"{row[1] or ''} {row[2] or ''}".lower()).split()


def test_a_word_is_a_row_of_a_run(spark, tmp_path):
    rows = _rows()
    index = _landed(spark, tmp_path / "i", rows, "d1")
    stored = spark.read.parquet(f"{index.path}/postings")
    # One partition, one run: five words and the run's items, however many places there are.
    assert stored.count() == 6
    asked = spark.createDataFrame([("a",), ("e",), ("z",)], "word string")
    got = index.postings(asked).join(index.items(), "item").select("word", "n", "at").collect()
    assert sorted(map(tuple, got)) == sorted(
        (w, r[0], at) for r in rows for at, w in enumerate(_words(r)) if w in "ae")


def test_phrases_by_hand_and_of_two_days(spark, tmp_path):
    rows = _rows()
    asked = ["a", "a b", "b a", "a a a", "d c b a", "a b c d e", "e", "e a", "z", "a z"]
    phrases = spark.createDataFrame([(p,) for p in asked], "phrase string")
    want = sorted((p, r[0]) for p in asked for r in rows if f" {p} " in f" {' '.join(_words(r))} ")
    for k, days in enumerate((("d1",), ("d1", "d2"))):
        index = _landed(spark, tmp_path / f"i{k}", rows, *days)
        hits = index.phrases(phrases).join(index.items().select("item", "n").distinct(), "item")
        assert sorted((r["phrase"], r["n"]) for r in hits.collect()) == want


def test_days_need_not_be_plain_and_other_days_stay(spark, tmp_path):
    index = _landed(spark, tmp_path / "i", _rows(5), "2024-06-29 08:00:00", "a/b=c%")
    index.land(spark.createDataFrame([(1, "new", "")], ITEMS), "a/b=c%")
    for table in ("items", "postings"):
        days = spark.read.parquet(f"{index.path}/{table}").select(F.col("day").cast("string")).distinct()
        assert len(days.collect()) == 2
    new = spark.createDataFrame([("new",)], "phrase string")
    assert index.phrases(new, ("a/b=c%", "a/b=c%")).count() == 1
    assert index.phrases(new, ("2024-06-29 08:00:00", "2024-06-29 08:00:00")).count() == 0


def test_runs_hold_every_text_once():
    texts = ["x" * k for k in (0, 5, 3, 30, 1, 0, 2, 9, 9, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array([bytes([k]) * 16 for k in range(10)], pa.binary()),
                                        pa.array(texts)], names=["item", "text"])
    for most in (1, 10, 1000):
        runs = list(_runs(iter([batch[:4], batch[4:], batch[:0]]), most))
        assert [t for run in runs for t in run.column(1).to_pylist()] == texts
        assert all(run.num_rows == 1 or run.column(1).nbytes < most + 30 + 8 * run.num_rows for run in runs)
    none = list(_posting_lists(iter([batch[:0]])))
    assert sum(x.num_rows for x in none if x.column(0).null_count == 0) == 0
