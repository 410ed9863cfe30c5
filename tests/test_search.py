"""The landed-item index and the request rounds."""

import json
import re

import pytest
from pyspark.sql import functions as F

from firmlens.operators import requests
from firmlens.operators.mentions import mentions_words
from firmlens.operators.search import NEWS_RULES, Rule, rule_table, search_landed
from firmlens.params import NEWS_WORDS, Params
from firmlens.sources.search_index import SearchIndex

ITEMS = "source string, item_rank long, title string, snippet string, section string, domain string, raw_date string"
AS_OF = "2024-06-30 00:00:00"


@pytest.fixture
def index(spark, tmp_path):
    index = SearchIndex(spark, str(tmp_path / "index"), buckets=8)
    rows = [("gdelt", 1, "Acme Rockets plans merger", "", "", "", "20240601"),
            ("gdelt", 2, "Acme, Rockets!", "a new   name for it", "", "", ""),
            ("gdelt", 3, "Acme builds rockets", "merger", "", "", "20240601"),
            ("gdelt", 4, "Acme Rockets merger", "", "", "", "20200101"),
            ("guardian", 5, "the acme rockets acquisition", None, "business", "", "2024-05-01"),
            ("guardian", 6, "the acme rockets acquisition", None, "sport", "", "2024-05-01")]
    index.land(spark.createDataFrame(rows, ITEMS), "2024-06-01")
    more = [("google_news", 7, "Acme Rockets", "what 2024 brings", "", "", "2024-02-01"),
            ("edgar", 8, "Acme Rockets", "", "", "10-K", "2024-02-01"),
            ("edgar", 9, "Acme Rockets", "", "", "8-K/A", "2024-02-01"),
            ("prnewswire", 10, "Acme Rockets merger", "", "", "", "2024-02-01")]
    index.land(spark.createDataFrame(more, ITEMS), "2024-06-02")
    return index


def found(index, names, **kw):
    companies = index.spark.createDataFrame([(n,) for n in names], "company string")
    rows = search_landed(index, companies, F.lit(AS_OF).cast("timestamp"), **kw)
    return sorted((r["company"], r["source"], r["query_rank"], r["item_rank"]) for r in rows.collect())


def test_rules_of_the_feeds(index):
    assert found(index, ["ACME Rockets Ltd", "Nobody Here", "plc"]) == [
        ("ACME Rockets Ltd", "edgar", 1, 9), ("ACME Rockets Ltd", "gdelt", 1, 1),
        ("ACME Rockets Ltd", "gdelt", 1, 2), ("ACME Rockets Ltd", "google_news", 1, 7),
        ("ACME Rockets Ltd", "google_news", 2, 7), ("ACME Rockets Ltd", "guardian", 1, 5)]
    assert {w for r in NEWS_RULES for w in r.any_of} == set(NEWS_WORDS)


def test_landing_again_replaces_the_day(index, spark):
    one = spark.createDataFrame([("gdelt", 1, "Acme Rockets merger", "", "", "", "20240601")], ITEMS)
    for _ in range(2):
        index.land(one, "2024-06-01")
    assert [r for r in found(index, ["acme rockets"]) if r[1] == "gdelt"] == [("acme rockets", "gdelt", 1, 1)]
    assert found(index, ["acme rockets"], days=("2024-06-02", "2024-06-09"))[0][1] == "edgar"


def test_phrases_equal_the_scan(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = SearchIndex(spark, str(tmp_path / "index"), buckets=16)
    index.land(docs.select("doc_id", F.lit("").alias("title"), F.col("text").alias("snippet")), "d1")
    names = spark.createDataFrame([("the",), ("of the",), ("in no event",), ("de la",), ("zzz",),
                                   ("all rights reserved",)], "company string")
    hits = index.phrases(names.withColumnRenamed("company", "phrase")).join(index.items(), "item")
    scan = mentions_words(docs, "doc_id", F.col("text"), names)
    assert ({(r["doc_id"], r["phrase"]) for r in hits.collect()}
            == {(r["doc_id"], r["company"]) for r in scan.select("doc_id", "company").collect()})


def test_a_second_list_reads_no_texts_and_only_its_buckets(index, spark):
    words = spark.createDataFrame([("rockets",)], "phrase string")
    plan = index.phrases(words)._jdf.queryExecution().executedPlan().toString()
    assert "snippet" not in plan and "title" not in plan
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#", plan)


def test_empty_index_words(index, spark):
    assert index.phrases(spark.createDataFrame([("",), (None,)], "phrase string")).count() == 0
    none = rule_table(spark, (Rule("gdelt", any_of=("never said",)),))
    assert found(index, ["acme rockets"], rules=none) == []


# ---- requests -----------------------------------------------------------------------------

PARAMS = Params(chunk_chars=100, max_chunks=3, num_partitions=2)


def model(log):
    """A model that tells all it was asked, and fails for one company's details once."""
    def setup():
        import os

        def call(row):
            with open(log, "a") as f:
                f.write(json.dumps([row["company"], row["pass"], row["chunk_idx"], row["signal"]]) + "\n")
            if row["pass"] == "pass1":
                named = ["renaming"] if row["company"] == "b" else ["renaming", "bankruptcy"]
                return {"raw": json.dumps({"detected": [] if row["company"] == "c" else named,
                                           "confidence": 4})}
            if row["pass"] == "pass2":
                if row["company"] == "a" and row["signal"] == "renaming" and not os.path.exists(log + ".up"):
                    raise RuntimeError("down")
                return {"raw": json.dumps({"confirmed": row["company"] != "b", "confidence": 3,
                                           "detail": row["signal"] + " told"})}
            return {"raw": json.dumps({"verified": {"bankruptcy": False}})}
        return call
    return setup


def test_rounds_ask_nothing_twice(spark, tmp_path):
    log = str(tmp_path / "asked")
    contexts = spark.createDataFrame(
        [(c, (c + " evidence ") * 25, [c]) for c in "abc"] + [("d", "short", [])],
        "company string, context string, sources array<string>")
    store = requests.AnswerStore(spark, str(tmp_path / "answers"))
    first = {r["company"]: r for r in requests.answer_all(contexts, store, model(log), PARAMS, 2).collect()}
    asked = [tuple(json.loads(line)) for line in open(log)]
    assert len(asked) == len(set(asked))
    # Three chunks each; details of named signals; the last question waits for the failed detail.
    assert sorted(a[:2] for a in asked if a[1] != "pass1") == [
        ("a", "pass2"), ("a", "pass2"), ("b", "pass2")]
    assert sum(a[1] == "pass1" for a in asked) == 9 and not any(a[0] == "d" for a in asked)
    assert first["a"]["bankruptcy"] and not first["a"]["renaming"]
    open(log + ".up", "w").close()
    again = {r["company"]: r for r in requests.answer_all(contexts, store, model(log), PARAMS, 2).collect()}
    more = [tuple(json.loads(line)) for line in open(log)][len(asked):]
    assert sorted(more) == [("a", "pass2", 0, "renaming"), ("a", "pass3", 0, "")]
    assert again["a"]["renaming"] and not again["a"]["bankruptcy"]
    assert again["a"]["rename_detail"] == "renaming told" and again["c"]["total_signals"] == 0
    assert again["d"]["summary"] == "Insufficient context to classify."
    assert requests.open_requests(contexts, store.read(), PARAMS).isEmpty()


def test_single_pass_requests(spark):
    contexts = spark.createDataFrame([("a", "x" * 200), ("b", "y")], "company string, context string")
    store = spark.createDataFrame([], requests.ANSWER_TYPE)
    rows = requests.open_requests(contexts, store, Params(three_pass=False)).collect()
    assert [(r["company"], r["pass"], len(r["prompt"])) for r in rows] == [("a", "single", 200)]
