"""Nearest neighbours: recall against brute force, exact scores and ties, odd rows."""

import numpy as np

from firmlens.llm import permutation_index
from firmlens.llm.catalog import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


def _by_hand(ids, table, k=20, every=20):
    out = {}
    for i, v in zip(ids, table):
        if i % every == 0:
            score = (table * v).sum(axis=1)
            others = ids != i
            best = np.lexsort((ids[others], -score[others]))[:k]
            out[i] = (ids[others][best].tolist(), score[others][best].tolist())
    return out


def _recall(rows, want):
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got.keys() == want.keys()
    return np.mean([len(set(got[q]) & set(want[q][0])) / max(1, len(want[q][0])) for q in want])


def _read(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    return rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), "f8")


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    ids, table = _read(spark, folder)
    rows = QUERIES["op10_nearest"][0](spark, folder).collect()
    assert _recall(rows, _by_hand(ids, table)) >= 0.9
    at = {i: k for k, i in enumerate(ids)}
    for r in rows[:300]:
        exact = (table[at[r["query_id"]]] * table[at[r["vec_id"]]]).sum()
        assert r["score"] == exact and r["vec_id"] != r["query_id"]


def test_recall_of_lengths_that_differ_and_many_blocks(spark):
    rng = np.random.default_rng(3)
    table = rng.normal(size=(6000, 24)) * rng.lognormal(0, 0.7, (6000, 1))
    table = table.astype("f4").astype("f8")
    ids = np.arange(6000) * 3
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, table)], VECTORS)
    rows = permutation_index.search(df, block=1500, chunk=64).collect()
    assert _recall(rows, _by_hand(ids, table)) >= 0.9


def test_recall_with_a_third_of_equal_vectors(spark):
    rng = np.random.default_rng(6)
    table = rng.normal(size=(6000, 64))
    table /= np.linalg.norm(table, axis=1)[:, None]
    table[rng.permutation(6000)[:2000]] = table[1]
    table = table.astype("f4").astype("f8")
    ids = np.arange(6000)
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, table)], VECTORS)
    rows = permutation_index.search(df, block=2048).collect()
    want = _by_hand(ids, table)
    assert _recall(rows, want) >= 0.9
    hot = {r["query_id"] for r in rows if (table[r["query_id"]] == table[1]).all()}
    for q in list(hot)[:5]:
        got = sorted((r["rank"], r["vec_id"]) for r in rows if r["query_id"] == q)
        assert [v for _, v in got] == want[q][0]


def test_ties_go_to_smaller_ids(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, 1.0, 0.5]
    rows = [(i, v if i < 500 else w, 0) for i in range(600)]
    got = permutation_index.search(spark.createDataFrame(rows, VECTORS)).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 40] == [
        i for i in range(21) if i != 40][:20]
    assert sorted({r["rank"] for r in got}) == list(range(1, 21))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], None), (20, [0.5, 0.5], 1), (20, [0.5, 0.5], 1), (40, None, 1),
            (60, [0.0, 0.0], 1), (80, [nan, 1.0], 1), (100, [inf, 1.0], 1), (120, [None, 1.0], 1),
            (None, [1.0, 1.0], 1), (140, [], 1), (160, [1.0, 1.0, 1.0], 1), (1, [0.9, 0.1], 1)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'own' AS score", "1 AS rank", "2 AS v")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in
           permutation_index.search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 20), (20, 1, 0), (20, 2, 1)]
    assert permutation_index.search(df.limit(0)).count() == 0
