"""Toxicity and quality: held-out accuracy, what the machines learn, odd rows."""

import numpy as np
import pytest

from firmlens.llm import quality_rank, toxicity
from firmlens.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def _held_out(spark, name, column):
    rows = QUERIES[name][0](spark, SF).join(
        spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    return rows["score"].to_numpy(), rows[column].to_numpy(), rows["predicted"].to_numpy()


def _auc(score, label):
    good, bad = score[label == 1], score[label == 0]
    return np.mean([(good > b).mean() + 0.5 * (good == b).mean() for b in bad])


def test_toxicity_held_out(spark):
    score, label, predicted = _held_out(spark, "op1_toxicity", "toxic")
    assert ((score >= 0) & (score <= 1)).all()
    assert (predicted == (score >= 0.5)).all()
    assert _auc(score, label) > 0.7  # some labelled rows hold no word at all that tells
    assert (predicted[label == 0] == 0).mean() > 0.95


def test_quality_held_out(spark):
    score, label, predicted = _held_out(spark, "op8_quality", "quality")
    assert (predicted == (score >= 0.3)).all()
    assert _auc(score, label) > 0.98
    assert (predicted[label == 1] == 1).mean() > 0.95


def test_machine_learns_a_pair():
    """Neither term tells alone, both together do: only the factors can."""
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for _ in range(1500):
        a, b = (rng.random(2) < 0.5).tolist()
        docs.append(np.array([0] * a + [1] * b + [2]))
        labels.append(float(a and b))
    fm = toxicity.train(np.array([10, 20, 30]), docs, np.array(labels), decay=1e-6)
    sizes = [len(d) for d in docs]
    margin = fm.margins(np.repeat(np.arange(len(docs)), sizes), np.concatenate(docs), len(docs))
    assert ((margin > 0) == np.array(labels)).mean() > 0.99
    assert (fm.factors[0] @ fm.factors[1]) > 1


def test_one_label_gives_its_share():
    fm = toxicity.train(np.array([1]), [np.array([0])] * 4, np.zeros(4))
    assert fm.score(["a", None, ""]).max() < 1e-3
    bt = quality_rank.train(np.ones((4, quality_rank.WIDTH)), np.ones(4))
    assert bt.score(np.zeros((1, quality_rank.WIDTH)))[0] > 0.99


def test_pairs_order_scores():
    rng = np.random.default_rng(2)
    stats = rng.normal(size=(400, quality_rank.WIDTH))
    labels = (stats[:, 3] < 0.8).astype(float)
    model = quality_rank.train(stats, labels)
    assert _auc(model.raw(stats), labels) > 0.99
    assert abs((model.score(stats) < 0.3).mean() - (labels == 0).mean()) < 0.02


@pytest.mark.parametrize("module", [toxicity, quality_rank])
def test_odd_rows(spark, odd, odd_rows, nothing, no_labels, module):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (None, 1, 1), (3, None, None),
                                    (7, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    made = module.score(odd, module.fit(odd, labels))
    rows = made.collect()
    assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert made.columns.count("score") == 1 and "own tokens" in set(rows[0])
    assert module.score(nothing, module.fit(nothing, no_labels)).count() == 0
    same = {r["score"] for r in rows if r["text"] in (None, "")}
    assert len(same) == 1


def test_bound_is_kept(spark):
    from firmlens.llm.common import bounded_labels

    labels = spark.range(20_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    n = bounded_labels(labels, "toxic", 2_000).count()
    assert 1_700 < n < 2_300


def _toxic_by_hand(fm, text):
    place = {int(t): i for i, t in enumerate(fm.terms)}
    held = sorted({place[h] for h in toxicity.term_hashes(text) if h in place})
    margin = fm.bias + sum(fm.weights[i] for i in held)
    for a, i in enumerate(held):
        for j in held[a + 1:]:
            margin += sum(x * y for x, y in zip(fm.factors[i], fm.factors[j]))
    return 1 / (1 + np.exp(-margin))


def test_toxicity_scores_by_hand(spark, odd_rows):
    """The query's scores, pair by pair."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r["score"] for r in QUERIES["op1_toxicity"][0](spark, folder).collect()}
    fm = toxicity.fit(docs, labels)
    want = {r["doc_id"]: _toxic_by_hand(fm, r["text"]) for r in docs.collect()}
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-9 for d in want)
    rng = np.random.default_rng(4)
    terms = np.unique(np.concatenate([toxicity.term_hashes(r[1]) for r in odd_rows]).astype("i8"))[::3]
    fm = toxicity.FactorizationMachine(terms, -0.2, rng.normal(0, 0.05, len(terms)),
                                       rng.normal(0, 0.01, (len(terms), 3)))
    for row in odd_rows[:7] + odd_rows[9:]:
        if len(row[1] or "") < 1000:
            assert abs(fm.score([row[1]])[0] - _toxic_by_hand(fm, row[1])) < 1e-9


def test_quality_scores_by_hand(spark):
    """The query's scores from their definition, one statistic after the other."""
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r["score"] for r in QUERIES["op8_quality"][0](spark, folder).collect()}
    bt = quality_rank.fit(docs, labels)
    width = quality_rank.WIDTH
    for r in docs.collect():
        raw = bt.shift
        for i, x in enumerate(quality_rank.statistics(r["text"])):
            z = min(6.0, max(-6.0, (x - bt.centre[i]) / bt.scale[i]))
            raw += z * bt.weights[i] + abs(z) * bt.weights[width + i] + min(z * z, 9) / 3 * bt.weights[2 * width + i]
        assert abs(got[r["doc_id"]] - 1 / (1 + np.exp(-min(40, max(-40, raw))))) < 1e-9


def test_toxicity_held_out_on_more_rows(spark):
    rows = QUERIES["op1_toxicity"][0](spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").toPandas()
    score, label = rows["score"].to_numpy(), rows["toxic"].to_numpy()
    assert _auc(score, label) > 0.95
    assert (rows["predicted"].to_numpy()[label == 1] == 1).mean() > 0.8
    assert (rows["predicted"].to_numpy()[label == 0] == 0).mean() > 0.99
