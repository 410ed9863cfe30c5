"""Ranked search against brute force, and that it stops early."""

import math
import random
import re
from collections import Counter

import numpy as np

from firmlens.llm import best_position as bp

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return TERM.findall((text or "").translate(fold))


def _by_hand(docs, items, top):
    counted = [(doc, Counter(_terms(text))) for doc, text in docs]
    counted = [(doc, c, sum(c.values())) for doc, c in counted if c]
    n, total = len(counted), sum(size for _, _, size in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        query = Counter(_terms(text))
        scored = []
        for doc, c, size in counted:
            m = 75 + (25 * size * n) // total
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                        for t, k in query.items() if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def _rows(found):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()],
                  key=str)


def _words(rng, n):
    return " ".join(f"w{int(60 * rng.random() ** 3)}" for _ in range(n))


def test_ranks_of_random_texts(spark):
    rng = random.Random(5)
    docs = [(d, _words(rng, rng.choice([1, 3, 20, 200]))) for d in range(600)]
    docs += [(600 + d, docs[d % 4][1]) for d in range(150)]  # ties
    items = [(i, _words(rng, 6) + " nowhere w1 w1") for i in range(12)] + [(12, "absent"), (13, None)]
    made = bp.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                     spark.createDataFrame(items, "item_id long, text string"), shard=64, block=5)
    assert _rows(made) == _by_hand(docs, items, 20)


def test_search_of_odd_rows(spark, odd, odd_rows, nothing):
    items = [(1, "The story of the naïve 日本語 END"), (1, "dup"), (None, "short other"), (4, ""), (5, None)]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id",
                                                                                 "1 AS score")
    made = _rows(bp.search(odd, asked))
    assert made == _by_hand([r[:2] for r in odd_rows], items, 20)
    assert bp.search(nothing, asked).count() == 0
    assert bp.search(odd, asked.limit(0)).count() == 0


def test_terms_of_bytes():
    text = "Ab-c 1x\x00é中, Z_z\x7f·k İstanbul ａ\n\u0085q"
    assert [t.decode() for t in bp.terms(text.encode())] == _terms(text)


def _shard(rng, n_docs, n_terms):
    lists = [sorted(rng.sample(range(n_terms), rng.randint(1, n_terms))) for _ in range(n_docs)]
    times = [[rng.randint(1, 9) if rng.random() < 0.2 else 1 for _ in x] for x in lists]
    sizes = np.array([sum(t) + rng.randint(0, 50) for t in times])
    ends = np.cumsum([0] + [len(x) for x in lists])
    weight = np.array([rng.randint(0, 5000) for _ in range(n_terms)])
    return bp.Shard(sizes, ends, np.concatenate(lists), np.concatenate(times), weight, n_docs,
                    int(sizes.sum())), lists


def test_no_better_document_is_left_unseen():
    rng = random.Random(8)
    for _ in range(40):
        shard, lists = _shard(rng, rng.choice([5, 300, 2000]), 12)
        query = np.array(sorted(rng.sample(range(12), rng.randint(1, 5))))
        repeats = np.array([rng.randint(1, 3) for _ in query])
        full = np.zeros(len(lists), "i8")
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        for q, k in zip(query, repeats):
            at = shard.term == q
            full[owner[at]] += k * shard.impact[at]
        best = np.sort(full)[::-1]
        last = max(1, best[9] if len(best) > 9 else 1)
        for floor in (0, int(last)):
            docs, scores, _ = shard.search(query, repeats, 10, floor, portion=2)
            assert (full[docs] == scores).all()
            assert set(np.flatnonzero(full >= last)) <= set(docs)


def test_search_stops_before_the_lists_end():
    rng = random.Random(2)
    shard, lists = _shard(rng, 20_000, 6)
    _, _, entries = shard.search(np.array([0]), np.array([1]), 10)
    assert entries < len([x for x in lists if 0 in x])
