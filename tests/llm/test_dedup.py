"""Line, near-duplicate and span dedup against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.llm import dart_minhash, line_runs, sentence_spans
from firmlens.llm.common import Scratch, components

DOCS = "doc_id long, text string"


def _lines_by_hand(rows, min_chars=20, min_docs=3):
    least = -1
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line_runs.line_key(line)
            if len(key) >= min_chars:
                holders[key].add(least if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(line_runs.line_key(line), ())
            if len(held) < min_docs or max(held) == (least if doc is None else doc):
                kept.append(line)
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def _dedup(spark, rows, **params):
    made = line_runs.dedup_lines(spark.createDataFrame(rows, DOCS), **params)
    return sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in made.collect()],
                  key=str)


def test_lines_in_many_batches(spark):
    rng = random.Random(4)
    shared = [f"this line number {i} is long enough" for i in range(40)]
    rows = [(d, "\n".join(rng.choice([rng.choice(shared), rng.choice(shared).upper() + " \t",
                                      "short", f"only in document {d} and nowhere"])
                          for _ in range(rng.randint(0, 12)))) for d in range(120)]
    for params in ({"batches": 1}, {"batches": 7, "buckets": 4}):
        assert _dedup(spark, rows, **params) == _lines_by_hand(rows)


def test_runs_are_levelled_and_disjoint(spark):
    runs = line_runs.LineRuns(Scratch(spark, "test"), buckets=4, fanout=2)
    for k in range(5):
        runs.add(spark.createDataFrame([(k * 10 + i, i % 6 + k, 1) for i in range(10)],
                                       "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    names = [n for level in runs.levels for n in level]
    hashes = [r["h1"] for n in names for r in spark.table(n).collect()]
    assert len(hashes) == len(set(hashes)) == 10
    runs.close()


def test_lines_of_odd_rows(spark, odd, odd_rows, nothing):
    made = line_runs.dedup_lines(odd)
    got = sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in made.collect()],
                 key=str)
    assert got == _lines_by_hand([r[:2] for r in odd_rows])
    assert made.columns.count("n_lines") == 1
    assert line_runs.dedup_lines(nothing).count() == 0


def _near_by_hand(rows, width=5, least=0.8):
    sets = []
    for _, text in rows:
        words = dart_minhash.plain_words(text)
        sets.append({tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}
                    if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= least * len(a | sets[j]):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    return {frozenset(m) for m in members.values()}


def _near_rows():
    rng = random.Random(6)
    rows, n = [], 0
    for group in range(25):
        base = [f"g{group}w{rng.randint(0, 400)}" for _ in range(rng.choice([4, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 5, 20])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                words[rng.randrange(len(words))] = f"new{rng.random()}"
            rows.append((n, " ".join(words)))
            n += 1
    return rows


@pytest.mark.parametrize("part", [4096, 8])
def test_near_classes(spark, part):
    rows = _near_rows()
    made = dart_minhash.near_classes(spark.createDataFrame(rows, DOCS), part=part).collect()
    got = defaultdict(list)
    for r in made:
        got[r["class_id"]].append(r["doc_id"])
    assert {frozenset(m) for m in got.values()} == _near_by_hand(rows)
    assert all(k == min(m) for k, m in got.items())
    assert sorted(r["doc_id"] for r in made if r["kept"]) == sorted(got)
    assert all(r["class_size"] == len(got[r["class_id"]]) for r in made)


@pytest.mark.parametrize("part", [4096, 64])
def test_one_text_quoted_by_many_dissimilar_documents(spark, part):
    """Each is similar (0.82) to the text, none (0.69) to another: one class by way of the text."""
    text = " ".join(f"w{i}" for i in range(104))
    rows = [(0, text)] + [(d, text + "".join(f" d{d}t{i}" for i in range(22)))
                          for d in range(1, 3001)]
    made = dart_minhash.near_classes(spark.createDataFrame(rows, DOCS).repartition(8), part=part)
    assert {(r["class_id"], r["class_size"]) for r in made.collect()} == {(0, 3001)}


def test_candidates_of_the_exact_join_hold_every_link(spark):
    rng = random.Random(12)
    sets = []
    for _ in range(300):
        pool = range(rng.choice([0, 0, 40]), 60)
        sets.append(sorted(rng.sample(pool, rng.randint(1, 20))))
        sets.append(sorted(set(sets[-1][1:]) | {rng.choice(pool)}))
    rows = [(bytes([i // 256, i % 256]), bytes([i % 7]), s) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "node binary, root binary, elements array<int>")
    for part in (4096, 4):
        made = dart_minhash._candidates(df, 0.8, part, Scratch(spark, "test"))
        got = {frozenset((bytes(r["u"]), bytes(r["v"]))) for r in made.collect()}
        want = {frozenset((a[0], b[0])) for i, a in enumerate(rows) for b in rows[:i] if a[1] != b[1]
                and 10 * len(set(a[2]) & set(b[2])) >= 8 * len(set(a[2]) | set(b[2]))}
        assert want and want <= got
        root = {n: r for n, r, _ in rows}
        assert all(len({root[n] for n in pair}) == 2 for pair in got)


@pytest.mark.parametrize("weights", ["set", "count"])
def test_signatures_agree_as_often_as_texts_are_similar(weights):
    rng = np.random.default_rng(5)
    for n in (30, 300, 3000):
        a = [f"w{i}" for i in rng.integers(0, 10 ** 6, n)]
        b = list(a)
        for i in rng.choice(n, max(1, n // 50), replace=False):
            b[i] = f"other{i}"
        a += a[: n // 2]
        _, element, weight, owner = dart_minhash.elements_of([" ".join(a), " ".join(b)], 5, weights)
        marks = dart_minhash.signatures(element, weight, owner, 2, 2000)
        assert (marks != 0).all()
        one, two = (dict(zip(element[owner == i].tolist(), weight[owner == i])) for i in (0, 1))
        keys = set(one) | set(two)
        true = (sum(min(one.get(x, 0), two.get(x, 0)) for x in keys)
                / sum(max(one.get(x, 0), two.get(x, 0)) for x in keys))
        assert abs((marks[0] == marks[1]).mean() - true) < 0.05


def test_near_duplicates_of_odd_rows(odd, odd_rows, nothing):
    rows = {(r["doc_id"], r["class_id"], r["kept"]) for r in
            dart_minhash.near_documents(odd).collect()}
    assert {(1, 1, True), (2, 1, False), (None, 1, False), (4, 4, True), (5, 5, True)} <= rows
    kept = dart_minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    texts = sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=str)
    gone = [(2, odd_rows[1][1]), (None, odd_rows[6][1]), (8, "dup")]
    want = [r[:2] for r in odd_rows]
    for g in gone:
        want.remove(g)
    assert texts == sorted(want, key=str) or texts == sorted(
        [w for w in want if w[0] != 3], key=str)
    assert dart_minhash.near_documents(nothing).count() == 0
    assert dart_minhash.drop_near_duplicates(nothing).count() == 0


def test_kept_texts_are_shuffled_once(spark):
    rows = [(d, f"text number {d // 2} of some that come twice") for d in range(40)]
    rows += [(0, rows[0][1]), (None, rows[2][1]), (None, "only here"), (None, "only here"), (50, " "), (50, " ")]
    made = dart_minhash.drop_near_duplicates(spark.createDataFrame(rows, DOCS))
    got = sorted(((r["doc_id"], r["text"]) for r in made.collect()), key=str)
    assert got == sorted([*rows[0:40:2], (None, "only here"), (50, " "), (50, " ")], key=str)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = made.select("*")._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # The texts' own exchange and that of the ids; no other one for the rows that repeat.
    assert sum("Exchange" in x for x in lines) == 2


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80))
                                               for _ in range(50)] + [(300, k) for k in range(301, 340)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a)
        root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"), "c")
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in got.collect()} == {n: root[n] for n in linked}


def _spans_by_hand(rows, min_words):
    """Every run that the definition names, hashed as text, first places by id and place."""
    seen, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    made = {}
    for i in order:
        parts = sentence_spans.sentences(rows[i][1])
        runs = sorted((a, b) for a, b, _ in sentence_spans.spans(parts, min_words))
        made[i] = [(a, b, " ".join("".join(parts[a:b + 1]).lower().split())) for a, b in runs]
    for i in order:
        for _, _, key in made[i]:
            seen.setdefault(key, i)
    for i, (doc, _) in enumerate(rows):
        met, gone = set(), set()
        for a, b, key in made[i]:
            if key in met or seen[key] != i:
                gone.update(range(a, b + 1))
            met.add(key)
        parts = sentence_spans.sentences(rows[i][1])
        out.append((doc, "".join(p for k, p in enumerate(parts) if k not in gone), len(parts),
                    sorted(gone)))
    return sorted(out, key=str)


def test_spans(spark):
    rng = random.Random(9)

    def sentence():
        return " ".join(f"v{rng.randint(0, 3000)}" for _ in range(rng.randint(1, 25))) + "."

    passages = [" ".join(sentence() for _ in range(rng.randint(3, 9))) for _ in range(12)]
    rows = [(d, " ".join(rng.choice([sentence(), sentence() + "\n", rng.choice(passages)])
                         for _ in range(rng.randint(0, 12)))) for d in range(80)]
    made = sentence_spans.dedup_spans(spark.createDataFrame(rows, DOCS)).collect()
    got = sorted([(r["doc_id"], r["text"], r["n_sentences"], r["removed"]) for r in made], key=str)
    assert got == _spans_by_hand(rows, 20)
    kept = defaultdict(set)
    for doc, text, _, _ in got:
        words = text.split()
        for i in range(len(words) - 49):
            kept[tuple(words[i:i + 50])].add(doc)
    assert all(len(docs) == 1 for docs in kept.values())


def test_every_passage_is_covered():
    """Whatever stands around it, a shared passage is covered whole by spans of its own."""
    rng = random.Random(10)
    for _ in range(300):
        passage = [" ".join(f"p{rng.random()}" for _ in range(rng.randint(1, 24))) + ". "
                   for _ in range(rng.randint(3, 8))]
        if len(" ".join(passage).split()) < 20:
            continue
        made = []
        for _ in range(2):
            before = ["".join(f"x{rng.random()} " for _ in range(rng.randint(1, 9))) + ". "
                      for _ in range(rng.randint(0, 4))]
            after = ["".join(f"y{rng.random()} " for _ in range(rng.randint(1, 9))) + ". "
                     for _ in range(rng.randint(0, 4))]
            spans = sentence_spans.spans(before + passage + after, 20)
            made.append({h: (a - len(before), b - len(before)) for a, b, h in spans})
        common = [made[0][h] for h in made[0].keys() & made[1].keys()]
        covered = {k for a, b in common for k in range(a, b + 1)}
        assert covered == set(range(len(passage)))


def test_spans_of_odd_rows(odd, odd_rows, nothing):
    made = sentence_spans.dedup_spans(odd)
    rows = sorted([(r["doc_id"], r["text"], r["n_sentences"], r["removed"]) for r in
                   made.collect()], key=str)
    assert rows == _spans_by_hand([r[:2] for r in odd_rows], 20)
    assert sentence_spans.dedup_spans(nothing).count() == 0


def test_spans_of_rows_without_or_with_the_same_id(spark):
    story = ("The first sentence of this story is quite long and calm. The second one adds some more words "
             "to it. A third one ends the whole passage at last.")
    rows = [(None, story), (None, story), (None, story + " More of it."), (3, story), (3, story)]
    for part in (rows[:3], rows):
        made = sentence_spans.dedup_spans(spark.createDataFrame(part, DOCS).coalesce(1)).collect()
        got = sorted([(r["doc_id"], r["text"], r["n_sentences"], r["removed"]) for r in made], key=str)
        assert got == _spans_by_hand(part, 20)
        assert sum("The second one" in r["text"] for r in made) == 1


def test_a_family_of_near_copies_leaves_few_pairs_to_verify(spark):
    """Most pairs of the family are not quite similar enough: the sketches tell, inside the join."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for d in range(400):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 3])):
            words[at] = f"x{d}y{at}"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, DOCS)
    made = dart_minhash.near_classes(docs).collect()
    classes = defaultdict(list)
    for r in made:
        classes[r["class_id"]].append(r["doc_id"])
    assert {frozenset(m) for m in classes.values()} == _near_by_hand(rows)
    sets = dart_minhash.element_sets(docs, 5, "set")
    lone = sets.withColumn("root", F.col("node")).cache()
    pairs = dart_minhash._candidates(lone, 0.8, 4096, Scratch(spark, "test")).distinct()
    linked = dart_minhash._linked(pairs.select(F.col("u").alias("a"), F.col("v").alias("b")), sets, 0.8)
    assert pairs.count() < 1.3 * linked.count() + 100
