"""Mixing, license scans and outliers: brute force, odd rows, no Python in the plans."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.llm import licenses, mixing, outliers
from firmlens.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets_by_hand(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, target, open_ = 1.5 * sum(sizes.values()), {}, set(sizes)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if budget * weight[s] / total > 2 * sizes[s]}
        if not over:
            target |= {s: budget * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
        budget -= sum(target[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 5000, "c": 300, None: 40, "d": 0},
    {"x": 7}, {None: 3, "": 9}, {f"s{i:02}": (i * 37) % 11 * 1000 + 1 for i in range(20)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    want = _targets_by_hand(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i * 7919 % 90), f"s{i % 7 if i % 3 else 0}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = mixing.mix(docs, bins=4).collect(), mixing.mix(docs, bins=64).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in one) == sorted((r["doc_id"], r["taken"])
                                                                    for r in two)
    for source_size, target in {(r["source_size"], r["target"]) for r in one}:
        own = [r for r in one if r["source_size"] == source_size and r["target"] == target]
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own)
        assert all(r["taken"] <= 2 * r["size"] for r in own)
        epochs = int(target // source_size)
        assert {r["taken"] // r["size"] for r in own} <= {epochs, epochs + 1}


def test_better_documents_come_first(spark):
    docs = spark.createDataFrame([(i, "word " * 20 + "# " * (20 * (i % 2)), f"s{i % 6 // 2}")
                                  for i in range(4000)],
                                 "doc_id long, text string, source string")
    mixed = mixing.mix(docs, budget_share=0.5).collect()
    rows = [r for r in mixed if r["target"] < 0.5 * r["source_size"]]
    taken = Counter((r["doc_id"] % 2, r["copies"]) for r in rows)
    assert taken[0, 1] / (taken[0, 0] + taken[0, 1]) > 1.5 * taken[1, 1] / (taken[1, 0]
                                                                           + taken[1, 1])


def test_mix_of_odd_rows(odd, odd_rows, nothing):
    rows = mixing.mixed_documents(odd).collect()
    sizes = sorted(len(WORD.findall(r[1] or "")) for r in odd_rows)
    assert sorted(r["size"] for r in rows) == sizes
    taken = mixing.take(odd)
    assert taken.columns == odd.columns
    assert taken.count() == sum(r["copies"] for r in rows)
    assert mixing.mixed_documents(nothing).count() == 0 and mixing.take(nothing).count() == 0


def test_the_mix_holds_what_it_reports(spark):
    """Repeated ids, over two sources; equal rows at the end of a target; rows without an id."""
    rows = [(i % 400, f"w{i % 3} " * (1 + i % 40), f"s{i % 2}", i) for i in range(2000)]
    rows += [(7, "same words here", "s2", i) for i in range(300)] + [(None, "a b c", None, i) for i in range(50)]
    rows += [(None, None, None, 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mark int").repartition(4)
    stored = docs.cache()
    for share in (1.5, 0.4):
        taken = Counter()
        for r in mixing.mix(stored, budget_share=share).collect():
            taken[r["__source"]] += r["taken"]
        handed = Counter()
        for r in mixing.take(stored, budget_share=share).collect():
            handed[r["source"]] += len((r["text"] or "").split())
        assert +handed == +taken


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                      re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_base_places(spark, odd, odd_rows, nothing):
    texts = [r[1] for r in odd_rows] + [
        "MIT License, mit-license; the MIT\nLicense", "cc by cc by cc", "GNU General Public",
        "GNU GENERAL Public License gnu general public license v3 apache license",
        "Licensed under the Apache License, Version 2.0.", "mit licenses", "mité license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.license_documents(docs).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = _words(text)
        found = [(k, label) for label, phrase in licenses.BASE for k in range(len(words))
                 if words[k:k + len(phrase.split())] == phrase.split()]
        places = [k for k, _ in found]
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(words), len(found), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in found})))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1
    assert licenses.license_documents(odd).count() == len(odd_rows)
    assert licenses.license_documents(nothing).count() == 0


def test_spans_with_changes(spark):
    """Words put in, left out and replaced move the diagonal; far-off votes don't add up."""
    text = dict(licenses.TEMPLATES)["bsd-text"]
    words = text.split()
    texts = [text, " ".join(words[:9] + ["really"] + words[9:]), " ".join(words[:9] + words[10:]),
             " ".join(words[:12]) + " x" * 40 + " " + " ".join(words[12:]), " ".join(words[:8])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.license_documents(docs).collect()}
    assert [("bsd-text" in rows[i]["labels"]) for i in range(5)] == [True, True, True, False, False]
    assert rows[0]["score"] == 1.0 and rows[1]["score"] < 1.0


def test_a_phrase_said_again_votes_once(spark):
    texts = ["mit license " * 3, "all rights reserved " * 3, "all rights reserved", "the mit license " * 9,
             "x all rights reserved all rights reserved released under the new mit license " * 4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["labels"].split(",") for r in licenses.license_documents(docs).collect()}
    assert [("mit-line" in rows[i], "all-rights-reserved" in rows[i]) for i in range(5)] == [
        (False, False), (False, True), (False, True), (False, False), (True, True)]


def _counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_counts(spark, odd, odd_rows, nothing):
    texts = [r[1] for r in odd_rows] + [
        "a b c d e f g h " * 3, "a b c d e f g h a b c d e f g h", "x " * 30, "one two\n\none two\n ",
        "q w e r t y u i o p q w e r t y u i z q w e r t y u i", "# * $ % & | < >", "\x0b\x1c\xa0 z"]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    rows = {r["doc_id"]: r for r in outliers.judged(docs).collect()}
    for i, text in enumerate(texts):
        n, chars, symbols, lines, repeats = _counts(text)
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"]) == (n, chars, symbols, lines, repeats), text
        assert r["base_failed"] == (n < 20 or 100 * repeats > 30 * n)
        assert not (r["base_failed"] and r["kept"])
    assert outliers.judged(odd).count() == len(odd_rows)
    assert outliers.judged(nothing).count() == 0


def test_outliers_go_and_the_rest_stays(spark):
    rows = []
    for i in range(600):
        n = 60 + i * 7919 % 240
        words = [f"w{(i * 31 + k * 17) % 5000:04}" for k in range(n)]
        if i % 60 == 7:
            words = [w + "%%$$" for w in words]
        rows.append((i, " ".join(words), "en" if i % 3 else "de", "hot" if i % 4 else f"s{i % 8}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for steps in (1, 3):
        kept = {r["doc_id"]: r["kept"] for r in outliers.judged(docs, steps=steps).collect()}
        assert {i for i, k in kept.items() if not k} == {i for i in range(600) if i % 60 == 7}


def test_the_estimate_has_the_smallest_determinant(spark):
    """Against concentration steps from many random halves, with a third of the rows in a far clump."""
    rng = np.random.default_rng(5)
    ridge, p = (0.1, 0.1, 0.1), 3
    shape = np.array([[1.0, 0.8, 0.0], [0.0, 0.5, 0.3], [0.0, 0.0, 2.0]])
    groups = {}
    for g, share in (("a", 0.0), ("b", 0.33)):
        x = rng.normal(size=(600, p)) @ shape + 1.0
        x[:int(600 * share)] = rng.normal(size=(int(600 * share), p)) * 0.3 + [9, -7, 5]
        groups[g] = x

    def size(x, near):
        return np.linalg.slogdet(np.cov(x[near].T, bias=True) + np.diag(np.square(ridge)))[1]

    def steps(x, near):
        for _ in range(3):
            cov = np.cov(x[near].T, bias=True) + np.diag(np.square(ridge))
            far = x - x[near].mean(axis=0)
            near = np.argsort((far @ np.linalg.inv(cov) * far).sum(axis=1))[:len(x) // 2]
        return size(x, near)

    rows = spark.createDataFrame([(g, *map(float, r)) for g, x in groups.items() for r in x],
                                 "g string, x0 double, x1 double, x2 double")
    made = {r["g"]: r for r in outliers.covariance(rows, p, 3, 0.5, ridge, Scratch(spark, "test")).collect()}
    for g, x in groups.items():
        best = min(steps(x, rng.permutation(600)[:300 if k % 2 else 4]) for k in range(200))
        got = 2 * sum(np.log(made[g][f"l{i}{i}"]) for i in range(p))
        assert got < best + 0.1
    assert abs(made["b"]["m0"] - 1) < 0.5


@pytest.mark.parametrize("kind", ["symbols", "lines", "long words"])
def test_each_statistic_rejects_by_itself(spark, kind):
    rows = []
    for i in range(400):
        words = [f"w{(i * 31 + k * 17) % 5000:04}" for k in range(80 + i % 60)]
        if i % 50 == 7 and kind == "symbols":
            words = [w + "#$" for w in words]
        if i % 50 == 7 and kind == "long words":
            words = [w * 4 for w in words]
        text = " ".join(words)
        if i % 50 == 7 and kind == "lines":
            text += "\n\nmore\n" + "more\n" * 400 + " ".join(f"z{k}" for k in range(1500))
        rows.append((i, text, "en", "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in outliers.judged(docs).collect()}
    assert {i for i, k in kept.items() if not k} == {i for i in range(400) if i % 50 == 7}


def test_nothing_but_native_operators(spark, sf_dir):
    from firmlens.llm.catalog import QUERIES

    for name in ("op2_mixing", "op6_licenses", "op9_outliers"):
        plan = QUERIES[name][0](spark, sf_dir)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_words_are_counted_as_the_contract_says(spark):
    text = "a\x0bb\x1cc\xa0d e  f\n"
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(mixing.word_count(F.col("text"))).first()[0] == len(WORD.findall(text)) == 3
