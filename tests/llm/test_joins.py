"""PartEnum join and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from firmlens.llm import part_enum, spelling

DOCS = "doc_id long, text string"


# ---- PartEnum -----------------------------------------------------------------------------


def _set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(
        c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def _links_by_hand(rows, percent=80):
    sets = [_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def _linked(spark, rows, **params):
    made = part_enum.linked_documents(spark.createDataFrame(rows, DOCS).repartition(4), **params)
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in made.collect()], key=str)


def _families(rng, groups):
    rows, n = [], 0
    for group in range(groups):
        base = [f"g{group}w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 9, 12, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 5, 20])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                kind, at = rng.random(), rng.randrange(len(words))
                if kind < 0.3:
                    words.insert(at, f"new{rng.random()}")
                elif kind < 0.6 and len(words) > 1:
                    words.pop(at)
                else:
                    words[at] = f"new{rng.random()}"
            rows.append((n, " ".join(words)))
            n += 1
    return rows


@pytest.mark.parametrize("part", [4096, 4])
def test_links_of_families(spark, part):
    rows = _families(random.Random(3), 25)
    assert _linked(spark, rows, part=part) == _links_by_hand(rows)


def test_linked_sets_share_a_signature():
    rng = random.Random(11)
    pairs = 0
    while pairs < 1500:
        base = {rng.getrandbits(64) for _ in range(rng.choice([4, 5, 6, 8, 9, 10, 12, 15, 20, 40, 100, 500]))}
        gone = rng.sample(sorted(base), rng.randint(0, max(1, len(base) // 6)))
        other = (base - set(gone)) | {rng.getrandbits(64) for _ in range(rng.randint(0, len(base) // 8 + 1))}
        if base == other or 100 * len(base & other) < 80 * len(base | other):
            continue
        pairs += 1
        element = np.array(sorted(base) + sorted(other), "u8")
        owner = np.repeat([0, 1], [len(base), len(other)])
        mark, text, spare = part_enum.signatures(element, owner, 2, 80)
        common = set(mark[text == 0].tolist()) & set(mark[text == 1].tolist())
        # By the kind of signature: as many as either can spare, of the kind that both have.
        held = [sum(m & 1 == odd for m in common) for odd in (0, 1)]
        assert any(held[odd] >= max(spare[:, odd]) > 0 for odd in (0, 1) if spare[:, odd].all())


def test_sketches_never_refute_a_link():
    rng = random.Random(4)
    for _ in range(200):
        a = {rng.getrandbits(64) for _ in range(rng.choice([5, 50, 2000]))}
        b = set(rng.sample(sorted(a), max(1, len(a) * 9 // 10))) | {rng.getrandbits(64) for _ in range(3)}
        element = np.array(sorted(a) + sorted(b), "u8")
        sketch = part_enum.sketches(element, np.repeat([0, 1], [len(a), len(b)]), 2).view("u8")
        apart = sum(int(x ^ y).bit_count() for x, y in zip(*sketch))
        assert apart <= len(a ^ b)


def test_one_family_of_many_near_copies(spark):
    """Only a family's base text joins some of them; many classes share signatures."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for d in range(1, 260):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 3, 4])):
            words[at] = f"x{d}y{at}"
        rows.append((d, " ".join(words)))
    assert _linked(spark, rows) == _links_by_hand(rows)


def test_a_family_of_sets_too_large_for_sketches(spark):
    rng = random.Random(12)
    rows = []
    for d in range(24):
        words = [f"b{i}" for i in range(rng.choice([1100, 1300, 1400]))]
        for at in rng.sample(range(len(words)), rng.choice([5, 20, 30, 60])):
            words[at] = f"x{d}y{at}"
        rows.append((d, " ".join(words)))
    by_hand = _links_by_hand(rows)
    assert 1 < len({r[2] for r in by_hand}) < len(rows)
    assert _linked(spark, rows) == by_hand


def test_links_of_odd_rows(spark, odd, odd_rows, nothing):
    made = part_enum.linked_documents(odd)
    got = sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in made.collect()], key=str)
    assert got == _links_by_hand([r[:2] for r in odd_rows])
    assert part_enum.linked_documents(nothing).count() == 0


# ---- spelling -----------------------------------------------------------------------------


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _forms_by_hand(rows, every=199, least_chars=6, least_n=5, ratio=5):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(fold)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_n}
    forms, near_counts = {}, defaultdict(int)
    for w, n in words.items():
        near = sorted((-words[v], v) for v in words if _near(w, v))
        near_counts[w] = len(near)
        if near and -near[0][0] >= ratio * n:
            forms[w] = near[0][1]
    out = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        out.append((w, form, root, n, near_counts[w], words[form] if form else None))
    return sorted(out)


def _formed(docs, **params):
    made = spelling.spelling_forms(docs, **params)
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
                  for r in made.collect())


@pytest.mark.parametrize("symbols", [None, 2, 9])
def test_forms_of_random_words(spark, symbols):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcéÿ") for _ in range(rng.choice([6, 6, 7, 8]))) for _ in range(60)]
    rows = []
    for d in range(80):
        picked = [words[int(len(words) * rng.random() ** 3)] for _ in range(120)]
        for k in range(0, 120, 7):
            at = rng.randrange(len(picked[k]))
            picked[k] = picked[k][:at] + rng.choice(["", "a", "é", "xa"]) + picked[k][at + 1:]
        rows.append((d, rng.choice([" ", "-", "×, 1 "]).join(picked).replace("a", rng.choice("aA"))))
    # A word whose form has a form.
    rows += [(d, "chained " * 50 + "chainez " * 8 + "chainezz") for d in range(80, 90)]
    made = _formed(spark.createDataFrame(rows, DOCS).repartition(3), every=19, symbols=symbols)
    assert made == _forms_by_hand(rows, every=19)
    assert any(r[1] and r[1] != r[2] for r in made) and any(r[1] is None for r in made)


def test_neighbourhood_holds_all_words_at_one_edit():
    rng = random.Random(1)
    for _ in range(50):
        word = [rng.randint(1, 4) for _ in range(rng.choice([1, 2, 6, 30]))]
        near = {tuple(word)} | {tuple(word[:i] + word[i + 1:]) for i in range(len(word))}
        for c in range(1, 5):
            near |= {tuple(word[:i] + [c] + word[i + 1:]) for i in range(len(word))}
            near |= {tuple(word[:i] + [c] + word[i:]) for i in range(len(word) + 1)}
        made = spelling.neighbourhood(np.array([word], "u8"), 4)[0]
        alone = {int(spelling.neighbourhood(np.array([w], "u8"), 0)[0, 0]) for w in near if w}
        # The empty word, near every word of one letter, is no word.
        assert set(made.tolist()) == alone


def test_spelling_of_odd_rows(spark, odd, odd_rows, nothing):
    assert _formed(odd, least_chars=3, least_n=1) == _forms_by_hand(
        [r[:2] for r in odd_rows], least_chars=3, least_n=1)
    assert _formed(nothing) == []


def test_very_long_words(spark):
    long = "ab" * 20_000
    rows = [(d, " ".join([long, long[:-1] + "c"])) for d in range(6)] + [(9, long)]
    got = _formed(spark.createDataFrame(rows, DOCS), every=10 ** 9, least_n=5, ratio=1)
    assert [(r[0] == long, r[3], r[4]) for r in got] == [(True, 7, 1), (False, 6, 1)]
    assert got[1][1] == long
