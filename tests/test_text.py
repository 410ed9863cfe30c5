"""Text functions against short restatements on random texts."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from firmlens.functions.names import clean_name, clean_name_light, normalise_words
from firmlens.functions.text import (decode_entities, first_headlines, fixed_chunks,
                                     headline_lines, paragraph_chunks, sanitise, shorten, strip)

ALPHABET = ["a", "é", "漢", "𝒳", " ", " ", ". ", "\n", "\n\n", "\n\n", "zz", "[", "=== ", "\t"]


def random_texts(n, longest, seed=7):
    rng = random.Random(seed)
    out = ["", "x", "\n\n", "\n\n\n\n", "a" * longest]
    out += ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest)))
            for _ in range(n)]
    return out


def evaluate(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["o"] for r in df.select("i", column(F.col("t")).alias("o")).orderBy("i").collect()]


def paragraphs(text, size, most, overlap):
    closed, open_, used = [], [], 0
    for p in text[:size * most + overlap].split("\n\n"):
        if open_ and used + len(p) + 2 > size:
            closed.append("\n\n".join(open_))
            if len(closed) == most:
                open_ = []
                break
            open_, used = open_[-1:], len(open_[-1])
        open_.append(p)
        used += len(p) + 2
    if open_ and text:
        closed.append("\n\n".join(open_))
    pieces = []
    for c in closed:
        pieces += [c] if len(c) <= size else [
            c[s:s + size] for s in range(0, len(c), size - overlap)]
    return pieces[:most]


@pytest.mark.parametrize("size,most,overlap", [(20, 3, 5), (8, 5, 2), (50, 2, 10)])
def test_paragraph_chunks(spark, size, most, overlap):
    texts = random_texts(400, 60)
    got = evaluate(spark, texts, lambda c: paragraph_chunks(c, size, most, overlap))
    for text, chunks in zip(texts, got):
        assert chunks == paragraphs(text, size, most, overlap), repr(text)
        assert len(chunks) <= most and all(len(c) <= size for c in chunks)


def test_fixed_chunks(spark):
    texts = random_texts(200, 60)
    got = evaluate(spark, texts, lambda c: fixed_chunks(c, 10, 4))
    for text, chunks in zip(texts, got):
        want = [text[i:i + 10] for i in range(0, min(len(text), 40), 10)]
        want = [w for w in want if w.strip()]
        assert chunks == (want or [text[:10]])


@pytest.mark.parametrize("n", [5, 12, 31])
def test_shorten(spark, n):
    texts = random_texts(300, 60)
    for text, got in zip(texts, evaluate(spark, texts, lambda c: shorten(c, n))):
        want = text
        if len(text) > n:
            cut = text[:n]
            dot = cut.rfind(". ")
            want = (cut[:dot + 1] if dot > n // 2 else cut) + " …"
        assert got == want, repr(text)


def test_headlines(spark):
    texts = random_texts(300, 40) + ["a\x85[x  === y\x1c[z", "\r\n [q]\r=== r"]
    for text, got in zip(texts, evaluate(spark, texts, headline_lines)):
        lines = [x.strip() for x in text.splitlines()]
        assert got == "\n".join(x for x in lines if x.startswith(("[", "==="))), repr(text)
    got = evaluate(spark, ["a\n[one\n[two"], lambda c: first_headlines(
        F.array(c, F.lit("none"), F.lit(" [three"))))
    assert got == ["[one\n[three"]


def test_sanitise(spark):
    texts = ["&lt;b&gt;x&lt;/b&gt; &eacute;&#233; y", "a\x00b\x07  c\t\td", "a\n\n\n\nb",
             "  x\xa0", "a<br>b &amp;lt; c", None, "&notin; &hearts &copy"]
    for text, got in zip(texts, evaluate(spark, texts, sanitise)):
        want = html.unescape(text or "")
        want = re.sub(r"<[^>]+>", " ", want)
        want = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "", want)
        want = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]{2,}", " ", want)).strip()
        assert got == want


def test_entities_as_the_standard_library_reads_them(spark):
    rng = random.Random(12)
    names = ["amp;", "amp", "eacute;", "eacute", "notin;", "notit;", "not", "copy", "NotEqualTilde;",
             "bogus;", "x", "l", "lt", "ltx;", "fjlig;", "trade;", "nbsp", "Amp;", "frac12"]
    numbers = ["#233;", "#233", "#8217;", "#x2019;", "#X1F600;", "#0;", "#13;", "#128;", "#x9f;", "#1;",
               "#55296;", "#1114112;", "#99999999999999999999;", "#xFFFFE;", "#xfdd0;", "#11;", "#x;",
               "#", "#x110000", "#0000000000000000065;"]
    texts = ["&" + n for n in names + numbers] + ["&amp;lt; &quot;&copy;", "a & b && c &;", "", "&"]
    texts += ["".join(rng.choice(["&" + rng.choice(names + numbers), "&", ";", " x", "<", "é", "\n"])
                      for _ in range(rng.randint(1, 9))) for _ in range(400)]
    assert evaluate(spark, texts, decode_entities) == [html.unescape(t) for t in texts]
    assert evaluate(spark, [None], decode_entities) == [None]


def test_strip(spark):
    texts = random_texts(50, 20) + ["\x1c\x1f x 　\x85"]
    assert evaluate(spark, texts, strip) == [t.strip() for t in texts]


NAMES = {
    "Partners Group": ("", "Partners"),
    "Marcopolo S.A.": ("Marcopolo S A", "Marcopolo S.A."),
    "Ngk Insulators, Ltd.": ("Ngk Insulators", "Ngk Insulators,"),
    "AT&T Inc.": ("AT T", "AT&T"),
    "Aam Holdings": ("Aam", "Aam"),
    "Société Générale Group": ("Société Générale", "Société Générale"),
    "Égroup": ("Égroup", "Égroup"),
    "Coca-Cola Co": ("Coca Cola", "Coca-Cola Co"),
}


def test_names(spark):
    names = list(NAMES)
    assert evaluate(spark, names, clean_name) == [NAMES[n][0] for n in names]
    assert evaluate(spark, names, clean_name_light) == [NAMES[n][1] for n in names]
    assert evaluate(spark, ["A-b,  C"], normalise_words) == ["a b c"]
