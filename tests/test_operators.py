"""Operators against brute force on small random data, and each decided behaviour."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmlens.functions.names import clean_name
from firmlens.operators.batch import score_batch, spread
from firmlens.operators.evidence import (ITEM_ORDER, add_sections, assemble, dedupe_capped,
                                         dedupe_then_cap, merge_deep)
from firmlens.operators.extraction import classify, single_pass, three_pass
from firmlens.operators.lifecycle import category_counts, run_kpis, select_run
from firmlens.operators.mentions import (attach_companies, mentions_substring, mentions_words,
                                         unsearchable)
from firmlens.operators.screening import decide, keyword_near_name, keyword_pattern, score_of
from firmlens.params import LAYERED_SOURCES, SIGNAL_ROOTS, SOURCES, Params

# ---- mentions -----------------------------------------------------------------------------

WORDS = ["ab", "abc", "a", "art", "party", "ge", "corp", "bank", "xy z", "é", "O", "banking"]


def mention_data(spark):
    rng = random.Random(5)
    texts = [(i, rng.choice(["", "🚀 ", "\n"]) + rng.choice([" ", "  ", ", "]).join(
        rng.choice(WORDS) for _ in range(rng.randint(0, 12)))) for i in range(150)]
    names = sorted({" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 4)))
                    for _ in range(60)} | {"Group", "ge ge", "Partners Ltd", "AB", "ab"})
    return (texts, names, spark.createDataFrame(texts, "id int, t string"),
            spark.createDataFrame([(n,) for n in names], "company string"))


def cleaned(spark, companies):
    return {r[0]: r[1].lower() for r in companies.select(
        "company", clean_name(F.col("company"))).collect()}


@pytest.fixture(params=["-1", "10m"])  # everything shuffled, and broadcasts where Spark likes
def broadcasts(spark, request):
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, request.param)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset(name)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_substring_mentions(spark, broadcasts):
    texts, names, items, companies = mention_data(spark)
    keys = cleaned(spark, companies)
    want = {(i, n) for i, t in texts for n in names if keys[n] and keys[n] in t.lower()}
    got = mentions_substring(items, "id", F.col("t"), companies)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 100


def test_word_mentions(spark):
    texts, names, items, companies = mention_data(spark)
    keys = cleaned(spark, companies)
    def words(t):
        return " " + " ".join(re.sub(r"\W+", " ", t.lower()).split()) + " "
    want = {(i, n) for i, t in texts for n in names if keys[n] and words(keys[n]) in words(t)}
    rows = [tuple(r) for r in mentions_words(items, "id", F.col("t"), companies).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert {r[0] for r in unsearchable(companies).collect()} == {n for n in names if not keys[n]}


def test_feed_items_get_their_companies(spark):
    items = spark.createDataFrame(
        [(1, None, "Acme buys", "Bolt today", "u1"), (2, None, "quiet", "day", "u2"),
         (3, None, "the ac", "me split", "u3")],
        "id int, company string, title string, snippet string, url string")
    companies = spark.createDataFrame([("Acme Inc.",), ("BOLT",)], "company string")
    for words in (False, True):
        got = attach_companies(items, "id", companies, words=words).select(
            "id", "company", "url").collect()
        assert {tuple(r) for r in got} == {(1, "Acme Inc.", "u1"), (1, "BOLT", "u1")}
    joined = attach_companies(items, "id", companies, between="").filter("id = 3").collect()
    assert [r["company"] for r in joined] == ["Acme Inc."]


def test_repeated_and_missing_ids_keep_their_rows(spark, broadcasts):
    items = spark.createDataFrame(
        [(1, "acme one", "A"), (1, "acme two", "B"), (None, "blue sky is up", "C"),
         (None, None, "D"), (2, "big c.m (x) [y]*", "E"), (2, "big c.m (x) [y]*", "E")],
        "id int, t string, tag string")
    companies = spark.createDataFrame([("Acme",), ("blue sky",), ("y",), ("ig",), ("m",)],
                                      "company string")
    want = [(None, "C", "blue sky"), (None, "C", "y"), (1, "A", "Acme"), (1, "B", "Acme"),
            (1, "A", "m"), (1, "B", "m")] + 2 * [(2, "E", "y"), (2, "E", "ig"), (2, "E", "m")]
    got = mentions_substring(items, "id", F.col("t"), companies, carry=["tag"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    words = mentions_words(items, "id", F.col("t"), companies, carry=["tag"]).collect()
    assert sorted(map(str, map(tuple, words))) == sorted(map(str, [
        (None, "C", "blue sky"), (1, "A", "Acme"), (1, "B", "Acme")]
        + 2 * [(2, "E", "y"), (2, "E", "m")]))


def test_mentions_of_no_one(spark):
    items = spark.createDataFrame([(1, "x")], "id int, t string")
    nobody = spark.createDataFrame([("Group",)], "company string")
    assert mentions_substring(items, "id", F.col("t"), nobody).count() == 0
    assert mentions_words(items, "id", F.col("t"), nobody).count() == 0


# ---- keyword gate -------------------------------------------------------------------------


def near(name, text, pattern):
    low = text.lower()
    for s in re.split(r"[.\n!?]", low):
        m = name in s and pattern.search(s)
        if m:
            return m.group(0)
    for hit in re.finditer(re.escape(name), low):
        m = pattern.search(low[max(0, hit.start() - 300):hit.end() + 300])
        if m:
            return m.group(0)
    return None


def test_keyword_gate(spark):
    rng = random.Random(3)
    parts = ["acme", "Acme ", "divested", " undivested ", "buy-out", "exits", ". ", "\n", "? ",
             "x" * 120, "é" * 90, " ", "new hq", "closing", "énew name "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14))))
            for i in range(400)]
    df = spark.createDataFrame(rows, "i int, t string")
    got = {r[0]: r[1] for r in df.select("i", keyword_near_name(
        F.lit("Acme Ltd"), F.col("t"))).collect()}
    pattern = re.compile(r"\b(?:" + "|".join(SIGNAL_ROOTS) + r")\w*")
    want = {i: near("acme", t, pattern) for i, t in rows}
    assert got == want
    assert len({v for v in want.values()}) > 4
    # Names with pattern characters, and a name that cleans to nothing.
    odd = spark.createDataFrame([("A.C (x)\\E", "a.c (x)\\e exits"), ("AxC", "a.c exits"),
                                 ("Group", "group exits")], "c string, t string")
    assert [r[0] for r in odd.select(keyword_near_name(F.col("c"), F.col("t"))).collect()] == [
        "exits", None, None]


def test_decisions(spark):
    text = "Acme announces that it will exit the market for good this very year"
    rows = [("Acme", text), ("Bolt", text), ("Cold", ""), ("Acme Ltd", text), ("Acme plc", text)]
    answers = [("Acme", '{"score": 2, "reason": "r"}'), ("Acme Ltd", '{"score": "5"}'),
               ("Bolt", '{"score": 5}')]
    got = {r["company"]: (r["passed"], r["stage"], r["score"]) for r in decide(
        spark.createDataFrame(rows, "company string, headline_text string"),
        spark.createDataFrame(answers, "company string, raw string")).collect()}
    assert got == {"Acme": (False, "1C_llm", 2), "Bolt": (False, "1B_keyword", 0),
                   "Cold": (False, "no_content", 0), "Acme Ltd": (True, "passed", 5),
                   "Acme plc": (True, "passed", 3)}


def test_scores(spark):
    raws = {'```json\n{"score": 4}```': 4, '{"score": "4"}': 4, '{"score": 4.7}': 4,
            '{"score": 9}': 5, '{"score": 0}': 1, '{"score": null}': 3, '{"score": "4.7"}': 3,
            "text": 3, "{}": 3, '{"score": {"a": 1}}': 3, 'ok {"score": 2} so {"score": 5}': 2}
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = {r[0]: r[1] for r in df.select("raw", score_of(F.col("raw"))["score"]).collect()}
    assert got == raws


def test_default_pattern_compiles():
    assert keyword_pattern().startswith("(?U)")


# ---- evidence -----------------------------------------------------------------------------

SCHEMA = ("company string, source string, source_rank int, query_rank int, item_rank long, "
          "url string, title string, snippet string, domain string, raw_date string")


def take_turns(rows, sources):
    """The feeds one after another, as their fetchers would fill one company's list."""
    kept, seen = [], set()
    for s in sources:
        n, handed = 0, set()
        for q in range(1, s.queries + 1):
            mine = sorted(r for r in rows if r[2] == s.rank and r[3] == q)
            mine = sorted(mine, key=lambda r: r[4])[:s.page]
            for r in mine:
                if s.cap is not None and n >= s.cap and not s.overrun:
                    break
                if s.skip_empty and not r[5]:
                    continue
                handed.add(r[5])
                if s.checks and r[5] in seen:
                    continue
                kept.append(r)
                seen.add(r[5])
                n += 1
                if s.overrun and n >= s.cap:
                    break
        if s.marks_all:
            seen |= {r[5] for r in rows if r[2] == s.rank}
    return kept


@pytest.mark.parametrize("sources", [SOURCES, LAYERED_SOURCES])
def test_exact_caps(spark, sources):
    rng = random.Random(11)
    rows, serial = [], 0
    for company in ("A", "B", "C", "D"):
        urls = [f"u{i}" for i in range({"A": 12, "B": 60, "C": 300, "D": 25}[company])] + [""]
        for s in sources:
            for _ in range(rng.choice([0, 3, 25, 120])):
                serial += 1
                rows.append((company, s.name, s.rank, rng.randint(1, s.queries), serial,
                             rng.choice(urls), f"t{serial}", "", "", ""))
    df = spark.createDataFrame(rows, SCHEMA)
    got = dedupe_capped(df, sources).select("company", "item_rank").collect()
    want = {(c, r[4]) for c in "ABCD" for r in take_turns(
        [x for x in rows if x[0] == c], sources)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    fast = dedupe_then_cap(df, sources)
    assert fast.count() == fast.select("company", "url").distinct().count()


def item(company, source, rank, at, url, snippet="s", query=1):
    return (company, source, rank, query, at, url, "T", snippet, "d", "2024")


def test_contexts_and_deep_merge(spark):
    long = "x" * 16000
    rows = [item("A", "edgar", 1, 1, "e1", long), item("A", "gdelt", 3, 1, "g1"),
            item("A", "gdelt", 3, 2, "g2"), item("B", "gdelt", 3, 1, "g1")]
    base = assemble(add_sections(spark.createDataFrame(rows, SCHEMA)))
    a = base.filter("company = 'A'").first()
    assert a["char_count"] > 16000 and len(a["context"]) == 15000
    assert a["sources"] == ["e1", "g1", "g2"]
    assert a["headline_text"].splitlines() == [
        "=== SEC EDGAR ===", "[SEC EDGAR d] T — 2024", "=== GDELT NEWS ===",
        "[GDELT] T (2024) — d", "[GDELT] T (2024) — d"]
    assert set(a["source_breakdown"]) == {"edgar", "gdelt"}
    assert sum(a["source_breakdown"].values()) + len(
        "=== SEC EDGAR ===\n\n\n=== GDELT NEWS ===\n") == a["char_count"]
    deep = spark.createDataFrame(
        [item("A", "tavily", 9, i, f"d{i}") for i in range(1, 9)]
        + [item("A", "tavily", 9, 1, "g1", query=2), item("A", "tavily", 9, 2, "d1", query=2),
           item("B", "tavily", 9, 1, "d1")], SCHEMA)
    gated = base.withColumn("passed", F.col("company") == "A")
    new = {r["company"]: r for r in merge_deep(gated, deep).collect()}
    assert new["B"]["sources"] == ["g1"] and "tavily" not in new["B"]["source_breakdown"]
    assert new["A"]["sources"] == ["e1", "g1", "g2", "d1", "d2", "d3", "d4", "d5"]
    assert new["A"]["context"].endswith("[TAVILY] T\nd5\ns") and len(new["A"]["context"]) == 15000
    old = merge_deep(gated, deep, Params(compat=True)).filter("company = 'A'").first()
    assert old["context"] == a["context"] and old["char_count"] == new["A"]["char_count"]


# ---- answers ------------------------------------------------------------------------------

ANSWERS = "company string, pass string, chunk_idx long, signal string, raw string"


def contexts(spark, *names, text="word " * 40):
    return spark.createDataFrame([(n, text, ["u"]) for n in names],
                                 "company string, context string, sources array<string>")


def yes(signal, detail="d", conf=4, **kw):
    extra = "".join(f', "{k}": {v}' for k, v in kw.items())
    return ("A", "pass2", 0, signal,
            f'{{"confirmed": true, "detail": "{detail}", "confidence": {conf}{extra}}}')


def found(*signals, conf=3):
    named = ", ".join(f'"{s}"' for s in signals)
    return ("A", "pass1", 0, "", f'{{"detected": [{named}], "confidence": {conf}}}')


def run_three(spark, *answers, **kw):
    df = spark.createDataFrame(list(answers), ANSWERS)
    return three_pass(contexts(spark, "A"), df, Params(**kw)).first()


def test_three_pass_short_cuts(spark):
    none = "No significant corporate changes identified"
    assert run_three(spark, found()).summary == none + "."
    assert run_three(spark, found("renaming", conf=1), yes("renaming")).summary == none + "."
    unconfirmed = "Signals detected but none confirmed after extraction."
    assert run_three(spark, found("renaming")).summary == unconfirmed
    assert run_three(spark, found("renaming"), yes("renaming", conf=1)).summary == unconfirmed
    # An answer for a signal nobody named does not count; an unknown signal maps to nothing.
    assert run_three(spark, found("renaming"), yes("hq_change")).summary == unconfirmed
    assert run_three(spark, found("odd"), yes("odd")).summary == none + " after verification."
    assert run_three(spark, ("A", "pass1", 0, "", "broken {")).summary == none + "."


def test_three_pass_shutdown_order_and_score(spark):
    answers = [found("shutdown", "operational_change"), yes("shutdown", "closed", 5),
               yes("operational_change", "cuts", 2)]
    row = run_three(spark, *answers)
    assert row.shutdown and row.operational_change and row.total_signals == 1
    assert row.ops_detail == "cuts | closed" and row.summary == "ops: cuts | closed"
    assert row.confidence_score == 5
    old = run_three(spark, *answers, compat=True)
    assert not old.shutdown and old.operational_change and old.confidence_score == 0


def test_strict_answers(spark):
    assert not run_three(spark, found("renaming"), (
        "A", "pass2", 0, "renaming", '{"confirmed": "false", "confidence": 4}')).renaming
    assert run_three(spark, found("renaming"), yes("renaming", conf="null")).total_signals == 0
    single = [("A", "single", 0, "", '{"renaming": "false", "bankruptcy": true, '
                                     '"confidence": "3", "summary": "s"}')]
    row = single_pass(contexts(spark, "A", "B"), spark.createDataFrame(single, ANSWERS))
    rows = {r.company: r for r in row.collect()}
    assert rows["A"].bankruptcy and not rows["A"].renaming and rows["A"].summary == "s"
    assert rows["B"].summary == "[parse error] " and rows["B"].total_signals == 0


def test_classify_needs_context(spark):
    df = spark.createDataFrame([found("renaming"), yes("renaming")], ANSWERS)
    both = contexts(spark, "A").unionByName(contexts(spark, "B", text="short"))
    rows = {r.company: r for r in classify(both, df).collect()}
    assert rows["A"].renaming and rows["A"].sources == ["u"]
    assert rows["B"].summary == "Insufficient context to classify." and not rows["B"].renaming
    total = sum(rows["A"][s] for s in ("sector_change", "hq_change", "ma_spinoff", "renaming",
                                       "operational_change", "bankruptcy"))
    assert rows["A"].total_signals == total


# ---- runs and batches ---------------------------------------------------------------------


def test_empty_results(spark):
    empty = spark.createDataFrame([], T.StructType(
        [T.StructField(s, T.BooleanType()) for s in (
            "sector_change", "hq_change", "ma_spinoff", "renaming", "operational_change",
            "shutdown", "bankruptcy")]
        + [T.StructField("total_signals", T.IntegerType()),
           T.StructField("run_id", T.StringType()), T.StructField("error", T.StringType()),
           T.StructField("processed_at", T.TimestampType())]))
    assert select_run(empty, "latest").count() == 0
    assert tuple(run_kpis(empty).first()) == (0, 0, 0, 0.0)
    assert set(category_counts(empty).first()) == {None}
    assert set(category_counts(empty, null_when_empty=False).first()) == {0}


def test_score_batch_and_spread(spark):
    def setup():
        return lambda row: {"n": 10 // row["v"]}
    df = spark.createDataFrame([("a", 5), ("b", 0)], "company string, v int")
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    rows = {r["company"]: r for r in score_batch(spread(df, 50), setup, schema).collect()}
    assert rows["a"]["n"] == 2 and rows["a"]["error"] is None
    assert rows["b"]["n"] == 0 and "zero" in rows["b"]["error"]
    assert spread(df, 50).rdd.getNumPartitions() == 2


def test_item_order_is_total():
    assert ITEM_ORDER[-1] == "url"
