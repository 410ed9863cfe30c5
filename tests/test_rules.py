"""Nothing is dropped in silence: streams, unknown feeds, checkpoints, repeated runs and answers."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from firmlens.functions.jsonio import flag_field, truth
from firmlens.operators.evidence import cap_per_source, dedupe_capped
from firmlens.operators.extraction import single_pass, three_pass
from firmlens.operators.screening import decide
from firmlens.params import SOURCES, Params
from firmlens.plans.run import base_contexts
from firmlens.sources import results
from firmlens.streaming.ingest import dedupe_stream, item_stream, rejected, start_ingest

ITEM = ("company string, source string, source_rank int, query_rank int, item_rank long, url string, "
        "title string, snippet string, domain string, raw_date string")


def item(company="a", source="gdelt", rank=3, n=1, url="u", day="2024-06-01"):
    return (company, source, rank, 1, n, url, f"t{n}", "", "", day)


def test_stream_keeps_old_news_and_items_without_url(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    deliveries = [
        [item(url="u1", day="2024-06-01"), item(url="", source="edgar", rank=1, n=1)],
        [item(url="u2", day="2024-06-02"), item(url="", source="edgar", rank=1, n=2),
         item(url="", source="edgar", rank=1, n=1)],
        [item(url="u3", day="2024-03-01"), item(url="u1", n=9), item(url="", n=5)]]
    for rows in deliveries:
        spark.createDataFrame(rows, ITEM).coalesce(1).write.mode("append").parquet(landed)
    schema = spark.read.parquet(landed).schema
    stream = dedupe_stream(item_stream(spark, landed, schema, max_files=1))
    start_ingest(stream, out, str(tmp_path / "cp")).awaitTermination(120)
    got = sorted((r["source"], r["url"], r["item_rank"] if not r["url"] else 0)
                 for r in spark.read.parquet(out).collect())
    assert got == [("edgar", "", 1), ("edgar", "", 2), ("gdelt", "u1", 0), ("gdelt", "u2", 0),
                   ("gdelt", "u3", 0)]
    assert [tuple(r) for r in rejected(spark.read.parquet(landed)).collect()] == [("gdelt", 1)]


@pytest.mark.parametrize("caps", [dedupe_capped, cap_per_source])
def test_unknown_feed_is_an_error(spark, caps):
    rows = spark.createDataFrame([item(), item(source="newfeed", url="v")], ITEM)
    with pytest.raises(Exception, match="no such feed among the sources: newfeed"):
        caps(rows).collect()
    assert caps(rows.filter("source = 'gdelt'")).count() == 1
    with pytest.raises(Exception, match="newfeed"):
        base_contexts(spark.createDataFrame([("a",)], "company string"), rows).collect()


def test_only_an_absent_checkpoint_is_empty(spark, tmp_path):
    assert results.read_checkpoint(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        results.read_checkpoint(spark, str(tmp_path / "bad")).count()
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        results.read_checkpoint(spark, str(tmp_path / "empty"))


def test_a_run_written_again_replaces_itself(spark):
    spark.sql("DROP TABLE IF EXISTS rerun")
    results.create_table(spark, "rerun")
    rows = spark.createDataFrame([("a", True), ("b", False)], "company string, renaming boolean")
    results.append_run(rows, "rerun", "one")
    results.append_run(rows, "rerun", "two")
    results.append_run(rows.filter("renaming"), "rerun", "one")
    got = sorted((r["run_id"], r["company"], r["renaming"])
                 for r in results.read_results(spark, "rerun").collect())
    assert got == [("one", "a", True), ("two", "a", True), ("two", "b", False)]
    spark.sql("DROP TABLE rerun")


def test_truth(spark):
    values = {"true": (1, 1), "false": (0, 0), "1": (1, 1), "0": (0, 0), "0.5": (1, 1), "null": (0, 0),
              '"yes"': (1, 1), '"True"': (1, 1), '"false"': (0, 1), '"No "': (0, 1), '"0"': (0, 1),
              '""': (0, 0), "[]": (0, 0), "[0]": (1, 1), "{}": (0, 0), '{"ok": 1}': (1, 1)}
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    for plain in (False, True):
        got = {r["v"]: (r["a"], r["b"]) for r in rows.select(
            "v", truth(F.parse_json("v"), plain).alias("a"),
            flag_field(F.parse_json(F.concat(F.lit('{"x": '), "v", F.lit("}"))), "x", plain)
            .alias("b")).collect()}
        assert got == {v: (bool(w[plain]),) * 2 for v, w in values.items()}
    missing = spark.range(1).select(flag_field(F.parse_json(F.lit('{"y": 1}')), "x")).first()[0]
    assert missing is False


def test_repeated_answers_count_once(spark):
    base = spark.createDataFrame([("a", "a " * 60, ["u"])],
                                 "company string, headline_text string, sources array<string>")
    screen = spark.createDataFrame([("a", '{"score": 1}', 2), ("a", '{"score": 5}', 1)],
                                   "company string, raw string, answered_at int")
    text = F.concat(F.col("headline_text"), F.lit(" a merger of a."))
    rows = decide(base.withColumn("headline_text", text), screen).collect()
    assert [(r["passed"], r["score"]) for r in rows] == [(False, 1)]
    answers = spark.createDataFrame(
        [("a", "single", 0, "", '{"confidence": 4, "renaming": true, "summary": "new"}', 2),
         ("a", "single", 0, "", '{"confidence": 4, "bankruptcy": true, "summary": "old"}', 1),
         ("a", "pass1", 0, "", '{"detected": ["renaming"], "confidence": 4}', 1),
         ("a", "pass2", 0, "renaming", '{"confirmed": "yes", "detail": "d", "confidence": 3}', 1),
         ("a", "pass3", 0, "", '{"verified": {"renaming": "true"}}', 2),
         ("a", "pass3", 0, "", '{"verified": {"renaming": false}}', 1)],
        "company string, pass string, chunk_idx long, signal string, raw string, answered_at int")
    contexts = base.select("company")
    for params in (Params(), Params(compat=True)):
        one = single_pass(contexts, answers, params).collect()
        assert [(r["renaming"], r["bankruptcy"], r["summary"]) for r in one] == [
            (True, False, "new")]
        three = three_pass(contexts, answers, params).collect()
        assert [(r["renaming"], r["rename_detail"]) for r in three] == [(True, "d")]


def test_feeds_are_ranked_before_any_company_join(spark):
    """With broadcasts off, every exchange of items stands above a partial rank limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([item(source=s.name, rank=s.rank, n=i, url=f"u{i}")
                                      for i in range(5) for s in SOURCES], ITEM)
        companies = spark.createDataFrame([("a",)], "company string")
        df = base_contexts(companies, rows)
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("LeftSemi"):]
        assert "WindowGroupLimit" in below and "Partial" in below
        assert df.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_is_written_from_one_evaluation(spark, tmp_path):
    from firmlens.params import EMPTY_VIEW_TEXT
    from firmlens.plans.report import report_run

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    columns = {f.name: f for f in results.RESULT_SCHEMA}
    rows = results.conform(spark.createDataFrame(
        [("a", True, "merged"), ("b", False, ""), ("c", True, "bought")],
        "company string, ma_spinoff boolean, ma_detail string"))
    rows = rows.withColumn("sources", F.array(F.lit("u")))
    counted = rows.mapInPandas(count, rows.schema)
    report_run(counted, str(tmp_path / "r"), F.lit("now"), F.lit("12 months"), F.lit(61.0))
    assert seen.value == 3 and len(columns) == 22
    read = {name: spark.read.parquet(str(tmp_path / "r" / name)).collect() for name in (
        "dashboard", "ma_spinoffs", "sector_changes", "renaming_rebranding", "bankruptcy",
        "hq_changes", "operational_changes", "run_stats")}
    assert sorted(r["company"] for r in read["ma_spinoffs"]) == ["a", "c"]
    assert len(read["dashboard"]) == 3 and len(read["run_stats"]) == 14
    for name in ("sector_changes", "hq_changes", "operational_changes", "bankruptcy"):
        assert [r["company"] for r in read[name]] == [EMPTY_VIEW_TEXT]


def test_run_from_landed_feeds(spark):
    """The press item finds its company, old news stays out, the sector comes along."""
    from firmlens.plans.run import run_feeds

    rows = [(None, "prnewswire", 5, 1, 1, "p1", "Acme merger", "acme buys all " * 9, "", "20 years ago"),
            ("Acme", "guardian", 4, 1, 2, "g1", "Acme merger news", "x" * 90, "", "2024-05-01"),
            ("Acme", "guardian", 4, 1, 3, "g2", "Acme merger olds", "x" * 90, "", "2023-01-01"),
            ("Acme", "edgar", 1, 1, 4, "e1", "Acme 10-K", "y" * 90, "10-K", "2024-05-01")]
    companies = spark.createDataFrame([(0, "Acme", "Tools"), (1, "Bolt", "Nails")],
                                      "input_pos long, company string, sector string")
    none = spark.createDataFrame([], "company string, raw string")
    answers = spark.createDataFrame(
        [], "company string, pass string, chunk_idx long, signal string, raw string")
    as_of = F.lit("2024-06-30").cast("timestamp")
    for months, urls in ((6, ["g1", "p1"]), (24, ["g1", "g2", "p1"])):
        got = {r["company"]: r for r in run_feeds(
            companies, spark.createDataFrame(rows, ITEM), none, answers, as_of,
            Params(horizon_months=months)).collect()}
        assert sorted(got["Acme"]["sources"]) == urls
        assert (got["Acme"]["sector"], got["Bolt"]["sector"]) == ("Tools", "Nails")
        assert got["Bolt"]["sources"] == []


def test_scorer_is_asked_about_short_headlines_of_gated_companies(spark):
    from firmlens.operators.screening import ask_scores

    rows = [("Acme", "Acme merger. " * 400), ("Bolt", "Bolt merger news of today, in many words. " * 2),
            ("Coil", "Coil merger news of today, in many words. " * 2), ("Dart", "Dart merger"),
            ("Edge", "Edge is quiet today, nothing at all goes on there. " * 2)]
    headlines = spark.createDataFrame(rows, "company string, headline_text string")

    def setup():
        def call(row):
            if row["company"] == "Coil":
                raise ValueError("no answer")
            return {"raw": '{"score": %d, "reason": "%d"}' % (
                1 + len(row["headlines"]) % 5, len(row["headlines"]))}
        return call

    answers = ask_scores(headlines, setup)
    assert sorted((r["company"], r["raw"]) for r in answers.collect()) == [
        ("Acme", '{"score": 1, "reason": "2000"}'), ("Bolt", '{"score": 5, "reason": "84"}'),
        ("Coil", None)]
    got = {r["company"]: (r["stage"], r["score"]) for r in decide(headlines, answers).collect()}
    assert got == {"Acme": ("1C_llm", 1), "Bolt": ("passed", 5), "Coil": ("passed", 3),
                   "Dart": ("no_content", 0), "Edge": ("1B_keyword", 0)}
    whole = ask_scores(headlines, setup, Params(screen_chars=None)).filter("company = 'Acme'").first()
    assert '"5200"' in whole["raw"]
