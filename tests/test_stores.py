"""Snapshot tables, stores of runs, streams with state, file order."""

import os

import pytest
from pyspark.sql import functions as F

from firmlens.operators.evidence import first_seen, known_feeds
from firmlens.operators.lifecycle import alltime_counts, category_counts, run_kpis, todo
from firmlens.operators.screening import screen_usage
from firmlens.params import SIGNALS, SOURCES, Params
from firmlens.plans import record
from firmlens.plans.run import base_contexts, in_horizon
from firmlens.sources import cache, tables
from firmlens.sources.companies import load_companies
from firmlens.sources.snapshots import SnapshotTable
from firmlens.streaming import best, payloads

ITEM_SCHEMA = ("company string, source string, source_rank int, query_rank int, item_rank long, "
               "url string, title string, snippet string, domain string, raw_date string")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v int, day string")


def held(df):
    return sorted((r["day"], r["k"], r["v"]) for r in df.collect())


# ---- snapshots ----------------------------------------------------------------------------


def test_append_replace_and_versions(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "day", "k string, v int")
    assert table.read().count() == 0 and table.versions() == []
    table.append(rows(spark, ("a", 1, "d1"), ("b", 2, "d2")))
    table.append(rows(spark, ("c", 3, "d1")))
    table.replace(rows(spark, ("a", 9, "d1")), "d1")
    assert held(table.read()) == [("d1", "a", 9), ("d2", "b", 2)]
    assert held(table.read(version=2)) == [("d1", "a", 1), ("d1", "c", 3), ("d2", "b", 2)]
    assert held(table.read("d2")) == [("d2", "b", 2)] and table.read("none").count() == 0
    table.replace(rows(spark).limit(0), "d2")
    assert held(table.read()) == [("d1", "a", 9)]
    table.expire(keep=1)
    assert table.versions() == [4] and held(table.read()) == [("d1", "a", 9)]


@pytest.mark.parametrize("step", ["_written", "_publish"])
def test_a_failure_leaves_the_old_rows(spark, tmp_path, monkeypatch, step):
    table = SnapshotTable(spark, str(tmp_path / "t"), "day")
    table.append(rows(spark, ("a", 1, "d1")))
    whole = getattr(SnapshotTable, step)

    def broken(self, *args):
        if step == "_written":
            whole(self, *args)  # all files are there, the manifest is not
        raise RuntimeError("lost")

    monkeypatch.setattr(SnapshotTable, step, broken)
    with pytest.raises(RuntimeError):
        table.replace(rows(spark, ("a", 2, "d1")), "d1")
    monkeypatch.undo()
    assert held(table.read()) == [("d1", "a", 1)]
    table.replace(rows(spark, ("a", 3, "d1")), "d1")
    assert held(table.read()) == [("d1", "a", 3)]


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t"), "day")
    table.append(rows(spark, ("a", 1, "d1")))
    publish, between = SnapshotTable._publish, []

    def slow(self, folders, version):
        if not between:  # another writer commits between reading and publishing
            between.append(1)
            SnapshotTable(spark, table.path, "day").append(rows(spark, ("b", 2, "d2")))
        return publish(self, folders, version)

    monkeypatch.setattr(SnapshotTable, "_publish", slow)
    table.append(rows(spark, ("c", 3, "d3")))
    assert held(table.read()) == [("d1", "a", 1), ("d2", "b", 2), ("d3", "c", 3)]
    assert table.versions() == [1, 2, 3]


def test_cache_reads_the_asked_week_and_its_keys(spark, tmp_path):
    path = str(tmp_path / "cache")
    entries = spark.range(20_000).select(
        F.concat(F.lit("k"), F.col("id")).alias("key"), F.lit("A").alias("company"),
        F.lit("p").alias("payload"), F.lit("2024-01-29 09:00:00").cast("timestamp").alias("fetched_at"))
    cache.write_entries(entries, path)
    cache.write_entries(entries.limit(5).withColumn(
        "fetched_at", F.lit("2024-02-06 09:00:00").cast("timestamp")), path)
    week = cache.read_entries(spark, path, F.lit("2024-02-07 00:00:00").cast("timestamp"))
    assert week.count() == 5 and len(week.inputFiles()) <= 8
    assert cache.read_entries(spark, path).count() == 20_005
    missing = cache.read_entries(spark, path).filter("key = 'k77x'")
    assert missing.count() == 0


def _rows_scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_probe_reads_the_pages_that_may_hold_its_keys(spark, tmp_path):
    path = str(tmp_path / "cache")
    entries = spark.range(200_000).select(
        F.format_string("k%06d", "id").alias("key"), F.lit("A").alias("company"),
        F.concat(F.lit("p"), F.col("id")).alias("payload"),
        F.lit("2024-01-29 09:00:00").cast("timestamp").alias("fetched_at"))
    cache.write_entries(entries.coalesce(1), path)
    stored = cache.read_entries(spark, path)

    def keys(*names):
        return spark.createDataFrame([(k,) for k in names], "key string")

    two = cache.probed(stored, keys("k000007", "k150000", "k150000"), 2)
    assert _rows_scanned(two) <= 60_000 and sorted(r["payload"] for r in two.collect()) == ["p150000", "p7"]
    assert _rows_scanned(cache.probed(stored, keys("k000007x"), 2)) == 0
    assert cache.probed(stored, keys(), 2).count() == 0
    for whole in (cache.probed(stored, keys("a", "b", "c"), 2), cache.probed(stored, keys("a"), 0)):
        assert _rows_scanned(whole) == 200_000


def test_a_probe_answers_as_a_join_does(spark, tmp_path):
    as_of = F.lit("2024-01-30 09:00:00").cast("timestamp")
    names = spark.range(40).select(F.concat(F.lit("c"), F.col("id")).alias("company"))
    two = [(f"2024-01-30 0{h}:00:00", p) for h, p in ((7, "z"), (8, "a"), (8, "b"))]
    entries = cache.with_key(names.filter("company <> 'c3'"), as_of).crossJoin(
        spark.createDataFrame(two, "at string, payload string")).select(
        "key", "company", "payload", F.col("at").cast("timestamp").alias("fetched_at"))
    path = str(tmp_path / "cache")
    cache.write_entries(entries, path)
    stored = cache.read_entries(spark, path, as_of)
    for asked in (names, names.filter("company IN ('c3', 'c4')"), names.filter("company = 'x'")):
        for answer in (cache.lookup, cache.misses):
            plain, few = (sorted(map(str, answer(asked, stored, as_of, Params(cache_probe=n)).collect()))
                          for n in (0, 5))
            assert plain == few
    found = cache.lookup(names, stored, as_of, Params(cache_probe=5)).select("payload").distinct()
    assert [r[0] for r in found.collect()] in (["a"], ["b"])


# ---- runs ---------------------------------------------------------------------------------


def run_rows(spark, n, errors=0):
    df = spark.range(n).select(F.concat(F.lit("c"), F.col("id")).alias("company"),
                               (F.col("id") % 3).cast("int").alias("total_signals"),
                               F.when(F.col("id") < errors, "bad").alias("error"))
    return df.withColumns({s: F.col("total_signals") > i % 3 for i, s in enumerate(SIGNALS)})


def test_observed_totals_are_the_runs(spark, tmp_path):
    runs = record.run_table(spark, str(tmp_path / "runs"))
    totals = record.store_run(run_rows(spark, 50, 4), runs, "r1")
    stored = runs.read("r1")
    kpis, counts = run_kpis(stored).first().asDict(), category_counts(stored).first().asDict()
    assert {k: totals[k] for k in kpis} == kpis and {k: totals[k] for k in counts} == counts
    assert record.store_run(run_rows(spark, 0), runs, "r2")["processed"] == 0
    record.store_run(run_rows(spark, 7), runs, "r1")
    assert runs.read().count() == 7


def test_screening_log_replaces_itself(spark, tmp_path):
    log = spark.createDataFrame([("a", True, "passed", 4, "r"), ("b", False, "1C_llm", 1, "r")],
                                "company string, passed boolean, stage string, score int, reason string")
    for _ in range(2):
        totals = record.log_screening(log, str(tmp_path / "log"), "r1")
    assert totals == screen_usage(log).first().asDict()
    record.log_screening(log, str(tmp_path / "log"), "r2")
    assert spark.read.csv(str(tmp_path / "log"), header=True).count() == 4


def test_the_report_is_one_scan(spark, tmp_path, monkeypatch):
    stored = str(tmp_path / "run")
    none = {c: F.lit("") for c in ("sector_detail", "hq_detail", "ma_detail", "rename_detail", "ops_detail",
                                   "bankruptcy_detail", "summary", "hq_region")}
    run_rows(spark, 9).withColumns(none).withColumn("sources", F.array(F.lit("u"))).write.parquet(stored)
    evaluated = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def count(company):
        evaluated.add(1)
        return True

    results = spark.read.parquet(stored).filter(count("company"))
    path = str(tmp_path / "report")
    record.write_report_once(results, path, F.lit("now"), F.lit("12 months"))
    assert evaluated.value == 9
    views = {r["view"]: r["n"] for r in record.read_views(spark, path).groupBy("view").agg(
        F.count("*").alias("n")).collect()}
    assert views["dashboard"] == 9 and views["run_stats"] == 13 and len(views) == 8
    record.write_report_once(results.filter("false"), path, F.lit("now"), F.lit("w"), F.lit(61.0))
    empty = record.read_views(spark, path).filter("view <> 'run_stats'").collect()
    assert len(empty) == 7 and {r["name"] for r in empty} == {"No signals detected."}


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    names = ("by_company_names", "by_company_rows")
    try:
        tables.save_by_company(run_rows(spark, 40).select("company"), names[0], 4, str(tmp_path / "a"))
        tables.save_by_company(run_rows(spark, 20, 3), names[1], 4, str(tmp_path / "b"))
        left = todo(spark.table(names[0]), spark.table(names[1]))
        assert left.count() == 23
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_company_sketches(spark, tmp_path):
    path = str(tmp_path / "sketches")
    runs = [run_rows(spark, 30_000), run_rows(spark, 45_000)]
    for k, run in enumerate((runs[0], *runs)):
        tables.save_company_sketch(run, path, f"r{min(k, 1) if k < 2 else 2}")
    tables.save_company_sketch(runs[0], path, "r0")
    both = runs[0].union(runs[0]).union(runs[1])
    exact, about = alltime_counts(both).first(), tables.estimated_counts(spark, path).first()
    assert about["row_count"] == exact["row_count"]
    assert abs(about["company_count"] / exact["company_count"] - 1) < 0.02


# ---- feeds --------------------------------------------------------------------------------


@pytest.mark.parametrize("feed", ["unheard", None])
def test_unknown_feeds_raise_from_files(spark, tmp_path, feed):
    """Each feed in a file of its own, so that a filter handed to the reader could skip the wrong one."""
    path = str(tmp_path / "items")
    for k, source in enumerate(("gdelt", feed)):
        spark.createDataFrame([("A", source, 3, 1, k, f"u{k}", "t", "", "", "20240601")], ITEM_SCHEMA) \
            .coalesce(1).write.mode("append").parquet(path)
    items = spark.read.parquet(path)
    with pytest.raises(Exception, match="no such feed"):
        known_feeds(items, SOURCES).filter("source IN ('gdelt', 'edgar')").collect()
    names = spark.createDataFrame([("A",)], "company string")
    with pytest.raises(Exception, match="no such feed"):
        base_contexts(names, in_horizon(items, F.lit("2024-06-30").cast("date"))).collect()


def test_encyclopedia_stubs_stay_out(spark):
    items = spark.createDataFrame(
        [("A", "wikipedia", 7, 1, 1, "u", "A", "too short", "", ""),
         ("B", "wikipedia", 7, 1, 1, "u", "B", "x" * 50, "", ""),
         ("A", "wikipedia", 7, 1, 2, "v", "A2", "y" * 60, "", ""),
         ("B", "gdelt", 3, 1, 1, "g", "short", "s", "d", "")], ITEM_SCHEMA)
    names = spark.createDataFrame([("A",), ("B",)], "company string")
    got = {r["company"]: r["sources"] for r in base_contexts(names, items).collect()}
    assert got == {"A": ["v"], "B": ["g", "u"]}
    loose = base_contexts(names, items, Params(encyclopedia_min_chars=0)).collect()
    assert {r["company"]: r["sources"] for r in loose}["A"] == ["u"]


def test_best_items_in_any_order_of_deliveries(spark, tmp_path):
    data = [("A", "gdelt", 3, 1, 1, "u"), ("A", "edgar", 1, 1, 5, "u"), ("A", "brave", 8, 1, 1, "u"),
            ("A", "edgar", 1, 1, 4, "v"), ("B", "guardian", 4, 1, 1, "u"), ("B", "gdelt", 3, 1, 9, "u"),
            ("A", "edgar", 1, 1, 6, ""), ("A", "gdelt", 3, 1, 7, "")]
    schema = "company string, source string, source_rank int, query_rank int, item_rank long, url string"
    whole = spark.createDataFrame(data, schema)
    want = {tuple(r) for r in first_seen(whole.filter("url <> ''")).collect()}
    for name, order in (("up", range(8)), ("down", reversed(range(8)))):
        landed, out, state = (str(tmp_path / f"{name}-{x}") for x in ("in", "out", "state"))
        os.makedirs(landed)
        stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(landed)
        for k, i in enumerate(order):
            spark.createDataFrame([data[i]], schema).coalesce(1).write.mode("append").parquet(landed)
            if k in (2, 7):  # the second start goes on where the first one stopped
                best.start_best(best.keep_best(stream), out, state).awaitTermination(120)
        standing = best.best_items(spark.read.parquet(out)).select(*whole.columns)
        assert {tuple(r) for r in standing.filter("url <> ''").collect()} == want
        assert [tuple(r) for r in standing.filter("url = ''").collect()] == [data[6]]


def test_state_goes_with_its_span(spark, tmp_path):
    schema = "company string, source_rank int, query_rank int, item_rank long, url string, at timestamp, source string"
    landed, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    os.makedirs(landed)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    for k, day in enumerate(("2024-01-01", "2024-01-02", "2024-02-20", "2024-03-20")):
        spark.sql(f"SELECT 'A' AS company, {9 - k} AS source_rank, 1 AS query_rank, {k}L AS item_rank, 'u{k // 2}' "
                  f"AS url, TIMESTAMP '{day} 10:00:00' AS at, 'gdelt' AS source").coalesce(1) \
            .write.mode("append").parquet(landed)
    query = best.start_best(best.keep_best(stream, landed="at"), out, state)
    query.awaitTermination(120)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 3
    assert sorted((r["url"], r["source_rank"]) for r in best.best_items(spark.read.parquet(out)).collect()) == [
        ("u0", 8), ("u1", 6)]


def test_payloads_run_again_change_nothing(spark, tmp_path):
    landed, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    raw = [("prnewswire", None, "<rss><channel><item><title>t</title><link>u</link></item></channel></rss>"),
           ("prnewswire", None, "<rss><chan"), ("gdelt", "A", '{"articles": [{"url": "g"}, {"url": "h"}]}'),
           ("gdelt", "A", '{"articles": ['), ("edgar", "A", ""), (None, "A", "{}"), ("brave", "A", "{}")]
    spark.createDataFrame(raw, payloads.PAYLOAD_TYPE).write.parquet(landed)
    stream = payloads.payload_stream(spark, landed)
    payloads.start_payloads(stream, out, state).awaitTermination(120)
    payloads.start_payloads(stream, out, str(tmp_path / "state-lost")).awaitTermination(120)
    items = spark.read.parquet(f"{out}/items").collect()
    assert sorted((r["source"], r["company"] or "", r["url"]) for r in items) == [
        ("gdelt", "A", "g"), ("gdelt", "A", "h"), ("prnewswire", "", "u")]
    bad = {(r["source"], r["reason"]): r["payloads"] for r in payloads.rejected_counts(spark, out).collect()}
    assert bad == {("prnewswire", "not XML"): 1, ("gdelt", "not JSON"): 1, ("edgar", "empty"): 1,
                   (None, "no such feed"): 1}


def test_order_of_several_files_and_splits(spark, tmp_path):
    sizes = {"a": 3, "b": 4000, "c": 700}
    for name, n in sizes.items():
        lines = "".join(f"{name}{i:05},s\n" for i in range(n))
        (tmp_path / f"{name}.csv").write_text("company,sector\n" + lines)
    want = [f"{name}{i:05}" for name, n in sizes.items() for i in range(n)]
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    try:
        for size in (old, "8k"):
            spark.conf.set(key, size)
            got = load_companies(spark, str(tmp_path)).collect()
            ordered = sorted((r["input_pos"], r["company"]) for r in got)
            assert [c for _, c in ordered] == want and [p for p, _ in ordered] == list(range(len(want)))
    finally:
        spark.conf.set(key, old)
