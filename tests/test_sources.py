"""Company lists, feeds, the result table and the cache."""

import pytest
from pyspark.sql import functions as F

from firmlens.functions.dates import parse_published, runtime_label
from firmlens.params import Params
from firmlens.plans.run import RECORD_TYPE, cache_records, layered_fetch, select_work
from firmlens.sources import cache, feeds, results
from firmlens.sources.companies import first_companies, load_companies, read_company_csv


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_in_file_order(spark, tmp_path):
    path = write(tmp_path / "a.csv", '﻿Sector , Name,company\r\n'
                 'Energy," Ngk, Ltd. ",x\r\n,  ,y\r\nTech,123,z\r\n\r\nTech,123,w\r\nOnly\r\n')
    rows = load_companies(spark, path).orderBy("input_pos").collect()
    assert [(r["company"], r["sector"]) for r in rows] == [
        ("Ngk, Ltd.", "Energy"), ("123", "Tech"), ("123", "Tech")]


def test_csv_by_priority(spark, tmp_path):
    path = write(tmp_path / "b.csv", "Name,COMPANY\nx, A \ny,  \nz, A \nw,B\n")
    rows = load_companies(spark, path, by_priority=True).collect()
    assert sorted(r["company"] for r in rows) == [" A ", "B"]


def test_csv_without_known_header(spark, tmp_path):
    path = write(tmp_path / "c.csv", "Firm,City\nA,x\n")
    assert [r["company"] for r in load_companies(spark, path).collect()] == ["A"]


def test_csv_bom(spark, tmp_path):
    path = write(tmp_path / "d.csv", "﻿company,Industry\nA,Steel\n")
    assert read_company_csv(spark, path).columns[0].endswith("company")
    row = load_companies(spark, path).first()
    assert (row["company"], row["sector"]) == ("A", "Steel")


def test_first_companies(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "input_pos long, company string")
    assert [r["company"] for r in first_companies(df, 2).collect()] == ["a", "b"]
    for everything in (None, 0, -4):
        assert first_companies(df, everything).count() == 3


def test_limit_and_resume(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "input_pos long, company string")
    done = spark.createDataFrame([("a", None), ("b", "x")], "company string, error string")
    def names(**kw):
        return sorted(r["company"] for r in select_work(df, done, **kw).collect())
    assert names(limit=1) == ["b"]  # failed ones are open again
    assert names(limit=1, params=Params(compat=True)) == []
    assert names(resume=False) == ["a", "b", "c"]


def test_published_dates(spark):
    raws = ["20240105T101500Z", "2024-01-05T10:15:00Z", "2024-01-05",
            "Fri, 05 Jan 2024 10:15:00 GMT", "", "soon"]
    df = spark.createDataFrame([(r,) for r in raws], "r string")
    got = [str(r[0]) if r[0] else None for r in df.select(
        parse_published(F.col("r")).cast("string")).collect()]
    assert got == ["2024-01-05 00:00:00", "2024-01-05 10:15:00", "2024-01-05 00:00:00",
                   "2024-01-05 10:15:00", None, None]
    assert df.select(runtime_label(F.lit(125.7))).first()[0] == "2m 5s"


def test_rss(spark, tmp_path):
    good = ("<rss><channel><item><title> A &amp; b </title><link>u1</link></item>"
            "<item><link> u2 </link><pubDate>d</pubDate></item></channel></rss>")
    rdf = "<rdf><item><title>t</title></item></rdf>"
    df = spark.createDataFrame([(1, good), (2, "<rss><channel><item><title>x</title></item>"),
                                (3, rdf)], "k int, p string")
    rows = feeds.rss_items(df, "p", ["k"]).orderBy("k", "item_rank").collect()
    assert [(r["k"], r["item_rank"], r["title"], r["url"], r["raw_date"]) for r in rows] == [
        (1, 1, "A & b", "u1", ""), (1, 2, "", "u2", "d"), (3, 1, "t", "", "")]
    write(tmp_path / "f.xml", good)
    assert {r["url"] for r in feeds.read_rss_files(
        spark, str(tmp_path), "businesswire").collect()} == {"u1", "u2"}


def test_json_feeds_tolerate_gaps(spark):
    df = spark.createDataFrame([(1, "{}"), (2, "no"), (3, '{"articles": []}'),
                                (4, '{"articles": [{"url": "u"}]}')], "k int, p string")
    rows = feeds.json_items(df, "p", "gdelt", ["k"]).collect()
    assert [(r["k"], r["url"], r["title"]) for r in rows] == [(4, "u", "")]
    hit = '{"hits": {"hits": [{"_source": {"file_url": "/f"}}, {"_source": {}}]}}'
    df = spark.createDataFrame([("Acme", hit)], "company string, p string")
    rows = feeds.json_items(df, "p", "edgar", ["company"], company="company", page=1).collect()
    assert [(r["url"], r["title"], r["domain"]) for r in rows] == [
        ("https://www.sec.gov/f", "Acme", "8-K")]
    with pytest.raises(ValueError):
        feeds.json_items(df, "p", "nowhere", [])


def test_result_table(spark, tmp_path):
    table = "firmlens_results"
    results.create_table(spark, table, location=str(tmp_path / "t"))
    results.create_table(spark, table)  # again: no harm
    rows = spark.createDataFrame([("a", True, ["u"]), ("b", None, [])],
                                 "company string, hq_change boolean, sources array<string>")
    results.append_run(rows.withColumn("unknown", F.lit(1)), table, "run1")
    results.append_run(rows.filter("company = 'a'"), table, "run2")
    assert results.read_results(spark, table).count() == 3
    one = results.read_results(spark, table, "run1").filter("company = 'b'").first()
    assert (one["hq_change"], one["summary"], one["sources"], one["error"]) == (
        False, "", "[]", None)
    back = results.with_source_list(results.read_results(spark, table, "run2")).first()
    assert back["sources"] == ["u"] and len(back.asDict()) == 22
    plan = results.read_results(spark, table, "run2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    spark.sql(f"DROP TABLE {table}")


def test_checkpoint(spark, tmp_path):
    assert results.read_checkpoint(spark, str(tmp_path / "none")).count() == 0
    spark.createDataFrame([("a", 1)], "company string, extra int").write.parquet(
        str(tmp_path / "cp"))
    row = results.read_checkpoint(spark, str(tmp_path / "cp")).first()
    assert row["company"] == "a" and row["total_signals"] == 0 and row["sources"] == "[]"


ITEM_SCHEMA = ("company string, source string, source_rank int, query_rank int, item_rank long, "
               "url string, title string, snippet string, domain string, raw_date string")


def test_cached_fetch(spark, tmp_path):
    path = str(tmp_path / "cache")
    monday = F.lit("2024-01-29 09:00:00").cast("timestamp")
    names = spark.createDataFrame([("A",), ("B",), ("C",)], "company string")
    items = spark.createDataFrame(
        [("A", "gdelt", 3, 1, 1, "u1", "T", "", "d", "20240101"),
         ("B", "wikipedia", 7, 1, 1, "u2", "W", "x" * 60, "", "")], ITEM_SCHEMA)
    empty = spark.createDataFrame([], f"key string, company string, payload {RECORD_TYPE}, "
                                      "fetched_at timestamp")
    first = layered_fetch(names, empty, items, monday)
    got = {r["company"]: r for r in first.collect()}
    assert got["A"]["context"] == "[GDELT] T (20240101) — d\nu1" and not got["A"]["from_cache"]
    assert got["A"]["chunks"] == [got["A"]["context"]] and got["C"]["context"] == ""
    cache.write_entries(cache_records(first, monday), path)
    again = layered_fetch(names, cache.read_entries(spark, path), items.filter("false"),
                          F.lit("2024-02-01 00:00:00").cast("timestamp")).collect()
    assert all(r["from_cache"] for r in again)
    assert {r["company"]: r["context"] for r in again} == {
        n: r["context"] for n, r in got.items()}
    # The next week asks anew, and so does stage 2 in the same week.
    late = F.lit("2024-02-05 00:00:00").cast("timestamp")
    assert cache.misses(names, cache.read_entries(spark, path), late, stage="1").count() == 3
    assert cache.misses(names, cache.read_entries(spark, path), monday, stage="2").count() == 3
    cache.rewrite_week(spark, path, names.filter("company = 'A'"), monday, "1")
    left = cache.read_entries(spark, path)
    assert sorted(r["company"] for r in left.collect()) == ["B", "C"]
