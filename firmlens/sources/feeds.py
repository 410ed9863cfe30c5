"""Landed feed payloads to normalised items.

Every reader takes a table with a payload column (and whatever key columns are to be kept) and
returns one row per item. Payloads that do not parse give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

ITEM_FIELDS = ("url", "title", "snippet", "domain", "raw_date")

_RSS_ITEM = "struct<title:string,link:string,description:string,pubDate:string>"
_RSS_SCHEMA = (f"channel struct<item:array<{_RSS_ITEM}>>, item array<{_RSS_ITEM}>, "
               "_broken string")
EDGAR_SITE = "https://www.sec.gov"


def rss_items(df: DataFrame, payload: str, keys: Sequence[str]) -> DataFrame:
    """Items of an RSS document: under the channel, or next to it as in RSS 1.0."""
    parsed = F.from_xml(F.col(payload), _RSS_SCHEMA,
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    none = F.array().cast(f"array<{_RSS_ITEM}>")
    items = F.concat(F.coalesce(F.col("_doc.channel.item"), none),
                     F.coalesce(F.col("_doc.item"), none))
    def text(name: str) -> Column:
        return strip(F.coalesce(F.col(f"_item.{name}"), F.lit("")))
    return (
        df.select(*keys, parsed.alias("_doc"))
        .filter(F.col("_doc._broken").isNull())
        .select(*keys, F.posexplode(items).alias("item_rank", "_item"))
        .select(*keys, (F.col("item_rank") + 1).alias("item_rank"),
                text("link").alias("url"), text("title").alias("title"),
                text("description").alias("snippet"), F.lit("").alias("domain"),
                text("pubDate").alias("raw_date"))
    )


def read_rss_files(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Items of landed RSS files of one feed, each file split by Spark at its item elements; ready for
    the union of feeds. They belong to no company yet. item_rank grows along each file; it orders
    items, it does not count them. A file that breaks off gives the items before the break."""
    return (
        spark.read.format("xml").option("rowTag", "item")
        .schema("title string, link string, description string, pubDate string")
        .load(path)
        .select(F.lit(None).cast("string").alias("company"), F.lit(source).alias("source"),
                F.monotonically_increasing_id().alias("item_rank"),
                *[strip(F.coalesce(F.col(c), F.lit(""))).alias(a) for c, a in
                  (("link", "url"), ("title", "title"), ("description", "snippet"),
                   ("pubDate", "raw_date"))])
    )


# JSON feeds: schema of the payload, the item arrays in it, and the item's fields.
_HIT = ("struct<_source:struct<entity_name:string,file_date:string,form_type:string,"
        "file_description:string,file_url:string>>")
_GDELT = "struct<url:string,title:string,domain:string,seendate:string>"
_GUARDIAN = ("struct<webUrl:string,webTitle:string,webPublicationDate:string,"
             "fields:struct<headline:string,trailText:string>>")
_WEB = "struct<url:string,title:string,description:string,age:string>"
_DEEP = "struct<url:string,title:string,content:string,snippet:string>"

_SCHEMAS = {
    "edgar": f"hits struct<hits:array<{_HIT}>>",
    "gdelt": f"articles array<{_GDELT}>",
    "guardian": f"response struct<results:array<{_GUARDIAN}>>",
    "wikipedia": "extract string, title string, "
                 "content_urls struct<desktop:struct<page:string>>",
    "brave": f"web struct<results:array<{_WEB}>>, news struct<results:array<{_WEB}>>",
    "tavily": f"results array<{_DEEP}>",
}


def _or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def _item(url, title, snippet, domain, raw_date) -> Column:
    values = (url, title, snippet, domain, raw_date)
    return F.struct(*[_or_empty(v).alias(n) for v, n in zip(values, ITEM_FIELDS)])


def _items_of(source: str, doc: Column, company: Column) -> Column:
    """Array of normalised items of one parsed payload."""
    blank = F.lit("")
    if source == "edgar":
        return F.transform(doc["hits"]["hits"], lambda h: _item(
            F.concat(F.lit(EDGAR_SITE), _or_empty(h["_source"]["file_url"])),
            F.coalesce(h["_source"]["entity_name"], company),
            h["_source"]["file_description"],
            F.coalesce(h["_source"]["form_type"], F.lit("8-K")),
            h["_source"]["file_date"]))
    if source == "gdelt":
        return F.transform(doc["articles"], lambda a: _item(
            a["url"], strip(a["title"]), blank, a["domain"], F.substring(a["seendate"], 1, 8)))
    if source == "guardian":
        return F.transform(doc["response"]["results"], lambda r: _item(
            r["webUrl"], strip(F.coalesce(r["fields"]["headline"], r["webTitle"])),
            strip(r["fields"]["trailText"]), blank, F.substring(r["webPublicationDate"], 1, 10)))
    if source == "wikipedia":
        return F.array(_item(doc["content_urls"]["desktop"]["page"], doc["title"],
                             doc["extract"], blank, blank))
    if source == "brave":
        def web(part: str) -> Column:
            found = F.transform(doc[part]["results"], lambda r: _item(
                r["url"], r["title"], r["description"], F.lit(part), r["age"]))
            return F.coalesce(found, F.array().cast(
                "array<struct<url:string,title:string,snippet:string,domain:string,"
                "raw_date:string>>"))
        return F.concat(web("web"), web("news"))
    if source == "tavily":
        return F.transform(doc["results"], lambda r: _item(
            r["url"], r["title"],
            F.coalesce(F.nullif(r["content"], F.lit("")), r["snippet"]), blank, blank))
    raise AssertionError(source)


def json_items(df: DataFrame, payload: str, source: str, keys: Sequence[str],
               company: str | None = None, page: int | None = None,
               min_extract: int = 50) -> DataFrame:
    """Items of one JSON feed. `page` keeps the head of each payload's list, before it is
    exploded; encyclopedia extracts shorter than `min_extract` are dropped."""
    if source not in _SCHEMAS:
        raise ValueError(f"no JSON feed named {source!r}")
    doc = F.from_json(F.col(payload), _SCHEMAS[source])
    name = F.col(company) if company else F.lit("")
    items = _items_of(source, F.col("_doc"), name)
    if page is not None:
        items = F.slice(items, 1, page)
    out = (
        df.select(*keys, *([company] if company and company not in keys else []),
                  doc.alias("_doc"))
        .select(*keys, F.posexplode(items).alias("item_rank", "_item"))
        .select(*keys, (F.col("item_rank") + 1).alias("item_rank"), "_item.*")
    )
    if source == "wikipedia":
        out = out.filter(F.length("snippet") >= min_extract)
    return out
