"""Queries over company lists, names and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import horizon_label, horizon_start, year_terms
from ..functions.names import cache_key, clean_name, clean_name_light
from ..params import USA_REGIONS
from ..functions.fields import is_usa_region
from ..sources.companies import (companies_by_priority, companies_in_file_order,
                                 distinct_companies, first_companies)
from .inputs import PARTY_NAMES_SQL, party_names, table

STRONG = (r"(?i)\b(plc|ltd|llc|inc\.?|corp\.?|co\.?|s\.a\.b?\.?|ag|gmbh|bv|nv|pty|holdings?|group|"
          r"international|industries|enterprises|limited|incorporated|associates|partners)\b\.?")
LIGHT = r"(?i)\b(plc|ltd|llc|inc\.?|corp\.?|group|holdings?)\b\.?"


def company_scan(spark, sf):
    """Headers out of order and padded, names padded, some blank: file-order choice."""
    c = table(spark, sf, "customer")
    padded = F.when(F.col("c_custkey") % 11 == 0, "   ").otherwise(
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
    raw = c.select("c_custkey", F.col("c_mktsegment").alias("Industry"),
                   padded.alias(" Entity "), F.col("c_name").alias("company"))
    return companies_in_file_order(raw).select("company", "sector")


COMPANY_SCAN = """
  SELECT c_name AS company, c_mktsegment AS sector FROM customer WHERE c_custkey % 11 <> 0
"""


def company_scan_priority(spark, sf):
    """Two alias headers: the higher one wins wherever it stands; names repeat."""
    c = table(spark, sf, "customer")
    blank = F.when(F.col("c_custkey") % 11 == 0, "  ").otherwise(
        F.concat(F.lit("N"), (F.col("c_custkey") % 97).cast("string"), F.lit(" ")))
    raw = c.select(F.col("c_name").alias("Name"), blank.alias("COMPANY"))
    return companies_by_priority(raw)


COMPANY_SCAN_PRIORITY = """
  SELECT DISTINCT 'N' || (c_custkey % 97) || ' ' AS company FROM customer
  WHERE c_custkey % 11 <> 0
"""


def first_n_companies(spark, sf):
    c = party_names(spark, sf).withColumnRenamed("pos", "input_pos")
    return first_companies(c, 10)


def distinct_names(spark, sf):
    """Names repeat heavily: a third of the list is one company."""
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("input_pos"),
        F.when(F.col("c_custkey") % 3 == 0, "Everywhere").otherwise(
            F.concat(F.lit("Co "), (F.col("c_custkey") % 101).cast("string"))).alias("company"))
    return distinct_companies(c)


DISTINCT_NAMES = """
  SELECT min(c_custkey) AS input_pos, CASE WHEN c_custkey % 3 = 0 THEN 'Everywhere'
    ELSE 'Co ' || (c_custkey % 101) END AS company FROM customer GROUP BY 2
"""


def cleaned(spark, sf):
    return party_names(spark, sf).select("company", clean_name(F.col("company")).alias("cleaned"))


CLEANED = rf"""
  SELECT company, trim(regexp_replace(regexp_replace(regexp_replace(company, '{STRONG}', '', 'g'),
    '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g')) AS cleaned FROM ({PARTY_NAMES_SQL})
"""


def cleaned_light(spark, sf):
    return party_names(spark, sf).select(
        "company", clean_name_light(F.col("company")).alias("cleaned"))


CLEANED_LIGHT = rf"""
  SELECT company, trim(regexp_replace(company, '{LIGHT}', '', 'g')) AS cleaned
  FROM ({PARTY_NAMES_SQL})
"""


def date_horizon(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("day"),
        *[F.date_format(horizon_start(F.col("d"), m), "yyyy-MM-dd").alias(f"start_{m}")
          for m in (6, 12, 24, 7)],
        horizon_label(F.col("d"), 24).alias("label"))


DATE_HORIZON = """
  SELECT strftime(d, '%Y-%m-%d') AS day, strftime(d - INTERVAL 6 MONTH, '%Y-%m-%d') AS start_6,
    strftime(d - INTERVAL 12 MONTH, '%Y-%m-%d') AS start_12,
    strftime(d - INTERVAL 24 MONTH, '%Y-%m-%d') AS start_24,
    strftime(d - INTERVAL 12 MONTH, '%Y-%m-%d') AS start_7,
    strftime(d - INTERVAL 24 MONTH, '%Y-%m-%d') || ' – ' || strftime(d, '%Y-%m-%d')
      || ' (24 months)' AS label
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
"""


def years(spark, sf):
    spans = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return spans.select("o_custkey", year_terms(F.col("a"), F.col("b")).alias("terms"))


YEARS = """
  SELECT o_custkey, array_to_string(range(year(min(o_orderdate)), year(max(o_orderdate)) + 1),
    ' OR ') AS terms FROM orders GROUP BY o_custkey
"""


def keys(spark, sf):
    """The key of each ordering customer in the week of each order day."""
    o = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return (o.join(c, "o_custkey")
            .select("c_name", cache_key(F.concat(F.lit(" "), F.col("c_name")), F.col("d"))
                    .alias("key")).groupBy("c_name", "key").agg(F.count(F.lit(1)).alias("n")))


KEYS = """
  SELECT c_name, substr(sha256(lower(trim(' ' || c_name)) || '::'
      || strftime(o_orderdate, '%Y-W%W')), 1, 16) AS key, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
"""


def usa_region(spark, sf):
    """Customers' nations read as regions of a move: six nations carry the region names."""
    n = table(spark, sf, "nation")
    regions = F.array(*map(F.lit, USA_REGIONS))
    named = F.coalesce(F.get(regions, F.col("n_nationkey")), F.col("n_name"))
    c = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("companies"))
    return c.join(n, "n_nationkey").select(
        named.alias("hq_region"), is_usa_region(named).alias("is_usa"), "companies")


USA_REGION = f"""
  SELECT hq_region, hq_region IN ({", ".join(f"'{r}'" for r in USA_REGIONS)}) AS is_usa,
    companies FROM (
    SELECT coalesce(([{", ".join(f"'{r}'" for r in USA_REGIONS)}])[n_nationkey + 1], n_name)
      AS hq_region, companies
    FROM nation JOIN (SELECT c_nationkey, count(*) AS companies FROM customer GROUP BY 1)
      ON c_nationkey = n_nationkey)
"""

QUERIES = {
    "company_scan": (company_scan, COMPANY_SCAN),
    "company_scan_priority": (company_scan_priority, COMPANY_SCAN_PRIORITY),
    "first_n_companies": (first_n_companies, f"""
        SELECT pos AS input_pos, company FROM ({PARTY_NAMES_SQL}) ORDER BY pos LIMIT 10"""),
    "distinct_companies": (distinct_names, DISTINCT_NAMES),
    "clean_name": (cleaned, CLEANED),
    "clean_name_light": (cleaned_light, CLEANED_LIGHT),
    "date_horizon": (date_horizon, DATE_HORIZON),
    "year_terms": (years, YEARS),
    "cache_key": (keys, KEYS),
    "usa_region": (usa_region, USA_REGION),
}
