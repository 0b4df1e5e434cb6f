"""Registered queries: one per operator group, each with its SQL oracle.

Each query takes ``(spark, sf_dir)``, renders what it needs from the driver
tables (cached under the shared scratch folder) and returns a DataFrame.
Each oracle is DuckDB SQL over the same driver tables that computes the same
answer independently: it re-derives the rendered values in SQL and applies
the operator's semantics directly.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakesmith.fixtures import render
from lakesmith.functions.ids import SENTINEL_PMID
from lakesmith.plans.csv_ingest import DATA_TYPES, URL_BASE
from lakesmith.plans.fetch_plan import BASELINE_URL
from lakesmith.plans.linktable import build_link_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def _sql_int(expr: str) -> str:
    """Integer text by its rule, spelled out: outer white space off, a sign,
    digits with single underscores between them, within 64 bits."""
    text = f"trim({expr}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    digits = f"ltrim({text}, '+-')"
    return (f"CASE WHEN length({text}) - length({digits}) <= 1 AND len(list_filter(string_split({digits}, '_'), "
            f"lambda p: p = '' OR length(translate(p, '0123456789', '')) > 0)) = 0 "
            f"THEN try_cast(replace({text}, '_', '') AS BIGINT) END")


# ---------------------------------------------------------------- link table

def _sql_lake_pmid(first_copy: bool) -> str:
    high = "'00' || CAST(o_orderkey AS VARCHAR)" if first_copy else "CAST(o_orderkey AS VARCHAR)"
    return f"""CASE
      WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '{SENTINEL_PMID}'
      WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL
      WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN CAST(o_orderkey AS VARCHAR) || 'x'
      WHEN o_orderpriority = '2-HIGH' THEN {high}
      WHEN o_orderpriority = '3-MEDIUM' THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
      WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN '+' || CAST(o_orderkey AS VARCHAR)
      ELSE CAST(o_orderkey AS VARCHAR) END"""


SQL_LAKE = f"""lake AS (
  SELECT {_sql_lake_pmid(True)} AS PMID, '10.1000/' || CAST(o_custkey AS VARCHAR) AS DOI FROM orders
  UNION ALL
  SELECT {_sql_lake_pmid(False)} AS PMID, '10.1000/' || CAST(o_custkey AS VARCHAR) AS DOI FROM orders
)"""


@register("linktable_build", f"""WITH {SQL_LAKE},
d AS (SELECT DISTINCT PMID, DOI FROM lake),
c AS (SELECT {_sql_int('PMID')} AS PMID_int, DOI FROM d
      WHERE PMID IS DISTINCT FROM '{SENTINEL_PMID}')
SELECT PMID_int AS PMID, DOI FROM c WHERE PMID_int IS NOT NULL""")
def linktable_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_link_table(spark, render.link_lake(spark, sf_dir))


@register("linktable_distinct_after_cast", f"""WITH {SQL_LAKE}
SELECT DISTINCT {_sql_int('PMID')} AS PMID, DOI FROM lake
WHERE PMID IS DISTINCT FROM '{SENTINEL_PMID}' AND {_sql_int('PMID')} IS NOT NULL""")
def linktable_distinct_after_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_link_table(spark, render.link_lake(spark, sf_dir), distinct_after_cast=True)


_SQL_AT_LAST = "(SELECT * FROM orders WHERE o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_custkey % 2 = 0)) AS orders"


@register("linktable_incremental", f"""WITH {SQL_LAKE.replace("FROM orders", f"FROM {_SQL_AT_LAST}")},
d AS (SELECT DISTINCT PMID, DOI FROM lake),
c AS (SELECT {_sql_int('PMID')} AS PMID_int, DOI FROM d
      WHERE PMID IS DISTINCT FROM '{SENTINEL_PMID}')
SELECT PMID_int AS PMID, DOI FROM c WHERE PMID_int IS NOT NULL""")
def linktable_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three refreshes: statuses F and O; F replaced by a part of it and P added; O removed."""
    from pyspark.sql import functions as F

    from lakesmith.operators.sinks import remove_files
    from lakesmith.plans.linktable_incremental import read_link_table, refresh_link_table
    from lakesmith.session import fresh_dir
    from lakesmith.sources.listings import file_inventory

    run = fresh_dir(spark, "linktable", "incremental")
    lake, state = f"{run}/lake", f"{run}/state"
    orders = render.table(spark, sf_dir, "orders")

    def deliver(status: str, some=F.lit(True)):
        render.link_lake_frame(orders.where((F.col("o_orderstatus") == status) & some)).write.mode("overwrite").parquet(f"{lake}/{status}")

    deliver("F")
    deliver("O")
    refresh_link_table(spark, lake, state, part_bytes=1 << 16)
    deliver("F", F.col("o_custkey") % 2 == 0)
    deliver("P")
    refresh_link_table(spark, lake, state)
    remove_files(file_inventory(spark, f"{lake}/O", "*.parquet").select(F.regexp_replace("path", "^file:", "").alias("path")))
    refresh_link_table(spark, lake, state)
    return read_link_table(spark, state)


# ---------------------------------------------------------------- XML ingest

_SQL_DOI = "'10.1000/' || CAST(o_custkey AS VARCHAR)"


@register("xml_ingest", f"""SELECT CAST(o_orderkey AS VARCHAR) AS PMID,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN ' ' || {_SQL_DOI} || ' '
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {_SQL_DOI} || '<&>'
       ELSE {_SQL_DOI} END AS DOI
FROM orders
WHERE o_orderpriority <> '1-URGENT' AND NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')""")
def xml_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.plans.xml_ingest import ingest_xml
    from lakesmith.session import fresh_dir

    lake = ingest_xml(spark, render.article_xml(spark, sf_dir), fresh_dir(spark, "lake", "xml"))
    return lake.select("PMID", "DOI")


_SQL_OWN = ("SELECT CAST(l_orderkey AS VARCHAR) AS PMID, '10.1000/' || CAST(l_orderkey AS VARCHAR) AS DOI "
            "FROM lineitem")
_SQL_REFS = ("SELECT CAST(l_partkey AS VARCHAR) AS PMID, '10.2000/' || CAST(l_suppkey AS VARCHAR) AS DOI "
             "FROM lineitem")


@register("xml_nested_refs", f"{_SQL_OWN} UNION ALL {_SQL_REFS}")
def xml_nested_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.plans.xml_ingest import xml_links

    return xml_links(spark, render.nested_xml(spark, sf_dir)).select("PMID", "DOI")


@register("xml_own_refs", _SQL_OWN)
def xml_own_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.plans.xml_ingest import xml_links

    return xml_links(spark, render.nested_xml(spark, sf_dir), own_only=True).select("PMID", "DOI")


# ---------------------------------------------------------------- zipped CSV

@register("zip_csv_ingest", """SELECT c_custkey,
  replace(c_name, '#', ' "É"' || chr(10) || '#') AS c_name,
  CAST(c_nationkey AS BIGINT) AS c_nationkey,
  CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_nationkey < 5 OR c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def zip_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.plans.csv_ingest import typed_rows

    return typed_rows(spark, render.customer_zips(spark, sf_dir)).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("csv_quote_comma_fallback", """SELECT p_partkey,
  replace(p_name, ' ', ' "x", ') AS p_name, p_brand, p_type,
  CAST(p_size AS BIGINT) AS p_size, p_retailprice
FROM part""")
def csv_quote_comma_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.plans.csv_ingest import typed_rows

    return typed_rows(spark, render.part_zips(spark, sf_dir)).select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


# ---------------------------------------------------------------- lakes

@register("lake_union_drift", """SELECT s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
  CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS s_acctbal
FROM supplier""")
def lake_union_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.sources.lake import read_drifting_lake

    root = os.path.dirname(render.supplier_drift(spark, sf_dir)[0])
    return read_drifting_lake(spark, root).select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal")


# ---------------------------------------------------------------- pages and plans

# Written out for the oracle, apart from the patterns under test: comments and
# script bodies go, then the quoted or bare values of link attributes in tags.
_SQL_BODY = (r"regexp_replace(regexp_replace({html}, '<!--[\s\S]*?-->', '', 'g'), "
             r"'(<[sS][cC][rR][iI][pP][tT][^>]*>)[\s\S]*?(</[sS][cC][rR][iI][pP][tT] *>)', '\1\2', 'g')")
_SQL_TAG = """'<[A-Za-z]([^>"'']|"[^"]*"|''[^'']*'')*>'"""
_SQL_ATTR = ("""'[ \t\n](?i:href|src|action|formaction|cite|data|background|codebase|classid|longdesc|profile|usemap|archive|dynsrc|lowsrc)"""
             """ *= *("[^"]*"|''[^'']*''|[^ "''>]+)'""")
_SQL_CLEAN = ("replace(replace(replace(replace(replace(replace("
              "CASE WHEN left(q, 1) IN ('\"', '''') THEN substr(q, 2, length(q) - 2) ELSE q END, "
              "'&#47;', '/'), '&#x2F;', '/'), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')")


def _sql_links(html: str = "html") -> str:
    return f"""links AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY ti, ai) - 1 AS pos, {_SQL_CLEAN} AS link FROM (
    SELECT page_id, ti, generate_subscripts(arr, 1) AS ai, unnest(arr) AS q FROM (
      SELECT page_id, ti, regexp_extract_all(tag, {_SQL_ATTR}, 1) AS arr FROM (
        SELECT page_id, generate_subscripts(tags, 1) AS ti, unnest(tags) AS tag FROM (
          SELECT page_id, regexp_extract_all({_SQL_BODY.format(html=html)}, {_SQL_TAG}) AS tags FROM pages)))))"""


SQL_LINKS = _sql_links()
LINK_SUFFIX = ","
START_INDEX, BATCH = 348, 5


@register("page_links", f"WITH {SQL_LINKS} SELECT CAST(page_id AS BIGINT) AS page_id, CAST(pos AS INT) AS pos, link FROM links")
def page_links_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.sources.listings import page_links

    return page_links(render.table(spark, sf_dir, "pages"))


_DIRT = ('<p>set src="x.xml.gz" here</p><button formaction="&#47;f&#x2F;', '.xml.gz" title=" href=no">go</button>')


@register("page_links_dirty", "WITH " + _sql_links(f"(html || '{_DIRT[0]}' || page_id || '{_DIRT[1]}')")
          + " SELECT CAST(page_id AS BIGINT) AS page_id, CAST(pos AS INT) AS pos, link FROM links WHERE link <> 'no'")
def page_links_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A link-like text outside tags, one inside another attribute's value, and numeric references."""
    from pyspark.sql import functions as F

    from lakesmith.sources.listings import page_links

    pages = render.table(spark, sf_dir, "pages").withColumn(
        "html", F.concat("html", F.lit(_DIRT[0]), F.col("page_id").cast("string"), F.lit(_DIRT[1])))
    return page_links(pages)


_STYLED = ('<style>@import "i', '.css"; a{b:url( c', ' )}</style><meta http-equiv="refresh" content="5; URL=m', '"><p style="x:url(&quot;p', '&quot;)">t</p><!-- <a href="no"> -->')


@register("page_links_css", f"""WITH {SQL_LINKS}
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(pos + 4 AS INT) AS pos, link FROM links
UNION ALL SELECT CAST(page_id AS BIGINT), k, CASE k WHEN 0 THEN 'i' || page_id || '.css' WHEN 1 THEN 'c' || page_id WHEN 2 THEN 'm' || page_id ELSE 'p' || page_id END
FROM pages, (SELECT unnest([0, 1, 2, 3])::INT AS k)""")
def page_links_css(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before each page a style sheet's files, a page that moves on, a style attribute, and a link in a comment."""
    from pyspark.sql import functions as F

    from lakesmith.sources.listings import page_links

    number = F.col("page_id").cast("string")
    parts = [x for piece in _STYLED[:-1] for x in (F.lit(piece), number)]
    return page_links(render.table(spark, sf_dir, "pages").withColumn("html", F.concat(*parts, F.lit(_STYLED[-1]), "html")))


@register("page_links_suffix", f"WITH {SQL_LINKS} SELECT CAST(page_id AS BIGINT) AS page_id, "
          f"CAST(pos AS INT) AS pos, link FROM links WHERE suffix(link, '{LINK_SUFFIX}')")
def page_links_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from lakesmith.functions.paths import has_suffix
    from lakesmith.sources.listings import page_links

    return page_links(render.table(spark, sf_dir, "pages")).filter(has_suffix(F.col("link"), LINK_SUFFIX))


@register("batch_slice", f"""WITH {SQL_LINKS}, r AS (
  SELECT page_id, pos, link, row_number() OVER (ORDER BY page_id, pos) AS rn FROM links)
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(pos AS INT) AS pos, link FROM r
WHERE rn BETWEEN {START_INDEX + 1} AND {START_INDEX + BATCH}""")
def batch_slice_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.operators.planning import batch_slice
    from lakesmith.sources.listings import page_links

    return batch_slice(page_links(render.table(spark, sf_dir, "pages")), ["page_id", "pos"], START_INDEX, BATCH)


@register("batch_resume", f"""WITH {SQL_LINKS}, r AS (
  SELECT page_id, pos, link, row_number() OVER (ORDER BY page_id, pos) AS rn FROM links)
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(pos AS INT) AS pos, link FROM r WHERE rn > {START_INDEX}""")
def batch_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.operators.planning import batch_slice
    from lakesmith.sources.listings import page_links

    return batch_slice(page_links(render.table(spark, sf_dir, "pages")), ["page_id", "pos"], START_INDEX)


_FETCH_BASE = "https://example.org/listing/"
FETCH_SUFFIX, FETCH_START = "e", 20
_SQL_STEM = f"regexp_replace(string_split(link, '/')[-1], '{FETCH_SUFFIX}$', '')"


@register("fetch_plan", f"""WITH {SQL_LINKS},
w AS (SELECT page_id, pos, link, row_number() OVER (ORDER BY page_id, pos) AS rn
      FROM links WHERE suffix(link, '{FETCH_SUFFIX}')),
s AS (SELECT page_id, pos, link, {_SQL_STEM} AS stem FROM w WHERE rn > {FETCH_START}),
present AS (SELECT DISTINCT {_SQL_STEM} AS stem FROM links l JOIN pages p USING (page_id)
            WHERE p.url LIKE '%/fr/%' AND suffix(link, '{FETCH_SUFFIX}'))
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(pos AS INT) AS pos, link, stem,
       '{_FETCH_BASE}' || link AS url, 'lake/' || stem || '.parquet' AS lake_path
FROM s WHERE NOT EXISTS (SELECT 1 FROM present WHERE present.stem = s.stem)""")
def fetch_plan_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links ending in the suffix on all pages, resumed from index 20, minus
    files already loaded (here: those listed on the French pages)."""
    from pyspark.sql import functions as F

    from lakesmith.functions.paths import base_name, has_suffix, strip_suffix
    from lakesmith.plans.fetch_plan import plan_fetch
    from lakesmith.sources.listings import page_links

    pages = render.table(spark, sf_dir, "pages")
    present = (page_links(pages.filter(F.col("url").contains("/fr/")))
               .filter(has_suffix(F.col("link"), FETCH_SUFFIX))
               .select(strip_suffix(base_name(F.col("link")), FETCH_SUFFIX).alias("stem")))
    return plan_fetch(pages, present, suffix=FETCH_SUFFIX, base_url=_FETCH_BASE, start=FETCH_START)


_SQL_YEARS = "SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS data_year FROM orders"


@register("plan_cross", f"""SELECT t.data_type, y.data_year,
  '{URL_BASE}/' || t.data_type || '/download/' || CAST(y.data_year AS VARCHAR) AS url,
  'data/' || t.data_type || '/' || CAST(y.data_year AS VARCHAR) || '.zip' AS landing_path
FROM (VALUES {', '.join(f"('{t}')" for t in DATA_TYPES)}) t(data_type),
     ({_SQL_YEARS}) y""")
def plan_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four data types for every order year found in ``orders``."""
    from pyspark.sql import functions as F

    from lakesmith.plans.csv_ingest import fetch_plan

    years = render.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("data_year")).distinct()
    return fetch_plan(spark, years=years)


# Fixed value: the naming of the baseline files.
SERIES_PATTERN = "pubmed23n%04d.xml.gz"


@register("numbered_series", f"""SELECT id, '{BASELINE_URL}' || printf('{SERIES_PATTERN}', id) AS url
FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS id FROM orders)""")
def numbered_series_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series over the whole range of the order keys."""
    from pyspark.sql import functions as F

    from lakesmith.sources.listings import numbered_series

    lo, hi = render.table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return numbered_series(spark, BASELINE_URL, SERIES_PATTERN, lo, hi)


@register("numbered_names", f"""SELECT o_orderkey AS id, '{BASELINE_URL}' || printf('{SERIES_PATTERN}', o_orderkey) AS url
FROM orders""")
def numbered_names_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One numbered file name per order key (the series is the table's keys)."""
    from pyspark.sql import functions as F

    from lakesmith.sources.listings import numbered_names

    ids = render.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return numbered_names(ids, BASELINE_URL, SERIES_PATTERN)


@register("path_functions", """SELECT page_id,
  string_split(url, '/')[-1] AS base,
  array_to_string(list_slice(string_split(url, '/'), 1, greatest(len(string_split(url, '/')) - 1, 0)), '/') AS parent1,
  array_to_string(list_slice(string_split(url, '/'), 1, greatest(len(string_split(url, '/')) - 2, 0)), '/') AS parent2,
  regexp_replace(string_split(url, '/')[-1], '\\.[^./]*$', '') AS stem,
  'lake/' || regexp_replace(string_split(url, '/')[-1], '\\.[^./]*$', '') || '.parquet' AS lake_path,
  concat_ws('/', 'https://example.org', 'pages', CAST(page_id AS VARCHAR)) AS built_url
FROM pages""")
def path_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from lakesmith.functions import paths as P

    pages = render.table(spark, sf_dir, "pages")
    url = F.col("url")
    return pages.select(
        "page_id",
        P.base_name(url).alias("base"),
        P.parent(url, 1).alias("parent1"),
        P.parent(url, 2).alias("parent2"),
        P.strip_last_extension(P.base_name(url)).alias("stem"),
        P.lake_path(url, "lake").alias("lake_path"),
        P.join_url("https://example.org", "pages", F.col("page_id").cast("string")).alias("built_url"),
    )


# ---------------------------------------------------------------- row operators

@register("drop_any_null", """SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def drop_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with status P and priority 5-LOW made null, then rows with any null dropped."""
    from pyspark.sql import functions as F

    from lakesmith.operators.tables import drop_any_null as dropna

    o = render.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    return dropna(o)


@register("sentinel_keep_null", f"""WITH {SQL_LAKE}
SELECT PMID, DOI FROM lake WHERE PMID IS DISTINCT FROM '{SENTINEL_PMID}'""")
def sentinel_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.functions.ids import not_equal_keep_null

    lake = render.link_lake_frame(render.table(spark, sf_dir, "orders"))
    return lake.filter(not_equal_keep_null("PMID", SENTINEL_PMID))


@register("safe_int", f"""WITH {SQL_LAKE}
SELECT PMID AS PMID_text, {_sql_int('PMID')} AS PMID FROM lake""")
def safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.functions.ids import python_int

    lake = render.link_lake_frame(render.table(spark, sf_dir, "orders"))
    return lake.select(lake.PMID.alias("PMID_text"), python_int("PMID").alias("PMID"))


@register("project_rename", """SELECT o_orderkey AS PMID, '10.1000/' || CAST(o_custkey AS VARCHAR) AS DOI FROM orders""")
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional columns named, then projected and renamed."""
    from pyspark.sql import functions as F

    from lakesmith.operators.tables import name_columns, project_rename as pr

    o = render.table(spark, sf_dir, "orders")
    pos = name_columns(o.select("o_orderkey", F.concat(F.lit("10.1000/"), F.col("o_custkey").cast("string"))),
                       "PMID_int", "DOI")
    return pr(pos, {"PMID_int": "PMID", "DOI": "DOI"})


_EVENT_TYPES = ["click", "view", "purchase", "signup"]


@register("domain_reject", """SELECT event_id, event_type FROM events
WHERE event_type IN ('click', 'view', 'purchase', 'signup')""")
def domain_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose type is outside the allowed list are rejected."""
    from lakesmith.functions.ids import in_domain

    ev = render.table(spark, sf_dir, "events")
    return ev.filter(in_domain("event_type", _EVENT_TYPES)).select("event_id", "event_type")


@register("domain_check", """SELECT event_id, event_type FROM events
WHERE event_type IN ('click', 'view', 'purchase', 'signup', 'error')""")
def domain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value is in the domain, so the fail-on-unknown check passes all rows."""
    from pyspark.sql import functions as F

    from lakesmith.functions.ids import in_domain_or_fail

    ev = render.table(spark, sf_dir, "events")
    return ev.select("event_id", in_domain_or_fail(F.col("event_type"), [*_EVENT_TYPES, "error"], "event_type").alias("event_type"))


@register("presence_anti_join", """SELECT o_orderkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_orderstatus = 'F' AND d.o_orderkey = o.o_orderkey)""")
def presence_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders not yet done, where done = orders with status F."""
    from pyspark.sql import functions as F

    from lakesmith.operators.planning import not_yet_done

    o = render.table(spark, sf_dir, "orders")
    done = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    return not_yet_done(o.select("o_orderkey", "o_orderstatus"), done, "o_orderkey")


@register("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.operators.tables import distinct_rows as dr

    return dr(render.table(spark, sf_dir, "events").select("user_id", "event_type"))


@register("load_counts", "SELECT event_type AS source_file, CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY event_type")
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.operators.tables import counts_by

    ev = render.table(spark, sf_dir, "events").withColumnRenamed("event_type", "source_file")
    return counts_by(ev, "source_file")


# ---------------------------------------------------------------- sinks

@register("per_file_sink", "SELECT o_orderstatus AS source_file, CAST(count(*) AS BIGINT) AS rows FROM orders GROUP BY o_orderstatus")
def per_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written one output per status, read back and counted per output."""
    from lakesmith.operators.sinks import write_per_source
    from lakesmith.operators.tables import counts_by
    from lakesmith.session import fresh_dir

    out = fresh_dir(spark, "sink", "per_file")
    o = render.table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "source_file")
    write_per_source(o, out, "source_file", mode="overwrite", rebalance=True)
    return counts_by(spark.read.parquet(out), "source_file")


@register("compaction", f"WITH {SQL_LAKE} SELECT PMID, DOI FROM lake")
def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The many-file lake rewritten as files sized from its bytes, read back."""
    from lakesmith.operators.sinks import files_for, input_bytes, write_compacted
    from lakesmith.session import fresh_dir
    from lakesmith.sources.lake import read_link_lake

    from lakesmith.sources.listings import file_inventory

    lake = render.link_lake(spark, sf_dir)
    out = fresh_dir(spark, "sink", "compacted")
    n = files_for(input_bytes(spark, lake))
    write_compacted(read_link_lake(spark, lake), out, n)
    written = file_inventory(spark, out, "*.parquet").count()
    if written > n:
        raise AssertionError(f"compaction wrote {written} files, expected at most {n}")
    return spark.read.parquet(out)


@register("compaction_incremental", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P') OR (o_orderstatus = 'F' AND o_custkey % 2 = 0)")
def compaction_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small files packed in two runs; in between one status' files are replaced and another status lands."""
    from pyspark.sql import functions as F

    from lakesmith.plans.compaction import compact_new, read_compacted
    from lakesmith.session import fresh_dir

    run = fresh_dir(spark, "compaction", "incremental")
    lake, out = f"{run}/lake", f"{run}/packed"
    orders = render.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")

    def deliver(status: str, some=F.lit(True)):
        rows = orders.where((F.col("o_orderstatus") == status) & some).drop("o_custkey")
        rows.repartition(6).write.mode("overwrite").parquet(f"{lake}/{status}")

    deliver("F")
    deliver("O")
    compact_new(spark, lake, out, target_bytes=1 << 14)
    deliver("F", F.col("o_custkey") % 2 == 0)
    deliver("P")
    compact_new(spark, lake, out, target_bytes=1 << 14)
    return read_compacted(spark, out)


@register("json_sink", "SELECT CAST(json(props) AS VARCHAR) AS value FROM events")
def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.props`` parsed and written as one JSON document per line, read back."""
    from pyspark.sql import functions as F

    from lakesmith.functions.text import strict_json
    from lakesmith.operators.sinks import write_json_documents
    from lakesmith.session import fresh_dir

    out = fresh_dir(spark, "sink", "json")
    ev = render.table(spark, sf_dir, "events").select(strict_json(F.col("props")).alias("doc"))
    write_json_documents(ev, "doc", out)
    return spark.read.text(out)


_NATION_COLS = ["n_nationkey", "n_name", "n_regionkey"]


@register("idempotent_publish", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def idempotent_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published twice, the second time with changed names: nothing changes."""
    from pyspark.sql import functions as F

    from lakesmith.operators.sinks import publish
    from lakesmith.session import fresh_dir

    out = fresh_dir(spark, "publish", "skip")
    nation = render.table(spark, sf_dir, "nation").select(*_NATION_COLS)
    publish(nation, out, ["n_regionkey"])
    publish(nation.withColumn("n_name", F.lower("n_name")), out, ["n_regionkey"])
    return spark.read.parquet(out).select(*_NATION_COLS)


@register("versioned_publish", """SELECT CAST(2 AS BIGINT) AS version, n_nationkey, lower(n_name) AS n_name, n_regionkey FROM nation
UNION ALL SELECT CAST(1 AS BIGINT), n_nationkey, n_name, n_regionkey FROM nation""")
def versioned_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published whole, a write that fails on its way, the next version: both versions can be read."""
    from pyspark.sql import functions as F

    from lakesmith.operators.versions import publish_version, read_version
    from lakesmith.session import fresh_dir

    out = fresh_dir(spark, "publish", "versions")
    nation = render.table(spark, sf_dir, "nation").select(*_NATION_COLS)
    publish_version(nation, out)
    try:
        publish_version(nation.withColumn("n_name", F.when(F.col("n_nationkey") < 3, F.raise_error(F.lit("fails"))).otherwise(F.col("n_name"))), out)
    except Exception as e:  # noqa: BLE001 - the failure is the point
        if "fails" not in str(e):
            raise
    publish_version(nation.withColumn("n_name", F.lower("n_name")), out)
    return read_version(spark, out).select(F.lit(2).cast("long").alias("version"), "*").unionAll(
        read_version(spark, out, 1).select(F.lit(1).cast("long").alias("version"), "*"))


@register("replace_publish", """SELECT n_nationkey,
  CASE WHEN n_regionkey = 0 THEN lower(n_name) ELSE n_name END AS n_name, n_regionkey FROM nation""")
def replace_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second publish with replace=True holds region 0 only: that partition is
    replaced, the others stay."""
    from pyspark.sql import functions as F

    from lakesmith.operators.sinks import publish
    from lakesmith.session import fresh_dir

    out = fresh_dir(spark, "publish", "replace")
    nation = render.table(spark, sf_dir, "nation").select(*_NATION_COLS)
    publish(nation, out, ["n_regionkey"])
    changed = nation.filter(F.col("n_regionkey") == 0).withColumn("n_name", F.lower("n_name"))
    publish(changed, out, ["n_regionkey"], replace=True)
    return spark.read.parquet(out).select(*_NATION_COLS)


# ---------------------------------------------------------------- responses

_SQL_RAW = """CASE WHEN event_type = 'signup' THEN chr(65279) || '(' || props || ')'
  WHEN event_type = 'view' THEN '((' || props || ')'
  WHEN event_type = 'error' THEN '\\(' || props || ')'
  WHEN event_type = 'purchase' THEN 'cb(' || props || ')'
  ELSE '(' || props || ');' END"""


@register("jsonp_unwrap", f"""SELECT '10.1101/' || CAST(event_id AS VARCHAR) AS doi,
  rtrim(ltrim(regexp_replace({_SQL_RAW}, '^' || chr(65279), ''), '\\('), ')') AS body FROM events""")
def jsonp_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.plans.responses import unwrap_responses

    raw = render.jsonp_responses(render.table(spark, sf_dir, "events"))
    return unwrap_responses(raw).select("doi", "body")


@register("json_variant", """SELECT '10.1101/' || CAST(event_id AS VARCHAR) AS doi,
  CASE WHEN event_type IN ('purchase', 'click') THEN NULL
       ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""")
def json_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from lakesmith.plans.responses import unwrap_responses

    raw = render.jsonp_responses(render.table(spark, sf_dir, "events"))
    return unwrap_responses(raw).select("doi", F.try_variant_get("doc", "$.k", "bigint").alias("k"))


@register("json_long_strings", "SELECT doc_id, text AS value, false AS pair FROM documents")
def json_long_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as top-level JSON strings of any length; two values in one text are no JSON text."""
    from pyspark.sql import functions as F

    from lakesmith.functions.text import strict_json

    d = render.table(spark, sf_dir, "documents")
    listed = F.to_json(F.array("text"))
    string = F.substring(listed, F.lit(2), F.length(listed) - 2)
    docs = d.select("doc_id", strict_json(string).alias("doc"), strict_json(F.concat(string, F.lit(" "), string)).alias("two"))
    return docs.select("doc_id", F.try_variant_get("doc", "$", "string").alias("value"), F.col("two").isNotNull().alias("pair"))


@register("response_rejects", f"""SELECT '10.1101/' || CAST(event_id AS VARCHAR) AS doi,
  CASE WHEN event_type IN ('purchase', 'click') THEN NULL ELSE CAST(json(props) AS VARCHAR) END AS document,
  CASE WHEN event_type IN ('purchase', 'click') THEN {_SQL_RAW} END AS raw FROM events""")
def response_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents tied to their ids, and the rejected responses, as the ingest left them on disk."""
    from pyspark.sql import functions as F

    from lakesmith.plans.responses import ingest_responses
    from lakesmith.session import fresh_dir

    out = fresh_dir(spark, "sink", "responses_by_doi")
    ingest_responses(render.jsonp_responses(render.table(spark, sf_dir, "events")), out)
    ok, bad = spark.read.parquet(f"{out}_by_doi"), spark.read.parquet(f"{out}_rejects")
    return ok.withColumn("raw", F.lit(None).cast("string")).unionByName(bad.withColumn("document", F.lit(None).cast("string")))


@register("response_ingest", """SELECT CAST(json(props) AS VARCHAR) AS value FROM events
WHERE event_type NOT IN ('purchase', 'click')""")
def response_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses -> JSON documents on disk, read back."""
    from lakesmith.plans.responses import ingest_responses
    from lakesmith.session import fresh_dir

    out = fresh_dir(spark, "sink", "responses")
    ingest_responses(render.jsonp_responses(render.table(spark, sf_dir, "events")), out)
    return spark.read.text(out)


# ---------------------------------------------------------------- inventory and streams

@register("file_inventory", """SELECT coalesce(CASE WHEN o_orderstatus IN ('F', 'O', 'P') THEN o_orderstatus END, 'other') AS status,
  CAST(count(*) AS BIGINT) AS rows, true AS named FROM orders GROUP BY 1""")
def file_inventory_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered article files listed, each with the records read from it:
    per arrival folder the records add up, and every record's file is listed
    under a name that its lake path is made of."""
    from pyspark.sql import functions as F

    from lakesmith.functions.paths import lake_path, parent, strip_suffix
    from lakesmith.sources.listings import file_inventory
    from lakesmith.sources.xml import read_id_lists

    landing = render.stream_xml_batches(spark, sf_dir)
    plain = lambda c: F.regexp_replace(c, "^file:/*", "/")
    inv = file_inventory(spark, landing, "*.xml.gz").select(
        plain(F.col("path")).alias("path"), "name", "length",
        strip_suffix(F.col("name"), ".xml.gz").alias("stem"),
        lake_path(F.col("path"), "lake", suffix=".xml.gz").alias("lake_path"))
    held = (read_id_lists(spark, f"{landing}/*").groupBy(plain(F.col("path")).alias("path"), F.col("source_file"))
            .agg(F.count(F.lit(1)).alias("k")))
    named = ((F.col("name") == F.col("source_file")) & (F.col("length") > 0)
             & (F.col("lake_path") == F.concat(F.lit("lake/"), F.col("stem"), F.lit(".parquet"))))
    folder = F.regexp_extract(parent(F.col("path"), 1), "batch=(.*)$", 1)
    return held.join(inv, "path", "left").groupBy(folder.alias("status")).agg(
        F.sum("k").alias("rows"), F.bool_and(F.coalesce(named, F.lit(False))).alias("named"))


_SQL_XML_LINKS = f"""SELECT CAST(o_orderkey AS VARCHAR) AS PMID,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN ' ' || {_SQL_DOI} || ' '
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {_SQL_DOI} || '<&>'
       ELSE {_SQL_DOI} END AS DOI
FROM orders
WHERE o_orderpriority <> '1-URGENT' AND NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')"""


@register("stream_ingest", _SQL_XML_LINKS)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrival folders ingested incrementally; the stream is run twice
    and the second run must add nothing (the lake is read after both)."""
    from lakesmith.session import fresh_dir
    from lakesmith.streaming.ingest import stream_xml_links

    landing = render.stream_xml_batches(spark, sf_dir)
    run = fresh_dir(spark, "stream", "ingest")
    lake, ckpt = f"{run}/lake", f"{run}/checkpoint"
    stream_xml_links(spark, landing, lake, ckpt)
    stream_xml_links(spark, landing, lake, ckpt)
    return spark.read.parquet(lake).select("PMID", "DOI")


@register("stream_limited", _SQL_XML_LINKS)
def stream_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per micro-batch: same rows, bounded work per batch."""
    from lakesmith.session import fresh_dir
    from lakesmith.streaming.ingest import stream_xml_links

    landing = render.stream_xml_batches(spark, sf_dir)
    run = fresh_dir(spark, "stream", "limited")
    lake = f"{run}/lake"
    stream_xml_links(spark, landing, lake, f"{run}/checkpoint", max_files_per_trigger=1)
    return spark.read.parquet(lake).select("PMID", "DOI")


@register("stream_cleanup", _SQL_XML_LINKS)
def stream_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed files are deleted once loaded, as the raw files are after a
    load (best effort, one batch late); the files are a fresh rendering, so
    the shared fixture is untouched."""
    from lakesmith.session import fresh_dir
    from lakesmith.sources.listings import file_inventory
    from lakesmith.streaming.ingest import stream_xml_links

    run = fresh_dir(spark, "stream", "cleanup")
    landing = f"{run}/landing"
    render.write_stream_batches(spark, sf_dir, landing)
    stream_xml_links(spark, landing, f"{run}/lake", f"{run}/checkpoint", max_files_per_trigger=1,
                     clean_source="delete")
    left = file_inventory(spark, landing, "*.xml.gz").count()
    if left > 1:
        raise AssertionError(f"{left} processed files are still there, at most the last batch's one may be")
    return spark.read.parquet(f"{run}/lake").select("PMID", "DOI")


# ---------------------------------------------------------------- plain CSV, Latin-1, response URLs

_SQL_CUSTOMER = """SELECT c_custkey,
  replace(c_name, '#', ' "É"' || chr(10) || '#') AS c_name,
  CAST(c_nationkey AS BIGINT) AS c_nationkey,
  CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_nationkey < 5 OR c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer"""


@register("plain_csv_ingest", _SQL_CUSTOMER)
def plain_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same customer rendering as unzipped Latin-1 CSV, read by Spark's CSV source."""
    from lakesmith.operators.tables import infer_and_cast, stage
    from lakesmith.sources.plaincsv import read_csv

    raw = stage(read_csv(spark, render.customer_csv(spark, sf_dir)), "plaincsv")
    return infer_and_cast(raw).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("plain_csv_ranges", """SELECT CAST(o_orderkey AS VARCHAR) AS id,
  'No "' || o_orderstatus || '",' || chr(10) || o_orderpriority || ',' || chr(13) || chr(10) || '"' || o_custkey || chr(10) AS note,
  CAST(o_totalprice AS DOUBLE) AS price, CAST(NULL AS VARCHAR) AS bad_line
FROM orders""")
def plain_csv_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One big file of records over several lines, read in ranges of 64 kB: quoted fields lie across range ends."""
    from pyspark.sql import functions as F

    from lakesmith.sources.plaincsv import read_csv

    t = read_csv(spark, render.order_notes_csv(spark, sf_dir), "*.txt", range_bytes=1 << 16)
    return t.select("id", "note", F.col("price").cast("double").alias("price"), F.col("_bad_line").alias("bad_line"))


@register("plain_csv_quote_split", """SELECT p_partkey,
  replace(p_name, ' ', ' "x", ') AS p_name, p_brand, p_type,
  CAST(p_size AS BIGINT) AS p_size, p_retailprice
FROM part""")
def plain_csv_quote_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.operators.tables import infer_and_cast, stage
    from lakesmith.sources.plaincsv import read_quote_split_csv

    raw = stage(read_quote_split_csv(spark, render.part_quoted_lines(spark, sf_dir)), "plaincsv")
    return infer_and_cast(raw).select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@register("latin1_decode", """SELECT c_custkey, replace(c_name, '#', ' É#') AS c_name FROM customer""")
def latin1_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with a Latin-1 letter as ISO-8859-1 bytes, decoded back."""
    from pyspark.sql import functions as F

    from lakesmith.functions.text import latin1

    c = render.table(spark, sf_dir, "customer")
    raw = c.select("c_custkey", F.encode(F.replace(F.col("c_name"), F.lit("#"), F.lit(" É#")), "ISO-8859-1").alias("b"))
    return raw.select("c_custkey", latin1("b").alias("c_name"))


@register("response_urls", """SELECT '10.1101/' || CAST(event_id AS VARCHAR) AS doi,
  'https://example.org/api/' || '10.1101/' || CAST(event_id AS VARCHAR) AS url FROM events""")
def response_urls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakesmith.plans.responses import response_urls

    dois = render.jsonp_responses(render.table(spark, sf_dir, "events")).select("doi")
    return response_urls(dois, "https://example.org/api/")


@register("zip_plan_ingest", _SQL_CUSTOMER)
def zip_plan_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan for 1985-1989 loaded first, whose archives lack a column, then the
    full 1985-2009 plan: the second run reads only the years not yet in the
    lake; the lake ends with every customer exactly once, in all columns."""
    from lakesmith.plans.csv_ingest import fetch_plan, ingest_planned
    from lakesmith.session import fresh_dir

    landing = render.customer_zips(spark, sf_dir)
    lake = fresh_dir(spark, "lake", "zip_plan")
    ingest_planned(spark, fetch_plan(spark, ["projects"], 1985, 1990), landing, lake, "projects")
    out = ingest_planned(spark, fetch_plan(spark, ["projects"], 1985, 2010), landing, lake, "projects")
    return out.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("stream_new_arrivals", _SQL_XML_LINKS)
def stream_new_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files for two order statuses land and are ingested; the third status
    lands later and the next run adds exactly its rows (each file once)."""
    from lakesmith.session import fresh_dir
    from lakesmith.streaming.ingest import stream_xml_links

    run = fresh_dir(spark, "stream", "arrivals")
    landing, lake, ckpt = f"{run}/landing", f"{run}/lake", f"{run}/checkpoint"
    render.write_stream_batches(spark, sf_dir, landing, statuses=("F", "O"))
    stream_xml_links(spark, landing, lake, ckpt)
    render.write_stream_batches(spark, sf_dir, landing, statuses=("P", render.OTHER))
    stream_xml_links(spark, landing, lake, ckpt)
    return spark.read.parquet(lake).select("PMID", "DOI")


@register("zip_inventory", """SELECT DISTINCT CAST(c_nationkey + 1985 AS INT) AS data_year,
  'lake/projects/' || CAST(c_nationkey + 1985 AS VARCHAR) || '.parquet' AS lake_path
FROM customer""")
def zip_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed archives listed (no file opened), the year parsed from each
    name and mapped to its lake path: one row per year present."""
    from pyspark.sql import functions as F

    from lakesmith.sources.listings import file_inventory

    inv = file_inventory(spark, render.customer_zips(spark, sf_dir), "*.zip")
    year = F.regexp_extract(F.col("name"), r"^([0-9]{4})", 1)
    return inv.select(
        year.cast("int").alias("data_year"),
        F.concat(F.lit("lake/projects/"), year, F.lit(".parquet")).alias("lake_path"),
    ).distinct()


# ---------------------------------------------------------------- dirty CSV

_SQL_KIND = "(['open', 'quoted', 'long', 'ragged'])[CAST(s_suppkey % 4 AS INT) + 1]"


@register("zip_dirty_csv", f"""SELECT {_SQL_KIND} AS source_file,
  CASE {_SQL_KIND} WHEN 'open' THEN CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_suppkey AS VARCHAR) END
    WHEN 'ragged' THEN CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey AS VARCHAR) END
    ELSE CAST(s_suppkey AS VARCHAR) END AS s_suppkey,
  CASE {_SQL_KIND} WHEN 'open' THEN CASE WHEN s_suppkey % 7 <> 0 THEN s_name END
    WHEN 'quoted' THEN 'a "b" ' || s_name
    WHEN 'long' THEN s_name || CASE WHEN s_suppkey % 50 = 0 THEN repeat('x', 200000) ELSE '' END
    ELSE CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 3 <> 0 THEN s_name END END AS s_name,
  CASE WHEN {_SQL_KIND} = 'open' AND s_suppkey % 7 = 0 THEN s_suppkey || ',"' || s_name
    WHEN {_SQL_KIND} = 'ragged' AND s_suppkey % 5 = 0 THEN s_suppkey || ',' || s_name || ',more' END AS bad_line
FROM supplier""")
def zip_dirty_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unclosed quotes, bare quotes, 200,000-character fields, rows too long and
    too short: every source line is a row or a ``_bad_line``."""
    from pyspark.sql import functions as F

    from lakesmith.plans.csv_ingest import cleaned_rows

    rows = cleaned_rows(spark, render.dirty_zips(spark, sf_dir))
    return rows.select("source_file", "s_suppkey", "s_name", F.col("_bad_line").alias("bad_line"))


@register("csv_headers", """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey,
  CASE WHEN n_nationkey % 3 = 2 THEN NULL ELSE n_name END AS v,
  CASE WHEN n_nationkey % 3 = 2 THEN NULL ELSE CAST(n_regionkey AS VARCHAR) END AS v_1,
  CASE WHEN n_nationkey % 3 = 0 THEN 'z' END AS blank, CASE WHEN n_nationkey % 3 = 1 THEN 'd' END AS dotted,
  CASE WHEN n_nationkey % 3 = 2 THEN n_name END AS mode_1, CASE WHEN n_nationkey % 3 = 2 THEN CAST(n_regionkey AS VARCHAR) END AS source_1
FROM nation""")
def csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files under headers of their own: repeated, blank, case-only repeated and
    dotted names, names of the engine's columns, and columns in another order."""
    from lakesmith.operators.tables import column
    from lakesmith.sources.plaincsv import read_csv

    t = read_csv(spark, render.header_csv(spark, sf_dir), "*.txt")
    named = {"v": "v", "v_1": "v.1", "blank": "Unnamed: 3", "dotted": "a.b", "mode_1": "_mode.1", "source_1": "source_file.1"}
    return t.select("n_nationkey", *[column(name).alias(alias) for alias, name in named.items()])


@register("safe_types", """SELECT s_suppkey, s_suppkey || 'D' AS suffixed, '0x' || s_suppkey AS hexlike,
  '1234567890123456' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS long_id, s_suppkey / 4.0 AS ratio, CAST(s_suppkey AS BIGINT) AS whole FROM supplier""")
def safe_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that a bare cast would take for numbers stays text; numbers become numbers."""
    from pyspark.sql import functions as F

    from lakesmith.operators.tables import infer_and_cast

    s = render.table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    text = s.select(
        "s_suppkey", F.concat(key, F.lit("D")).alias("suffixed"), F.concat(F.lit("0x"), key).alias("hexlike"),
        F.concat(F.lit("1234567890123456"), F.lpad(key, 4, "0")).alias("long_id"),
        (F.col("s_suppkey") / 4).cast("string").alias("ratio"), F.concat(F.lit(" "), key).alias("whole"))
    return infer_and_cast(text)


@register("publish_odd_partitions", """SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'a:b' WHEN 2 THEN 'p%2F+q r' ELSE 'plain' END AS part FROM customer""")
def publish_odd_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published twice, under partition values that are null or need path escapes: nothing is added."""
    from pyspark.sql import functions as F

    from lakesmith.operators.sinks import publish
    from lakesmith.session import fresh_dir

    group = F.col("c_nationkey") % 4
    part = F.when(group == 1, "a:b").when(group == 2, "p%2F+q r").when(group == 3, "plain")
    rows = render.table(spark, sf_dir, "customer").select("c_custkey", part.alias("part"))
    out = fresh_dir(spark, "publish", "odd")
    publish(rows, out, ["part"])
    publish(rows, out, ["part"])
    return spark.read.schema("c_custkey bigint, part string").parquet(out)


@register("xml_mixed_lake", _SQL_XML_LINKS)
def xml_mixed_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream, then a batch load, then a stream again into one lake: every row once."""
    from lakesmith.plans.xml_ingest import ingest_xml
    from lakesmith.session import fresh_dir
    from lakesmith.streaming.ingest import stream_xml_links

    run = fresh_dir(spark, "stream", "mixed")
    landing, lake = f"{run}/landing", f"{run}/lake"
    render.write_stream_batches(spark, sf_dir, landing, statuses=("F",))
    stream_xml_links(spark, landing, lake)
    render.write_stream_batches(spark, sf_dir, landing, statuses=("O",))
    ingest_xml(spark, landing, lake)
    render.write_stream_batches(spark, sf_dir, landing, statuses=("P", render.OTHER))
    stream_xml_links(spark, landing, lake, f"{run}/other_checkpoint")   # reads all again, replaces what it gave
    return spark.read.parquet(lake).select("PMID", "DOI")


@register("xml_damaged_files", f"""{_SQL_XML_LINKS}
UNION ALL SELECT 'damaged', 'cut' UNION ALL SELECT 'damaged', 'two'""")
def xml_damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive that ends in the middle and one with two roots among the others: all others are loaded, both are listed."""
    from pyspark.sql import functions as F

    from lakesmith.plans.xml_ingest import dead_letters, read_link_partitions
    from lakesmith.session import fresh_dir
    from lakesmith.streaming.ingest import stream_xml_links

    run = fresh_dir(spark, "stream", "damaged")
    landing, lake = f"{run}/landing", f"{run}/lake"
    render.write_stream_batches(spark, sf_dir, landing)
    render.write_damaged_articles(landing)
    stream_xml_links(spark, landing, lake)
    stream_xml_links(spark, landing, lake)   # nothing has changed, so nothing is tried again
    dead = dead_letters(spark, lake).select(F.lit("damaged").alias("PMID"), F.col("source_file").alias("DOI"))
    return read_link_partitions(spark, lake).select("PMID", "DOI").unionAll(dead)


@register("xml_redelivered", f"{_SQL_XML_LINKS} AND coalesce(o_orderstatus <> 'F', TRUE)")
def xml_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of one order status are delivered again, now without articles: their rows go, all others stay."""
    from lakesmith.plans.xml_ingest import ingest_xml
    from lakesmith.session import fresh_dir

    run = fresh_dir(spark, "lake", "redelivered")
    landing, lake = f"{run}/landing", f"{run}/lake"
    render.write_stream_batches(spark, sf_dir, landing)
    ingest_xml(spark, landing, lake)
    render.empty_articles(f"{landing}/batch=F")
    return ingest_xml(spark, landing, lake, skip_present=False).select("PMID", "DOI")
