"""Queries over the crawl snapshot ``pages`` (T tests: the oracle reads the raw
HTML with regular expressions; the Spark side parses it).

Facts of the test pages these oracles rely on: anchors are
``<a href="..">text</a>`` inside the one ``<nav>``, hrefs are root-relative,
and anchor text holds no character references.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.select import sel
from leadforge.functions.urls import country_from_url, is_valid_website
from leadforge.operators import discovery
from leadforge.operators.dom import elements, parse_pages
from leadforge.operators.links import anchors, resolve, selected
from leadforge.sources.pages import lookup_pages, read_pages

ORIGIN_RE = r"^(https?://[^/?#]*)"


def _dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_pages(read_pages(spark, sf_dir), keep=["page_id", "url"])


def scan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL plus its site's ``/contact`` URL, looked up in the
    snapshot; a miss is a NULL page."""
    pages = read_pages(spark, sf_dir)
    wanted = pages.select(F.explode(F.array(
        F.col("url"), F.concat(F.regexp_extract("url", ORIGIN_RE, 1), F.lit("/contact")))).alias("url"))
    found = lookup_pages(wanted, pages)
    return found.select(
        "url",
        F.col("html").isNotNull().alias("found"),
        F.length("html").cast("bigint").alias("html_chars"),
    )


def html_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: elements per tag over all pages."""
    return (
        elements(_dom(spark, sf_dir))
        .groupBy("tag")
        .agg(F.count("*").alias("n_elements"), F.countDistinct("url").alias("n_pages"))
    )


def extract_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: anchors with href, in document order per page."""
    return anchors(_dom(spark, sf_dir), keep=["page_id"]).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "href", F.col("text").alias("anchor_text")
    )


def resolve_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: anchors resolved against their page URL."""
    a = anchors(_dom(spark, sf_dir), keep=["page_id", "url"])
    return resolve(a).select("page_id", F.col("pos").cast("bigint").alias("pos"), "href", "abs_url")


def css_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: ``nav a[href]`` and ``li a`` counts per page (selector records)."""
    dom = _dom(spark, sf_dir)
    from leadforge.functions.select import count

    return dom.select(
        "page_id",
        F.size(F.col("elems")).cast("bigint").alias("n_elements"),
        count(sel("a", attrs=[("href",)], inside=sel("nav"))).cast("bigint").alias("nav_links"),
        count(sel("a", inside=sel("li", inside=sel("ul")))).cast("bigint").alias("list_links"),
        count(sel("div", cls="ad")).cast("bigint").alias("ad_blocks"),
    )


def element_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: raw and stripped text of the ``div.ad`` block and of the nav links."""
    dom = _dom(spark, sf_dir)
    ad = selected(dom, sel("div", cls="ad"), keep=["page_id"]).select(
        "page_id", F.lit("ad").alias("part"), F.col("pos").cast("bigint").alias("pos"), "text", "stext"
    )
    nav = selected(dom, sel("a", inside=sel("nav")), keep=["page_id"]).select(
        "page_id", F.lit("nav_a").alias("part"), F.col("pos").cast("bigint").alias("pos"), "text", "stext"
    )
    return ad.unionByName(nav)


def valid_website_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 on the page URLs."""
    return read_pages(spark, sf_dir).select("page_id", "url", is_valid_website(F.col("url")).alias("valid"))


def country_from_url_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 on the page URLs."""
    return read_pages(spark, sf_dir).select("page_id", "url", country_from_url(F.col("url")).alias("country"))


def region_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links per search region (nav, header, footer, main menu, sidebar,
    whole page), one row per enclosing region element, with the P2/P3 match."""
    return discovery.region_links(_dom(spark, sf_dir), keep=["page_id"]).select(
        "page_id",
        "area",
        F.col("area_prio").cast("bigint").alias("area_prio"),
        F.col("link_ord").cast("bigint").alias("link_ord"),
        "href",
        "is_contact",
    )


def generated_contact_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 for every distinct site (origin) in the snapshot."""
    sites = read_pages(spark, sf_dir).select(F.regexp_extract("url", ORIGIN_RE, 1).alias("site_url")).distinct()
    return discovery.generated_urls(sites, "site_url").select(
        "site_url", F.col("rank").cast("bigint").alias("rank"), "page_name", "page_url"
    )


def dedup_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 on nav links: each resolved URL kept once, with its first page and
    position (order: page_id, pos)."""
    from leadforge.operators.dedup import first_by

    a = resolve(anchors(_dom(spark, sf_dir), keep=["page_id", "url"]))
    firsts = first_by(a, ["abs_url"], ["page_id", "pos"], ["page_id", "pos"])
    return firsts.select("abs_url", F.col("page_id").alias("first_page_id"), F.col("pos").cast("bigint").alias("first_pos"))


QUERIES = {
    "scan_pages": scan_pages,
    "html_elements": html_elements,
    "extract_anchors": extract_anchors,
    "resolve_links": resolve_links,
    "css_select": css_select,
    "element_text": element_text,
    "valid_website_url": valid_website_url,
    "country_from_url": country_from_url_q,
    "region_links": region_links,
    "generated_contact_urls": generated_contact_urls,
    "dedup_links": dedup_links,
}

# -- oracles (DuckDB over the raw tables) ------------------------------------------

_ANCHORS_SQL = """
  SELECT page_id, url,
         CAST(generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1), 1) AS BIGINT) AS pos,
         unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
         unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS anchor_text
  FROM pages
"""

_ENTITY_DECODE = (
    "replace(replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), "
    "'&quot;', '\"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
)

_URL_COUNTRY_CASE = "CASE " + " ".join(
    f"WHEN contains(lower(url), '{seg}') THEN '{name}'" for seg, name in params.URL_COUNTRY_SEGMENTS
) + " END"

_UNWANTED = ", ".join(f"'{u}'" for u in params.UNWANTED_WEBSITE_PARTS)

_KEYWORDS = sorted({k for ks in params.CONTACT_KEYWORDS.values() for k in ks})
_KW_SQL = ", ".join(f"'{k}'" for k in _KEYWORDS)
_PAT_SQL = ", ".join(f"'{p}'" for p in params.CONTACT_PAGE_PATTERNS)


def _generated_values() -> str:
    rows = []
    for i, pat in enumerate(params.CONTACT_PAGE_PATTERNS[: params.GENERATED_PATTERN_COUNT], start=1):
        name = "Contact " + pat.replace("/", "").replace("-", " ").title()
        rows.append(f"({i}, '{pat}', '{name}')")
    return ", ".join(rows)


ORACLES = {
    "scan_pages": f"""
        WITH wanted AS (
          SELECT url FROM pages
          UNION
          SELECT regexp_extract(url, '{ORIGIN_RE}', 1) || '/contact' FROM pages)
        SELECT w.url, p.html IS NOT NULL AS found, CAST(length(p.html) AS BIGINT) AS html_chars
        FROM wanted w LEFT JOIN pages p ON p.url = w.url
    """,
    "html_elements": """
        SELECT tag, count(*) AS n_elements, count(DISTINCT url) AS n_pages
        FROM (SELECT url, lower(unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages)
        GROUP BY tag
    """,
    "extract_anchors": f"SELECT page_id, pos, href, anchor_text FROM ({_ANCHORS_SQL})",
    "resolve_links": f"""
        SELECT page_id, pos, href, regexp_extract(url, '{ORIGIN_RE}', 1) || href AS abs_url
        FROM ({_ANCHORS_SQL})
    """,
    "css_select": """
        SELECT page_id,
               CAST(len(regexp_extract_all(html, '<[a-zA-Z]')) AS BIGINT) AS n_elements,
               CAST(len(regexp_extract_all(html, '<a href=')) AS BIGINT) AS nav_links,
               CAST(len(regexp_extract_all(html, '<li><a ')) AS BIGINT) AS list_links,
               CAST(len(regexp_extract_all(html, '<div class="ad">')) AS BIGINT) AS ad_blocks
        FROM pages
    """,
    "element_text": f"""
        SELECT page_id, 'ad' AS part, CAST(1 AS BIGINT) AS pos,
               {_ENTITY_DECODE.format(x="regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")} AS text,
               trim({_ENTITY_DECODE.format(x="regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")}) AS stext
        FROM pages
        UNION ALL
        SELECT page_id, 'nav_a', pos, anchor_text, trim(anchor_text) FROM ({_ANCHORS_SQL})
    """,
    "valid_website_url": f"""
        SELECT page_id, url,
               (starts_with(url, 'http://') OR starts_with(url, 'https://'))
               AND NOT list_bool_or([contains(lower(url), x) FOR x IN [{_UNWANTED}]]) AS valid
        FROM pages
    """,
    "country_from_url": f"SELECT page_id, url, {_URL_COUNTRY_CASE} AS country FROM pages",
    "region_links": f"""
        WITH a AS ({_ANCHORS_SQL}),
        areas AS (SELECT * FROM (VALUES ('nav', 1), ('content', 6)) t(area, area_prio))
        SELECT page_id, area, CAST(area_prio AS BIGINT) AS area_prio, CAST(pos AS BIGINT) AS link_ord, href,
               (list_bool_or([contains(lower(trim(anchor_text)), k) FOR k IN [{_KW_SQL}]])
                OR list_bool_or([contains(lower(trim(href)), p) FOR p IN [{_PAT_SQL}]])) AS is_contact
        FROM a CROSS JOIN areas
        WHERE trim(href) <> '' AND NOT starts_with(trim(href), 'javascript:') AND NOT starts_with(trim(href), '#')
    """,
    "generated_contact_urls": f"""
        WITH sites AS (SELECT DISTINCT regexp_extract(url, '{ORIGIN_RE}', 1) AS site_url FROM pages),
        pat AS (SELECT * FROM (VALUES {_generated_values()}) t(rank, pattern, page_name))
        SELECT site_url, CAST(rank AS BIGINT) AS rank, page_name, rtrim(site_url, '/') || pattern AS page_url
        FROM sites CROSS JOIN pat
    """,
    "dedup_links": f"""
        SELECT abs_url, arg_min(page_id, (page_id, pos)) AS first_page_id,
               CAST(arg_min(pos, (page_id, pos)) AS BIGINT) AS first_pos
        FROM (SELECT page_id, pos, regexp_extract(url, '{ORIGIN_RE}', 1) || href AS abs_url FROM ({_ANCHORS_SQL}))
        GROUP BY abs_url
    """,
}
