"""Directory, country and website queries on the synthesised crawl (S tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.country import context_ok, normalize_country
from leadforge.functions.select import sel, select, strip_text
from leadforge.operators import directory as D
from leadforge.operators.country import country_columns
from leadforge.operators.dom import parse_pages
from leadforge.operators.website import website_columns, website_exprs, website_url
from leadforge.plans.fixture_sql import LISTING_URL, with_base
from leadforge.sources import fixtures as FX


def listing_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_pages(FX.crawl(spark, sf_dir)[0], keep=["sector", "page_no", "url"])


def profile_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_pages(FX.crawl(spark, sf_dir)[1])


def features(spark: SparkSession, sf_dir: str, bounded: bool = False) -> DataFrame:
    return D.listing_features(parse_pages(FX.crawl(spark, sf_dir)[0]), FX.fixture_sector_config(spark, sf_dir, bounded))


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.fixture_sector_config(spark, sf_dir)


def d3_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.directory_companies(features(spark, sf_dir), config(spark, sf_dir))


# -- D ---------------------------------------------------------------------------

def company_links(spark, sf_dir):
    """D1 on every listing page."""
    return D.company_links(listing_dom(spark, sf_dir), keep=["sector", "page_no"]).select(
        "sector", "page_no", F.col("link_pos").cast("int").alias("link_pos"), "name", "company_url")


def company_name(spark, sf_dir):
    """D2 with the rule that produced each name."""
    return D.company_links(listing_dom(spark, sf_dir), keep=["sector", "page_no"]).select(
        "sector", "page_no", F.col("link_pos").cast("int").alias("link_pos"), "name_source", "name")


def next_page(spark, sf_dir):
    """D5 on every listing page."""
    return D.next_pages(listing_dom(spark, sf_dir), keep=["sector", "page_no"]).select("sector", "page_no", "next_url")


def follow_pagination(spark, sf_dir):
    """Pages each sector's walk visits."""
    return D.visited_pages(features(spark, sf_dir, bounded=True), FX.fixture_sector_config(spark, sf_dir, bounded=True)).select(
        "sector", F.col("page_no").cast("int").alias("page_no"), "url")


def dedup_companies(spark, sf_dir):
    """First occurrence of each company within its sector."""
    d = D.directory_companies(features(spark, sf_dir), config(spark, sf_dir), group=["sector"])
    return d.select("sector", "company_url", "name", F.col("page_no").cast("int").alias("page_no"),
                    F.col("link_pos").cast("int").alias("link_pos"))


def dedup_cross_sector(spark, sf_dir):
    """D3: first occurrence across sectors (shared seen-URL set)."""
    return d3_companies(spark, sf_dir).select("sector", "company_url", "name", F.col("page_no").cast("int").alias("page_no"),
                                              F.col("link_pos").cast("int").alias("link_pos"))


def new_links_anti_join(spark, sf_dir):
    """D3 incremental: this run's companies minus those an earlier run (which
    read only the first listing page of every sector) already saw."""
    f = features(spark, sf_dir)
    first = config(spark, sf_dir).select("url", D.selector_key().alias("sel_key"))
    history = D.feature_links(f.join(first, ["sel_key", "url"], "left_semi"))
    now = D.directory_companies(f, config(spark, sf_dir))
    from leadforge.operators.dedup import drop_seen

    return drop_seen(now, history.select(F.col("company_url")), "company_url").select("sector", "company_url")


def limit_companies(spark, sf_dir):
    """First 20 companies per sector (the pipeline's setting)."""
    d = D.limit_per_group(d3_companies(spark, sf_dir), ["sector"], ["page_no", "link_pos"], params.DEFAULT_COMPANY_LIMIT)
    return d.select("sector", "company_url", "name", F.col("page_no").cast("int").alias("page_no"),
                    F.col("link_pos").cast("int").alias("link_pos"))


# -- C / W -----------------------------------------------------------------------

def _countries(spark, sf_dir):
    return country_columns(profile_dom(spark, sf_dir))


def _method(col):
    def q(spark, sf_dir):
        c = _countries(spark, sf_dir)
        return c.filter(F.col(col).isNotNull()).select("url", F.col(col).alias("country"))
    q.__doc__ = f"Country method column {col!r} where it finds one."
    return q


def company_country(spark, sf_dir):
    """The cascade result for every profile ('' if none)."""
    return _countries(spark, sf_dir).select("url", "country")


def normalize_country_q(spark, sf_dir):
    """C3 on the text of every span of the profile pages."""
    dom = profile_dom(spark, sf_dir)
    spans = F.transform(select(sel("span")), lambda e, i: F.struct((i + 1).alias("pos"), strip_text(e).alias("text")))
    rows = dom.select("url", F.explode(spans).alias("s")).select("url", F.col("s.pos").cast("int").alias("pos"), "s.text")
    return rows.withColumn("country", normalize_country(F.col("text")))


def country_context(spark, sf_dir):
    """C5 on every address block of the profile pages."""
    dom = profile_dom(spark, sf_dir)
    blocks = F.transform(select(sel(attrs=[("class", "*=", "address")])), lambda e: F.lower(strip_text(e)))
    rows = dom.select("url", F.explode(blocks).alias("text"))
    return rows.select("url", "text", context_ok(F.col("text")).alias("context_ok"))


def _websites(spark, sf_dir):
    return website_columns(profile_dom(spark, sf_dir))


def website_button(spark, sf_dir):
    """First website button and whether its URL is valid."""
    return _websites(spark, sf_dir).filter(F.col("button_href").isNotNull()).select("url", "button_href", "button_valid")


def website_fallback(spark, sf_dir):
    """W2 on its own."""
    return _websites(spark, sf_dir).filter(F.col("fallback_href").isNotNull()).select("url", "fallback_href")


def enrich_companies(spark, sf_dir):
    """Every company (after D3) with country and website ('' if none)."""
    comp = d3_companies(spark, sf_dir)
    prof = profile_dom(spark, sf_dir)
    feats = country_columns(prof, extra=website_exprs()).select("url", "country", website_url().alias("website_url"))
    out = comp.join(feats, comp["company_url"] == feats["url"], "left")
    return out.select("sector", "name", "company_url", F.coalesce("country", F.lit("")).alias("country"),
                      F.coalesce("website_url", F.lit("")).alias("website_url"))


QUERIES = {
    "company_links": company_links,
    "company_name": company_name,
    "next_page": next_page,
    "follow_pagination": follow_pagination,
    "dedup_companies": dedup_companies,
    "dedup_cross_sector": dedup_cross_sector,
    "new_links_anti_join": new_links_anti_join,
    "limit_companies": limit_companies,
    "country_flag_pattern": _method("flag_pattern"),
    "country_flag_sibling": _method("flag_sibling"),
    "country_selectors": _method("selectors"),
    "country_jsonld": _method("json_ld"),
    "country_meta": _method("meta"),
    "company_country": company_country,
    "normalize_country": normalize_country_q,
    "country_context": country_context,
    "website_button": website_button,
    "website_fallback": website_fallback,
    "enrich_companies": enrich_companies,
}

_D6 = """
  SELECT sector, company_url, arg_min(name, (page_no, link_pos)) AS name,
         arg_min(page_no, (page_no, link_pos)) AS page_no, arg_min(link_pos, (page_no, link_pos)) AS link_pos
  FROM occ GROUP BY sector, company_url
"""

ORACLES = {
    "company_links": with_base("SELECT sector, page_no, link_pos, name, company_url FROM links"),
    "company_name": with_base("SELECT sector, page_no, link_pos, name_source, name FROM links"),
    "next_page": with_base(f"""
        SELECT n.sector, CAST(p.page_no AS INTEGER) AS page_no,
               CASE WHEN p.page_no < n.n_pages THEN {LISTING_URL.format(p='p.page_no + 1', s='n.sector')}
                    WHEN n.sector = 'machinery' AND p.page_no > 1 THEN {LISTING_URL.format(p='p.page_no', s='n.sector')}
               END AS next_url
        FROM npages n, LATERAL (SELECT unnest(range(1, n.n_pages + 1)) AS page_no) p
    """),
    "follow_pagination": with_base(f"SELECT sector, page_no, {LISTING_URL.format(p='page_no', s='sector')} AS url FROM visited_bounded"),
    "dedup_companies": with_base(_D6),
    "dedup_cross_sector": with_base("SELECT sector, company_url, name, page_no, link_pos FROM d3"),
    "new_links_anti_join": with_base("""
        SELECT sector, company_url FROM d3
        WHERE company_url NOT IN (SELECT company_url FROM links WHERE page_no = 1)
    """),
    "limit_companies": with_base(f"""
        SELECT sector, company_url, name, page_no, link_pos FROM (
          SELECT *, row_number() OVER (PARTITION BY sector ORDER BY page_no, link_pos) AS rn FROM d3)
        WHERE rn <= {params.DEFAULT_COMPANY_LIMIT}
    """),
    "country_flag_pattern": with_base("SELECT company_url AS url, 'Germany' AS country FROM prof WHERE k % 12 = 0"),
    "country_flag_sibling": with_base("""
        SELECT company_url AS url, CASE k % 12 WHEN 0 THEN 'Germany' ELSE 'Spain' END AS country
        FROM prof WHERE k % 12 IN (0, 1)
    """),
    "country_selectors": with_base("""
        SELECT company_url AS url,
               CASE k % 12 WHEN 0 THEN 'Germany' WHEN 2 THEN 'France' WHEN 9 THEN 'Turkey' ELSE 'United Kingdom' END AS country
        FROM prof WHERE k % 12 IN (0, 2, 9, 11)
    """),
    "country_jsonld": with_base("SELECT company_url AS url, 'United Kingdom' AS country FROM prof WHERE k % 12 = 5"),
    "country_meta": with_base("SELECT company_url AS url, 'Austria' AS country FROM prof WHERE k % 12 = 6"),
    "company_country": with_base("SELECT company_url AS url, country FROM prof"),
    "normalize_country": with_base("""
        SELECT company_url AS url, 1 AS pos, '' AS text, '' AS country FROM prof WHERE k % 12 IN (0, 9)
        UNION ALL
        SELECT company_url, 2, CASE k % 12 WHEN 0 THEN 'Deutschland' ELSE 'Turkey' END,
               CASE k % 12 WHEN 0 THEN 'Germany' ELSE '' END FROM prof WHERE k % 12 IN (0, 9)
        UNION ALL
        SELECT company_url, 1, 'España', 'Spain' FROM prof WHERE k % 12 = 1
    """),
    "country_context": with_base(f"""
        SELECT company_url AS url,
               CASE k % 12 WHEN 2 THEN '12 rue x, france' WHEN 4 THEN 'exports to italy'
                           WHEN 8 THEN '{FX.FILLER_500}italy' ELSE 'kyiv, ukraine' END AS text,
               k % 12 <> 4 AS context_ok
        FROM prof WHERE k % 12 IN (2, 4, 8, 11)
    """),
    "website_button": with_base("""
        SELECT company_url AS url, CASE WHEN wv = 2 THEN 'https://www.dropbox.com/x' ELSE site END AS button_href,
               wv <> 2 AS button_valid
        FROM prof WHERE wv IN (0, 1, 2)
    """),
    "website_fallback": with_base("SELECT company_url AS url, site AS fallback_href FROM prof WHERE wv IN (0, 1, 2, 3)"),
    "enrich_companies": with_base("""
        SELECT d.sector, d.name, d.company_url, p.country, p.website_url
        FROM d3 d JOIN profx p ON p.k = d.k
    """),
}
