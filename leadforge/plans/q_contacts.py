"""Discovery, email, statistics and export queries on the synthesised crawl."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.email import clean_email
from leadforge.operators import discovery as P
from leadforge.operators import emails as E
from leadforge.operators import stats as A
from leadforge.operators.dom import parse_pages
from leadforge.plans import pipeline
from leadforge.plans.fixture_sql import SITE_EM_ALL, SITE_EM_SECTOR, with_base
from leadforge.sources import fixtures as FX
from leadforge.sources import sinks as S
from leadforge.sources.pages import lookup_pages


def fixture_run(spark: SparkSession, sf_dir: str, limit: int | None = None, **caps) -> pipeline.Run:
    """The pipeline over the synthesised crawl (``FX.crawl``: written once to
    the checkpoint folder, like a stored crawl table)."""
    cfg = FX.fixture_sector_config(spark, sf_dir)
    listings, profiles, sites = FX.crawl(spark, sf_dir)
    return pipeline.run(cfg, listings.select("url", "html"), profiles.unionByName(sites), limit=limit, **caps)


def _site_cands(spark, sf_dir) -> DataFrame:
    return E.page_candidates(FX.crawl(spark, sf_dir)[2])


def _sites(spark, sf_dir) -> DataFrame:
    co = FX.crawl_companies(spark, sf_dir).filter(F.floor(F.col("k") / 10) % 5 != 4)
    return co.select(FX.site_url(F.col("k")).alias("site_url"))


def _homes(spark, sf_dir) -> DataFrame:
    return parse_pages(lookup_pages(_sites(spark, sf_dir), FX.crawl(spark, sf_dir)[2], "site_url"), keep=["site_url"])


# -- E ---------------------------------------------------------------------------

def _method_emails(col: str):
    def q(spark, sf_dir):
        c = _site_cands(spark, sf_dir)
        e = c.select("url", F.explode(col).alias("raw")).select("url", clean_email(F.col("raw")).alias("email"))
        return e.filter(F.col("email").isNotNull()).distinct()
    return q


def emails_mailto(spark, sf_dir):
    """Cleaned mailto addresses per page."""
    return _method_emails("mailto")(spark, sf_dir)


def emails_text(spark, sf_dir):
    """E2 on the page text (no conditional), cleaned."""
    return _method_emails("text_hits")(spark, sf_dir)


def emails_contact_areas(spark, sf_dir):
    """Addresses in contact areas (text and mailto)."""
    return _method_emails("area_hits")(spark, sf_dir)


def _pattern_emails(pattern: str):
    def q(spark, sf_dir):
        # raw-HTML patterns need no parse: straight on the crawl rows
        site_pages = FX.crawl(spark, sf_dir)[2]
        m = site_pages.select("url", F.explode(F.regexp_extract_all("html", F.lit(E.UI + pattern), 0)).alias("m"))
        e = m.select("url", clean_email(E._unobfuscate(F.col("m"))).alias("email"))
        return e.filter(F.col("email").isNotNull()).distinct()
    q.__doc__ = "E4-E6: one raw-HTML pattern over every company-site page, un-obfuscated and cleaned."
    return q


def page_emails(spark, sf_dir):
    """E11 on every company-site page (no custom domain list)."""
    return E.page_emails(_site_cands(spark, sf_dir), ["url"]).distinct()


def site_emails(spark, sf_dir):
    """E12 per company, with its sector's domain list, before E13."""
    r = fixture_run(spark, sf_dir)
    return r.site_emails.select("sector", "company_url", "email")


def dedup_emails(spark, sf_dir):
    """Each address stays with the first company of its sector."""
    return fixture_run(spark, sf_dir).contacts.select("sector", "company_url", "email")


def sector_contacts(spark, sf_dir):
    """E15 (flagship): the whole pipeline, all sectors, no company limit."""
    return pipeline.contacts_export(fixture_run(spark, sf_dir))


def sector_contacts_all(spark, sf_dir):
    """E15 without the fetch-saving caps: every discovered page of every site
    is read, and no address count ends a visit."""
    return pipeline.contacts_export(fixture_run(spark, sf_dir, max_contact_pages=None, stop_at=None))


# -- P ---------------------------------------------------------------------------

def discover_contact_pages(spark, sf_dir):
    """P5 for every company website."""
    return P.discover_contact_pages(_homes(spark, sf_dir)).select(
        "site_url", F.col("rank").cast("int").alias("rank"), "page_name", "page_url")


def pages_to_check(spark, sf_dir):
    """Homepage (rank 0) then P5."""
    return P.pages_to_check(_homes(spark, sf_dir)).select(
        "site_url", F.col("rank").cast("int").alias("rank"), "page_name", "page_url")


def _homepage_links(spark, sf_dir):
    homes = parse_pages(FX.crawl(spark, sf_dir)[2])
    homes = homes.join(_sites(spark, sf_dir).withColumnRenamed("site_url", "url"), "url", "left_semi")
    return P.region_links(homes)


def contact_link_text(spark, sf_dir):
    """Homepage links whose text has a contact keyword."""
    l = _homepage_links(spark, sf_dir)
    return l.filter(P.is_contact_link(F.struct("link_text", F.lit("").alias("href")))).select(
        "url", "area", F.col("link_ord").cast("int").alias("link_ord"), "href", "link_text")


def contact_link_href(spark, sf_dir):
    """Homepage links whose href has a contact URL pattern."""
    l = _homepage_links(spark, sf_dir)
    return l.filter(P.is_contact_link(F.struct(F.lit("").alias("link_text"), "href"))).select(
        "url", "area", F.col("link_ord").cast("int").alias("link_ord"), "href", "link_text")


# -- A ---------------------------------------------------------------------------

def run_stats(spark, sf_dir):
    """A1-A3 per sector."""
    return A.run_stats(fixture_run(spark, sf_dir))


def scraping_stats(spark, sf_dir):
    """A4 per sector; the time only as what can be compared, that it is not
    negative."""
    return A.scraping_stats(fixture_run(spark, sf_dir)).withColumn("processing_time_seconds", F.col("processing_time_seconds") >= 0)


def geo_distribution(spark, sf_dir):
    """A5: companies per country."""
    return A.geo_distribution(fixture_run(spark, sf_dir))


def funnel_counts(spark, sf_dir):
    """Unique, limited (20), with contacts among the limited."""
    return A.funnel_counts(fixture_run(spark, sf_dir), params.DEFAULT_COMPANY_LIMIT)


# -- S ---------------------------------------------------------------------------

def export_links(spark, sf_dir):
    """S3: the rows the links sink writes (Name, URL, Country)."""
    return S.links_rows(fixture_run(spark, sf_dir))


def export_links_with_websites(spark, sf_dir):
    """Every company with country and website ('' when none)."""
    return S.links_with_websites_rows(fixture_run(spark, sf_dir))


def export_emails(spark, sf_dir):
    """One row per kept email (Name, Country, Email)."""
    return S.emails_rows(fixture_run(spark, sf_dir))


def export_emails_with_websites(spark, sf_dir):
    """One row per kept email with the company website."""
    return S.emails_with_websites_rows(fixture_run(spark, sf_dir))


def output_manifest(spark, sf_dir):
    """File labels and row counts per sector and dataset."""
    return S.manifest(fixture_run(spark, sf_dir)).withColumn("processing_time_seconds", F.col("processing_time_seconds") >= 0)


QUERIES = {
    "emails_mailto": emails_mailto,
    "emails_text": emails_text,
    "emails_contact_areas": emails_contact_areas,
    "emails_entity": _pattern_emails(params.EMAIL_ENTITY_PATTERN),
    "emails_spaced": _pattern_emails(params.EMAIL_SPACED_PATTERN),
    "emails_js_mailto": _pattern_emails(params.EMAIL_JS_MAILTO_PATTERN),
    "page_emails": page_emails,
    "site_emails": site_emails,
    "dedup_emails": dedup_emails,
    "sector_contacts": sector_contacts,
    "sector_contacts_all": sector_contacts_all,
    "discover_contact_pages": discover_contact_pages,
    "pages_to_check": pages_to_check,
    "contact_link_text": contact_link_text,
    "contact_link_href": contact_link_href,
    "run_stats": run_stats,
    "scraping_stats": scraping_stats,
    "geo_distribution": geo_distribution,
    "funnel_counts": funnel_counts,
    "export_links": export_links,
    "export_links_with_websites": export_links_with_websites,
    "export_emails": export_emails,
    "export_emails_with_websites": export_emails_with_websites,
    "output_manifest": output_manifest,
}

# -- oracles -----------------------------------------------------------------------

_HOME = "FROM comp WHERE (k // 10) % 5 <> 4 AND k % 20 <> 15"
_SUB = "FROM comp WHERE (k // 10) % 5 <> 4"


def _em(local: str) -> str:
    return f"'{local}@' || w || '.com'"


_GEN = [("/contact", "Contact Contact"), ("/contact-us", "Contact Contact Us"), ("/contacts", "Contact Contacts"),
        ("/contacto", "Contact Contacto"), ("/contatti", "Contact Contatti"), ("/about", "Contact About")]
_GEN_SQL = ", ".join(f"({i}, '{p}', '{n}')" for i, (p, n) in enumerate(_GEN, start=1))

_P5 = f"""
  SELECT site AS site_url, g.rank, g.page_name, site || g.pattern AS page_url
  FROM comp, (VALUES {_GEN_SQL}) g(rank, pattern, page_name)
  WHERE (k // 10) % 5 <> 4 AND (k % 20 = 15 OR (k % 10 NOT IN (0, 7, 8) AND g.rank <= 5))
  UNION ALL
  SELECT site, n.rank, n.page_name, site || n.path
  FROM comp, (VALUES (1, '/contact', 'Contact (contact)', 0), (2, '/ueber', 'Contact (über uns)', 0),
                     (3, '/team', 'Contact (team)', 8), (4, '/extra', 'Contact (info)', 8)) n(rank, path, page_name, only_k)
  WHERE (k // 10) % 5 <> 4 AND k % 20 <> 15 AND k % 10 IN (0, 7, 8) AND (n.only_k = 0 OR k % 10 = 8)
"""

_NAV = """
  FROM comp, (VALUES ('nav', 1), ('content', 1)) a(area, dummy),
       (VALUES (1, '/contact', 'contact', 0), (2, '/ueber', 'über uns', 0), (3, '/team', 'team', 8), (4, '/extra', 'info', 8)) n(link_ord, href, link_text, only_k)
  WHERE (k // 10) % 5 <> 4 AND k % 20 <> 15 AND k % 10 IN (0, 7, 8) AND (n.only_k = 0 OR k % 10 = 8)
"""

_RUN = SITE_EM_SECTOR + """,
withc AS (SELECT sector, company_url, count(*) AS n_emails FROM site_em_sector GROUP BY sector, company_url),
kept AS (SELECT sector, count(*) AS total FROM e13 GROUP BY sector),
ds AS (SELECT sector, count(*) AS n_companies FROM d3 GROUP BY sector),
dw AS (SELECT sector, count(*) AS n_with FROM withc GROUP BY sector)
"""

ORACLES = {
    "emails_mailto": with_base(f"SELECT site || '/contact' AS url, {_em('sales')} AS email {_SUB} AND k % 10 = 0"),
    "emails_text": with_base(f"""
        SELECT page_url AS url, email FROM home_emails h JOIN comp c ON c.k = h.k WHERE c.k % 10 <> 3
        UNION ALL SELECT site || '/contact', {_em('cc')} {_SUB} AND k % 10 = 8
        UNION ALL SELECT site || '/contact', {_em('dd')} {_SUB} AND k % 10 = 8
        UNION ALL SELECT site || '/ueber', {_em('ee')} {_SUB} AND k % 10 = 8
        UNION ALL SELECT site || '/ueber', {_em('ff')} {_SUB} AND k % 10 = 8
        UNION ALL SELECT site || '/team', {_em('gg')} {_SUB} AND k % 10 = 8
    """),
    "emails_contact_areas": with_base(f"""
        SELECT site || '/contact' AS url, {_em('cc')} AS email {_SUB} AND k % 10 = 8
        UNION ALL SELECT site || '/contact', {_em('dd')} {_SUB} AND k % 10 = 8
    """),
    "emails_entity": with_base(f"SELECT site AS url, {_em('office')} AS email {_HOME} AND k % 10 = 2"),
    "emails_spaced": with_base("""
        SELECT page_url AS url, email FROM home_emails h WHERE h.k % 10 <> 2
        UNION ALL SELECT page_url, email FROM sub_emails
    """),
    "emails_js_mailto": with_base(f"SELECT site || '/contact' AS url, {_em('gg')} AS email {_SUB} AND k % 10 = 7"),
    "page_emails": with_base("SELECT page_url AS url, email FROM home_emails UNION SELECT page_url, email FROM sub_emails"),
    "site_emails": with_base("SELECT sector, company_url, email FROM site_em_sector", SITE_EM_SECTOR),
    "dedup_emails": with_base("SELECT sector, company_url, email FROM e13", SITE_EM_SECTOR),
    "sector_contacts": with_base("""
        SELECT e.sector, d.name AS "Company Name", p.country AS "Country", p.website_url AS "Company Website URL",
               e.email AS "Email"
        FROM e13 e JOIN d3 d ON d.company_url = e.company_url JOIN profx p ON p.k = d.k
    """, SITE_EM_SECTOR),
    "sector_contacts_all": with_base("""
        SELECT e.sector, d.name AS "Company Name", p.country AS "Country", p.website_url AS "Company Website URL",
               e.email AS "Email"
        FROM e13 e JOIN d3 d ON d.company_url = e.company_url JOIN profx p ON p.k = d.k
    """, SITE_EM_ALL),
    "discover_contact_pages": with_base(f"SELECT site_url, CAST(rank AS INTEGER) AS rank, page_name, page_url FROM ({_P5})"),
    "pages_to_check": with_base(f"""
        SELECT site_url, CAST(rank AS INTEGER) AS rank, page_name, page_url FROM ({_P5})
        UNION ALL SELECT site, 0, 'Homepage', site {_SUB}
    """),
    "contact_link_text": with_base(f"""
        SELECT site AS url, area, CAST(link_ord AS INTEGER) AS link_ord, n.href, link_text {_NAV} AND link_text <> 'team'
    """),
    "contact_link_href": with_base(f"""
        SELECT site AS url, area, CAST(link_ord AS INTEGER) AS link_ord, n.href, link_text {_NAV} AND n.href IN ('/contact', '/team')
    """),
    "run_stats": with_base("""
        SELECT ds.sector, ds.n_companies, coalesce(dw.n_with, 0) AS n_with_contacts,
               coalesce(kept.total, 0) AS total_emails,
               coalesce(kept.total, 0) / greatest(coalesce(dw.n_with, 0), 1) AS avg_emails_per_company,
               coalesce(dw.n_with, 0) / greatest(ds.n_companies, 1) * 100 AS success_rate
        FROM ds LEFT JOIN dw USING (sector) LEFT JOIN kept USING (sector)
    """, _RUN),
    "scraping_stats": with_base("""
        SELECT ds.sector, ds.n_companies AS companies_found, x.processed AS companies_processed,
               coalesce(kept.total, 0) AS emails_found, x.errors AS errors, CAST(0 AS BIGINT) AS rejected, TRUE AS processing_time_seconds,
               x.processed / greatest(ds.n_companies, 1) * 100 AS success_rate
        FROM ds LEFT JOIN kept USING (sector)
        JOIN (SELECT d.sector, CAST(sum(CASE WHEN d.k % 40 <> 39 THEN 1 ELSE 0 END) AS BIGINT) AS processed,
                     CAST(sum(CASE WHEN d.k % 40 <> 39 THEN coalesce(er.n, 0) ELSE 1 END) AS BIGINT) AS errors
              FROM d3 d LEFT JOIN err er ON er.k = d.k GROUP BY d.sector) x USING (sector)
    """, _RUN + f""",
pgs AS (SELECT c.k, p.page_url FROM ({_P5}) p JOIN comp c ON c.site = p.site_url
        UNION ALL SELECT k, site FROM comp WHERE (k // 10) % 5 <> 4),
have AS (SELECT site AS u FROM comp WHERE (k // 10) % 5 <> 4 AND k % 20 <> 15
         UNION ALL SELECT site || '/contact' FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 IN (0, 7, 8)
         UNION ALL SELECT site || '/ueber' FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 = 8
         UNION ALL SELECT site || '/team' FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 = 8),
err AS (SELECT k, count(*) AS n FROM pgs WHERE page_url NOT IN (SELECT u FROM have) GROUP BY k)
"""),
    "geo_distribution": with_base("""
        SELECT p.country, count(*) AS n_companies FROM d3 d JOIN profx p ON p.k = d.k GROUP BY p.country
    """),
    "funnel_counts": with_base(f"""
        SELECT ds.sector, ds.n_companies AS unique_companies, count(l.company_url) AS limited_companies,
               count(w.company_url) AS with_contacts
        FROM ds LEFT JOIN (SELECT sector, company_url FROM (
                  SELECT *, row_number() OVER (PARTITION BY sector ORDER BY page_no, link_pos) AS rn FROM d3)
                WHERE rn <= {params.DEFAULT_COMPANY_LIMIT}) l USING (sector)
        LEFT JOIN withc w ON w.sector = l.sector AND w.company_url = l.company_url
        GROUP BY ds.sector, ds.n_companies
    """, _RUN),
    "export_links": with_base("""
        SELECT d.sector, d.name AS "Name", d.company_url AS "URL", p.country AS "Country"
        FROM d3 d JOIN profx p ON p.k = d.k
    """),
    "export_links_with_websites": with_base("""
        SELECT d.sector, d.name AS "Company Name", p.country AS "Country", d.company_url AS "Europages URL",
               p.website_url AS "Company Website URL"
        FROM d3 d JOIN profx p ON p.k = d.k
    """),
    "export_emails": with_base("""
        SELECT e.sector, d.name AS "Name", p.country AS "Country", e.email AS "Email"
        FROM e13 e JOIN d3 d ON d.company_url = e.company_url JOIN profx p ON p.k = d.k
    """, SITE_EM_SECTOR),
    "export_emails_with_websites": with_base("""
        SELECT e.sector, d.name AS "Company Name", p.country AS "Country", p.website_url AS "Company Website URL",
               e.email AS "Email"
        FROM e13 e JOIN d3 d ON d.company_url = e.company_url JOIN profx p ON p.k = d.k
    """, SITE_EM_SECTOR),
    "output_manifest": with_base("""
        SELECT sector, 'links' AS dataset, 'links_' || sector || '_found_' || CAST(n_companies AS VARCHAR) || '.csv' AS label,
               n_companies, n_companies AS n_rows, TRUE AS processing_time_seconds FROM ds
        UNION ALL
        SELECT ds.sector, 'emails', 'emails_' || ds.sector || '_found_' || CAST(coalesce(dw.n_with, 0) AS VARCHAR) || '.csv',
               coalesce(dw.n_with, 0), coalesce(kept.total, 0), TRUE
        FROM ds LEFT JOIN dw USING (sector) LEFT JOIN kept USING (sector)
    """, _RUN),
}
