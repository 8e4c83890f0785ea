"""DuckDB CTEs that derive every S-fixture expectation from ``customer`` alone
(``k = c_custkey``); they never look at HTML.  See ``sources/fixtures.py``."""

from __future__ import annotations

from leadforge import params
from leadforge.sources.fixtures import SECTOR_FIXTURE


def _sec_values() -> str:
    return ", ".join(f"('{s}', {i}, {'NULL' if mp is None else mp})" for i, (s, _f, mp) in enumerate(SECTOR_FIXTURE, start=1))


LISTING_URL = (
    "CASE WHEN {p} = 1 THEN 'https://dir.test/companies/' || {s} || '.html' "
    "ELSE 'https://dir.test/companies/' || {s} || '/pg-' || CAST({p} AS VARCHAR) || '.html' END"
)

BASE = f"""
sec(sector, sector_ord, max_pages) AS (VALUES {_sec_values()}),
co AS (
  SELECT c.c_custkey AS k, c.c_name, lower(c.c_mktsegment) AS sector, s.sector_ord, s.max_pages,
         row_number() OVER (PARTITION BY lower(c.c_mktsegment) ORDER BY c.c_custkey) - 1 AS pos
  FROM customer c JOIN sec s ON s.sector = lower(c.c_mktsegment)),
co2 AS (
  SELECT *, pos // 25 + 1 AS own_page,
         'co' || translate(CAST(k AS VARCHAR), '0123456789', 'abcdefghij') AS w,
         (CASE WHEN k % 12 = 3 THEN '/pl' ELSE '' END)
           || (CASE WHEN k % 6 = 4 THEN '/ACME-TOOLS-' ELSE '/CO-' END)
           || CAST(k AS VARCHAR) || '/' || CAST(k AS VARCHAR) || '-001.html' AS href,
         CASE WHEN k % 6 = 4 THEN 'Acme Tools' ELSE c_name END AS exp_name,
         CASE k % 6 WHEN 0 THEN 'text' WHEN 1 THEN 'text' WHEN 2 THEN 'title' WHEN 3 THEN 'aria-label'
                    WHEN 4 THEN 'slug' ELSE 'title' END AS exp_source
  FROM co),
comp AS (SELECT *, 'https://dir.test' || href AS company_url, 'https://www.' || w || '.com' AS site FROM co2),
npages AS (SELECT sector, max(own_page) AS n_pages FROM co2 GROUP BY sector),
mp AS (SELECT n_pages AS m_pages FROM npages WHERE sector = 'machinery'),
place AS (
  SELECT sector, own_page AS page_no, 1 AS g, pos AS o, k FROM co2
  UNION ALL
  SELECT c.sector, c.own_page + 1, 0, c.pos, c.k FROM co2 c JOIN npages n ON n.sector = c.sector
   WHERE c.pos % 25 = 24 AND c.own_page < n.n_pages
  UNION ALL
  SELECT 'machinery', (k // 50) % m_pages + 1, 2, k, k FROM co2, mp WHERE k % 50 = 0),
links AS (
  SELECT p.sector, CAST(p.page_no AS INTEGER) AS page_no,
         CAST(row_number() OVER (PARTITION BY p.sector, p.page_no ORDER BY p.g, p.o) AS INTEGER) AS link_pos,
         c.k, c.exp_name AS name, c.exp_source AS name_source, c.company_url, c.href
  FROM place p JOIN comp c ON c.k = p.k),
visited AS (
  SELECT n.sector, s.sector_ord, gs.page_no
  FROM npages n JOIN sec s ON s.sector = n.sector,
       LATERAL (SELECT CAST(unnest(range(1, n.n_pages + 1)) AS INTEGER) AS page_no) gs),
visited_bounded AS (
  SELECT v.* FROM visited v JOIN sec s ON s.sector = v.sector WHERE v.page_no <= CASE WHEN v.sector = 'furniture' THEN 1 ELSE coalesce(s.max_pages, 2) END),
occ AS (SELECT l.*, v.sector_ord FROM links l JOIN visited v ON v.sector = l.sector AND v.page_no = l.page_no),
d3 AS (
  SELECT company_url, arg_min(sector, (sector_ord, page_no, link_pos)) AS sector,
         arg_min(sector_ord, (sector_ord, page_no, link_pos)) AS sector_ord,
         arg_min(page_no, (sector_ord, page_no, link_pos)) AS page_no,
         arg_min(link_pos, (sector_ord, page_no, link_pos)) AS link_pos,
         arg_min(name, (sector_ord, page_no, link_pos)) AS name,
         arg_min(k, (sector_ord, page_no, link_pos)) AS k
  FROM occ GROUP BY company_url),
prof AS (
  SELECT k, company_url, w, site,
         CASE k % 12 WHEN 0 THEN 'Germany' WHEN 1 THEN 'Spain' WHEN 2 THEN 'France' WHEN 3 THEN 'Poland'
                     WHEN 5 THEN 'United Kingdom' WHEN 6 THEN 'Austria' WHEN 7 THEN 'Portugal'
                     WHEN 8 THEN 'Italy' WHEN 9 THEN 'Turkey' WHEN 11 THEN 'United Kingdom' ELSE '' END AS country,
         CASE WHEN (k // 10) % 5 = 4 THEN '' ELSE site END AS website_url,
         (k // 10) % 5 AS wv
  FROM comp WHERE k % 40 <> 39),
profx AS (
  SELECT c.k, coalesce(p.country, '') AS country, coalesce(p.website_url, '') AS website_url
  FROM comp c LEFT JOIN prof p ON p.k = c.k),
home_emails AS (
  SELECT k, site AS page_url, e AS email FROM (
    SELECT k, site, CASE k % 10
        WHEN 1 THEN ['office@' || w || '.com'] WHEN 2 THEN ['office@' || w || '.com']
        WHEN 3 THEN ['office@' || w || '.com'] WHEN 4 THEN ['doe@' || w || '.com']
        WHEN 6 THEN ['sales@group.com']
        WHEN 7 THEN [x || '@' || w || '.com' FOR x IN ['aa', 'bb', 'cc', 'dd', 'ee', 'ff']]
        WHEN 8 THEN ['aa@' || w || '.com', 'bb@' || w || '.com']
        ELSE [] END AS es
    FROM comp WHERE (k // 10) % 5 <> 4 AND k % 20 <> 15), unnest(es) AS t(e)),
sub_emails AS (
  SELECT k, site || '/contact' AS page_url, 1 AS page_rank, 'sales@' || w || '.com' AS email FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 = 0
  UNION ALL SELECT k, site || '/contact', 1, 'gg@' || w || '.com' FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 = 7
  UNION ALL SELECT k, site || '/contact', 1, 'cc@' || w || '.com' FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 = 8
  UNION ALL SELECT k, site || '/contact', 1, 'dd@' || w || '.com' FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 = 8
  UNION ALL SELECT k, site || '/ueber', 2, 'ee@' || w || '.com' FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 = 8
  UNION ALL SELECT k, site || '/ueber', 2, 'ff@' || w || '.com' FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 = 8
  UNION ALL SELECT k, site || '/team', 3, 'gg@' || w || '.com' FROM comp WHERE (k // 10) % 5 <> 4 AND k % 10 = 8),
site_em AS (
  SELECT k, email FROM home_emails
  UNION ALL SELECT k, email FROM sub_emails WHERE (k % 10 = 0)
  UNION ALL SELECT k, email FROM sub_emails WHERE k % 10 = 8 AND page_rank <= 2),
site_em_all AS (SELECT k, email FROM home_emails UNION SELECT k, email FROM sub_emails)
"""

# Site emails with a sector's custom business domains: machinery accepts yahoo.com.
SITE_EM_SECTOR = """
site_em_sector AS (
  SELECT d.sector, d.sector_ord, d.page_no, d.link_pos, d.company_url, d.name, se.email
  FROM d3 d JOIN site_em se ON se.k = d.k
  UNION ALL
  SELECT d.sector, d.sector_ord, d.page_no, d.link_pos, d.company_url, d.name, 'abc@yahoo.com'
  FROM d3 d JOIN comp c ON c.k = d.k
  WHERE d.sector = 'machinery' AND c.k % 10 = 5 AND c.k % 20 <> 15 AND (c.k // 10) % 5 <> 4),
e13 AS (
  SELECT sector, email, arg_min(company_url, (page_no, link_pos)) AS company_url
  FROM site_em_sector GROUP BY sector, email)
"""


SITE_EM_ALL = SITE_EM_SECTOR.replace("JOIN site_em se", "JOIN site_em_all se")


def with_base(body: str, extra: str = "") -> str:
    return "WITH " + BASE + ("," + extra if extra else "") + "\n" + body


__all__ = ["with_base", "LISTING_URL", "SITE_EM_SECTOR", "params"]
