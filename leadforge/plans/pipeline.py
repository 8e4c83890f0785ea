"""The contact pipeline for all sectors at once.

    sector_config + listing crawl -> companies (D1-D7)
    companies + page crawl        -> country, website (C*, W*)
    websites + page crawl         -> pages to check (P1-P7)
    pages to check + page crawl   -> emails (E1-E13)

Every page is parsed once and reduced, in the same projection, to the small
per-page features the later stages need; those feature tables are cut from
their lineage (reliable checkpoint) because each feeds more than one branch.
The crawl is only ever joined on the URL; only scalars and the config's
distinct selectors reach the driver.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from leadforge import params
from leadforge.operators import directory as D
from leadforge.operators import discovery as P
from leadforge.operators import emails as E
from leadforge.operators.country import country_columns
from leadforge.operators.dom import parse_pages
from leadforge.operators.website import website_exprs, website_url
from leadforge.session import cut_lineage
from leadforge.sources.pages import lookup_pages


@dataclass
class Run:
    config: DataFrame
    companies: DataFrame        # after D3 (+ D7 when limited)
    enriched: DataFrame         # + country, website_url ('' when none)
    homes: DataFrame            # site_url, discovery + candidate columns (per distinct website)
    pages_to_check: DataFrame   # site_url, rank, page_name, page_url
    page_cands: DataFrame       # page_url, candidate columns
    site_emails: DataFrame      # sector, company_url, email, first_rank  (before E13)
    contacts: DataFrame         # sector, company_url, email (after E13)
    started: float = field(default_factory=time.monotonic)
    observations: dict[str, Observation] = field(default_factory=dict)

    def seconds(self) -> float:
        """Since the run began."""
        return time.monotonic() - self.started

    def observed(self) -> dict[str, dict]:
        """Per crawl read (``listings``, ``homepages``): pages read, pages that
        are missing, pages that the parser rejected."""
        return {name: o.get for name, o in self.observations.items()}


def parsed(pages: DataFrame, keep: list[str], sep: str = "") -> DataFrame:
    """``parse_pages`` with ``stored``: whether there was any HTML to parse."""
    flagged = pages.withColumn("stored", F.col("html").isNotNull())
    return parse_pages(flagged, keep=[*keep, "stored"], sep=sep)


def rejected() -> Column:
    """A stored page that the parser could not read."""
    return F.col("stored") & F.col("elems").isNull()


def _counted(dom: DataFrame, name: str, into: dict[str, Observation]) -> DataFrame:
    """Counts the pages as they pass (no job of its own)."""
    into[name] = Observation(name)
    return dom.observe(into[name], F.count(F.lit(1)).alias("pages"), F.count_if(~F.col("stored")).alias("missing"), F.count_if(rejected()).alias("rejected"))


def _profiles(companies: DataFrame, pages: DataFrame) -> DataFrame:
    urls = companies.select(F.col("company_url").alias("url")).distinct()
    dom = parsed(lookup_pages(urls, pages), ["url"])
    fetched = F.col("elems").isNotNull().alias("profile_fetched")
    feats = country_columns(dom, keep=["url", "stored"], extra=[*website_exprs(), fetched, rejected().alias("profile_rejected")]).select(
        "url", "country", "profile_fetched", "profile_rejected", website_url().alias("website_url"))
    return feats


def run(config: DataFrame, listings: DataFrame, pages: DataFrame, limit: int | None = None,
        max_contact_pages: int | None = params.MAX_CONTACT_PAGES, stop_at: int | None = params.EARLY_STOP_EMAILS,
        text_pattern: str = params.EMAIL_TEXT_PATTERN, sep: str = "", match: str = "exact") -> Run:
    """``config(sector, sector_ord, url, max_pages, business_domain_keywords,
    link_selector, pagination_selector)`` (see ``sources.config``);
    ``listings(url, html)`` the directory crawl; ``pages(url, html)`` the crawl
    of profiles and company sites.  The reproduced tool reads five contact
    pages a site and stops after five addresses, to save fetches; on a stored
    crawl ``max_contact_pages=None, stop_at=None`` reads all that is there.
    ``text_pattern`` (K5), ``sep`` between text nodes (K7) and ``match`` of the
    keywords (K2: ``exact`` or ``contains``) are the reproduced tool's by default."""
    started, seen = time.monotonic(), {}
    # the config feeds several small actions (walk bound, broadcast checks)
    config = cut_lineage(config)
    features = D.listing_features(_counted(parsed(listings.select("url", "html"), ["url"]), "listings", seen), config)
    companies = D.directory_companies(features, config)
    companies = D.limit_per_group(companies, ["sector"], ["page_no", "link_pos"], limit)
    # four consumers (profile lookup and its size check, enrichment, E13 order, stats)
    companies = cut_lineage(companies)

    prof = _profiles(companies, pages)
    enriched = companies.join(prof, companies["company_url"] == prof["url"], "left").select(
        *companies.columns,
        F.coalesce("country", F.lit("")).alias("country"),
        F.coalesce("website_url", F.lit("")).alias("website_url"),
        F.coalesce("profile_fetched", F.lit(False)).alias("profile_fetched"),
        F.coalesce("profile_rejected", F.lit(False)).alias("profile_rejected"),
    )
    enriched = cut_lineage(enriched)

    with_site = enriched.filter(F.trim(F.col("website_url")) != F.lit(""))
    sites = with_site.select(F.col("website_url").alias("site_url")).distinct()
    home_pages = E.with_pattern_hits(lookup_pages(sites, pages, "site_url"))
    home_dom = _counted(parsed(home_pages, ["site_url", "pattern_hits"], sep), "homepages", seen)
    homes = cut_lineage(home_dom.select("site_url", *P.discovery_exprs(), *E.candidate_exprs(text_pattern=text_pattern)))

    # small (at most 6 rows a site) but read three times: lookup size check,
    # lookup, pages-to-check
    discovered = cut_lineage(P.discover_from(homes, "site_url", max_contact_pages))
    to_check = homes.select("site_url", F.lit(0).alias("rank"), F.lit("Homepage").alias("page_name"),
                            F.col("site_url").alias("page_url")).unionByName(discovered)

    others = discovered.select("page_url").distinct()
    page_cands = E.page_candidates(lookup_pages(others, pages, "page_url"), keep=["page_url"], text_pattern=text_pattern, sep=sep)
    home_cands = homes.select(F.col("site_url").alias("page_url"), "fetched", "mailto", "text_hits",
                              "area_hits", "pattern_hits")
    all_cands = home_cands.unionByName(page_cands.join(home_cands.select("page_url"), "page_url", "left_anti"))

    # The keyword lists come from the sector config: one row per configured sector.
    # They go to the visits: joined by sector, a sector's visits would meet in one task.
    keywords = config.select("sector", F.coalesce("business_domain_keywords", F.array().cast("array<string>"))
                             .alias("custom"))
    # E12 depends only on the site and the sector's keyword list, so it runs
    # once per (sector, site): a site shared by many companies is visited once.
    site_keys = with_site.select("sector", F.col("website_url").alias("site_url")).distinct()
    # Dealt like the lookups, into a number of parts that AQE keeps: the cleaning
    # behind the join costs far more than the few bytes of the candidates show.
    parts = int(config.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    visits = (
        site_keys.join(to_check, "site_url").repartition(parts, "page_url")
        .join(all_cands.repartition(parts, "page_url"), "page_url")
        .join(F.broadcast(keywords), "sector")
    )
    emails = E.page_emails(visits, ["sector", "site_url", "rank"], custom_col="custom", match=match)
    per_site = E.site_emails(emails, ["sector", "site_url"], stop_at)
    site = with_site.select("sector", "company_url", F.col("website_url").alias("site_url")).join(
        per_site, ["sector", "site_url"]).select("sector", "company_url", "email", "first_rank")
    site = cut_lineage(site)

    order = companies.select("sector", "company_url", "page_no", "link_pos")
    ranked = site.join(order, ["sector", "company_url"])
    contacts = E.dedup_emails(ranked, ["sector"], ["page_no", "link_pos"], ["company_url"])
    return Run(config, companies, enriched, homes, to_check, all_cands, site, contacts, started, seen)


def contacts_export(r: Run) -> DataFrame:
    """S6 projection with the sector: one row per kept email."""
    e = r.enriched.select("sector", "company_url", "name", "country", "website_url")
    return r.contacts.join(e, ["sector", "company_url"]).select(
        "sector",
        F.coalesce("name", F.lit("")).alias("Company Name"),
        F.col("country").alias("Country"),
        F.col("website_url").alias("Company Website URL"),
        F.col("email").alias("Email"),
    )


__all__ = ["run", "Run", "contacts_export", "params"]
