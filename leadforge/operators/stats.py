"""Run statistics as aggregations (partial + final, never collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_sector(r) -> DataFrame:
    """``sector, n_companies, n_with_contacts, total_emails`` (after E13)."""
    comp = r.companies.groupBy("sector").agg(F.count("*").alias("n_companies"))
    withc = r.site_emails.select("sector", "company_url").distinct().groupBy("sector").agg(
        F.count("*").alias("n_with_contacts"))
    kept = r.contacts.groupBy("sector").agg(F.count("*").alias("total_emails"))
    return comp.join(withc, "sector", "left").join(kept, "sector", "left").select(
        "sector", "n_companies",
        F.coalesce("n_with_contacts", F.lit(0)).alias("n_with_contacts"),
        F.coalesce("total_emails", F.lit(0)).alias("total_emails"),
    )


def run_stats(r) -> DataFrame:
    """A1 total emails, A2 average per company with contacts (denominator
    ``max(n, 1)``), A3 success rate in percent."""
    s = _per_sector(r)
    return s.select(
        "sector", "n_companies", "n_with_contacts", "total_emails",
        (F.col("total_emails") / F.greatest("n_with_contacts", F.lit(1))).alias("avg_emails_per_company"),
        (F.col("n_with_contacts") / F.greatest("n_companies", F.lit(1)) * 100).alias("success_rate"),
    )


def scraping_stats(r) -> DataFrame:
    """A4: companies found; processed (their profile page was fetched); emails;
    errors (pages that could not be fetched: profiles, homepages, contact
    pages to check, one for each company they belong to); profiles that are
    stored but that the parser rejected (among the errors); success rate in
    percent of the companies found; seconds since the run began."""
    s = _per_sector(r)
    missing = (r.pages_to_check.join(r.page_cands.select("page_url", "fetched"), "page_url")
               .filter(~F.col("fetched")).groupBy(F.col("site_url").alias("website_url")).agg(F.count("*").alias("n_missing")))
    fetched = F.col("profile_fetched").cast("long")
    per_sector = r.enriched.join(missing, "website_url", "left").groupBy("sector").agg(
        F.sum(fetched).alias("processed"), F.sum(1 - fetched + F.coalesce("n_missing", F.lit(0))).alias("errors"),
        F.sum(F.col("profile_rejected").cast("long")).alias("rejected"))
    return s.join(per_sector, "sector").select(
        "sector",
        F.col("n_companies").alias("companies_found"),
        F.col("processed").alias("companies_processed"),
        F.col("total_emails").alias("emails_found"),
        "errors",
        "rejected",
        (F.col("processed") / F.greatest("n_companies", F.lit(1)) * 100).alias("success_rate"),
        F.lit(r.seconds()).alias("processing_time_seconds"),
    )


def geo_distribution(r) -> DataFrame:
    """A5: companies per country ('' = unknown)."""
    return r.enriched.groupBy("country").agg(F.count("*").alias("n_companies"))


def funnel_counts(r, limit: int) -> DataFrame:
    """Unique companies, companies kept by the per-sector limit, and of
    those the ones with at least one email."""
    from leadforge.operators.directory import limit_per_group

    limited = limit_per_group(r.companies, ["sector"], ["page_no", "link_pos"], limit).select("sector", "company_url")
    withc = r.site_emails.select("sector", "company_url").distinct().withColumn("_has", F.lit(1))
    lim = limited.join(withc, ["sector", "company_url"], "left").groupBy("sector").agg(
        F.count("*").alias("limited_companies"), F.count("_has").alias("with_contacts"))
    uniq = r.companies.groupBy("sector").agg(F.count("*").alias("unique_companies"))
    return uniq.join(lim, "sector", "left").select(
        "sector", "unique_companies",
        F.coalesce("limited_companies", F.lit(0)).alias("limited_companies"),
        F.coalesce("with_contacts", F.lit(0)).alias("with_contacts"),
    )
