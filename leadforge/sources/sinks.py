"""CSV/JSON sinks and the output manifest.

Each ``*_rows`` function returns exactly the projection its writer stores
(with ``sector`` as the partition column); the writers add only the format.
Missing values are written as empty strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _s(c: str):
    return F.coalesce(F.col(c), F.lit(""))


def links_rows(r) -> DataFrame:
    """S3: ``Name, URL, Country``."""
    return r.enriched.select("sector", _s("name").alias("Name"), F.col("company_url").alias("URL"),
                             _s("country").alias("Country"))


def links_with_websites_rows(r) -> DataFrame:
    """Every company, with or without website."""
    return r.enriched.select("sector", _s("name").alias("Company Name"), _s("country").alias("Country"),
                             F.col("company_url").alias("Europages URL"),
                             _s("website_url").alias("Company Website URL"))


def _emails(r) -> DataFrame:
    return r.contacts.join(r.enriched, ["sector", "company_url"])


def emails_rows(r) -> DataFrame:
    """One row per email."""
    return _emails(r).select("sector", _s("name").alias("Name"), _s("country").alias("Country"),
                             F.col("email").alias("Email"))


def emails_with_websites_rows(r) -> DataFrame:
    """One row per email; companies without emails do not appear."""
    return _emails(r).select("sector", _s("name").alias("Company Name"), _s("country").alias("Country"),
                             _s("website_url").alias("Company Website URL"), F.col("email").alias("Email"))


def manifest(r) -> DataFrame:
    """Per sector and dataset the file label and counts.  The emails label
    counts companies that had emails before cross-company dedup (they stay
    listed even when dedup empties them).  Every row has the seconds since the
    run began."""
    links = r.companies.groupBy("sector").agg(F.count("*").alias("n_companies"))
    withc = r.site_emails.select("sector", "company_url").distinct().groupBy("sector").agg(F.count("*").alias("n_with"))
    kept = r.contacts.groupBy("sector").agg(F.count("*").alias("n_rows"))
    a = links.select("sector", F.lit("links").alias("dataset"),
                     F.concat(F.lit("links_"), F.col("sector"), F.lit("_found_"), F.col("n_companies").cast("string"),
                              F.lit(".csv")).alias("label"),
                     "n_companies", F.col("n_companies").alias("n_rows"))
    e = links.join(withc, "sector", "left").join(kept, "sector", "left").select(
        "sector", F.lit("emails").alias("dataset"),
        F.concat(F.lit("emails_"), F.col("sector"), F.lit("_found_"),
                 F.coalesce("n_with", F.lit(0)).cast("string"), F.lit(".csv")).alias("label"),
        F.coalesce("n_with", F.lit(0)).alias("n_companies"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    return a.unionByName(e).withColumn("processing_time_seconds", F.lit(r.seconds()))


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, one folder per sector; NULL and '' both written empty."""
    (rows.write.mode(mode).partitionBy("sector").option("header", True).option("emptyValue", "")
     .option("nullValue", "").csv(path))


def write_json(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines."""
    rows.write.mode(mode).json(path)
