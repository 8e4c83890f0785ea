"""Command line: the two jobs a user of the reproduced tool runs.

    python -m leadforge.plans.cli contacts --config cfg.jsonl --listings L --pages P --out DIR [--limit N]
        [--contact-pages N|all] [--stop-at N|all] [--match exact|contains] [--shipped-keywords]
        [--text-pattern flexible|REGEX] [--separator TEXT]
    python -m leadforge.plans.cli audit --pages L --out DIR

``contacts`` runs the pipeline for every configured sector and writes, under
``DIR``: ``links/`` (S4) and ``emails/`` (S6) as CSV with a header, one folder
per sector; ``manifest/`` (S7: file labels and counts) and ``stats/`` (A1-A4)
as JSON lines (with the run's seconds).  By default a site's five first
contact pages are read, until five addresses are held, as the reproduced tool
does to save fetches: ``all`` lifts either limit, the crawl is stored anyway.
``audit`` writes the selector results of every page (Q1, Q2,
Q4, S8), the containers (Q5) and the pagination probes (Q6) as JSON lines.  Inputs are parquet tables ``(url, html)``; the config
is JSON lines with the schema of ``sources.config``.  The session comes from
``spark-submit`` (cluster settings, ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from leadforge import params
from leadforge.operators import audit as Q
from leadforge.operators import stats as A
from leadforge.operators.dom import parse_pages
from leadforge.plans import pipeline
from leadforge.session import cut_lineage, ensure_checkpoint_dir
from leadforge.sources import sinks as S
from leadforge.sources.config import read_config


def contacts(spark: SparkSession, config_path: str, listings_path: str, pages_path: str, out: str,
             limit: int | None = None, shipped_keywords: bool = False, **options) -> pipeline.Run:
    """``options``: those of ``pipeline.run`` (caps, patterns, matching)."""
    cfg = read_config(spark, config_path, shipped_keywords)
    listings = spark.read.parquet(listings_path).select("url", "html")
    pages = spark.read.parquet(pages_path).select("url", "html")
    r = pipeline.run(cfg, listings, pages, limit=limit, **options)
    out = out.rstrip("/")
    S.write_csv(S.links_with_websites_rows(r), f"{out}/links")
    S.write_csv(S.emails_with_websites_rows(r), f"{out}/emails")
    S.write_json(S.manifest(r), f"{out}/manifest")
    stats = A.run_stats(r).join(A.scraping_stats(r).drop("success_rate"), "sector")
    S.write_json(stats, f"{out}/stats")
    return r


def audit(spark: SparkSession, pages_path: str, out: str) -> None:
    # unfetched pages have nothing to analyse
    dom = cut_lineage(parse_pages(spark.read.parquet(pages_path).select("url", "html").filter("html IS NOT NULL")).filter("elems IS NOT NULL"))
    res = Q.selector_results(dom)
    best = Q.best_selector(res)
    rows = res.groupBy("url").agg(F.map_from_entries(F.collect_list(F.struct(
        "selector_name", F.struct(F.col("n").alias("count"), "selector", "examples")))).alias("results"))
    out = out.rstrip("/")
    S.write_json(rows.join(best, "url", "left"), f"{out}/selectors")
    S.write_json(Q.container_analysis(dom), f"{out}/containers")
    S.write_json(Q.pagination_analysis(dom), f"{out}/pagination")


def _cap(value: str) -> int | None:
    """A number, or ``all``."""
    return None if value == "all" else int(value)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="leadforge")
    sub = ap.add_subparsers(dest="job", required=True)
    c = sub.add_parser("contacts")
    c.add_argument("--config", required=True)
    c.add_argument("--listings", required=True)
    c.add_argument("--pages", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--limit", type=int, default=None, help="companies a sector")
    c.add_argument("--contact-pages", dest="max_contact_pages", type=_cap, default=params.MAX_CONTACT_PAGES, help="contact pages a site, or all")
    c.add_argument("--stop-at", type=_cap, default=params.EARLY_STOP_EMAILS, help="addresses after which a site's visit ends, or all")
    c.add_argument("--match", choices=["exact", "contains"], default="exact", help="how keywords meet the domain of an address")
    c.add_argument("--shipped-keywords", action="store_true", help="keyword lists of the known sectors where the config has none")
    c.add_argument("--text-pattern", default=params.EMAIL_TEXT_PATTERN, help="what is an address in a text; flexible: dotted names, longer domains")
    c.add_argument("--separator", dest="sep", default="", help="text between the text nodes of a page")
    a = sub.add_parser("audit")
    a.add_argument("--pages", required=True)
    a.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    if args.job == "contacts" and args.text_pattern == "flexible":
        args.text_pattern = params.EMAIL_FLEXIBLE_PATTERN
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName(f"leadforge-{args.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.job == "contacts":
        contacts(spark, args.config, args.listings, args.pages, args.out, args.limit, args.shipped_keywords, max_contact_pages=args.max_contact_pages,
                 stop_at=args.stop_at, text_pattern=args.text_pattern, sep=args.sep, match=args.match)
    else:
        audit(spark, args.pages, args.out)


if __name__ == "__main__":
    main()
