"""Email extraction from parsed pages.

Two stages:

1. ``page_candidates`` (page-local, sector independent): the raw strings each
   method finds on a page, kept as arrays on the page row --
   ``mailto`` (E1, split but not cleaned), ``text_hits`` (E2 on the page
   text), ``area_hits`` (E3: E2 on every contact area's text plus the area's
   mailto parts), ``pattern_hits`` (E4-E6 on the raw HTML, un-obfuscated;
   computed on the JVM before the parse).
2. ``page_emails`` (needs the sector's keyword list, E9): cleans the arrays;
   the page text is used only when no mailto address survived cleaning (E11).

Then ``site_emails`` (E12) applies the "stop after the page that brings the
total to 5" rule with a running sum, and ``dedup_emails`` (E13) keeps each
address with the first company of its sector.

Raw-HTML patterns (E4-E6) scan the stored ``html`` rather than a re-serialised
tree, so they also see entities in ordinary text (a superset; quirk K6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.email import clean_email
from leadforge.functions.select import raw_text, sel, select, within
from leadforge.operators.links import anchor_list

# Python's \b and \s are Unicode-aware; (?U) pins Java to the same.
U = "(?U)"
UI = "(?iU)"

# E3 contact areas as selector records.
CONTACT_AREA_SELECTORS = (
    sel(cls="contact"), sel(cls="contact-info"), sel(cls="contacto"), sel(cls="contatti"),
    sel(cls="email"), sel(cls="mail"), sel(cls="footer"), sel("footer"),
    sel(attrs=[("class", "*=", "contact")]), sel(attrs=[("class", "*=", "email")]),
    sel(attrs=[("class", "*=", "mail")]),
)


def find_all(df: DataFrame, col: str, pattern: str, keep: list[str] | None = None, flags: str = U) -> DataFrame:
    """``re.findall`` as rows: ``keep..., pos (1-based), match``."""
    keep = list(keep or [])
    m = F.regexp_extract_all(F.col(col), F.lit(flags + pattern), 0)
    return df.select(*keep, F.posexplode(m).alias("pos", "match")).select(
        *keep, (F.col("pos") + 1).alias("pos"), "match"
    )


def _mailto_parts(anchors: Column) -> Column:
    """E1 before cleaning: ``mailto:`` hrefs (case-sensitive), scheme removed,
    cut at ``?`` then ``&``, split on ``,``."""
    hits = F.filter(anchors, lambda a: a["attrs"]["href"].startswith("mailto:"))
    return F.flatten(F.transform(hits, lambda a: F.split(
        F.substring_index(F.substring_index(F.replace(a["attrs"]["href"], F.lit("mailto:"), F.lit("")), "?", 1), "&", 1),
        ",")))


def _text_matches(text: Column, pattern: str = params.EMAIL_TEXT_PATTERN) -> Column:
    return F.regexp_extract_all(text, F.lit(UI + pattern), 0)


def _unobfuscate(m: Column) -> Column:
    return (
        F.when(m.contains("mailto:"), F.btrim(F.replace(m, F.lit("mailto:"), F.lit("")), F.lit("'\"")))
        .when(m.contains("&#64;"), F.replace(m, F.lit("&#64;"), F.lit("@")))
        .otherwise(F.regexp_replace(m, r"(?U)\s+", ""))
    )


def pattern_hits(html: Column) -> Column:
    """E4-E6 on the raw HTML (JVM regex), un-obfuscated.  Computed on the
    crawl rows *before* the parse, so the HTML itself never has to come back
    from the Python parser: only this small array passes through."""
    return F.transform(
        F.concat(
            F.regexp_extract_all(html, F.lit(UI + params.EMAIL_ENTITY_PATTERN), 0),
            F.regexp_extract_all(html, F.lit(UI + params.EMAIL_SPACED_PATTERN), 0),
            F.regexp_extract_all(html, F.lit(UI + params.EMAIL_JS_MAILTO_PATTERN), 0),
        ),
        _unobfuscate,
    )


def candidate_exprs(pattern_col: str = "pattern_hits", text_pattern: str = params.EMAIL_TEXT_PATTERN) -> list[Column]:
    """Stage 1 as columns of a DOM row; ``pattern_col`` holds ``pattern_hits``
    computed before the parse (``with_pattern_hits``).  ``text_pattern`` is what
    E2 looks for in texts (``params.EMAIL_FLEXIBLE_PATTERN`` also takes dotted
    local parts and domains of several labels, quirk K5)."""
    anchors = anchor_list()
    areas = select(CONTACT_AREA_SELECTORS)
    area_raw = F.flatten(F.transform(areas, lambda r: F.concat(
        _text_matches(raw_text(r), text_pattern), _mailto_parts(within(r, anchors)))))
    return [
        F.col("elems").isNotNull().alias("fetched"),
        _mailto_parts(anchors).alias("mailto"),
        _text_matches(F.col("text"), text_pattern).alias("text_hits"),
        area_raw.alias("area_hits"),
        F.col(pattern_col).alias("pattern_hits"),
    ]


def with_pattern_hits(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Crawl rows plus ``pattern_hits`` (to be kept through ``parse_pages``)."""
    return pages.withColumn("pattern_hits", pattern_hits(F.col(html_col)))


def page_candidates(pages: DataFrame, keep: list[str] | None = None, text_pattern: str = params.EMAIL_TEXT_PATTERN, sep: str = "") -> DataFrame:
    """Stage 1 on crawl rows ``(keep..., html)``: raw-HTML patterns first,
    then one parse (``sep`` between text nodes, quirk K7) and one projection."""
    from leadforge.operators.dom import parse_pages

    keep = list(keep or ["url"])
    dom = parse_pages(with_pattern_hits(pages), keep=[*keep, "pattern_hits"], sep=sep)
    return dom.select(*keep, *candidate_exprs(text_pattern=text_pattern))


def _clean_all(arr: Column, custom: Column | None, match: str) -> Column:
    return F.filter(F.transform(arr, lambda x: clean_email(x, custom, match=match)), lambda x: x.isNotNull())


def page_email_array(custom: Column | None = None, match: str = "exact") -> Column:
    """E11 on a candidates row: cleaned, distinct, in discovery order."""
    e1 = _clean_all(F.col("mailto"), custom, match)
    e2 = F.when(F.size(e1) == 0, _clean_all(F.col("text_hits"), custom, match)).otherwise(F.array().cast("array<string>"))
    rest = _clean_all(F.concat(F.col("area_hits"), F.col("pattern_hits")), custom, match)
    return F.array_distinct(F.concat(e1, e2, rest))


def page_emails(cands: DataFrame, keep: list[str], custom_col: str | None = None, match: str = "exact") -> DataFrame:
    """Stage 2 as rows ``keep..., email``; ``match``: see ``is_business``."""
    custom = F.col(custom_col) if custom_col else None
    return cands.select(*keep, F.explode(page_email_array(custom, match)).alias("email"))


def site_emails(visits: DataFrame, key: list[str], stop_at: int | None = params.EARLY_STOP_EMAILS) -> DataFrame:
    """``visits(key..., rank, email)`` -> the addresses a visit in rank
    order collects before it stops (after the page at which at least
    ``stop_at`` distinct addresses are held).

    Page ``k`` is visited iff fewer than ``stop_at`` addresses were first seen
    on pages ``< k``.  Per key there are at most 7 ranks, so the window is tiny;
    the per-(key, email) minimum is a partial aggregate.  A rank keeps its
    addresses, no more than its page holds, so the visits are computed once.
    """
    first = visits.groupBy(*key, "email").agg(F.min("rank").alias("first_rank"))
    if stop_at is None:  # every page is visited
        return first
    per_rank = first.groupBy(*key, "first_rank").agg(F.count("*").alias("n_new"), F.collect_list(F.struct("email")).alias("_new"))
    w = Window.partitionBy(*key).orderBy("first_rank").rowsBetween(Window.unboundedPreceding, -1)
    visited = per_rank.withColumn("held_before", F.coalesce(F.sum("n_new").over(w), F.lit(0))).filter(
        F.col("held_before") < stop_at
    )
    return visited.select(*key, "first_rank", F.explode("_new").alias("_e")).select(*key, "_e.email", "first_rank")


def dedup_emails(rows: DataFrame, group: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """``rows(group..., order..., email, ...)`` -> each email kept only on
    the first row (by ``order``) of its group.  Aggregation, not a window, so a
    hot address shared by many companies stays cheap."""
    from leadforge.operators.dedup import first_by

    return first_by(rows, [*group, "email"], order, payload)
