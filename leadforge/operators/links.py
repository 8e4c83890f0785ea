"""H4 anchors, H6 resolved links, H3 element text as relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge.functions.select import Selector, raw_text, select, strip_text
from leadforge.functions.urls import urljoin


def has_href(e: Column) -> Column:
    return (e["tag"] == F.lit("a")) & F.map_contains_key(e["attrs"], "href")


def anchor_list(dom_elems: Column | None = None) -> Column:
    """H4 (``find_all('a', href=True)``) as an array of element structs."""
    return F.filter(dom_elems if dom_elems is not None else F.col("elems"), has_href)


def _with_text(e: Column) -> Column:
    return F.struct(
        e["id"].alias("elem_id"),
        e["attrs"]["href"].alias("href"),
        raw_text(e).alias("text"),
        strip_text(e).alias("stext"),
    )


def anchors(dom: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per anchor with href: ``url, pos (1-based, document order),
    elem_id, href, text, stext``.  The text is cut from the page text inside
    the page row, before the explode, so the page text is never copied per
    anchor."""
    keep = list(keep or ["url"])
    arr = F.transform(anchor_list(), _with_text)
    return dom.select(*keep, F.posexplode(arr).alias("pos", "a")).select(
        *keep, (F.col("pos") + 1).alias("pos"), "a.*"
    )


def selected(dom: DataFrame, s: Selector, keep: list[str] | None = None) -> DataFrame:
    """Elements matching a selector record, one row each, in document order."""
    keep = list(keep or ["url"])
    arr = F.transform(
        select(s),
        lambda e: F.struct(
            e["id"].alias("elem_id"),
            e["tag"].alias("tag"),
            e["attrs"].alias("attrs"),
            raw_text(e).alias("text"),
            strip_text(e).alias("stext"),
        ),
    )
    return dom.select(*keep, F.posexplode(arr).alias("pos", "e")).select(
        *keep, (F.col("pos") + 1).alias("pos"), "e.*"
    )


def resolve(df: DataFrame, base_col: str = "url", href_col: str = "href", out: str = "abs_url") -> DataFrame:
    """H6 on a relation."""
    return df.withColumn(out, urljoin(F.col(base_col), F.col(href_col)))


__all__ = ["anchors", "anchor_list", "has_href", "resolve", "selected"]
