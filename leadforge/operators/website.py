"""Company website from its profile page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge import params
from leadforge.functions.select import raw_text, sel, select, select_one
from leadforge.functions.text import any_contains
from leadforge.functions.urls import is_valid_website

WEBSITE_BUTTON = (sel("a", cls="website-button"), sel("a", attrs=[("class", "*=", "website-button")]))
EXTERNAL_LINK = sel("a", attrs=[("href", "^=", "http")])


def button_href() -> Column:
    """Href of the first website button (NULL if none / no href)."""
    h = select_one(WEBSITE_BUTTON)["attrs"]["href"]
    return F.when(h != F.lit(""), h)


def fallback_href(words: list[str] | None = None) -> Column:
    """First ``a[href^=http]`` whose lower text has a website word and
    whose URL is valid."""
    words = params.WEBSITE_LINK_WORDS if words is None else words
    hits = F.filter(select(EXTERNAL_LINK), lambda a: any_contains(F.lower(raw_text(a)), words)
                    & is_valid_website(a["attrs"]["href"]))
    return F.get(hits, 0)["attrs"]["href"]


def website_columns(dom: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep..., button_href, button_valid, fallback_href, website_url``;
    an invalid button goes straight to W2, never to a second button."""
    keep = list(keep or ["url"])
    b = button_href()
    return dom.select(
        *keep,
        b.alias("button_href"),
        is_valid_website(b).alias("button_valid"),
        fallback_href().alias("fallback_href"),
    ).withColumn(
        "website_url",
        F.when(F.col("button_valid"), F.col("button_href")).otherwise(F.col("fallback_href")),
    )


def website_exprs() -> list[Column]:
    """W1/W2 as columns for a shared page projection; combine with
    ``website_url()`` afterwards."""
    b = button_href()
    return [b.alias("button_href"), is_valid_website(b).alias("button_valid"), fallback_href().alias("fallback_href")]


def website_url() -> Column:
    return F.when(F.col("button_valid"), F.col("button_href")).otherwise(F.col("fallback_href"))
