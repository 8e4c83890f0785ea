"""The crawl snapshot.  ``pages(url, html)`` replaces the fetcher: a page
that is missing (or whose fetch failed, NULL ``html``) yields no rows.

Lookups match normalised URLs and give one page per URL.  The crawl is thinned
to (nearly) the wanted pages where it is scanned, by a Bloom filter of their
keys, so the HTML of other pages is never moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.functions import bloom

PAGES_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.schema(PAGES_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Deal the crawl evenly over the shuffle partitions before the parse: the
    parse costs a hundred times this shuffle, and files may be one row group."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def url_key(url: Column) -> Column:
    """What identifies a page: the URL without fragment and without trailing
    ``/``, its scheme and host in lower case.  Few URLs have a fragment or end
    in ``/``: the others are looked at, not rewritten."""
    plain = F.when(F.contains(url, F.lit("#")), F.regexp_replace(url, "#.*$", "")).otherwise(url)
    plain = F.when(F.endswith(plain, F.lit("/")), F.rtrim(plain, F.lit("/"))).otherwise(plain)
    origin = F.regexp_extract(plain, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0)
    return F.concat(F.lower(origin), F.substr(plain, F.length(origin) + 1))


def with_key(df: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` and ``_key``, the ``url_key`` of ``url``.  The key is generated
    (an array of one): as a plain column it would be put into every condition on
    it, and the Bloom filter's test computed it a dozen times a page."""
    return df.select(*columns, F.explode(F.array(url_key(F.col("url")))).alias("_key"))


def lookup_pages(urls: DataFrame, pages: DataFrame, url_col: str = "url", bloom_bits: int = bloom.BITS) -> DataFrame:
    """The snapshot page of every distinct wanted URL, ``(url_col, html)``;
    a URL missing from the snapshot gets a NULL ``html`` (the fetcher's ``None``).

    URLs match by ``url_key``.  If the crawl holds several pages of one key,
    the first of these counts: fetched before failed, the very URL before
    others, then the smallest URL and HTML.  Only crawl rows that pass a Bloom
    filter of the wanted keys (``bloom_bits``: sixteen a key keep the others to
    one in a hundred) go into the shuffle.  The pages come dealt by key over
    ``spark.sql.shuffle.partitions`` parts, a number that AQE keeps: it would
    join parts by their bytes, a few MB of markup, and the parse behind the
    lookup, minutes of work, would run in a few tasks.
    """
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = with_key(urls.select(F.col(url_col).alias("url")).distinct(), "url")
    able = bloom.maybe_in(bloom.bloom(wanted, "_key", bloom_bits), "_key", bloom_bits)
    stored = with_key(pages, F.col("url").alias("_url"), "html").filter(able)
    found = (wanted.repartition(parts, "_key").join(stored.repartition(parts, "_key"), "_key", "left").groupBy("_key", "url")
             .agg(F.min(F.struct(F.col("html").isNull().alias("a"), (F.col("_url") != F.col("url")).alias("b"), "_url", "html")).alias("_p")))
    return found.select(F.col("url").alias(url_col), "_p.html")
