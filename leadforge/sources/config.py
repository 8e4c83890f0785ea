"""Sector configuration source.

Schema ``sector, sector_ord, url, max_pages, business_domain_keywords,
link_selector, pagination_selector``.  Selectors are records (``SELECTOR``); a
missing link selector means the default one, a missing pagination selector
means that the sector has no further pages.
Required fields must be non-empty (a violation fails the job, as the
config class raises); ``max_pages`` defaults to the pipeline's 2, NULL
keywords mean an empty list (quirk K3 fixed), and a missing ``sector_ord``
is 0 (sectors with equal order run in name order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge import params

REQUIRED = ("sector", "url")

_SIMPLE = "tag:string,id:string,classes:array<string>,attrs:array<struct<name:string,op:string,value:string>>,contains:string"
#: A selector record: a simple selector, if need be inside another one.
SELECTOR = f"struct<{_SIMPLE},inside:struct<{_SIMPLE}>>"
CONFIG_SCHEMA = (
    "sector string, sector_ord int, url string, max_pages int, business_domain_keywords array<string>, "
    f"link_selector {SELECTOR}, pagination_selector {SELECTOR}")


def validate_config(cfg: DataFrame) -> DataFrame:
    bad = None
    for c in REQUIRED:
        cond = F.col(c).isNull() | (F.trim(F.col(c)) == F.lit(""))
        bad = cond if bad is None else bad | cond
    checked = cfg.withColumn(
        "_ok", F.when(bad, F.raise_error(F.lit("sector config: required field is empty"))).otherwise(F.lit(True)))
    return checked.select(
        *[c for c in cfg.columns if c not in ("sector_ord", "max_pages", "business_domain_keywords")],
        F.coalesce(F.col("sector_ord"), F.lit(0)).alias("sector_ord"),
        F.coalesce(F.col("max_pages"), F.lit(params.DEFAULT_MAX_PAGES)).alias("max_pages"),
        F.coalesce(F.col("business_domain_keywords"), F.array().cast("array<string>")).alias("business_domain_keywords"),
        "_ok",
    ).filter(F.col("_ok")).drop("_ok")


def shipped_keywords(cfg: DataFrame) -> DataFrame:
    """The known sectors' keyword lists (E9) where the config has none."""
    lists = F.create_map(*(x for name, words in params.SECTOR_KEYWORDS.items() for x in (F.lit(name), F.array(*(F.lit(w) for w in dict.fromkeys(words))))))
    return cfg.withColumn("business_domain_keywords", F.coalesce("business_domain_keywords", lists[F.col("sector")]))


def read_config(spark: SparkSession, path: str, shipped: bool = False) -> DataFrame:
    """JSON-lines config with an explicit schema (no inference)."""
    cfg = spark.read.schema(CONFIG_SCHEMA).json(path)
    return validate_config(shipped_keywords(cfg) if shipped else cfg)
