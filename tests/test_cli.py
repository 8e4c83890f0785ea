"""The two user jobs end to end: tables on disk in, CSV/JSON out."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from leadforge.plans import cli
from leadforge.plans.q_contacts import fixture_run
from leadforge.sources import fixtures as FX


def test_contacts_and_audit_jobs(spark):
    root = tempfile.mkdtemp(prefix="leadforge-cli-")
    listings, profiles, sites = FX.crawl(spark, SF_SMALL)
    listings.select("url", "html").write.parquet(os.path.join(root, "listings"))
    profiles.unionByName(sites).write.parquet(os.path.join(root, "pages"))
    FX.fixture_sector_config(spark, SF_SMALL).write.json(os.path.join(root, "config"))

    out = os.path.join(root, "out")
    cli.contacts(spark, os.path.join(root, "config"), os.path.join(root, "listings"), os.path.join(root, "pages"), out)
    emails = spark.read.option("header", True).csv(os.path.join(out, "emails"))
    expected = fixture_run(spark, SF_SMALL).contacts.count()
    assert emails.count() == expected > 0
    manifest = spark.read.json(os.path.join(out, "manifest"))
    assert manifest.filter(F.col("label").startswith("emails_")).count() == manifest.select("sector").distinct().count()
    assert spark.read.json(os.path.join(out, "stats")).count() == manifest.select("sector").distinct().count()

    cli.audit(spark, os.path.join(root, "listings"), os.path.join(root, "audit"))
    sel = spark.read.json(os.path.join(root, "audit", "selectors"))
    assert sel.count() == listings.count()
    assert sel.filter(F.col("best_selector").isNotNull()).count() > 0
