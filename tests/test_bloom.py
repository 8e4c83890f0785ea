from pyspark.sql import functions as F

from leadforge.functions.bloom import bloom, maybe_in


def test_no_key_is_lost_and_few_others_pass(spark):
    keys = spark.range(0, 20_000, 7).selectExpr("CAST(id AS string) AS k").unionByName(spark.createDataFrame([(None,)], "k string"))
    rows = spark.range(20_000).selectExpr("id", "CAST(id AS string) AS k").unionByName(spark.createDataFrame([(-7, None)], "id long, k string"))
    got = rows.filter(maybe_in(bloom(keys, "k", 1 << 16), "k", 1 << 16)).agg(F.count("*"), F.count_if(F.col("id") % 7 == 0)).first()
    assert got[1] == 2858 and got[0] < 2858 + 500


def test_size_is_fixed_and_empty_filter_passes_nothing(spark):
    none = bloom(spark.createDataFrame([], "k string"), "k", 1 << 10)
    assert [set(r["words"]) | {len(r["words"])} for r in none.collect()] == [{0, 16}]
    assert spark.range(50).filter(maybe_in(none, "id", 1 << 10)).count() == 0
    full = bloom(spark.range(5000), "id", 1 << 10)
    assert len(full.first()["words"]) == 16 and spark.range(5000).filter(maybe_in(full, "id", 1 << 10)).count() == 5000


def test_filter_sits_below_the_shuffle(spark):
    keys = spark.range(10).selectExpr("id AS k")
    plan = spark.range(100).selectExpr("id AS k", "'x' AS html").repartition(4).filter(maybe_in(bloom(keys, "k", 1 << 10), "k", 1 << 10))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Repartition") < text.index("getbit") if "getbit" in text else text.index("Repartition") < text.index("bit_get")
