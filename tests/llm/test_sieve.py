from pyspark.sql import functions as F

from tidecycle.llm import near_dedup


def test_a_sieve_passes_all_keys_and_few_others(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.xxhash64(F.col("id") % 5000).alias("th"))
    keys = rows.where("id % 100 = 0 OR id IS NULL")
    got = near_dedup._sieved(rows, F.col("id"), F.col("th"), keys, "id", "th")
    assert got.columns == ["id", "th", "__in"] and got.count() == 20_000
    assert got.where("(id % 100 = 0 OR id IS NULL) AND NOT __in").count() == 0 and got.where("__in").count() < 220
    assert near_dedup._sieved(rows, F.col("id"), F.col("th"), keys.where("false"), "id", "th").where("__in").count() == 0
