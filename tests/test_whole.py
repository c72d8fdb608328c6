"""Queries reach all rows of their tables and all of their operators' lines."""

import pytest
from pyspark.sql import functions as F

from tidecycle import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sizes(spark):
    n = registry.events(spark, SF).groupBy("user_id").count().collect()
    return {r.user_id: r["count"] for r in n}


def test_all_lags_and_lines(spark, sizes):
    lags = {r.user_id: r.m for r in registry.QUERIES["autocorr"](spark, SF).groupBy("user_id").agg(F.max("lag").alias("m")).collect()}
    assert lags == {u: min(600, n - 2) for u, n in sizes.items() if n > 2} and max(lags.values()) > 20
    lines = {r.user_id: r.m for r in registry.QUERIES["fft_spectrum"](spark, SF).groupBy("user_id").agg(F.count("*").alias("m")).collect()}
    assert lines == {u: n // 2 for u, n in sizes.items() if n > 1} and max(lines.values()) > 8


def test_all_rows_reach_the_rollups(spark):
    e, o = registry.events(spark, SF), registry.read(spark, SF, "orders")
    assert registry.QUERIES["class_balance"](spark, SF).agg(F.sum("n")).first()[0] == e.count()
    assert registry.QUERIES["cycle_rollup"](spark, SF).agg(F.sum("cycles")).first()[0] == o.count()


def test_missing_sides(spark, tmp_path):
    """All ids count, and a side that is not there is 0."""
    rows = [(2, "a", "signup", 4.0), (3, "a", "signup", 8.0), (2, "a", "error", 2.0), (5, "b", "signup", 6.0), (6, "c", "error", 10.0), (7, "d", "view", 1.0)]
    df = spark.createDataFrame(rows, "event_id long, user_id string, event_type string, value double")
    df.withColumns({"ts": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "props": F.lit("{}")}).write.parquet(str(tmp_path / "events.parquet"))
    got = {r.user_id: tuple(r)[1:] for r in registry.QUERIES["full_outer_rois"](spark, str(tmp_path)).select("user_id", "left_deck_value", "right_deck_value", "roi_mean_value", "roi_diff_value").collect()}
    assert got == {"a": (6, 2, 4, 4), "b": (6, 0, 3, 6), "c": (0, 10, 5, -10)}
