import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecycle.operators import blocks, series, spectral


@pytest.fixture(scope="module")
def long(spark):
    """Series of 1, 5, 11, 200 and 2000 rows, with nulls and uneven times."""
    rng = np.random.default_rng(3)
    rows = [(k, float(t), None if rng.random() < 0.03 else float(rng.normal())) for k, n in (("a", 1), ("b", 5), ("c", 11), ("d", 200), ("e", 2000)) for t in np.cumsum(rng.integers(1, 9, n))]
    df = spark.createDataFrame(rows, "s string, t double, x double").repartition(6)
    return df.withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz")).cache()


def hour():
    return F.floor(F.col("t") / 100)


def same(a, b, cols, digits=9):
    key = lambda df: sorted(str([None if v is None else round(v, digits) + 0.0 if isinstance(v, float) else v for v in r]) for r in df.select(cols).collect())
    assert key(a) == key(b)


@pytest.mark.parametrize("size", [7, 64, 100_000])
def test_windows_of_blocks(long, size):
    same(blocks.rolling(long, ["s"], ["t"], hour(), "x", 29, 0, size, std="d"), series.rolling(long, ["s"], ["t"], "x", 29, 0, std="d"), ["s", "t", "rolling_mean", "d"])
    same(blocks.rolling(long, ["s"], ["t"], hour(), "x", 15, 15, size), series.rolling(long, ["s"], ["t"], "x", 15, 15), ["s", "t", "rolling_mean"])
    same(blocks.abs_diff(long, ["s"], ["t"], hour(), "x", size), series.abs_diff(long, ["s"], ["t"], "x"), ["s", "t", "diff"])
    same(blocks.time_gap(long, ["s"], ["t"], hour(), "ts", size), series.time_gap(long, ["s"], ["t"], "ts"), ["s", "t", "gap_sec"])
    for window, degree in ((11, 2), (7, 3)):
        same(blocks.savgol(long, ["s"], ["t"], hour(), "x", window, degree, size=size), series.savgol(long, ["s"], ["t"], "x", window, degree), ["s", "t", "smooth"])
    assert blocks.savgol(long, ["s"], ["t"], hour(), "x", 11, 2, size=size).columns == [*long.columns, "smooth"]


@pytest.mark.parametrize("size", [50, 100_000])
def test_correlations_and_lines_of_blocks(long, size):
    same(blocks.autocorrelation(long, ["s"], ["t"], hour(), "x", 40, size), spectral.autocorrelation(long, ["s"], ["t"], "x", 40), ["s", "lag", "r"], 7)
    same(blocks.spectrum(long, ["s"], ["t"], hour(), "x", size), spectral.spectrum(long, ["s"], ["t"], "x"), ["s", "k", "period", "amplitude"], 6)


def test_numbers_and_empty_tables(long):
    import pyspark.sql.window as w

    same(blocks.numbered(long, ["s"], ["t"], hour(), "i"), long.withColumn("i", F.row_number().over(w.Window.partitionBy("s").orderBy("t")) - 1), ["s", "t", "i"])
    none = long.limit(0)
    assert blocks.savgol(none, ["s"], ["t"], hour(), "x", 11, 2).count() == 0 == blocks.autocorrelation(none, ["s"], ["t"], hour(), "x").count()


def test_one_series_is_many_tasks(spark):
    x = spark.range(40_000).select(F.lit("one").alias("s"), F.col("id").cast("double").alias("t"), F.sin(F.col("id") / 50).alias("x"))
    rows = blocks.with_halo(blocks.numbered(x, ["s"], ["t"], F.floor(F.col("t") / 1000)), 1000, 10, 10)
    per = [r["count"] for r in rows.groupBy("__block").count().collect()]
    assert len(per) in (40, 41) and max(per) <= 1020 and sum(r["c"] for r in rows.groupBy("__block").agg(F.count_if("__own").alias("c")).collect()) == 40_000
