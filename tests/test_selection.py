import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidecycle.operators import peaks, selection, stats


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quantiles_equal_the_whole_sort(spark):
    rng = random.Random(1)
    rows = []
    for g in ["a", "b", None]:
        rows += [(g, rng.choice([rng.gauss(0, 1), 3.0, None, -1e300, 1e300, rng.random() * 1e-9]), float(i % 3)) for i in range(4000)]
    rows += [("one", 5.0, None), ("none", None, None), ("two", 1.0, 2.0), ("two", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(7)
    shares = (0.0, 0.1, 0.5, 0.9, 0.999, 1.0)
    for keys in ([], ["g"]):
        want = df.groupBy(*keys).agg(*[F.percentile(c, F.lit(q)).alias(f"{c}_p{round(100 * q)}_{i}") for c in ("x", "y") for i, q in enumerate(shares)])
        got = [selection.exact_quantiles(df, ["x", "y"], (q,), keys) for q in shares]
        for i, (q, g) in enumerate(zip(shares, got)):
            a = sorted((tuple(r) for r in g.collect()), key=str)
            b = sorted((tuple(r) for r in want.select(*keys, *[F.col(f"{c}_p{round(100 * q)}_{i}") for c in ("x", "y")]).collect()), key=str)
            assert a == b, (keys, q)


def test_quantiles_of_many_rows(spark):
    df = spark.range(300_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 5 == 0, 7.0).otherwise(F.rand(3) * 100).alias("x"))
    df.cache()
    got = selection.exact_quantiles(df, ["x"], (0.5, 0.9), ["g"])
    want = df.groupBy("g").agg(F.percentile("x", F.lit(0.5)).alias("x_p50"), F.percentile("x", F.lit(0.9)).alias("x_p90"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert " percentile(" not in plan(got)
    df.unpersist()


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, x double")
    assert selection.exact_quantiles(empty, ["x"], (0.5,), ["g"]).collect() == []
    assert [tuple(r) for r in selection.exact_quantiles(empty, ["x"], (0.5,)).collect()] in ([], [(None,)])


@pytest.mark.parametrize("share,whole", [(0.2, False), (0.5, True), (0.0, False), (1.0, False), (0.001, False)])
def test_split_equals_ranks_over_whole_classes(spark, share, whole):
    df = spark.range(40_000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 100 == 1, None).when(F.col("id") == 7, "single").otherwise("b").alias("c"), F.lit(1).alias("split"))
    w = Window.partitionBy("c")
    n = F.count("*").over(w) * share
    want = df.withColumn("split", F.when(F.row_number().over(w.orderBy(F.md5(F.concat(F.lit("s"), F.col("n").cast("string"))), "n")) <= (F.floor(n) if whole else F.bround(n)), "val").otherwise("train"))
    got = stats.stratified_split(df, "c", "n", share, "s", whole)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_only_one_range_of_a_class_is_ranked(spark, monkeypatch):
    df = spark.range(100_000).select(F.col("id").alias("n"), F.lit("c").alias("c"))
    x = selection.least_rows(df, ["c"], F.lit(31_000), F.md5(F.col("n").cast("string")), "n")
    assert x.where("chosen").count() == 31_000
    text = plan(x)
    assert text.count("Window ") >= 1 and x.count() == 100_000
    sample = stats.random_sample(df, "n", 500, "q")
    want = {r.n for r in df.orderBy(F.md5(F.concat(F.lit("q"), F.col("n").cast("string"))), "n").limit(500).collect()}
    assert {r.n for r in sample.collect()} == want
    assert stats.random_sample(df.limit(3), "n", 500, "q").count() == 3 and stats.random_sample(df.limit(0), "n", 5, "q").count() == 0


def plain_peaks(x):
    """Prominence and width by scanning from each peak."""
    out = {}
    for p in peaks.local_maxima_array(x):
        a = p
        while a > 0 and x[a - 1] <= x[p]:
            a -= 1
        b = p
        while b < len(x) - 1 and x[b + 1] <= x[p]:
            b += 1
        prom = x[p] - max(x[a : p + 1].min(), x[p : b + 1].min())
        level, i, j = x[p] - prom / 2, p, p
        while i > 0 and x[i] > level:
            i -= 1
        while j < len(x) - 1 and x[j] > level:
            j += 1
        left = i + (level - x[i]) / (x[i + 1] - x[i]) if x[i] < level else i
        right = j - (level - x[j]) / (x[j - 1] - x[j]) if x[j] < level else j
        out[int(p)] = (prom, right - left)
    return out


def test_peaks_against_plain_scans():
    rng = np.random.default_rng(4)
    for t in range(400):
        n = int(rng.integers(0, 90))
        x = [rng.normal(size=n), rng.integers(0, 4, n).astype(float), np.sort(rng.normal(size=n)), np.cumsum(rng.integers(-1, 2, n)).astype(float), np.zeros(n)][t % 5]
        want = plain_peaks(x)
        found, prom = peaks.find_peaks(x)
        assert found.tolist() == sorted(want) and all(want[p][0] == v for p, v in zip(found.tolist(), prom))
        assert np.allclose(peaks.widths(x, found, prom), [want[p][1] for p in found.tolist()])
        kept = peaks._keep_distance(x, found, 6).tolist()
        assert all(b - a >= 6 for a, b in zip(kept, kept[1:])) and all(any(abs(p - q) < 6 and x[q] >= x[p] for q in kept) for p in found.tolist())


@pytest.mark.parametrize("kind", ["random", "flat", "sorted", "walk", "saw"])
def test_peaks_of_a_million_rows(kind):
    import time

    rng = np.random.default_rng(1)
    x = {"random": rng.normal(size=1_000_000), "flat": np.zeros(1_000_000), "sorted": np.arange(1e6), "walk": np.cumsum(rng.normal(size=1_000_000)), "saw": np.tile([0.0, 1.0, 0.5, 2.0], 250_000)}[kind]
    began = time.process_time()
    peaks.find_peaks(x, 30, 1.5, 2.0)
    assert time.process_time() - began < 5


def test_strongest_peaks_of_touching_spans(spark):
    spans = spark.createDataFrame([("k", 0, 5), ("k", 5, 9), ("k", 12, 14), ("l", 0, 4)], "k string, start_i int, end_i int")
    found = spark.createDataFrame([("k", 5, 2.0), ("k", 3, 2.0), ("k", 7, 1.0), ("k", 10, 9.0), ("k", 12, 0.5), ("m", 1, 1.0)], "k string, i int, prominence double")
    got = {(r.k, r.start_i): (r.peak_i, r.peak_prom) for r in peaks.strongest_peaks(spans, found, ["k"]).collect()}
    assert got == {("k", 0): (3, 2.0), ("k", 5): (5, 2.0), ("k", 12): (12, 0.5), ("l", 0): (2, 0.0)}
