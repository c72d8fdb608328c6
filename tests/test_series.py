import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidecycle.operators import intervals, peaks, series, spectral, states, stats


def frame(spark, xs, key="a"):
    return spark.createDataFrame([(key, i, None if x is None else float(x)) for i, x in enumerate(xs)], "k string, i int, x double")


def values(df, col, order="i"):
    return [r[0] for r in df.orderBy(order).select(col).collect()]


def test_interpolation_then_fill(spark):
    xs = [None, 0, *[None] * 7, 8, None]
    x = series.interpolate(frame(spark, xs), ["k"], ["i"], "x", 5, "y")
    assert values(x, "y") == [None, 0, 1, 2, 3, 4, 5, None, None, 8, 8]
    assert values(series.fill_edges(x, ["k"], ["i"], "y"), "y") == [0, 0, 1, 2, 3, 4, 5, 5, 5, 8, 8]


def test_differences_area_and_quantiles(spark):
    assert values(series.abs_diff(frame(spark, [5, 7, 4]), ["k"], ["i"], "x"), "diff") == [0, 2, 3]
    assert stats.trapezoid(frame(spark, [1, 3, 2]), ["k"], ["i"], "x").first().auc == 4.5
    assert stats.quantile_refs(frame(spark, [1, 2, 3, 4]), ["x"], (0.4,)).first()[0] == pytest.approx(2.2)


@pytest.mark.parametrize("window,degree", [(11, 2), (7, 2), (7, 3)])
def test_smoothing_keeps_polynomials(spark, window, degree):
    rng = np.random.default_rng(window * degree)
    c = rng.normal(size=degree + 1)
    xs = np.polyval(c, np.arange(25) / 10)
    got = values(series.savgol(frame(spark, xs), ["k"], ["i"], "x", window, degree), "smooth")
    assert np.allclose(got, xs, atol=1e-9)
    assert np.allclose(series.smooth_array(xs, window, degree), xs, atol=1e-9)
    noisy = xs + rng.normal(size=25)
    assert np.allclose(values(series.savgol(frame(spark, noisy), ["k"], ["i"], "x", window, degree), "smooth"), series.smooth_array(noisy, window, degree))
    short = xs[: window - 1]
    assert values(series.savgol(frame(spark, short), ["k"], ["i"], "x", window, degree), "smooth") == short.tolist()


def test_edge_weights():
    assert np.allclose(series.smoothing_weights(7, 2)[0] * 42, [32, 15, 3, -4, -6, -3, 5])
    assert np.allclose(series.smoothing_weights(7, 3)[0] * 42, [39, 8, -4, -4, 1, 4, -2])
    assert np.allclose(series.smoothing_weights(11, 2)[5] * 429, [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36])


def test_rolling(spark):
    x = series.rolling_trailing(frame(spark, [1, 2, 4]), ["k"], ["i"], "x")
    assert np.allclose(values(x, "rolling_std"), [0, 0.5, 1.247219128924647])
    y = frame(spark, range(40))
    got = series.centred_std_p90(y, ["k"], "i", "x").first().std_p90
    assert got == pytest.approx(np.std(np.arange(10), ddof=1))
    assert values(series.boundary_flag(frame(spark, range(7)), ["k"], "i", 2), "is_boundary") == [1, 1, 0, 0, 0, 1, 1]
    assert series.every_nth(frame(spark, range(7)), ["k"], "i").count() == 3


def brute_prominence(x, p):
    l = p
    while l > 0 and x[l - 1] <= x[p]:
        l -= 1
    r = p
    while r < len(x) - 1 and x[r + 1] <= x[p]:
        r += 1
    return x[p] - max(x[l : p + 1].min(), x[p : r + 1].min())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=0, max_size=40), st.integers(1, 6))
def test_peaks_keep_their_distance_and_prominence(xs, distance):
    x = np.array(xs, float)
    found, prom = peaks.find_peaks(x, distance)
    assert all(np.diff(found) >= distance)
    assert np.allclose(prom, [brute_prominence(x, p) for p in found])
    everything = peaks.local_maxima_array(x)
    for p in set(everything.tolist()) - set(found.tolist()):  # what was dropped is near one that is as high
        assert any(abs(p - q) < distance and x[q] >= x[p] for q in found)


def test_plateaus_and_valleys(spark):
    assert peaks.local_maxima_array(np.array([1, 3, 3, 3, 1.0])).tolist() == [2]
    assert peaks.find_valleys(np.array([3, 1, 1, 1, 3.0]), 1, 0.5, 60).tolist() == [2]
    assert values(peaks.local_valleys(frame(spark, [3, 1, 1, 1, 3, 0, 4]), ["k"], ["i"], "x"), "i") == [2, 5]
    assert len(peaks.find_peaks(np.zeros(0))[0]) == 0


def test_segments_and_strongest_peaks(spark):
    x = frame(spark, [0, 2, 5, 5, 1, 3, 0])
    cuts = spark.createDataFrame([("a", 0), ("a", 4), ("a", 6)], "k string, i int")
    s = {r.start_i: r for r in peaks.segments(x, cuts, ["k"], ["i"], "x").collect()}
    assert (s[0].peak_i, s[0].peak, s[0].auc, s[0].n, s[4].peak_i, s[4].low) == (2, 5, 12.5, 5, 5, 0)
    spans = spark.createDataFrame([("a", 0, 4), ("a", 4, 6), ("a", 6, 9)], "k string, start_i int, end_i int")
    found = spark.createDataFrame([("a", 2, 4.0), ("a", 3, 5.0), ("a", 5, 1.0)], "k string, i int, prominence double")
    got = {r.start_i: (r.peak_i, r.peak_prom) for r in peaks.strongest_peaks(spans, found, ["k"]).collect()}
    assert got == {0: (3, 5.0), 4: (5, 1.0), 6: (7, 0.0)}


def test_sine_night(spark):
    x = frame(spark, np.sin(2 * np.pi * np.arange(720) / 60)).withColumnRenamed("k", "night")
    best = spectral.best_period(spectral.spectrum(x, ["night"], ["i"], "x"), ["night"]).first()
    assert best.period == 60 and best.snr == pytest.approx(19.0, abs=0.05)
    r = {a.lag: a.r for a in spectral.autocorrelation(x, ["night"], ["i"], "x", 60).collect()}
    assert r[60] == pytest.approx(1) and r[30] == pytest.approx(-1)
    flat = spectral.autocorrelation(frame(spark, [2] * 10), ["k"], ["i"], "x", 1)
    assert flat.first().r == 0


def test_spectrum_of_a_long_series(spark):
    xs = np.sin(2 * np.pi * np.arange(5001) / 50) + np.random.default_rng(5).normal(size=5001)
    x = frame(spark, xs).union(frame(spark, [1, 2, 4, None, 0], "b")).union(frame(spark, [3], "c"))
    got = [tuple(r) for r in spectral.spectrum(x.withColumnRenamed("k", "key"), ["key"], ["i"], "x").collect()]
    long = sorted(r[1:] for r in got if r[0] == "a")
    assert [r[0] for r in long] == list(range(1, 2501)) and sum(r[0] == "b" for r in got) == 2
    assert np.allclose([r[2] for r in long], np.abs(np.fft.rfft(xs - xs.mean()))[1:], atol=1e-6)
    small = np.array([1, 2, 4, np.nan, 0])
    assert np.allclose(sorted(r[3] for r in got if r[0] == "b"), sorted(np.abs(np.fft.rfft(np.nan_to_num(small - np.nanmean(small))))[1:]))
    none = spectral.spectrum(frame(spark, [None] * 4).withColumnRenamed("k", "key"), ["key"], ["i"], "x").collect()
    assert [r.amplitude for r in none] == [None, None]


def test_long_series(spark):
    """Work and memory in proportion to the rows: 50,000 of one series."""
    n = 50_000
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(5), n)
    x = spark.createDataFrame(pd.DataFrame({"k": "a", "i": np.arange(n), "x": rng.normal(size=n), "p": [q.tolist() for q in p], "t": np.arange(n, dtype=float)}))
    assert spectral.spectrum(x.withColumnRenamed("k", "key"), ["key"], ["i"], "x").count() == n // 2
    r = {a.lag: a.r for a in spectral.autocorrelation(x, ["k"], ["i"], "x").collect()}
    xs = np.array(values(x, "x"))
    assert len(r) == 600 and r[7] == pytest.approx(np.corrcoef(xs[:-7], xs[7:])[0, 1])
    assert values(states.viterbi(x, ["k"], "i", "p"), "state") == [states.CYCLE[s] for s in viterbi_brute(p)]
    assert states.adaptive_sampling(x, ["k"], "i", "t", "x", 0.0, 5.0).count() == n


def test_long_intervals_make_few_rows(spark):
    """An interval of a thousand days and one of a minute: complete, and the long one stands in two buckets."""
    day = 1440
    a = stamps(spark, [("long", 0, 1000 * day), ("short", 500, 501)], ["x", "start", "end"])
    b = stamps(spark, [(1, 100, 160), (2, 900 * day, 900 * day + 1), (3, 500, 502), (4, 999 * day, 1999 * day)], ["y", "r_start", "r_end"])
    got = sorted(map(tuple, intervals.overlap_join(a, b, bucket_sec=60.0).select("x", "y").collect()))
    assert got == [("long", 1), ("long", 2), ("long", 3), ("long", 4), ("short", 3)]
    p = stamps(spark, [(1, 0), (2, 500), (3, 1000 * day), (4, 1000 * day + 1)], ["p", "ts"])
    assert sorted((r.p, r.x) for r in intervals.rows_in(p, a, "ts", bucket_sec=60.0).collect()) == [(1, "long"), (2, "long"), (2, "short"), (3, "long")]


def test_repeated_rows_are_marked_each(spark):
    x = states_frame(spark, ["waiting", "sorting", "sorting"])
    twice = x.unionByName(x.where("i = 2"))
    assert states.abnormal_marks(twice, ["k"], ["i"], "s", "ts", 30.0).count() == states.abnormal_marks(x, ["k"], ["i"], "s", "ts", 30.0).count() + 1


def stamps(spark, rows, names):
    df = spark.createDataFrame(rows, names)
    return df.select(*[(F.timestamp_seconds(F.col(c) * 60).cast("timestamp_ntz").alias(c) if c in ("start", "end", "r_start", "r_end", "ts", "mark_ts", "ws", "we") else F.col(c)) for c in df.columns])


def test_interval_joins(spark):
    v = stamps(spark, [("A", 0, 10), ("B", 10, 20), ("C", 12, 500)], ["video", "start", "end"])
    w = stamps(spark, [(1, 0, 10)], ["w", "r_start", "r_end"])
    assert [r.video for r in intervals.overlap_join(v, w).collect()] == ["A"]  # touching is not overlapping
    p = stamps(spark, [(1, 10), (2, 700), (3, 501), (4, 15)], ["p", "ts"])
    assert {r.p: r.video for r in intervals.covering(p, v, "ts", "p").collect()} == {1: "B", 2: None, 3: None, 4: "B"}
    assert {r.p: (r.video, r.is_exact) for r in intervals.nearest_with_tolerance(p, v, "ts", "p", 120.0).collect()} == {1: ("B", True), 2: (None, None), 3: ("C", False), 4: ("B", True)}
    big = stamps(spark, [(1, 13, 400), (2, 5, 15)], ["w", "ws", "we"])
    assert {r.w: r.video for r in intervals.containing(big, v, "w").collect()} == {1: "C"}


def test_overlap_join_is_complete(spark):
    rng = np.random.default_rng(0)
    a = [(i, int(s), int(s + d)) for i, (s, d) in enumerate(zip(rng.integers(0, 3000, 60), rng.integers(1, 400, 60)))]
    b = [(i, int(s), int(s + d)) for i, (s, d) in enumerate(zip(rng.integers(0, 3000, 60), rng.integers(1, 400, 60)))]
    got = intervals.overlap_join(stamps(spark, a, ["x", "start", "end"]), stamps(spark, b, ["y", "r_start", "r_end"])).select("x", "y").collect()
    assert sorted(map(tuple, got)) == sorted((x, y) for x, s, e in a for y, s2, e2 in b if s < e2 and e > s2)


def test_merging_intervals_and_tags(spark):
    x = stamps(spark, [("k", 0, 10, "trans"), ("k", 10, 20, "ondeck"), ("k", 15, 18, "trans"), ("k", 25, 30, "ondeck")], ["k", "start", "end", "tag"])
    got = [(r.n, r.tags) for r in intervals.merge_intervals(x, ["k"], tag="tag").orderBy("start").collect()]
    assert got == [(3, "trans+ondeck"), (1, "ondeck")]


def states_frame(spark, labels, probs=None):
    rows = [("a", i, s, i, probs[i] if probs else None) for i, s in enumerate(labels)]
    return spark.createDataFrame(rows, "k string, i int, s string, t int, p array<double>").withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))


def test_majority_vote(spark):
    x = states_frame(spark, "AABBB", [[0.4, 0.6]] * 5)
    assert values(states.majority_vote(x, ["k"], ["i"], "s", "p", ["A", "B"]), "smoothed") == ["A", "B", "B", "B", "B"]
    assert values(states.majority_vote(states_frame(spark, "AABB"), ["k"], ["i"], "s"), "smoothed") == ["A", "A", "A", "B"]


def viterbi_brute(p, stay=0.85):
    n, m = p.shape
    e = np.log(p + 1e-9)
    d, back = e[0] - np.log(m), []
    for t in range(1, n):
        cand = np.full((m, m), -1e18)
        for s in range(m):
            cand[s, s], cand[(s - 1) % m, s] = d[s] + np.log(stay), d[(s - 1) % m] + np.log(1 - stay)
        back.append(cand.argmax(0))
        d = cand.max(0) + e[t]
    path = [int(d.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_viterbi(spark):
    p = np.random.default_rng(3).dirichlet(np.ones(5), 60)
    x = states_frame(spark, ["?"] * 60, p.tolist())
    assert values(states.viterbi(x, ["k"], "i", "p"), "state") == [states.CYCLE[s] for s in viterbi_brute(p)]
    one = states.viterbi(states_frame(spark, ["?"], [[0.0, 0.0, 1.0, 0.0, 0.0]]), ["k"], "i", "p")
    assert values(one, "state") == ["on_deck"]


def test_runs_transitions_and_legality(spark):
    x = states_frame(spark, ["waiting", "hauling", "hauling", "waiting", "on_deck"])
    assert [(r.s, r.n) for r in states.runs(x, ["k"], ["i"], "s", "ts").orderBy("run").collect()] == [("waiting", 1), ("hauling", 2), ("waiting", 1), ("on_deck", 1)]
    r = states.transition_counts(x, ["k"], ["i"], "s").first()
    assert (r.changes, r.illegal) == (3, 2)
    assert not states.all_legal(x, ["k"], ["i"], "s").first().legal
    assert states.collapse(x, ["k"], ["i"], "s", "ts").first().states == ["waiting", "hauling", "waiting", "on_deck"]


def test_adaptive_sampling(spark):
    x = spark.createDataFrame([("a", i, float(i), c) for i, c in enumerate([1.0, 0.5, 0.5, 1.0, 1.0])], "k string, i int, t double, c double")
    got = states.adaptive_sampling(x, ["k"], "i", "t", "c", 0.9, 2.0)
    assert values(got, "next_mode") == ["NORMAL", "BURST", "BURST", "BURST", "NORMAL"]


def test_partitioning_does_not_matter(spark):
    x = frame(spark, np.random.default_rng(1).normal(size=300))
    a, b = (values(series.savgol(x.repartition(n, F.rand(2)), ["k"], ["i"], "x", 11, 2), "smooth") for n in (1, 16))
    assert a == b


def test_measures_have_zero_guards(spark):
    x = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "t int, p int")
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in stats.precision_recall(x, "t", "p", [0, 1]).collect()}
    assert got[1] == (0, 0, 0, 1) and got[0][1] == 1


def test_split_sizes(spark):
    x = spark.createDataFrame([(c, f"{c}{i}") for c, n in (("a", 7), ("b", 12), ("c", 13)) for i in range(n)], "c string, n string")
    y = stats.stratified_split(x, "c", "n")
    assert {r.c: r["count"] for r in y.where("split = 'val'").groupBy("c").count().collect()} == {"a": 1, "b": 2, "c": 3}
    z = stats.oversample(y.limit(3), F.lit(True), 5, "n")
    assert z.count() == 15 and z.where("n LIKE '%_os4'").count() == 3
