"""Work follows the size of the input, not the number of recordings, series or groups."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidecycle.functions import temporal
from tidecycle.operators import blocks, groups, peaks, spectral
from tidecycle.sources import cbf, readers, sinks


def test_column_files_share_the_tasks_of_a_reader(spark, tmp_path):
    n = 600
    df = spark.range(2 * n, numPartitions=2).select(F.concat(F.lit("v"), F.col("id") % n).alias("video_id"), F.col("id").alias("frame_idx"), F.lit(1).cast("long").alias("roi_code"))
    spark.dataSource.register(cbf.CbfSource)
    cbf.dealt(df).write.format("cbf").option("path", str(tmp_path)).mode("append").save()
    (tmp_path / "old.cbf").write_bytes(cbf.encode({c: np.arange(3) for c in cbf.COLUMNS}, 1))
    back = spark.read.format("cbf").option("path", str(tmp_path)).load()
    assert back.rdd.getNumPartitions() <= 5
    assert sorted(tuple(r) for r in back.where("video_id <> 'old'").select("video_id", "frame_idx", "roi_name").collect()) == sorted((f"v{i % n}", i, "transfer") for i in range(2 * n))
    assert [tuple(r) for r in back.where("video_id = 'old'").select("frame_idx", "roi_code", "roi_name", "entropy").orderBy("frame_idx").collect()] == [(i, None, None, float(i)) for i in range(3)]


def test_a_writer_of_tiny_recordings_ranks_them_seldom(tmp_path, monkeypatch):
    w = cbf.CbfWriter({"path": str(tmp_path), "part_rows": "1000"}, False)
    ranked = []

    class Ranked(cbf.Counter):
        def most_common(self, n=None):
            ranked.append(n)
            return super().most_common(n)

    monkeypatch.setattr(cbf, "Counter", Ranked)
    done = w.write(iter([pa.RecordBatch.from_pydict({"video_id": [f"v{k}-{i}" for i in range(100)], "frame_idx": list(range(100))}) for k in range(40)]))
    w.commit([done])
    assert len(list(tmp_path.glob("*.cbf"))) == 4000 and len(ranked) < 20


def test_feature_files_follow_rows_not_recordings(spark, tmp_path):
    df = spark.range(1000, numPartitions=4).select(F.concat(F.lit("v"), F.col("id") % 200).alias("video_id"), F.col("id").cast("int").alias("frame_idx"), F.lit("full").alias("roi_name"), F.lit(1.0).alias("timestamp_sec"))
    path = str(tmp_path / "f")
    sinks.features(df.where("id % 200 < 150"), path)
    sinks.features_once(df, path, spark.read.parquet(path))
    assert len(list((tmp_path / "f").rglob("*.parquet"))) <= 8
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("video_id", "frame_idx").collect()) == sorted((f"v{i % 200}", i) for i in range(1000))


def test_annotation_files_are_bounded(spark, tmp_path):
    box = F.struct(*[F.lit(k).alias(n) for k, n in enumerate(("xmin", "ymin", "xmax", "ymax"))])
    size = F.struct(F.lit(8).alias("width"), F.lit(9).alias("height"), F.lit(3).alias("depth"))
    df = spark.range(100, numPartitions=1).select(F.concat(F.lit("o"), "id").alias("filename"), size.alias("size"), F.array(F.struct(F.lit("net").alias("name"), box.alias("bndbox"))).alias("object"))
    sinks.annotations(df, str(tmp_path / "a"), per_file=30)
    assert len(list((tmp_path / "a").glob("part-*.xml"))) == 4
    assert readers.annotations(spark, str(tmp_path / "a")).select("filename", "xmax").distinct().count() == 100


def test_peaks_of_many_series_are_those_of_each():
    rng = np.random.default_rng(7)
    series = [np.round(rng.normal(0, 3, n) + rng.integers(0, 3)) for n in rng.integers(1, 60, 400)]
    series[5][0] = series[9][-1] = np.nan
    series[11][:2] = np.inf
    x, starts = np.concatenate(series), np.concatenate([[0], np.cumsum([len(s) for s in series])[:-1]])
    for options in ({}, {"distance": 4}, {"distance": 2.5, "prominence": 2.0}, {"width": 2.5}, {"distance": 3, "prominence": 1.0, "width": 1.5}):
        want = [peaks.find_peaks(s, **options) for s in series]
        at, prom = peaks.find_peaks_of(x, starts, **options)
        assert at.tolist() == [int(i + a) for a, (w, _) in zip(starts, want) for i in w]
        np.testing.assert_array_equal(prom, np.concatenate([w for _, w in want]))
    want = [int(i + a) for a, s in zip(starts, series) for i in peaks.find_valleys(s, 3, 1.0, 40.0)]
    assert peaks.find_valleys_of(x, starts, 3, 1.0, 40.0).tolist() == want
    assert peaks.find_peaks_of(np.zeros(0), np.zeros(0, int))[0].tolist() == []


def test_series_share_calls_and_are_whole(spark):
    def run(table, first):
        return pa.table({"calls": [1], "series": [len(first)], "rows": [len(table)], "long": [int(np.diff(np.append(first, len(table))).max())]})

    df = spark.range(30_000).select(F.when(F.col("id") < 20_000, F.lit(None)).otherwise(F.col("id") % 2000).alias("k"), "id")
    got = groups.by_series(df, ["k"], ["id"], run, "calls long, series long, rows long, long long", rows=3000).toPandas()
    assert got["series"].sum() == 2001 and got["rows"].sum() == 30_000 and got["long"].max() == 20_000 and len(got) < 40
    assert spark.range(0).select(F.lit(1).alias("k"), "id").transform(lambda x: groups.by_series(x, ["k"], ["id"], run, "calls long, series long, rows long, long long")).count() == 0


def test_spectra_in_blocks_make_no_group_per_column(spark):
    x = spark.range(900).select((F.col("id") % 7).alias("s"), "id", F.sin("id").alias("v"))
    got = blocks.spectrum(x, ["s"], ["id"], F.floor(F.col("id") / 100), "v", 8)
    assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()
    want = spectral.spectrum(x, ["s"], ["id"], "v")
    both = got.join(want.select("s", "k", F.col("amplitude").alias("a")), ["s", "k"])
    assert both.count() == want.count() and both.where("abs(amplitude - a) > 1e-9").count() == 0


def test_chunks_of_long_recordings_are_spread(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([0, 1, 299, 300, 301, 900, -5, None] * 20)], "id long, n long").coalesce(1)
    got = temporal.exploded_chunks(df, "n")
    assert "Exchange" in got._jdf.queryExecution().executedPlan().toString()
    want = df.select("id", F.explode(temporal.chunks(F.col("n"))).alias("c")).select("id", "c.first", "c.count")
    assert sorted(map(tuple, got.select("id", "first", "count").collect())) == sorted(map(tuple, want.collect())) and want.count() == 160


def test_chunks_of_long_recordings_pack_well(spark, tmp_path):
    n = F.lit(300_000) + F.col("id") * 7
    got = temporal.exploded_chunks(spark.range(400, numPartitions=1).withColumn("n", n), "n")
    got.select("id", "first", "count").write.parquet(str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == sum(-(-(300_000 + 7 * i) // 300) for i in range(400))
    assert sum(p.stat().st_size for p in (tmp_path / "c").glob("*.parquet")) < 0.4 * 400_000


def test_chunks_in_tiles_are_whole(spark):
    span = temporal.TILE * 300
    ns = [span - 1, span, span + 1, 2 * span, 2 * span + 301, 5 * span - 300, 1]
    df = spark.createDataFrame(list(enumerate(ns)), "id long, n long")
    got = sorted(map(tuple, temporal.exploded_chunks(df, "n").select("id", "first", "count").collect()))
    assert got == [(i, f, min(300, n - f)) for i, n in enumerate(ns) for f in range(0, n, 300)]
    assert temporal.exploded_chunks(df.where("n > 2147483647"), "n").count() == 0
    most = spark.range(1).select("id", F.lit(2**31 - 1).alias("n"))
    assert tuple(temporal.exploded_chunks(most, "n").agg(F.count("*"), F.max("first"), F.sum("count")).first()) == (-(-(2**31 - 1) // 300), (2**31 - 2) // 300 * 300, 2**31 - 1)


def test_tasks_of_chunks_are_bounded(spark, monkeypatch):
    df = spark.range(1000, numPartitions=1).withColumn("n", F.lit(900))
    monkeypatch.setattr(temporal, "TASK_ROWS", 100)
    assert temporal.exploded_chunks(df, "n").rdd.getNumPartitions() == 10
    monkeypatch.setattr(temporal, "TASK_CHUNKS", 150)
    assert temporal.exploded_chunks(df, "n").rdd.getNumPartitions() == 20


def test_pictures_of_vectors_are_made_in_many_tasks(spark):
    from tidecycle import registry_sources

    plan = registry_sources.global_motion(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
