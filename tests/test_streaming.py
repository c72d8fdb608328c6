import random

import pytest
from pyspark.sql import functions as F

from tidecycle.operators import states
from tidecycle.streaming import ingest, windows


@pytest.fixture
def stream(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema

    def run(make, mode="append"):
        df = make(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        q = df.writeStream.outputMode(mode).format("memory").queryName("out").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.sql("SELECT * FROM out").collect()

    return run, spark.read.parquet(str(tmp_path / "in"))


def test_windows_equal_the_batch(stream):
    run, batch = stream
    got = run(lambda s: windows.resample(s, ["event_type"], "ts", "value", "1 hour"), "complete")
    want = batch.groupBy("event_type", F.window("ts", "1 hour")).count().count()
    assert len(got) == want and sum(r.n for r in got) == batch.count()


def test_sessions_close(stream):
    run, batch = stream
    assert sum(r.n for r in run(lambda s: windows.sessions(s, ["user_id"], "ts"))) <= batch.count()


def test_duplicates_go(stream):
    run, batch = stream
    assert len(run(lambda s: windows.dedupe(s.union(s), ["event_id"], "ts"))) == batch.count()


def test_state_machine_equals_the_batch(stream):
    run, batch = stream
    cols = lambda d: d.select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("us"), (F.col("value") % 10 / 10).alias("corr"))
    got = run(lambda s: windows.adaptive_sampling(cols(s), "user_id", "event_id", "us", "corr", 0.3, 7.2e9))
    want = states.adaptive_sampling(cols(batch), ["user_id"], "event_id", "us", "corr", 0.3, 7.2e9).collect()
    assert sorted((r.event_id, r.next_mode) for r in got) == sorted((r.event_id, r.next_mode) for r in want)


def test_late_rows_give_the_batch_result(spark, tmp_path):
    """Rows shuffled inside the delay, in many batches; a last row far ahead lets all others out."""
    rng = random.Random(5)
    rows = [(f"u{u}", i, float(1000 + i * 7 + u), rng.random()) for u in range(3) for i in range(80)]
    df = spark.createDataFrame(rows, "user string, n long, sec double, corr double").withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz"))
    want = {(r.user, r.n): (r["mode"], r.next_mode) for r in states.adaptive_sampling(df, ["user"], "n", "sec", "corr", 0.3, 20.0).collect()}
    order = sorted(rows, key=lambda r: r[2] + rng.random() * 120)
    parts = [order[i : i + 60] for i in range(0, len(order), 60)] + [[(f"u{u}", 999, 1e5, 1.0) for u in range(3)], [("other", 0, 2e5, 1.0)]]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, "user string, n long, sec double, corr double").withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{k:02d}"))
    s = spark.readStream.schema(df.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = windows.adaptive_sampling_late(s, "user", "n", "ts", "corr", 0.3, 20.0, "5 minutes")
    q = out.writeStream.format("memory").queryName("late").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = [r for r in spark.sql("SELECT * FROM late").collect() if r.n < 999 and r.user != "other"]
    assert len(got) == len(rows) and {(r.user, r.n): (r["mode"], r.next_mode) for r in got} == want


def test_recordings_are_taken_in_once(spark, tmp_path):
    def put(day, n):
        x = spark.range(n).select(F.lit(f"v{day}").alias("video_id"), F.col("id").cast("int").alias("frame_idx"), (F.col("id") * 3600).cast("float").alias("timestamp_sec"), F.lit("full").alias("roi_name"), F.lit(1.0).cast("float").alias("entropy"))
        x.coalesce(1).write.parquet(str(tmp_path / "tmp"), mode="overwrite")
        (tmp_path / "in").mkdir(exist_ok=True)
        next((tmp_path / "tmp").glob("*.parquet")).rename(tmp_path / "in" / f"ch01_202401{day:02d}_200000_080000.parquet")

    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    nights = lambda: {str(r.night): r["count"] for r in spark.read.parquet(out).groupBy("night").count().collect()}
    put(1, 10)
    put(2, 10)
    ingest.ingest(spark, root, out, str(tmp_path / "cp"), 1).awaitTermination(200)
    assert nights() == {"2024-01-01": 10, "2024-01-02": 10}
    files = {p for p in (tmp_path / "out" / "night=2024-01-01").iterdir()}
    put(3, 4)
    ingest.ingest(spark, root, out, str(tmp_path / "cp"), 1).awaitTermination(200)
    assert nights() == {"2024-01-01": 10, "2024-01-02": 10, "2024-01-03": 4}
    assert {p for p in (tmp_path / "out" / "night=2024-01-01").iterdir()} == files  # untouched
    ingest.ingest(spark, root, out, str(tmp_path / "lost"), 2).awaitTermination(200)  # the checkpoint is lost: all batches run again
    assert nights() == {"2024-01-01": 10, "2024-01-02": 10, "2024-01-03": 4}


def test_a_batch_killed_half_way_runs_again(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    x = spark.createDataFrame([("v", i, "full", f"2024-01-0{1 + i % 3}") for i in range(9)], "video_id string, frame_idx int, roi_name string, night string")
    ingest.merge_nights(x.where("night <> '2024-01-03'"), out)  # what a killed batch had committed of its nights
    for _ in range(2):
        ingest.merge_nights(x, out)
    assert spark.read.parquet(out).count() == 9
