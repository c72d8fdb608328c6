import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidecycle import schema
from tidecycle.functions import pixels, scalars, temporal
from tidecycle.operators import stats
from tidecycle.plans import night
from tidecycle.sources import cbf, readers, sinks

NAME = "ch02_20250515_235000_000500topspeed.parquet"


def coarse(n=6, video="v"):
    return pd.DataFrame({"video_id": video, "frame_idx": np.arange(n, dtype="i4"), "timestamp_sec": np.arange(n, dtype="f4") * 4, "roi_name": ["left_deck", "right_deck"] * (n // 2), **{c: np.arange(n, dtype="f4") for c in schema.COARSE_FEATURES}})


def test_parquet_folders(spark, tmp_path):
    (tmp_path / "n" / "debug").mkdir(parents=True)
    coarse().to_parquet(tmp_path / "n" / NAME)
    coarse().to_parquet(tmp_path / "n" / "debug" / NAME)
    coarse().to_parquet(tmp_path / "n" / "nameless.parquet")
    one = readers.parquet_folder(spark, str(tmp_path / "n"))
    assert one.count() == 12 and one.where("source_file = 'nameless.parquet'").select("wall_time").distinct().first()[0] is None
    first = one.where(f"source_file = '{NAME}'").orderBy("frame_idx").first()
    assert str(first.wall_time) == "2025-05-15 23:50:00"
    (tmp_path / "n" / "broken.parquet").write_bytes(b"no parquet")
    tree = readers.parquet_tree(spark, str(tmp_path / "n"), ["left_deck"], ["video_id", "abs_time", "entropy", "absent"])
    assert tree.count() == 6 and tree.columns == ["video_id", "abs_time", "entropy"]
    mean = readers.night_features(spark, str(tmp_path / "n"), ["entropy"], ["left_deck", "right_deck"])
    assert mean.count() == 12


def test_column_files(spark, tmp_path):
    n = 5
    cols = {c: np.arange(n) + k for k, c in enumerate(cbf.COLUMNS)} | {"roi_code": np.array([0, 1, 2, 0, 9])}
    assert len(cbf.encode(cols)) == 80 + 12 * 4 * n and len(cbf.encode(cols, 1)) == 76 + 11 * 4 * n
    for version in (1, 2):
        back = cbf.decode(cbf.encode(cols, version))
        assert all((back[c] == cols[c]).all() for c in cbf.columns_of(version))
    with pytest.raises(ValueError):
        cbf.decode(b"PAR1")
    (tmp_path / "a.cbf").write_bytes(cbf.encode(cols))
    (tmp_path / "b.cbf").write_bytes(cbf.encode(cols, 1))
    spark.dataSource.register(cbf.CbfSource)
    df = spark.read.format("cbf").option("path", str(tmp_path)).load()
    assert [r.roi_name for r in df.where("video_id = 'a'").orderBy("frame_idx").collect()] == ["left_deck", "transfer", "right_deck", "left_deck", None]
    assert df.where("video_id = 'b'").select("roi_code").distinct().first()[0] is None
    out = str(tmp_path / "out")
    df.where("video_id = 'a'").write.format("cbf").option("path", out).mode("append").save()
    again = spark.read.format("cbf").option("path", out).load()
    assert {r.video_id for r in again.collect()} == {"a"}
    assert again.select("frame_idx", "entropy").orderBy("frame_idx").collect() == df.where("video_id = 'a'").select("frame_idx", "entropy").orderBy("frame_idx").collect()


def test_column_files_are_replaced(spark, tmp_path):
    spark.dataSource.register(cbf.CbfSource)
    out = str(tmp_path / "out")
    df = spark.range(2000, numPartitions=3).select(F.concat(F.lit("v/"), F.col("id") % 2).alias("video_id"), *[F.col("id").cast("long" if c in cbf.UNSIGNED else "float").alias(c) for c in cbf.COLUMNS if c != "edge_density"])
    for mode, times in (("overwrite", 1), ("overwrite", 1), ("append", 2), ("overwrite", 1)):
        df.write.format("cbf").option("path", out).option("part_rows", 100).mode(mode).save()
        back = spark.read.format("cbf").option("path", out).load()
        assert back.count() == 2000 * times and {r.video_id for r in back.select("video_id").distinct().collect()} == {"v/0", "v/1"}
        assert sorted(r.frame_idx for r in back.collect()) == sorted(list(range(2000)) * times)
    assert back.where("NOT isnan(edge_density)").count() == 0
    assert not [p for p in (tmp_path / "out").iterdir() if p.suffix != ".cbf"]


def test_text_formats(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b"\xef\xbb\xbfdate,n\n2025-05-15,3\n")
    assert readers.csv(spark, str(tmp_path / "x.csv")).columns == ["date", "n"]
    (tmp_path / "x.xml").write_text("<annotation><filename>f.png</filename><size><width>2560</width><height>1440</height><depth>3</depth></size><object><name>net</name><bndbox><xmin>10</xmin><ymin>20</ymin><xmax>110</xmax><ymax>70</ymax></bndbox></object></annotation>")
    b = readers.annotations(spark, str(tmp_path / "x.xml")).first()
    assert (b.filename, b.width, b.name, b.xmax - b.xmin) == ("f.png", 2560, "net", 100)
    (tmp_path / "r.txt").write_text("Videos: 37\n  Realtime factor: 1127.4x\n  Videos:   38\n  Wall time: 78.1s\nnoise\n")
    r = readers.banners(spark, str(tmp_path / "r.txt")).first()
    assert (r.video_count, r.realtime_factor, r.wall_time_s, r.fps) == (37, 1127.4, 78.1, None)
    (tmp_path / "l.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert readers.json_lines(spark, str(tmp_path / "l.json")).agg(F.sum("a")).first()[0] == 3
    (tmp_path / "c.yaml").write_text("roi: {a: [0, 0, 1, 1]}\n")
    assert readers.config(str(tmp_path / "c.yaml")) == {"roi": {"a": [0, 0, 1, 1]}}


def test_manifests_and_pictures(spark, tmp_path):
    (tmp_path / "v").mkdir()
    for n in ("ch02_20250515_235000_000500topspeed.mp4", "other.MP4", "x.txt"):
        (tmp_path / "v" / n).write_bytes(b"0" * 2_000_000)
    m = {r.filename: r for r in readers.manifest(spark, str(tmp_path / "v")).collect()}
    assert set(m) == {"ch02_20250515_235000_000500topspeed.mp4", "other.MP4"}
    v = m["ch02_20250515_235000_000500topspeed.mp4"]
    assert (v.channel, v.size_mb, v.duration_est_min, m["other.MP4"].start_time) == (2, 2.0, 15.0, None)
    assert readers.interval_index(readers.manifest(spark, str(tmp_path / "v"))).count() == 1
    (tmp_path / "p" / "cat").mkdir(parents=True)
    (tmp_path / "p" / "cat" / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big"))
    (tmp_path / "p" / "cat" / "b.jpg").write_bytes(b"nothing")
    p = {r.path[-5:]: r for r in readers.image_folder(spark, str(tmp_path / "p")).collect()}
    assert (p["a.png"].width, p["a.png"].height, p["a.png"]["class"], p["b.jpg"].is_corrupt) == (7, 5, "cat", True)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame(coarse())
    sinks.features(df, str(tmp_path / "f"))
    sinks.features_once(spark.createDataFrame(pd.concat([coarse(), coarse(video="w")])), str(tmp_path / "f"), spark.read.parquet(str(tmp_path / "f")))
    assert spark.read.parquet(str(tmp_path / "f")).count() == 12
    n = spark.createDataFrame([("2025-05-15", ["a", "b"], [(1, 2)])], "night string, warnings array<string>, segments array<struct<a:int,b:int>>")
    sinks.night_summary(n, str(tmp_path / "s"))
    assert readers.csv(spark, str(tmp_path / "s/csv")).first().warnings == "a; b"
    assert spark.read.json(str(tmp_path / "s/json")).first().warnings == ["a", "b"]
    sinks.label_files(spark.createDataFrame([("i", 0, 0.5, 0.5, 0.1, 0.2)], "image string, cls int, cx double, cy double, w double, h double"), str(tmp_path / "l"))
    assert spark.read.text(str(tmp_path / "l")).first().value == "0 0.500000 0.500000 0.100000 0.200000"
    for day, k in (("a", 1), ("b", 2), ("a", 3)):
        sinks.by_date(spark.createDataFrame([(day, k)], "date string, k int"), str(tmp_path / "d"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "d")).collect()) == [2, 3]
    sinks.feature_csv(df, str(tmp_path / "c"), ["entropy"])
    assert readers.csv(spark, str(tmp_path / "c")).orderBy("frame_idx").first().entropy == "0.000000"
    sinks.log_lines(n, str(tmp_path / "log"))
    assert json.loads(spark.read.text(str(tmp_path / "log")).first()[0])["night"] == "2025-05-15"


def test_schema(spark):
    bad = spark.createDataFrame([("v", 1, float("nan"))], "video_id string, frame_idx int, entropy double")
    with pytest.raises(ValueError):
        schema.conform(bad, schema.COARSE)
    x = schema.conform(bad.withColumn("roi_name", F.lit("a")), schema.FEATURES)
    assert x.columns == schema.FEATURE_COLUMNS and x.first().entropy is None
    assert schema.check_config({"roi": {"a": (0, 0, 1, 1)}}) == []
    assert len(schema.check_config({"roi": {"a": (0.5, 0, 0.5, 2)}, "threshold": 1, "burst_fps": 1, "normal_fps": 1, "workers": 0})) == 5


def test_frames(spark):
    rng = np.random.default_rng(0)
    imgs = rng.integers(0, 256, (3, 6, 8, 3), dtype=np.uint8)
    imgs[2] = imgs[1]
    df = spark.createDataFrame([("v", i, 6, 8, bytearray(x.tobytes())) for i, x in enumerate(imgs)] + [("w", 0, 6, 8, bytearray(6 * 8 * 3))], "video_id string, frame_idx int, h int, w int, data binary")
    got = {(r.video_id, r.frame_idx): r for r in pixels.extract(df).collect()}
    g = [pixels.luma(x).astype(float) for x in imgs]
    assert got["v", 0].motion_intensity == 0 and got["v", 2].motion_intensity == 0
    assert got["v", 1].motion_intensity == pytest.approx(np.abs(g[1] - g[0]).mean(), rel=1e-5)
    assert got["v", 1].mean_r == pytest.approx(imgs[1][..., 2].mean(), rel=1e-5)
    assert (got["w", 0].entropy, got["w", 0].dark_ratio, got["w", 0].edge_density) == (0, 1, 0)
    gx = [[sum(k * g[0][y + dy][x + dx] for dy, dx, k in ((-1, -1, -1), (-1, 1, 1), (0, -1, -2), (0, 1, 2), (1, -1, -1), (1, 1, 1))) for x in range(1, 7)] for y in range(1, 5)]
    gy = [[sum(k * g[0][y + dy][x + dx] for dy, dx, k in ((-1, -1, -1), (-1, 0, -2), (-1, 1, -1), (1, -1, 1), (1, 0, 2), (1, 1, 1))) for x in range(1, 7)] for y in range(1, 5)]
    assert got["v", 0].edge_density == pytest.approx(np.hypot(gx, gy).mean() / 255, rel=1e-5)
    assert pixels.entropy(np.arange(256, dtype=np.uint8)) == 8 and pixels.luma(np.full((1, 1, 3), 255, np.uint8))[0, 0] == 255
    assert pixels.mask_box(np.eye(3)[1:]) == (2, 1, 0, 2, 2) and pixels.mask_box(np.zeros((2, 2))) == (0, 0, 0, 0, 0)
    assert pixels.laplacian_deviation(pixels.luma(imgs[0])) ** 2 == pytest.approx(pixels.laplacian_variance(pixels.luma(imgs[0])))


def test_small_expressions(spark):
    x = spark.createDataFrame([("2025-05-15 18:00:00",), ("2025-05-15 05:59:00",), ("2025-05-15 06:00:00",), (None,)], "t string").select(temporal.night_label(F.col("t").cast("timestamp_ntz")).alias("n"))
    assert [r.n for r in x.collect()] == ["2025-05-15", "2025-05-14", "daytime", "daytime"]
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(temporal.fixed_steps(F.lit(10.0), 3)) == [0, 3, 6, 9] and get(temporal.fixed_steps(F.lit(11.0), 3)) == [0, 3, 6, 9, 11]
    assert [tuple(c) for c in get(temporal.chunks(F.lit(700)))] == [(0, 300), (300, 300), (600, 100)]
    assert get(scalars.argmax(F.array(*map(F.lit, (0.2, 0.5, 0.5))))) == 1
    assert get(scalars.rate(F.lit("30000/1001"))) == pytest.approx(29.97003) and get(scalars.rate(F.lit("25"))) == 25
    assert get(scalars.confidence(scalars.window_issues(F.lit(14), F.lit(1.0), F.lit(50)))) == "LOW"
    assert [get(scalars.is_operating(F.lit(a), F.lit(b), F.lit(c))) for a, b, c in ((3, 0.17, 4.0), (2, 0.0, 5.0), (1, 0.5, 9.0))] == [False, True, False]
    assert get(temporal.clock_to_seconds(F.lit("01:02:03"))) == 3723 and get(scalars.stem(F.lit("a/b.c.mp4"))) == "b.c"
    assert get(scalars.histogram_entropy(F.array(F.lit(1.0), F.lit(1.0)))) == 1 and get(scalars.gray(F.lit(255), F.lit(255), F.lit(255))) == 255


def test_completeness_warnings(spark):
    rows = [("n", i * 60) for i in range(10)] + [("n", 9 * 60 + 200 * 60 + i * 60) for i in range(10)]
    x = spark.createDataFrame(rows, "night string, s int").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    r = stats.completeness(x, ["night"], "ts").first()
    assert len(r.warnings) == 4 and not r.is_complete and r.max_gap_minutes == 200


def test_two_pass_cycles():
    x = 10 + 5 * np.sin(2 * np.pi * np.arange(720) / 60)
    c = night.night_cycles(x)
    assert c["period"] == 60 and c["snr"] > 5 and set(np.diff(c["valleys"])) == {60}
    assert night.night_cycles(np.ones(720))["valleys"] == [] and night.night_cycles(np.ones(5))["period"] is None


def test_core_window_of_a_cycle(spark):
    i = np.arange(60)
    left, right = 0.05 + 0.2 * np.exp(-((i - 15) ** 2) / 20), 0.05 + 0.2 * np.exp(-((i - 35) ** 2) / 40)
    m = spark.createDataFrame([(int(k), float(a), float(b)) for k, a, b in zip(i, left, right)], "k int, l double, r double").withColumn("minute", F.timestamp_seconds(F.col("k") * 60).cast("timestamp_ntz"))
    c = m.agg(F.min("minute").alias("start"), F.max("minute").alias("end")).withColumn("cycle_id", F.lit(1))
    core = night.review(night.core_windows(m, c, "minute", "l", "r"))
    r = core.first()
    assert str(r.net_on_deck_time)[11:16] == "00:15" and r.fish_start_time > r.net_on_deck_time and r.right_edge_increase_vs_pre > 1.05
    plan = [x.group for x in night.sample_plan(core, ["cycle_id"]).orderBy("k").collect()]
    assert plan[:5] == ["net_landing"] * 3 + ["net_settled"] * 2
    short = m.where("k < 5")
    assert night.core_windows(short, c, "minute", "l", "r").count() == 0


def test_review_report(spark):
    core = spark.createDataFrame([(1, "a", "b", 20.0, "HIGH", [])], "cycle_id int, net_on_deck_time string, fish_end_time string, duration_core_window_min double, confidence string, issues array<string>")
    assert "1 cycles" in sinks.review_report(core) and "1 high" in sinks.review_report(core)


class Counted:
    """A file that counts the bytes it gives."""

    def __init__(self, f):
        self.f, self.bytes = f, 0

    def read(self, n):
        out = self.f.read(n)
        self.bytes += len(out)
        return out

    def seek(self, at):
        self.f.seek(at)


def test_column_files_read_what_is_asked(spark, tmp_path):
    import io

    n = 10_000
    data = cbf.encode({c: np.arange(n) for c in cbf.COLUMNS})
    f = Counted(io.BytesIO(data))
    rows, found = cbf.read_columns(f, ["entropy", "roi_code"])
    assert rows == n and set(found) == {"entropy", "roi_code"} and (found["entropy"] == np.arange(n)).all()
    assert f.bytes < 2 * 4 * n + 100 < len(data) / 5
    for v in "abc":
        (tmp_path / f"{v}.cbf").write_bytes(data)
    (tmp_path / "d.cbf").write_bytes(b"broken")
    x = cbf.scan(spark, str(tmp_path), ["video_id", "entropy", "roi_name"], ["a", "b"])
    assert x.groupBy("video_id").count().collect().__len__() == 2
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    x = cbf.scan(spark, str(tmp_path), ["video_id", "entropy", "roi_name"]).where("video_id IN ('a', 'b')")
    assert x.groupBy("video_id").count().collect().__len__() == 2 and x.columns == ["video_id", "entropy", "roi_name"]  # the broken file is never opened
    assert cbf.scan(spark, f"file://{tmp_path}", ["frame_idx", "video_id"]).where("video_id = 'c' AND frame_idx < 7").count() == 7
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    r = cbf.PushingReader({"path": str(tmp_path)})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    rest = list(r.pushFilters([EqualTo(("video_id",), "a"), GreaterThan(("frame_idx",), 3)]))
    assert [type(f) for f in rest] == [GreaterThan] and [cbf.recording(f) for f in r.files()] == ["a"]


def test_a_task_of_many_recordings_holds_a_bounded_number_of_rows(tmp_path):
    w = cbf.CbfWriter({"path": str(tmp_path), "part_rows": "1000"}, False)
    rng = np.random.default_rng(0)

    def batches():
        for _ in range(60):
            v = rng.integers(0, 2000, 200)
            yield pa.RecordBatch.from_pydict({"video_id": [f"v{i}" for i in v], "frame_idx": np.arange(200)})

    import tracemalloc

    tracemalloc.start()
    done = w.write(batches())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    w.commit([done])
    rows = sum(len(cbf.decode(p.read_bytes())["frame_idx"]) for p in tmp_path.glob("*.cbf"))
    assert rows == 12_000 and most < 60e6


def test_files_follow_recordings_not_tasks(spark, tmp_path):
    df = spark.range(4000, numPartitions=16).select(F.concat(F.lit("v"), F.col("id") % 20).alias("video_id"), F.col("id").cast("int").alias("frame_idx"), F.lit("full").alias("roi_name"), F.lit(1.0).cast("float").alias("timestamp_sec"), F.rand().cast("float").alias("entropy"))
    sinks.features(df, str(tmp_path / "p"))
    assert len(list((tmp_path / "p").rglob("*.parquet"))) <= 20 + 4
    spark.dataSource.register(cbf.CbfSource)
    cbf.dealt(df).write.format("cbf").option("path", str(tmp_path / "c")).mode("append").save()
    assert len(list((tmp_path / "c").glob("*.cbf"))) <= 20 + 4


def test_csv_with_a_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([(1, "ä"), (2, "b")], "a int, t string").coalesce(1)
    sinks.csv(df, str(tmp_path / "x"), mark=True)
    assert next((tmp_path / "x").glob("*.csv")).read_bytes()[:3] == b"\xef\xbb\xbf"
    assert [tuple(r) for r in readers.csv(spark, str(tmp_path / "x"), "a int, t string").collect()] == [(1, "ä"), (2, "b")]


def png(w=3, h=2):
    import struct
    import zlib

    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(h * (3 * w + 1)))) + chunk(b"IEND", b"")


def jpeg(w=40, h=30):
    part = lambda kind, body: bytes([0xFF, kind]) + (len(body) + 2).to_bytes(2, "big") + body
    frame = part(0xC0, b"\x08" + h.to_bytes(2, "big") + w.to_bytes(2, "big") + b"\x03" + bytes(9))
    scan = part(0xDA, bytes(10)) + b"\x12\xff\x00\x34\xff\xd0" * 20
    return b"\xff\xd8" + part(0xE0, b"JFIF\0" + b"\xff\xc0\x00\x09" + bytes(5)) + part(0xC4, bytes(20)) + frame + scan + b"\xff" + part(0xC4, bytes(8)) + scan + b"\xff\xd9"


def bmp(w=2, h=2):
    import struct

    body = bytes(8 * h)
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body


@pytest.mark.parametrize("make,size", [(png, (3, 2)), (jpeg, (40, 30)), (bmp, (2, 2))])
def test_pictures_are_followed_to_their_end(make, size):
    data = make()
    assert readers.image_size(data) == size and readers.image_whole(data) and readers.image_whole(data + b"more")
    assert not any(readers.image_whole(data[:n]) for n in range(len(data)))
    if make is png:
        for i in range(8, len(data) - 12):
            assert not readers.image_whole(data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :])


def test_broken_pictures_of_a_folder(spark, tmp_path):
    (tmp_path / "net").mkdir()
    for name, data in {"a.png": png(), "b.png": png()[:-20], "c.jpg": jpeg(), "d.jpeg": jpeg()[:-2], "e.bmp": bmp(), "f.bmp": bmp()[:-1]}.items():
        (tmp_path / "net" / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[1]: r.is_corrupt for r in readers.image_folder(spark, str(tmp_path)).collect()}
    assert got == {"a.png": False, "b.png": True, "c.jpg": False, "d.jpeg": True, "e.bmp": False, "f.bmp": True}
