"""Registered queries of readers and writers of whole folders, frames, masks and reports: made from the driver's tables, written, read again and checked by SQL."""

from __future__ import annotations

from fractions import Fraction

import pyarrow as pa
from pyspark.sql import functions as F

from .functions import pixels, scalars, temporal
from .operators import blocks, spectral, stats
from .registry import ORDER, ROWS_SQL, SPECTRUM_SQL, events, query, r6, read, savgol_sql
from .registry_files import FRAME_SQL, frame_columns, vector_frames
from .sources import cbf, readers, scratch, sinks, video

#: A recording a day: its name says when it begins and ends.
DAYS_SQL = """c AS (
  SELECT 'ch01_' || strftime(ts, '%Y%m%d') || '_000000_235959d' AS video_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS BIGINT) AS sec, event_id % 3 AS code,
         row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY ts, event_id) - 1 AS i, floor(value) AS motion, CAST(event_id % 256 AS DOUBLE) AS entropy FROM events)"""


def days(spark, d):
    """Events as frames of recordings of a day, half a frame number for each of two sides."""
    x = events(spark, d).withColumn("day", F.date_trunc("day", F.col("ts")).cast("timestamp_ntz"))
    number = blocks.numbered(x, ["day"], ORDER, F.date_trunc("hour", F.col("ts")), "i")
    roi = F.element_at(F.array(F.lit("left_deck"), F.lit("transfer"), F.lit("right_deck")), (F.col("event_id") % 3 + 1).cast("int"))
    name = F.concat(F.lit("ch01_"), F.date_format("ts", "yyyyMMdd"), F.lit("_000000_235959d"))
    sec = F.floor(temporal.seconds(F.col("day"), F.col("ts")))
    return number.select(name.alias("video_id"), F.col("i").alias("frame_idx"), sec.cast("float").alias("timestamp_sec"), roi.alias("roi_name"), (F.col("event_id") % 3).alias("roi_code"), F.floor("value").cast("float").alias("motion_intensity"), (F.col("event_id") % 256).cast("float").alias("entropy"))


def _time(c: str, name: str | None = None):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias(name or c)


@query(f"WITH {DAYS_SQL} SELECT strftime(day + sec * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS abs_time, video_id, CAST(sec AS DOUBLE) AS timestamp_sec, round(avg(motion), 6) AS motion, round(avg(entropy), 6) AS entropy FROM c WHERE code IN (0, 2) GROUP BY day, sec, video_id")
def night_features_of_a_tree(spark, d):
    """A file per recording, read as a tree: two regions, only the columns asked for, averaged over the regions of an instant."""
    path = scratch.new_folder(spark)
    sinks.recording_files(days(spark, d), f"{path}/2024/a")
    out = readers.night_features(spark, path, ["motion_intensity", "entropy", "not_there"][:2], ["left_deck", "right_deck"])
    return out.select(_time("abs_time"), "video_id", F.col("timestamp_sec").cast("double").alias("timestamp_sec"), r6(F.col("motion_intensity").cast("double"), "motion"), r6(F.col("entropy").cast("double"), "entropy"))


@query(f"WITH {DAYS_SQL} SELECT video_id, i AS frame_idx, strftime(day + sec * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS wall_time, motion FROM c")
def features_of_a_folder(spark, d):
    """All files of a folder, with wall-clock times from their names."""
    path = scratch.new_folder(spark)
    sinks.recording_files(days(spark, d), path)
    out = readers.parquet_folder(spark, path)
    return out.select("video_id", "frame_idx", _time("wall_time"), F.col("motion_intensity").cast("double").alias("motion"))


WIDE_SQL = f"""{DAYS_SQL}, h AS (SELECT *, i // 2 AS f FROM c), n AS (SELECT video_id, max(f) + 1 AS n, max(sec) AS last FROM h GROUP BY 1),
w AS (SELECT video_id, f, any_value(day) AS day, coalesce(max(CASE WHEN code = 0 THEN sec END), max(sec)) AS sec, max(CASE WHEN code = 0 THEN motion END) AS lm, max(CASE WHEN code = 1 THEN motion END) AS rm, max(CASE WHEN code = 0 THEN entropy END) AS le, max(CASE WHEN code = 1 THEN entropy END) AS re FROM h WHERE code IN (0, 1) GROUP BY 1, 2)"""


def _wide(spark, d):
    path = scratch.new_folder(spark)
    spark.dataSource.register(cbf.CbfSource)
    x = days(spark, d).select("video_id", F.floor(F.col("frame_idx") / 2).alias("frame_idx"), "roi_code", "timestamp_sec", "motion_intensity", "entropy")
    cbf.dealt(x).write.format("cbf").option("path", path).mode("append").save()
    return readers.wide_merge(cbf.scan(spark, path, ["video_id", "frame_idx", "roi_code", "timestamp_sec", "motion_intensity", "entropy"]))


@query(f"""WITH {WIDE_SQL} SELECT w.video_id, f AS frame_idx, strftime(day + sec * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS wall_time, CAST(f < 25 OR f >= greatest(n - 25, 0) AS INTEGER) AS is_boundary, lm AS left_deck_motion, rm AS right_deck_motion, le AS left_deck_entropy, re AS right_deck_entropy,
(lm + rm) / 2 AS roi_mean_motion, lm - rm AS roi_diff_motion, (le + re) / 2 AS roi_mean_entropy, le - re AS roi_diff_entropy FROM w JOIN n USING (video_id)""")
def wide_merge(spark, d):
    """Column files of recordings with both sides next to each other."""
    raw, _, _ = _wide(spark, d)
    return raw.withColumn("wall_time", _time("wall_time"))


@query(f"""WITH {WIDE_SQL} SELECT n.video_id, CASE WHEN n > 1 THEN round_even((n - 1) / greatest(last, 1e-6), 6) ELSE 0 END AS fps, n AS frame_count, (SELECT count(*) FROM w WHERE w.video_id = n.video_id) AS kept_frames,
strftime(day, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(day + INTERVAL 86399 SECOND, '%Y-%m-%d %H:%M:%S') AS end_time FROM n JOIN (SELECT DISTINCT video_id, day FROM c) USING (video_id)""")
def wide_merge_summary(spark, d):
    """The summary that goes with it, a row per recording."""
    _, _, summary = _wide(spark, d)
    return summary.withColumns({"start_time": _time("start_time"), "end_time": _time("end_time")})


@query("""SELECT 'o' || l_orderkey AS filename, CAST(l_orderkey % 640 AS INTEGER) AS width, CAST(480 AS INTEGER) AS height, l_returnflag AS name, CAST(l_quantity AS INTEGER) AS xmin, CAST(l_linenumber AS INTEGER) AS ymin, CAST(l_quantity + 10 AS INTEGER) AS xmax, CAST(l_linenumber + 5 AS INTEGER) AS ymax FROM lineitem""")
def annotation_files(spark, d):
    """Boxes written as annotation files and read again, a row per object."""
    path = scratch.new_folder(spark)
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber").cast("int")
    box = F.struct(q.alias("xmin"), n.alias("ymin"), (q + 10).alias("xmax"), (n + 5).alias("ymax"))
    x = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("name"), box.alias("bndbox"))).alias("object"))
    size = F.struct((F.col("l_orderkey") % 640).cast("int").alias("width"), F.lit(480).alias("height"), F.lit(3).alias("depth"))
    sinks.annotations(x.select(F.concat(F.lit("o"), "l_orderkey").alias("filename"), size.alias("size"), "object"), path)
    return readers.annotations(spark, path)


@query("""SELECT 'r' || l_suppkey % 10 AS run, CAST(count(*) AS DOUBLE) AS realtime_factor, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS fps, count(DISTINCT l_orderkey) / 4 AS wall_time_s, CAST(max(l_partkey) AS DOUBLE) AS video_count FROM lineitem GROUP BY 1""")
def benchmark_banners(spark, d):
    """Reports of runs as text, each number after its label."""
    path = scratch.new_folder(spark)
    x = read(spark, d, "lineitem").groupBy(F.concat(F.lit("r"), F.col("l_suppkey") % 10).alias("run")).agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"), (F.count_distinct("l_orderkey") / 4).alias("s"), F.max("l_partkey").alias("v"))
    lines = F.array(F.lit("==== benchmark ===="), F.format_string("  Realtime factor:  %dx", "n"), F.format_string("Frames/sec: %d", "q"), F.format_string("  Wall time: %.2f s", "s"), F.format_string("Videos: %d done", "v"), F.lit("Realtime factor: 0.5x"))
    x.select("run", F.explode(lines).alias("value")).hint("rebalance", "run").write.partitionBy("run").text(path)
    return readers.banners(spark, path).select(F.regexp_extract("file", r"run=(\w+)", 1).alias("run"), "realtime_factor", "fps", "wall_time_s", "video_count")


@query("""WITH m AS (SELECT o_orderkey % 8 AS ch, date_trunc('month', o_orderdate) AS t, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT 'ch' || ch || '_' || strftime(t, '%Y%m%d') || '_233000_001500.mp4' AS filename, CAST(ch AS INTEGER) AS channel, strftime(t + INTERVAL 1410 MINUTE, '%Y-%m-%d %H:%M:%S') AS start, strftime(t + INTERVAL 1455 MINUTE, '%Y-%m-%d %H:%M:%S') AS "end", 45.0 AS duration_est_min, round_even(n * 1000 / 1e6, 2) AS size_mb FROM m""")
def recording_index(spark, d):
    """Recordings found by a scan of a folder, none of them opened, as intervals of time."""
    path = scratch.new_folder(spark)
    x = read(spark, d, "orders").groupBy((F.col("o_orderkey") % 8).alias("ch"), F.date_trunc("month", "o_orderdate").alias("t")).agg(F.count("*").alias("n"))
    name = F.concat(F.lit("ch"), "ch", F.lit("_"), F.date_format("t", "yyyyMMdd"), F.lit("_233000_001500.mp4"))
    sinks.blobs(x.select(name.alias("name"), F.encode(F.repeat(F.lit("x"), (F.col("n") * 1000).cast("int")), "UTF-8").alias("data")), path)
    return readers.interval_index(readers.manifest(spark, path)).select("filename", "channel", _time("start"), _time("end"), "duration_est_min", "size_mb")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS night, count(*) AS n, round_even(avg(value), 3) AS level, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types, array_to_string(list_sort(list(DISTINCT event_type)), '; ') AS flat FROM events GROUP BY 1""")
def summary_files(spark, d):
    """A summary by night as CSV and as JSON, both read again."""
    path = scratch.new_folder(spark)
    x = events(spark, d).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("night")).agg(F.count("*").alias("n"), F.bround(F.avg("value"), 3).alias("level"), F.sort_array(F.collect_set("event_type")).alias("types"))
    sinks.night_summary(x, path)
    flat = readers.csv(spark, f"{path}/csv", "night string, n long, level double, types string")
    return readers.json_lines(spark, f"{path}/json", "night string, n long, level double, types array<string>").join(flat.select("night", "n", "level", F.col("types").alias("flat")), ["night", "n", "level"]).withColumn("types", F.array_join("types", ","))


REVIEW_SQL = """c AS (SELECT o_orderkey, o_orderdate, o_totalprice / 10000 AS core, o_totalprice / 200000 AS inc, o_custkey % 90 AS cyc FROM orders),
i AS (SELECT *, CAST(core < 15 AS INTEGER) + CAST(core > 30 AS INTEGER) + CAST(inc < 1.05 AS INTEGER) + CAST(cyc > 60 AS INTEGER) AS n FROM c),
k AS (SELECT *, CASE n WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM i)"""


def _reviewed(spark, d):
    x = read(spark, d, "orders")
    issues = scalars.window_issues(F.col("o_totalprice") / 10000, F.col("o_totalprice") / 200000, F.col("o_custkey") % 90)
    t = F.col("o_orderdate").cast("timestamp_ntz")
    return x.select(F.col("o_orderkey").alias("cycle_id"), t.alias("net_on_deck_time"), temporal.plus_seconds(t, F.col("o_custkey") % 60).alias("fish_end_time"), (F.col("o_totalprice") / 10000).alias("duration_core_window_min"), scalars.confidence(issues).alias("confidence"), issues.alias("issues"))


@query(f"""WITH {REVIEW_SQL} SELECT confidence, count(*) AS n, round(avg(core), 6) AS minutes FROM k GROUP BY 1""")
def confidence_counts(spark, d):
    """Reviewed core windows by confidence."""
    return stats.confidence_counts(_reviewed(spark, d)).withColumn("minutes", F.round("minutes", 6))


@query(f"""WITH {REVIEW_SQL}, l AS (SELECT '| ' || o_orderkey || ' | ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' | ' AS start, confidence, n FROM k)
SELECT start AS head, confidence, n AS n_issues FROM l
UNION ALL SELECT count(*) || ' cycles', count(*) FILTER (WHERE confidence = 'HIGH') || ' high, ' || count(*) FILTER (WHERE confidence = 'MEDIUM') || ' medium, ' || count(*) FILTER (WHERE confidence = 'LOW') || ' low', -1 FROM k""")
def review_report(spark, d):
    """The report of all cycles, written as text and taken apart again."""
    path = scratch.new_folder(spark)
    sinks.write_review(_reviewed(spark, d), path)
    line = F.col("value")
    row = spark.read.text(path).where(line.rlike(r"^\| \d|cycles,"))
    parts = F.split(line, r" \| ")
    issues = F.regexp_replace(F.element_at(parts, -1), r"\s*\|?$", "")
    n = F.when(issues == "", 0).otherwise(F.size(F.split(issues, "; ")))
    return row.select(
        F.when(line.contains("cycles,"), F.regexp_extract(line, r"^(\d+ cycles),", 1)).otherwise(F.concat(parts[0], F.lit(" | "), parts[1], F.lit(" | "))).alias("head"),
        F.when(line.contains("cycles,"), F.regexp_extract(line, r"average; (.*)$", 1)).otherwise(parts[4]).alias("confidence"),
        F.when(line.contains("cycles,"), -1).otherwise(n).alias("n_issues"),
    )


@query("""WITH p AS (SELECT vec_id, i, i % 8 AS x, i // 8 AS y FROM (SELECT vec_id, unnest(range(len(embedding))) AS i, unnest(embedding) AS v FROM embeddings) WHERE v > 0.1)
SELECT e.vec_id, CAST(count(i) AS INTEGER) AS area, CAST(coalesce(min(x), 0) AS INTEGER) AS x, CAST(coalesce(min(y), 0) AS INTEGER) AS y, CAST(coalesce(max(x) - min(x) + 1, 0) AS INTEGER) AS w, CAST(coalesce(max(y) - min(y) + 1, 0) AS INTEGER) AS h FROM embeddings e LEFT JOIN p USING (vec_id) GROUP BY 1""")
def mask_boxes(spark, d):
    """Boxes of bitmaps of 8 x 8 pixels: where the vectors are over a tenth."""
    bits = F.array_join(F.transform("embedding", lambda v: F.when(v > 0.1, "01").otherwise("00")), "")
    x = read(spark, d, "embeddings").select("vec_id", F.lit(8).alias("h"), F.lit(8).alias("w"), F.unhex(bits).alias("data"))
    return pixels.mask_boxes(x, "vec_id")


@query("""WITH f AS (SELECT vec_id, vec_id // 20 AS v, vec_id % 20 AS k, (vec_id % 20 * 7) % 9 - 4 AS dx, (vec_id % 20 * 5) % 7 - 3 AS dy FROM embeddings), s AS (SELECT *, lag(dx) OVER (PARTITION BY v ORDER BY k) AS px, lag(dy) OVER (PARTITION BY v ORDER BY k) AS py FROM f)
SELECT 'm' || v AS video_id, CAST(k AS INTEGER) AS frame_idx, coalesce(px - dx, 0) + 0.0 AS x, coalesce(py - dy, 0) + 0.0 AS y, px IS NULL OR true AS still FROM s""")
def global_motion(spark, d):
    """A picture of 24 x 24 pixels that moves in a circle of known steps, a recording for each twenty vectors; once the motion is undone, next to nothing is left inside."""
    k, n = F.col("vec_id") % 20, 24
    dx, dy = (k * 7) % 9 - 4, (k * 5) % 7 - 3
    first = read(spark, d, "embeddings").where(k == 0).select(F.floor(F.col("vec_id") / 20).alias("v"), F.col("embedding").alias("base"))
    x = read(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 20).alias("v"), k.cast("int").alias("frame_idx"), dx.cast("int").alias("dx"), dy.cast("int").alias("dy"))
    # Dealt over all cores first: a small file is one task, and a picture costs far more than its vector.
    x = x.repartition(2 * spark.sparkContext.defaultParallelism, "v").join(first, "v")
    # Pixel (y, x) of the picture that lies dx, dy off: a hash of the place and of the vector's values.
    place = F.expr(f"transform(sequence(0, {n * n - 1}), i -> pmod(i div {n} - dy, {n}) * {n} + pmod(i % {n} - dx, {n}))")
    level = F.transform(place, lambda p: F.pmod(F.xxhash64(p, F.element_at("base", (F.pmod(p, F.lit(64)) + 1).cast("int"))), F.lit(256)))
    data = F.unhex(F.array_join(F.transform(level, lambda v: F.repeat(F.lpad(F.hex(v), 2, "0"), 3)), ""))
    frames = x.select(F.concat(F.lit("m"), "v").alias("video_id"), "frame_idx", F.lit(n).alias("h"), F.lit(n).alias("w"), data.alias("data"))
    out = pixels.extract(frames, stabilize=True)
    tenth = lambda c: (F.bround(F.col(c).cast("double"), 1) + 0.0)
    return out.select("video_id", "frame_idx", tenth("global_motion_x").alias("x"), tenth("global_motion_y").alias("y"), (F.col("local_motion_intensity") <= F.greatest(F.col("motion_intensity"), F.lit(0.01))).alias("still"))


@query(FRAME_SQL)
def frames_round_trip(spark, d):
    """The frames of `frame_features` in uncompressed recordings, split at frames as they are read, with the same features."""
    path = scratch.new_folder(spark)
    x = vector_frames(spark, d)

    def clip(key, table):
        t = table.sort_by("frame_idx")
        return pa.table({"name": [f"{key[0].as_py()}.avi"], "data": pa.array([video.encode_avi(t["data"].to_pylist(), 8, 8, Fraction(25))], pa.binary())})

    sinks.blobs(x.groupBy("video_id").applyInArrow(clip, "name string, data binary"), path)
    spark.dataSource.register(video.FrameSource)
    return frame_columns(pixels.extract(spark.read.format("frames").option("path", path).load().drop("timestamp_sec")))


@query("""WITH f AS (SELECT vec_id // 50 AS v, vec_id % 50 AS k FROM embeddings), n AS (SELECT v, max(k) + 1 AS n FROM f GROUP BY 1)
SELECT 's' || v AS name, 'RAW' AS codec, 30000 / 1001 AS fps, n AS frame_count, CAST(8 AS INTEGER) AS width, CAST(8 AS INTEGER) AS height, round(n * 1001 / 30000, 6) AS duration_sec FROM n""")
def probed_recordings(spark, d):
    """What the containers of recordings say, without a frame being read."""
    path = scratch.new_folder(spark)

    def clip(key, table):
        n = max(table["frame_idx"].to_pylist()) + 1
        return pa.table({"name": [f"{key[0].as_py()}.avi"], "data": pa.array([video.encode_avi([bytes(192)] * n, 8, 8, Fraction(30000, 1001))], pa.binary())})

    sinks.blobs(vector_frames(spark, d).select("video_id", "frame_idx").groupBy("video_id").applyInArrow(clip, "name string, data binary"), path)
    out = video.probe(spark, path)
    return out.select(scalars.stem(F.col("path")).alias("name"), "codec", "fps", "frame_count", "width", "height", F.round("duration_sec", 6).alias("duration_sec"))


@query(f"WITH {SPECTRUM_SQL}, p AS (SELECT *, amplitude * amplitude AS power FROM a) SELECT user_id, round(arg_max(period, (power, -k)), 4) AS period, round(max(power), 1) AS peak, round(avg(power), 1) AS mean, round(max(power) / greatest(avg(power), 1e-9), 4) AS snr FROM p WHERE period BETWEEN 3 AND 30 GROUP BY user_id")
def fft_power(spark, d):
    """The strongest line by power."""
    x = spectral.best_period(spectral.spectrum(events(spark, d), ["user_id"], ORDER, "value"), ["user_id"], 3.0, 30.0, "power")
    return x.select("user_id", r6("period", "period", 4), r6("peak", "peak", 1), r6("mean", "mean", 1), r6("snr", "snr", 4))


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS x0, l_linenumber AS y0, l_quantity + l_partkey % 100 + 1 AS x1, l_linenumber + l_suppkey % 50 AS y1 FROM lineitem)
SELECT l_orderkey, l_linenumber, (x1 - x0) * (y1 - y0) AS area, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, round((x1 - x0) / nullif(y1 - y0, 0), 12) AS aspect, round((x0 + x1) / 2 / 2560, 12) AS rel_cx, round((y0 + y1) / 2 / 1440, 12) AS rel_cy, round((x1 - x0) / 2560, 12) AS rel_w, round((y1 - y0) / 1440, 12) AS rel_h FROM b""")
def box_shapes(spark, d):
    """All measures of boxes, heights of 0 included."""
    q, n = F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double")
    g = scalars.box_geometry(q, n, q + F.col("l_partkey") % 100 + 1, n + F.col("l_suppkey") % 50, F.lit(2560), F.lit(1440))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *[g[c].alias(c) if c in ("area", "cx", "cy") else F.round(g[c], 12).alias(c) for c in g])


def _bucket():
    return F.date_trunc("day", F.col("ts"))


@query(savgol_sql(11, 2))
def savgol_in_blocks(spark, d):
    """Smoothing with series cut into blocks of 64 rows."""
    return blocks.savgol(events(spark, d), ["user_id"], ORDER, _bucket(), "value", 11, 2, size=64).select("user_id", "event_id", r6("smooth", "smooth"))


@query(f"WITH {ROWS_SQL} SELECT user_id, event_id, round(avg(value) OVER w, 6) AS rolling_mean, round(stddev_pop(value) OVER w, 5) AS rolling_std FROM x WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)")
def rolling_in_blocks(spark, d):
    out = blocks.rolling(events(spark, d), ["user_id"], ORDER, _bucket(), "value", 29, 0, size=64, std="rolling_std")
    return out.select("user_id", "event_id", r6("rolling_mean", "rolling_mean"), r6("rolling_std", "rolling_std", 5))


@query(f"WITH {ROWS_SQL}, p AS (SELECT a.user_id, CAST(b.i - a.i AS INTEGER) AS lag, a.value AS x, b.value AS y FROM x a JOIN x b ON a.user_id = b.user_id AND b.i - a.i BETWEEN 1 AND least(100, a.n - 2) WHERE a.n > 2) SELECT user_id, lag, round(CASE WHEN stddev_pop(x) * stddev_pop(y) < 1e-9 THEN 0 ELSE corr(x, y) END, 6) AS r FROM p GROUP BY 1, 2")
def autocorr_in_blocks(spark, d):
    return blocks.autocorrelation(events(spark, d), ["user_id"], ORDER, _bucket(), "value", 100, 50).select("user_id", "lag", F.round("r", 6).alias("r"))


@query(f"WITH {SPECTRUM_SQL} SELECT user_id, CAST(k AS BIGINT) AS k, round(period, 4) AS period, round(amplitude, 4) AS amplitude FROM a")
def spectrum_in_blocks(spark, d):
    """Spectra in two steps, over columns and rows of a matrix."""
    return blocks.spectrum(events(spark, d), ["user_id"], ORDER, _bucket(), "value", 8).select("user_id", F.col("k").cast("long").alias("k"), r6("period", "period", 4), r6("amplitude", "amplitude", 4))

