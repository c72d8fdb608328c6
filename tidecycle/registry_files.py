"""Registered queries of sources, sinks, frames and small expressions: what is written from the driver's tables is read again and checked by SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .functions import pixels, scalars, temporal
from .operators import peaks, series, states, stats
from .plans import night
from .registry import GRID_SQL, ORDER, SMOOTHED_STATES, SPECTRUM_SQL, SPLIT_SQL, VOTES_SQL, events, night_events, query, r6, read, series_of_states
from .sources import cbf, readers, scratch, sinks


def _coarse(spark, d):
    """A coarse feature table of all events: a recording per user."""
    x = events(spark, d).withColumn("frame_idx", F.row_number().over(peaks.Window.partitionBy("user_id").orderBy(*ORDER)) - 1)
    roi = F.element_at(F.array(F.lit("left_deck"), F.lit("transfer"), F.lit("right_deck")), (F.col("event_id") % 3 + 1).cast("int"))
    return x.select(F.concat(F.lit("u"), "user_id").alias("video_id"), "frame_idx", (F.col("frame_idx") * 4).alias("timestamp_sec"), roi.alias("roi_name"), (F.col("event_id") % 3).alias("roi_code"), F.floor("value").alias("mean_brightness"), (F.col("event_id") % 256).alias("entropy"))


COARSE_SQL = "c AS (SELECT 'u' || user_id AS video_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx, event_id % 3 AS roi_code, ['left_deck', 'transfer', 'right_deck'][event_id % 3 + 1] AS roi_name, floor(value) AS mean_brightness, event_id % 256 AS entropy FROM events)"


@query(f"WITH {COARSE_SQL} SELECT video_id, CAST(frame_idx AS INTEGER) AS frame_idx, frame_idx * 4.0 AS timestamp_sec, roi_name, mean_brightness, CAST(entropy AS DOUBLE) AS entropy FROM c")
def features_round_trip(spark, d):
    """Written as the frozen 32-bit schema, recordings together; recordings that are there already are not written twice."""
    path = scratch.new_folder(spark)
    x = _coarse(spark, d)
    sinks.features(x.where("roi_code < 9 AND video_id < 'u3'"), path)
    sinks.features_once(x, path, spark.read.parquet(path).select("video_id").distinct())
    back = spark.read.schema("frame_idx int, timestamp_sec float, roi_name string, mean_brightness float, entropy float, video_id string").parquet(path)
    return back.select("video_id", "frame_idx", *[F.col(c).cast("double").alias(c) for c in ("timestamp_sec", "mean_brightness", "entropy")], "roi_name")


@query(f"WITH {COARSE_SQL} SELECT video_id, frame_idx, roi_code, roi_name, mean_brightness, CAST(entropy AS DOUBLE) AS entropy FROM c")
def cbf_round_trip(spark, d):
    """Written as column files twice, the second time over the first, and read with the names of the regions."""
    spark.dataSource.register(cbf.CbfSource)
    path = scratch.new_folder(spark)
    x = _coarse(spark, d).select("video_id", *[F.col(c).cast("long" if c in cbf.UNSIGNED else "float").alias(c) if c in ("frame_idx", "roi_code", "timestamp_sec", "mean_brightness", "entropy") else F.lit(0.5).cast("float").alias(c) for c in cbf.COLUMNS])
    for _ in range(2):
        cbf.dealt(x).write.format("cbf").option("path", path).mode("overwrite").save()
    back = spark.read.format("cbf").option("path", path).load()
    return back.select("video_id", "frame_idx", "roi_code", "roi_name", F.col("mean_brightness").cast("double").alias("mean_brightness"), F.col("entropy").cast("double").alias("entropy"))


@query(f"WITH {COARSE_SQL}, n AS (SELECT video_id, count(*) AS k FROM c GROUP BY 1) SELECT video_id, count(*) FILTER (WHERE frame_idx >= 2 AND frame_idx < k - 2) AS clean, count(*) AS raw FROM c JOIN n USING (video_id) GROUP BY 1")
def merged_features(spark, d):
    """All rows of the column files of a folder, and those off the boundaries of recordings."""
    spark.dataSource.register(cbf.CbfSource)
    path = scratch.new_folder(spark)
    cbf.dealt(_coarse(spark, d).select("video_id", F.col("frame_idx").cast("long").alias("frame_idx"))).write.format("cbf").option("path", path).mode("append").save()
    raw, clean = readers.merged_features(series.boundary_flag(cbf.scan(spark, path, ["video_id", "frame_idx"]), ["video_id"], "frame_idx", 2))
    return raw.groupBy("video_id").agg(F.count("*").alias("raw"), F.count_if(F.col("is_boundary") == 0).alias("clean")).join(clean.select("video_id").distinct(), "video_id", "left")


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN 'says \"' || c_name || '\", twice' ELSE c_name END AS quoted, c_acctbal FROM customer")
def csv_round_trip(spark, d):
    path = scratch.new_folder(spark)
    sinks.csv(read(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit('says "'), "c_name", F.lit('", twice'))).otherwise(F.col("c_name")).alias("quoted"), "c_acctbal"), path)
    return readers.csv(spark, path, "c_custkey long, c_name string, quoted string, c_acctbal double")


@query("SELECT l_orderkey, l_linenumber, printf('%.6f', l_quantity / 8) AS q, l_returnflag FROM lineitem")
def feature_csv_round_trip(spark, d):
    """Floats with six decimals."""
    path = scratch.new_folder(spark)
    sinks.feature_csv(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 8).alias("q"), "l_returnflag"), path, ["q"])
    return readers.csv(spark, path, "l_orderkey long, l_linenumber int, q string, l_returnflag string")


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_round_trip(spark, d):
    path = scratch.new_folder(spark)
    x = read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    sinks.log_lines(x.where("turn = 0"), path)
    sinks.log_lines(x.where("turn <> 0 OR turn IS NULL"), path)
    return readers.json_lines(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in x.schema))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, CASE WHEN month(o_orderdate) = 3 THEN 2 ELSE 1 END AS version FROM orders GROUP BY ALL")
def incremental_dates(spark, d):
    """A second write replaces the months that it holds and leaves the others."""
    path = scratch.new_folder(spark)
    x = read(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))
    sinks.by_date(x.withColumn("version", F.lit(1)), path, "month")
    sinks.by_date(x.where("month LIKE '%-03'").withColumn("version", F.lit(2)), path, "month")
    return spark.read.schema("n long, version int, month string").parquet(path)


@query("SELECT 'i' || l_suppkey % 5 AS image, CAST(l_linenumber AS VARCHAR) || printf(' %.6f %.6f %.6f %.6f', l_quantity / 64, l_discount, l_tax, l_quantity / 32) AS line, count(*) AS n FROM lineitem GROUP BY 1, 2")
def label_files_round_trip(spark, d):
    path = scratch.new_folder(spark)
    x = read(spark, d, "lineitem")
    sinks.label_files(x.select(F.concat(F.lit("i"), F.col("l_suppkey") % 5).alias("image"), F.col("l_linenumber").alias("cls"), (F.col("l_quantity") / 64).alias("cx"), F.col("l_discount").alias("cy"), F.col("l_tax").alias("w"), (F.col("l_quantity") / 32).alias("h")), path)
    return spark.read.text(path).groupBy("image", F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("""WITH m AS (SELECT o_orderkey AS frame_id, CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'failed' END AS status, CASE WHEN o_custkey % 4 > 0 THEN 'p' || o_custkey END AS path, o_custkey % 4 > 1 AS there FROM orders)
SELECT frame_id, coalesce(status, '') = 'ok' AND path IS NOT NULL AND there AS segmented, CASE WHEN status IS NULL OR status <> 'ok' OR path IS NULL THEN 'keyframe_status_not_ok' WHEN NOT there THEN 'roi_file_not_found' ELSE '' END AS skip_reason FROM m""")
def skip_reasons(spark, d):
    c = F.col("o_custkey")
    x = read(spark, d, "orders").select(F.col("o_orderkey").alias("frame_id"), F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "failed").alias("status"), F.when(c % 4 > 0, F.concat(F.lit("p"), c)).alias("path"), c.alias("c"))
    files = x.where("c % 4 > 1").select("path").distinct()
    return stats.skip_reasons(x, files, "status", "path").select("frame_id", "segmented", "skip_reason")


@query("""SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity / ((100 + l_tax * 100) / 80) * 25) AS INTEGER) AS frame, round(l_quantity / 25 * ((100 + l_tax * 100) / 80), 6) AS wall, CAST(floor(l_quantity / 8 * 30 + 1e-9) AS BIGINT) AS first_frame, round(l_linenumber * l_quantity / 7, 6) AS keyframe,
CAST(trunc(l_discount * 2560) AS INTEGER) AS cut, CAST(round_even(l_discount * 2560, 0) AS INTEGER) AS nearest, CAST(l_partkey // 4 AS INTEGER) AS quarter, CAST((77 * (l_partkey % 256) + 150 * (l_suppkey % 256) + 29 * (l_orderkey % 256)) >> 8 AS INTEGER) AS gray, round(l_quantity / greatest(l_tax, 1e-6), 4) AS ratio,
round_even(l_extendedprice / 3600, 1) AS hours FROM lineitem""")
def frame_arithmetic(spark, d):
    """Frames and wall-clock seconds, frame windows, keyframe times, pixels of regions, luma and guarded ratios."""
    q, tax, n = F.col("l_quantity"), F.col("l_tax"), F.col("l_linenumber")
    wall, video = 100 + tax * 100, F.lit(80)
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", temporal.wall_to_frame(q, wall, video, F.lit(25)).alias("frame"), r6(temporal.frame_to_wall(q, wall, video, F.lit(25)), "wall"), temporal.frame_window(q / 8, F.lit(30)).alias("first_frame"),
        r6(temporal.keyframe_time(n, F.lit(7), q), "keyframe"), scalars.roi_pixels(F.col("l_discount"), F.lit(2560)).alias("cut"), scalars.roi_pixels(F.col("l_discount"), F.lit(2560), True).alias("nearest"), scalars.roi_quarter(F.col("l_partkey")).alias("quarter"),
        scalars.gray(*(F.col(c) % 256 for c in ("l_partkey", "l_suppkey", "l_orderkey"))).alias("gray"), r6(scalars.guarded(q, tax), "ratio", 4), temporal.hours(F.col("l_extendedprice")).alias("hours"),
    )


@query("""SELECT event_id, strftime(ts, '%H:%M:%S') AS clock, strftime(ts, '%H:%M:%S.%g') AS clock_ms, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS seconds, strftime(date_trunc('second', ts) + (event_id % 90) * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS later,
'f' || event_id % 3 || '.x' AS stem, event_id % 3 < 2 AS is_picture, lpad(CAST(event_id AS VARCHAR), 8, '0') AS padded FROM events""")
def names_and_clocks(spark, d):
    e = F.col("event_id")
    path = F.concat(F.lit("a/b/f"), e % 3, F.lit(".x."), F.element_at(F.array(F.lit("JPG"), F.lit("png"), F.lit("txt")), (e % 3 + 1).cast("int")))
    ts = F.col("ts")
    return events(spark, d).select(
        "event_id", temporal.clock(ts).alias("clock"), temporal.clock(ts, True).alias("clock_ms"), temporal.clock_to_seconds(temporal.clock(ts)).cast("long").alias("seconds"),
        F.date_format(temporal.plus_seconds(F.date_trunc("second", "ts").cast("timestamp_ntz"), e % 90), "yyyy-MM-dd HH:mm:ss").alias("later"),
        scalars.stem(path).alias("stem"), scalars.has_extension(path, *readers.IMAGE_EXTENSIONS).alias("is_picture"), scalars.zero_padded(e, 8).alias("padded"),
    )


@query(f"WITH {GRID_SQL} SELECT count(DISTINCT night) AS nights, count(*) AS minutes, count(DISTINCT round(value, 6)) AS levels FROM filled")
def distinct_values(spark, d):
    """Distinct nights, minutes and levels."""
    x = series.minute_series(night_events(spark, d), ["night"], "ts", "value")
    return x.agg(F.count_distinct("night").alias("nights"), F.count("*").alias("minutes"), F.count_distinct(F.round("value", 6)).alias("levels"))


def _bytes(v: Column) -> Column:
    return F.lpad(F.hex(v), 2, "0")


FRAME_SQL = """WITH e AS (SELECT vec_id, unnest(range(len(embedding))) AS i, CAST(floor((CAST(unnest(embedding) AS DOUBLE) + 1) * 127) AS BIGINT) AS v FROM embeddings),
p AS (SELECT 's' || vec_id // 50 AS video_id, vec_id % 50 AS frame_idx, i, i // 8 AS y, i % 8 AS x, v AS b, (v * 3 + 7) % 256 AS g, 255 - v AS r FROM e),
l AS (SELECT *, (77 * r + 150 * g + 29 * b) >> 8 AS m FROM p),
w AS (SELECT *, lag(m, 9) OVER w AS nw, lag(m, 8) OVER w AS n, lag(m, 7) OVER w AS ne, lag(m, 1) OVER w AS ww, lead(m, 1) OVER w AS ea, lead(m, 7) OVER w AS sw, lead(m, 8) OVER w AS s, lead(m, 9) OVER w AS se FROM l WINDOW w AS (PARTITION BY video_id, frame_idx ORDER BY i)),
k AS (SELECT video_id, frame_idx, avg(sqrt(pow(ne + 2 * ea + se - nw - 2 * ww - sw, 2) + pow(sw + 2 * s + se - nw - 2 * n - ne, 2))) / 255 AS edges, var_pop(n + s + ea + ww - 4 * m) AS lap FROM w WHERE x BETWEEN 1 AND 6 AND y BETWEEN 1 AND 6 GROUP BY 1, 2),
h AS (SELECT video_id, frame_idx, -sum(c / 64 * log2(c / 64)) AS entropy FROM (SELECT video_id, frame_idx, m, count(*) AS c FROM l GROUP BY 1, 2, 3) GROUP BY 1, 2),
d AS (SELECT a.video_id, a.frame_idx, avg(abs(a.m - b.m)) AS motion FROM l a JOIN l b ON a.video_id = b.video_id AND a.i = b.i AND b.frame_idx = a.frame_idx - 1 GROUP BY 1, 2)
SELECT l.video_id, CAST(l.frame_idx AS INTEGER) AS frame_idx, round(CAST(CAST(avg(m) AS FLOAT) AS DOUBLE), 3) AS mean_brightness, round(CAST(CAST(stddev_pop(m) AS FLOAT) AS DOUBLE), 3) AS brightness_std, round(CAST(CAST(avg(r) AS FLOAT) AS DOUBLE), 3) AS mean_r, round(CAST(CAST(avg(b) AS FLOAT) AS DOUBLE), 3) AS mean_b,
       round(CAST(CAST(coalesce(any_value(motion), 0) AS FLOAT) AS DOUBLE), 3) AS motion_intensity, round(CAST(CAST(any_value(edges) AS FLOAT) AS DOUBLE), 3) AS edge_density, round(CAST(CAST(any_value(lap) AS FLOAT) AS DOUBLE), 1) AS laplacian_variance, round(CAST(CAST(any_value(entropy) AS FLOAT) AS DOUBLE), 3) + 0.0 AS entropy,
       round(CAST(CAST(avg(CAST(b < 35 AND g < 35 AND r < 35 AS INTEGER)) AS FLOAT) AS DOUBLE), 3) AS dark_ratio
FROM l JOIN k USING (video_id, frame_idx) JOIN h USING (video_id, frame_idx) LEFT JOIN d USING (video_id, frame_idx) GROUP BY 1, 2"""


def vector_frames(spark, d):
    """Frames of 8 x 8 pixels that stand for the vectors, 50 to a recording."""
    v = F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 127))
    data = F.unhex(F.array_join(F.transform(v, lambda b: F.concat(_bytes(b), _bytes((b * 3 + 7) % 256), _bytes(255 - b))), ""))
    return read(spark, d, "embeddings").select(F.concat(F.lit("s"), F.floor(F.col("vec_id") / 50)).alias("video_id"), (F.col("vec_id") % 50).cast("int").alias("frame_idx"), F.lit(8).alias("h"), F.lit(8).alias("w"), data.alias("data"))


def frame_columns(out):
    names = {"mean_brightness": 3, "brightness_std": 3, "mean_r": 3, "mean_b": 3, "motion_intensity": 3, "edge_density": 3, "laplacian_variance": 1, "entropy": 3, "dark_ratio": 3}
    return out.select("video_id", "frame_idx", *[F.round(F.col(c).cast("double"), k).alias(c) for c, k in names.items()])


@query(FRAME_SQL)
def frame_features(spark, d):
    """Features of frames of 8 x 8 pixels that stand for the vectors, 50 to a recording."""
    return frame_columns(pixels.extract(vector_frames(spark, d)))


@query(f"""WITH {SPLIT_SQL}, s AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CASE WHEN k <= round_even(n * 0.2, 0) THEN 'val' ELSE 'train' END AS split FROM r),
o AS (SELECT CASE WHEN k > 0 THEN doc_id || '_os' || k ELSE doc_id END AS doc_id, lang, split, CAST(k AS INTEGER) AS replica FROM (SELECT *, unnest(range(CASE WHEN lang = 'de' AND split = 'train' THEN 3 ELSE 1 END)) AS k FROM s))
SELECT *, split || '/' || lang || '/' || doc_id AS target FROM o""")
def dataset_manifest(spark, d):
    """Where each file of a training set goes; rare classes several times."""
    return sinks.dataset_manifest(read(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 0.2, "s", F.col("lang") == "de", 3)


_AT = "strftime({}(CASE WHEN smoothed = '{}' THEN t END), '%Y-%m-%d %H:%M:%S') AS {}_{}".format
TIMELINE_SQL = f"""WITH {VOTES_SQL}, sm AS ({SMOOTHED_STATES}), tl AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + vec_id * INTERVAL 4 SECOND AS t, lag(smoothed) OVER (PARTITION BY s ORDER BY vec_id) AS p FROM sm)
SELECT s, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS "end", count(*) FILTER (WHERE p <> smoothed) AS changes,
count(*) FILTER (WHERE p <> smoothed AND (p, smoothed) NOT IN ({", ".join(f"('{a}', '{b}')" for a, b in states.LEGAL)})) AS illegal,
{", ".join(f"count(*) FILTER (WHERE smoothed = '{c}') * 4.0 AS {c}_sec, {_AT('min', c, c, 'first')}, {_AT('max', c, c, 'last')}" for c in states.CYCLE)} FROM tl GROUP BY s"""


@query(TIMELINE_SQL)
def timeline_summary(spark, d):
    """Per series: smoothed states, their seconds, first and last times, changes and illegal ones."""
    x = series_of_states(spark, d).withColumn("ts", temporal.plus_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("vec_id") * 4))
    out = night.timeline_summary(x, ["s"], ["vec_id"], "st", "ts", "p", states.CYCLE)
    return out.select(*[F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name) for f in out.schema])


@query(f"WITH {SPECTRUM_SQL} SELECT user_id, round(arg_max(period, (amplitude, -k)), 4) AS period, round(max(amplitude), 4) AS peak, round(avg(amplitude), 4) AS mean, round(max(amplitude) / greatest(avg(amplitude), 1e-9), 4) AS snr FROM a WHERE period BETWEEN 30 AND 120 GROUP BY user_id")
def periodicity(spark, d):
    """The strongest period of 30 to 120 rows."""
    return night.periodicity(events(spark, d), ["user_id"], ORDER, "value").select("user_id", *[r6(c, c, 4) for c in ("period", "peak", "mean", "snr")])
