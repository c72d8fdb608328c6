"""Readers of feature tables, manifests, annotations, reports and configuration."""

from __future__ import annotations

import re
import zlib

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import temporal
from ..operators import stats

#: Extensions of recordings and pictures.
VIDEO_EXTENSIONS = (".mp4", ".avi", ".mkv", ".mov")
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp")


def parquet_folder(spark: SparkSession, folder: str, wall_time: bool = True) -> DataFrame:
    """All Parquet files of a folder (not below it), with source_file and, where missing, wall_time = start in the name + timestamp_sec."""
    df = spark.read.option("mergeSchema", True).option("pathGlobFilter", "*.parquet").parquet(folder)
    df = df.withColumn("source_file", F.col("_metadata.file_name"))
    if wall_time and "wall_time" not in df.columns:
        df = df.withColumn("wall_time", temporal.plus_seconds(temporal.start_of_name(F.col("source_file")), F.col("timestamp_sec")))
    return df


def parquet_tree(spark: SparkSession, root: str, rois: list[str] | None = None, keep: list[str] | None = None, max_files: int | None = None) -> DataFrame:
    """Readable Parquet files below `root` whose path from there on says neither debug nor test, with abs_time (null if the name has none).

    `rois` filters roi_name where there is one (pushed to the scan); `keep` projects the columns that exist;
    `max_files` takes the first files by path.
    """
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option("mergeSchema", True).option("ignoreCorruptFiles", True).parquet(root)
    df = df.withColumn("source_path", F.col("_metadata.file_path"))
    at = F.locate(root.rstrip("/"), F.col("source_path"))
    below = F.when(at > 0, F.substr(F.col("source_path"), at + len(root.rstrip("/")))).otherwise(F.col("source_path"))
    df = df.where(~F.lower(below).rlike("debug|test"))
    if max_files is not None:
        paths = df.select("source_path").distinct().orderBy("source_path").limit(max_files)
        df = df.join(F.broadcast(paths), "source_path", "left_semi")  # max_files paths at most
    if rois and "roi_name" in df.columns:
        df = df.where(F.col("roi_name").isin(rois))
    df = df.withColumn("abs_time", temporal.plus_seconds(temporal.start_of_name(F.element_at(F.split("source_path", "/"), -1)), F.col("timestamp_sec")))
    return df.select(*[c for c in keep if c in df.columns]) if keep else df


def night_features(spark: SparkSession, root: str, features: list[str], rois: list[str], max_files: int | None = None) -> DataFrame:
    """Features of all nights, averaged over the regions of an instant."""
    keys = ["abs_time", "video_id", "timestamp_sec"]
    return stats.average_rois(parquet_tree(spark, root, rois, [*keys, "roi_name", *features], max_files), keys, features)


def merged_features(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all rows, those off the boundaries of recordings)."""
    return df, df.where("is_boundary = 0")


#: Short names of features in the wide table.
WIDE = {"motion": "motion_intensity", "entropy": "entropy"}


def wide_merge(df: DataFrame, features: dict[str, str] = WIDE, edge: int = 25) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Column files of recordings side by side: (raw, clean, summary).

    raw has a row per recording and frame that the left (roi_code 0) or right (1) side holds: wall_time, is_boundary (the
    first and last `edge` frames), and of each feature left_deck_, right_deck_, roi_mean_ and roi_diff_, the last two null
    where a side is missing. clean leaves boundaries out. summary has a row per recording: fps by its last time stamp,
    frame_count, kept_frames, and start and end by its name. Times and numbers of a recording come from all its rows.
    """
    whole = df.groupBy("video_id").agg((F.max("frame_idx") + 1).cast("long").alias("frame_count"), F.max("timestamp_sec").alias("__last"))
    sides = {"left_deck": 0, "right_deck": 1}
    aggs = [F.max(F.when(F.col("roi_code") == code, F.col(c).cast("double"))).alias(f"{side}_{name}") for name, c in features.items() for side, code in sides.items()]
    at = F.coalesce(F.max(F.when(F.col("roi_code") == 0, F.col("timestamp_sec"))), F.max("timestamp_sec")).alias("timestamp_sec")
    wide = df.where(F.col("roi_code").isin(0, 1)).groupBy("video_id", "frame_idx").agg(at, *aggs).join(whole, "video_id")
    for name in features:
        left, right = (F.col(f"{side}_{name}") for side in sides)
        wide = wide.withColumns({f"roi_mean_{name}": (left + right) / 2, f"roi_diff_{name}": left - right})
    n = F.col("frame_count")
    wide = wide.withColumns({"wall_time": temporal.plus_seconds(temporal.start_of_name(F.col("video_id")), F.col("timestamp_sec")), "is_boundary": ((F.col("frame_idx") < edge) | (F.col("frame_idx") >= F.greatest(n - edge, F.lit(0)))).cast("int")})
    start, end = temporal.span_of_name(F.col("video_id"))
    fps = F.when(n > 1, F.bround((n - 1) / F.greatest("__last", F.lit(1e-6)), 6)).otherwise(0.0)
    kept = wide.groupBy("video_id").agg(F.count("*").alias("kept_frames"))
    summary = whole.join(kept, "video_id", "left").select("video_id", fps.alias("fps"), "frame_count", F.coalesce("kept_frames", F.lit(0)).alias("kept_frames"), start.alias("start_time"), end.alias("end_time"))
    raw = wide.drop("frame_count", "__last", "timestamp_sec")
    return raw, raw.where("is_boundary = 0"), summary


def csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header, whether or not it begins with a byte-order mark. Without a schema all columns are strings."""
    r = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"')
    df = r.schema(schema).csv(path) if schema else r.csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def json_lines(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False) -> DataFrame:
    r = spark.read.option("multiLine", multi_line)
    return (r.schema(schema) if schema else r).json(path)


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Boxes of annotation files, one row per object: filename, width, height, name, xmin, ymin, xmax, ymax."""
    box = "struct<xmin:int,ymin:int,xmax:int,ymax:int>"
    schema = f"filename string, size struct<width:int,height:int,depth:int>, object array<struct<name:string,bndbox:{box}>>"
    df = spark.read.format("xml").option("rowTag", "annotation").schema(schema).load(path)
    return df.select("filename", "size.width", "size.height", F.explode("object").alias("o")).select("filename", "width", "height", "o.name", "o.bndbox.*")


#: Labels of a benchmark report and the columns they become.
BANNER = {"Realtime factor:": "realtime_factor", "Frames/sec:": "fps", "Videos/sec:": "videos_per_sec", "Wall time:": "wall_time_s", "Peak memory:": "peak_memory_mb", "Video duration:": "video_hours", "Videos:": "video_count"}


def banners(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark reports as one row per file: the number after each label; of repeated labels the first counts."""
    x = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("i"), "value")
    out = []
    for label, name in BANNER.items():
        number = F.regexp_extract("value", rf"^\s*{label}\s*([0-9.]+)", 1)
        out.append(F.min_by(F.when(number != "", number.cast("double")), F.when(number != "", F.col("i"))).alias(name))
    return x.groupBy("file").agg(*out)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Recordings below a folder, without reading them: filename, path, size_mb, channel, start_time, end_time, duration_est_min; nulls where the name says nothing."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    x = x.withColumn("filename", F.element_at(F.split("path", "/"), -1)).where(F.lower("filename").rlike(r"\.(mp4|avi|mkv|mov)$"))
    start, end = temporal.span_of_name(F.col("filename"))
    x = x.select("filename", "path", F.bround(F.col("length") / 1e6, 2).alias("size_mb"), F.nullif(F.regexp_extract("filename", r"^ch(\d+)_", 1), F.lit("")).cast("int").alias("channel"), start.alias("start_time"), end.alias("end_time"))
    return x.withColumn("duration_est_min", temporal.minutes(temporal.seconds(F.col("start_time"), F.col("end_time"))))


def interval_index(videos: DataFrame) -> DataFrame:
    """Recordings with a known time, as intervals."""
    return videos.where("start_time IS NOT NULL").withColumnsRenamed({"start_time": "start", "end_time": "end"})


def image_folder(spark: SparkSession, root: str) -> DataFrame:
    """Pictures below a folder: path, class (the folder's name), bytes, width, height and whether the file is broken anywhere: cut, or with a part that fails its checksum. JPEG, PNG and BMP."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).where(F.lower("path").rlike(r"\.(jpg|jpeg|png|bmp)$"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            data = b.column(2).to_pylist()
            sizes = [image_size(c) for c in data]
            broken = [s is None or not image_whole(c) for s, c in zip(sizes, data)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s[0] if s else None for s in sizes], pa.int32()), pa.array([s[1] if s else None for s in sizes], pa.int32()), pa.array(broken)], names=["path", "bytes", "width", "height", "is_corrupt"])

    y = x.select("path", F.col("length").alias("bytes"), "content").mapInArrow(run, "path string, bytes long, width int, height int, is_corrupt boolean")
    return y.withColumn("class", F.element_at(F.split("path", "/"), -2))


def image_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) from the head of a picture; None if it is not one."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")
    if data[:2] == b"BM" and len(data) >= 26:
        return int.from_bytes(data[18:22], "little"), abs(int.from_bytes(data[22:26], "little", signed=True))
    if data[:2] == b"\xff\xd8":
        for kind, a, b in _jpeg_parts(data):
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC) and b - a >= 5:
                return int.from_bytes(data[a + 3 : a + 5], "big"), int.from_bytes(data[a + 1 : a + 3], "big")
    return None


def image_whole(data: bytes) -> bool:
    """Whether a picture goes on to its end: a PNG's chunks by length and CRC to IEND, a JPEG's segments and scans to the end marker, a BMP's size."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        at = 8
        while at + 12 <= len(data):
            n = int.from_bytes(data[at : at + 4], "big")
            if at + 12 + n > len(data) or zlib.crc32(data[at + 4 : at + 8 + n]) != int.from_bytes(data[at + 8 + n : at + 12 + n], "big"):
                return False
            if data[at + 4 : at + 8] == b"IEND":
                return True
            at += 12 + n
        return False
    if data[:2] == b"BM":
        return 26 <= len(data) >= int.from_bytes(data[2:6], "little")
    kinds = [k for k, _, _ in _jpeg_parts(data)] if data[:2] == b"\xff\xd8" else []
    return bool(kinds) and kinds[-1] == 0xD9 and 0xDA in kinds


#: End of a scan's coded bytes: a marker that is neither a stuffed zero, nor a fill byte, nor a restart.
SCAN_END = re.compile(rb"\xff[^\x00\xff\xd0-\xd7]")


def _jpeg_parts(data: bytes):
    """(marker, first byte, end) of the segments of a JPEG, scans passed over, as far as they are whole; the end marker last."""
    at = 2
    while at + 2 <= len(data) and data[at] == 0xFF:
        kind = data[at + 1]
        if kind == 0xFF:  # fill
            at += 1
        elif kind == 0xD9:
            yield kind, at + 2, at + 2
            return
        elif kind == 0x01 or 0xD0 <= kind <= 0xD7:
            at += 2
        else:
            n = int.from_bytes(data[at + 2 : at + 4], "big")
            if n < 2 or at + 2 + n > len(data):
                return
            yield kind, at + 4, at + 2 + n
            at += 2 + n
            if kind == 0xDA:
                found = SCAN_END.search(data, at)
                if not found:
                    return
                at = found.start()


def config(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}
