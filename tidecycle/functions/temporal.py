"""Time expressions over naive timestamps (TIMESTAMP_NTZ) and file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of recordings, as in ch02_20250515_183000_20250515_190000.
START_NAME = r"ch\d+_(\d{8})_(\d{6})_"
#: Chunks of a row that `exploded_chunks` gives one after the other; rows and chunks of one of its tasks.
TILE, TASK_ROWS, TASK_CHUNKS = 256, 1 << 16, 1 << 26


def seconds(a: Column, b: Column) -> Column:
    """Seconds from a to b, with fractions."""
    return F.timestamp_diff("MICROSECOND", a, b) / F.lit(1e6)


def start_of_name(name: Column, pattern: str = START_NAME) -> Column:
    """Start time in a file name; null if it has none."""
    return F.try_to_timestamp(F.nullif(F.concat(F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)), F.lit("")), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")


def end_after(start: Column, end: Column, equal_is_next_day: bool = False) -> Column:
    """An end that is before its start is on the next day; `equal_is_next_day` says the same of equal times."""
    late = (end <= start) if equal_is_next_day else (end < start)
    return F.when(late, end + F.expr("INTERVAL 1 DAY")).otherwise(end)


def span_of_name(name: Column, equal_is_next_day: bool = False) -> tuple[Column, Column]:
    """(start, end) of names with one date and two times: ch<n>_<date>_<time>_<time>."""
    pattern = r"ch\d+_(\d{8})_(\d{6})_(?:\d{8}_)?(\d{6})"
    at = [F.nullif(F.concat(F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, k)), F.lit("")) for k in (2, 3)]
    start, end = (F.try_to_timestamp(x, F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz") for x in at)
    return start, end_after(start, end, equal_is_next_day)


def plus_seconds(start: Column, sec: Column) -> Column:
    """Wall-clock time `sec` after `start`."""
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.round(sec.cast("decimal(18,6)"), 6))


def night_label(ts: Column) -> Column:
    """The date on which the night of `ts` began: from 18:00 the day itself, before 06:00 the day before, else (and for null) `daytime`."""
    day = F.to_date(ts)
    return F.when(F.hour(ts) >= 18, day.cast("string")).when(F.hour(ts) < 6, F.date_sub(day, 1).cast("string")).otherwise("daytime")


def in_night_of(ts: Column, first: Column, begin: str = "18:00:00", end: str = "06:00:00") -> Column:
    """Whether ts lies in the window that begins on the date of `first`, ends included; a window that ends before it begins ends on the next day."""
    day = F.date_format(first, "yyyy-MM-dd")
    lo = F.concat_ws(" ", day, F.lit(begin)).cast("timestamp_ntz")
    hi = F.concat_ws(" ", day, F.lit(end)).cast("timestamp_ntz")
    return ts.between(lo, end_after(lo, hi, True))


def minutes(sec: Column, digits: int = 1) -> Column:
    """Seconds as minutes, rounded half to even."""
    return F.bround(sec / 60, digits)


def hours(sec: Column, digits: int = 1) -> Column:
    return F.bround(sec / 3600, digits)


def clock(ts: Column, millis: bool = False) -> Column:
    """Time of day, with milliseconds if asked for."""
    return F.date_format(ts, "HH:mm:ss.SSS" if millis else "HH:mm:ss")


def clock_to_seconds(text: Column) -> Column:
    """HHMMSS or HH:MM:SS as seconds of the day."""
    t = F.regexp_replace(text, ":", "")
    return F.substring(t, 1, 2).cast("int") * 3600 + F.substring(t, 3, 2).cast("int") * 60 + F.substring(t, 5, 2).cast("int")


def wall_to_frame(sec: Column, wall_len: Column, video_len: Column, fps: Column) -> Column:
    """Frame that shows wall-clock second `sec` of a recording that plays `video_len` seconds for `wall_len`; cut, not rounded."""
    return (sec / (wall_len / video_len) * fps).cast("int")


def frame_to_wall(frame: Column, wall_len: Column, video_len: Column, fps: Column) -> Column:
    return frame / fps * (wall_len / video_len)


def frame_window(offset: Column, fps: Column) -> Column:
    """First frame at or after `offset` seconds, safe against rounding just below a whole frame."""
    return F.floor(offset * fps + F.lit(1e-9))


def keyframe_time(idx: Column, n: Column, duration: Column) -> Column:
    """Time of keyframe idx of n that are spread evenly over `duration`."""
    return idx * duration / n


def fixed_steps(duration: Column, step: int) -> Column:
    """0, step, ... up to the duration, and the duration itself if more than half a step is left."""
    base = F.sequence(F.lit(0), F.floor(duration / step).cast("int") * step, F.lit(step)).cast("array<double>")
    rest = duration - F.floor(duration / step) * step
    return F.when(rest > step / 2, F.concat(base, F.array(duration.cast("double")))).otherwise(base)


def chunks(n: Column, size: int = 300) -> Column:
    """Array of (first, count) that covers n frames."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n.cast("int") - 1, F.lit(size)), lambda s: F.struct(s.alias("first"), F.least(F.lit(size), n.cast("int") - s).alias("count"))))


def exploded_chunks(df: DataFrame, n: str, size: int = 300) -> DataFrame:
    """A row (first, count) for each chunk that covers the `n` frames of a row, beside its columns; rows of no frames give none.

    Only numbers are exploded, in compiled code; the structs of `chunks` cost several times that. The result can be thousands of
    times the input, so it is laid out for column files: the first TILE chunks of all rows of a task, then the next ones. `first`
    then runs through the same few numbers again and again, which packs well; all chunks of a long row in one go do not. Rows and
    chunks are counted first: a task gets no more rows than a column's dictionary holds, and a bounded number of chunks on average.
    """
    x = df.where(F.col(n) > 0).withColumn("__length", F.col(n).cast("int"))
    length, begin, span = F.col("__length"), F.col("__begin"), TILE * size
    rows, total = x.agg(F.count("*"), F.sum(F.ceil(length / size))).first()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS), -(-(total or 0) // TASK_CHUNKS))
    x = x.repartition(tasks).withColumn("__begin", F.explode(F.sequence(F.lit(0), length - 1, F.lit(span))))
    x = x.sortWithinPartitions("__begin", F.desc("__length"))
    x = x.withColumn("first", F.explode(F.sequence(begin, begin + F.least(length - 1 - begin, F.lit(span - 1)), F.lit(size))))
    return x.withColumn("count", F.least(F.lit(size), length - F.col("first"))).drop("__length", "__begin")
