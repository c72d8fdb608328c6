"""Joins and merges of intervals. Range joins are given an equality - a time bucket - so that they are hash or merge joins at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sec(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)


def _level(a: Column, b: Column, width: float) -> Column:
    """Length class of an interval: it is not longer than `width` * 2**level."""
    return F.greatest(F.lit(0), F.coalesce(F.ceil(F.log2((_sec(b) - _sec(a)) / width)), F.lit(0))).cast("int")


def _top(*sides: tuple[DataFrame, Column]) -> int:
    """The greatest level of some tables of intervals: one number, so that short intervals alone cost one level."""
    return max([x.agg(F.max(level)).first()[0] or 0 for x, level in sides])


def _buckets(a: Column, b: Column, width: Column) -> Column:
    return F.sequence(F.floor(_sec(a) / width), F.floor(_sec(b) / width))


def _width(level: Column, bucket_sec: float) -> Column:
    return bucket_sec * F.pow(F.lit(2.0), level)


def overlap_join(left: DataFrame, right: DataFrame, on: list[str] | None = None, bucket_sec: float = 3600.0, l: tuple[str, str] = ("start", "end"), r: tuple[str, str] = ("r_start", "r_end")) -> DataFrame:
    """Pairs that overlap by more than a point, with clip_start and clip_end. Column names of the two sides differ, apart from `on`.

    Intervals have a length class, a power of two of `bucket_sec`; an interval stands in the two time buckets at most
    that it touches at its own and at each greater class, and a pair meets at the greater class of its two sides, so
    that a long interval makes no more rows than a short one. A pair is kept in the bucket where its intersection
    begins, so each comes out once. `bucket_sec` should be about a usual length.
    """
    on = on or []
    levels = [_level(F.col(x[0]), F.col(x[1]), bucket_sec) for x in (l, r)]
    top = _top((left, levels[0]), (right, levels[1]))

    def spread(x: DataFrame, ends: tuple[str, str], level: Column, name: str) -> DataFrame:
        y = x.withColumn(name, level).withColumn("__l", F.explode(F.sequence(F.col(name), F.lit(top))))
        return y.withColumn("__b", F.explode(_buckets(F.col(ends[0]), F.col(ends[1]), _width(F.col("__l"), bucket_sec))))

    a, b = spread(left, l, levels[0], "__la"), spread(right, r, levels[1], "__lb")
    lo, hi = F.greatest(l[0], r[0]), F.least(l[1], r[1])
    pairs = a.join(b, ["__l", "__b", *on]).where((F.col(l[0]) < F.col(r[1])) & (F.col(l[1]) > F.col(r[0])) & (F.col("__l") == F.greatest("__la", "__lb")))
    pairs = pairs.where(F.col("__b") == F.floor(_sec(lo) / _width(F.col("__l"), bucket_sec)))
    return pairs.withColumns({"clip_start": lo, "clip_end": hi}).drop("__l", "__b", "__la", "__lb")


def rows_in(points: DataFrame, spans: DataFrame, ts: str, on: list[str] | None = None, bucket_sec: float = 3600.0, s: tuple[str, str] = ("start", "end"), closed: bool = True) -> DataFrame:
    """Rows joined to each interval that holds their time: both ends included, or with `closed=False` the start alone. An interval stands in two buckets of its length class at most, a row in one of each class there is."""
    on = on or []
    level = _level(F.col(s[0]), F.col(s[1]), bucket_sec)
    a = points.withColumn("__l", F.explode(F.sequence(F.lit(0), F.lit(_top((spans, level))))))
    a = a.withColumn("__b", F.floor(_sec(F.col(ts)) / _width(F.col("__l"), bucket_sec)))
    b = spans.withColumn("__l", level)
    b = b.withColumn("__b", F.explode(_buckets(F.col(s[0]), F.col(s[1]), _width(F.col("__l"), bucket_sec))))
    inside = (F.col(ts) >= F.col(s[0])) & ((F.col(ts) <= F.col(s[1])) if closed else (F.col(ts) < F.col(s[1])))
    return a.join(b, ["__l", "__b", *on]).where(inside).drop("__l", "__b")


def covering(points: DataFrame, spans: DataFrame, ts: str, point_id: str, on: list[str] | None = None, bucket_sec: float = 3600.0, s: tuple[str, str] = ("start", "end"), tie: str | None = None) -> DataFrame:
    """For each point the first interval, by start and `tie`, with start <= ts < end; points without one stay, with nulls."""
    on = on or []
    hit = rows_in(points.select(point_id, ts, *on), spans, ts, on, bucket_sec, s, closed=False)
    w = Window.partitionBy(point_id).orderBy(s[0], *([tie] if tie else []))
    first = hit.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k", ts, *on)
    return points.join(first, point_id, "left")


def nearest_with_tolerance(points: DataFrame, spans: DataFrame, ts: str, point_id: str, tolerance_sec: float = 120.0, on: list[str] | None = None, bucket_sec: float = 3600.0, s: tuple[str, str] = ("start", "end"), tie: str | None = None) -> DataFrame:
    """As `covering`; a point without one takes the first interval, by start, whose start or end is less than `tolerance_sec` away. First by start, not nearest."""
    on = on or []
    pad = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(tolerance_sec).cast("decimal(18,6)"))
    wide = spans.withColumns({"__lo": F.col(s[0]) - pad, "__hi": F.col(s[1]) + pad})
    hit = rows_in(points.select(point_id, ts, *on), wide, ts, on, bucket_sec, ("__lo", "__hi"))
    exact = (F.col(ts) >= F.col(s[0])) & (F.col(ts) < F.col(s[1]))
    near = (F.abs(_sec(F.col(ts)) - _sec(F.col(s[0]))) < tolerance_sec) | (F.abs(_sec(F.col(ts)) - _sec(F.col(s[1]))) < tolerance_sec)
    hit = hit.withColumn("is_exact", exact).where(exact | near)
    w = Window.partitionBy(point_id).orderBy(F.col("is_exact").desc(), s[0], *([tie] if tie else []))
    first = hit.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k", "__lo", "__hi", ts, *on)
    return points.join(first, point_id, "left")


def containing(windows: DataFrame, spans: DataFrame, window_id: str, on: list[str] | None = None, bucket_sec: float = 3600.0, w: tuple[str, str] = ("ws", "we"), s: tuple[str, str] = ("start", "end"), tie: str | None = None) -> DataFrame:
    """For each window the first interval, by start and `tie`, that holds all of it."""
    hit = rows_in(windows, spans, w[0], on, bucket_sec, s).where(F.col(s[1]) >= F.col(w[1]))
    o = Window.partitionBy(window_id).orderBy(s[0], *([tie] if tie else []))
    return hit.withColumn("__k", F.row_number().over(o)).where("__k = 1").drop("__k")


def band_join(df: DataFrame, marks: DataFrame, ts: str, mark_ts: str, pad_sec: float = 30.0, on: list[str] | None = None) -> DataFrame:
    """Rows within `pad_sec` of a mark, ends included; the bucket is the pad, a row looks into its own and both neighbours."""
    on = on or []
    a = df.withColumn("__b", F.explode(F.array(*[F.floor(_sec(F.col(ts)) / pad_sec) + k for k in (-1, 0, 1)])))
    b = marks.withColumn("__b", F.floor(_sec(F.col(mark_ts)) / pad_sec))
    return a.join(b, ["__b", *on]).where(F.abs(_sec(F.col(ts)) - _sec(F.col(mark_ts))) <= pad_sec).drop("__b")


def merge_intervals(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", tag: str | None = None) -> DataFrame:
    """Union of overlapping or touching intervals: (keys, start, end, n[, tags]). Tags are joined by + in order of start; one that is part of what is there already is not added."""
    w = Window.partitionBy(*keys).orderBy(start, end, *([tag] if tag else []))
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = df.withColumn("__new", F.when(before.isNull() | (F.col(start) > before), 1).otherwise(0)).withColumn("__g", F.sum("__new").over(w))
    aggs = [F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")]
    if tag:
        ordered = F.transform(F.array_sort(F.collect_list(F.struct(start, end, tag))), lambda t: t[tag])
        joined = F.aggregate(ordered, F.lit(""), lambda a, t: F.when(a == "", t).when(F.contains(a, t), a).otherwise(F.concat(a, F.lit("+"), t)))
        aggs.append(joined.alias("tags"))
    return x.groupBy(*keys, "__g").agg(*aggs).drop("__g")
