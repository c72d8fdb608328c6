"""Peaks, valleys and the segments between them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import groups


def local_maxima_array(x: np.ndarray) -> np.ndarray:
    """Strict maxima; a flat top counts once, at its middle (rounded down); ends never count."""
    if len(x) < 3:
        return np.zeros(0, int)
    edge = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    last = np.concatenate([edge[1:], [len(x)]]) - 1
    v = x[edge]
    top = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    return (edge[top] + last[top]) // 2


class _Lows:
    """Least values of a series over blocks of 1, 2, 4, ... samples, for searches that skip whole blocks."""

    def __init__(self, x: np.ndarray):
        self.n, self.depth = len(x), max(1, (len(x) - 1).bit_length())
        level = np.concatenate([x, np.full((1 << self.depth) - len(x), np.inf)])
        self.levels = [level]
        while len(level) > 1:
            level = np.minimum(level[::2], level[1::2])
            self.levels.append(level)
        self.flat, self.start = np.concatenate(self.levels), np.cumsum([0, *map(len, self.levels[:-1])])

    def next_below(self, first: np.ndarray, limit: np.ndarray, strict: bool) -> np.ndarray:
        """For each query the least index >= `first` whose sample is below `limit` (or at it, unless `strict`); n if there is none. Steps grow with the logarithm of the series."""

        def low(k, i):
            v = self.flat[self.start[k] + i]
            return v < limit_ if strict else v <= limit_

        out = np.full(len(first), self.n)
        ids = np.flatnonzero(first < self.n)
        k, i = np.zeros(len(ids), int), first[ids].astype(int)
        done_k, done_i, done = [], [], []
        while len(ids):  # up: over blocks that hold nothing
            limit_ = limit[ids]
            hit = low(k, i)
            done_k.append(k[hit]), done_i.append(i[hit]), done.append(ids[hit])
            k, i, ids = k[~hit], i[~hit] + 1, ids[~hit]
            climb = (i & 1) == 0
            k, i = np.where(climb, np.minimum(k + 1, self.depth), k), np.where(climb, i >> 1, i)
            inside = i < (1 << self.depth) >> k
            k, i, ids = k[inside], i[inside], ids[inside]
        if done:
            k, i, ids = np.concatenate(done_k), np.concatenate(done_i), np.concatenate(done)
            limit_ = limit[ids]
            for _ in range(self.depth):  # down: to the first sample of the block that is low
                deeper = k > 0
                k2, i2 = np.where(deeper, k - 1, 0), np.where(deeper, i * 2, i)
                i = np.where(deeper & ~low(k2, i2), i2 + 1, i2)
                k = k2
            out[ids] = i
        return out

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least sample of each range, ends included: of two blocks a level at most."""
        out, a, b = np.full(len(a), np.inf), a.astype(int), b.astype(int) + 1
        for level in self.levels:
            odd = (a < b) & (a & 1 == 1)
            out[odd] = np.minimum(out[odd], level[a[odd]])
            a = a + odd
            odd = (a < b) & (b & 1 == 1)
            b = b - odd
            out[odd] = np.minimum(out[odd], level[b[odd]])
            a, b = a >> 1, b >> 1
        return out


def prominences(x: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """Height over the higher of the two lowest points between the peak and the next strictly higher sample (or the end) on each side."""
    if not len(peaks):
        return np.zeros(0)
    bases = []
    for y, p in ((x, peaks), (x[::-1], len(x) - 1 - peaks)):
        end = _Lows(-y).next_below(p, -y[p], strict=True) - 1
        bases.append(_Lows(y).least(p, end))
    return x[peaks] - np.maximum(*bases)


def widths(x: np.ndarray, peaks: np.ndarray, prom: np.ndarray) -> np.ndarray:
    """Width at half prominence, crossings interpolated linearly."""
    if not len(peaks):
        return np.zeros(0)
    level, out = x[peaks] - prom / 2, np.zeros(len(peaks))
    for y, p in ((x, peaks), (x[::-1], len(x) - 1 - peaks)):
        at = np.minimum(_Lows(y).next_below(p, level, strict=False), len(x) - 1)
        under = y[at] < level
        part = np.zeros(len(p))
        part[under] = (level[under] - y[at[under]]) / (y[at[under] - 1] - y[at[under]])
        out += at - p - part
    return out


def _keep_distance(x: np.ndarray, peaks: np.ndarray, distance: int) -> np.ndarray:
    """Of the peaks those that stay when each, from the highest down and of equal ones from the last, takes out the others nearer than `distance`."""
    return _keep_distance_at(x[peaks], peaks, distance)


def _keep_distance_at(height: np.ndarray, peaks: np.ndarray, distance: int) -> np.ndarray:
    """`_keep_distance` of peaks of these heights."""
    keep, at = [True] * len(peaks), peaks.tolist()
    for k in np.argsort(height, kind="stable")[::-1].tolist():
        if keep[k]:
            for step in (-1, 1):  # what is in reach of one that stays is visited twice at most
                j = k + step
                while 0 <= j < len(at) and abs(at[j] - at[k]) < distance:
                    keep[j] = False
                    j += step
    return peaks[np.array(keep, bool)]


def find_peaks(x: np.ndarray, distance: float = 1, prominence: float | None = None, width: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(indices, prominences). Filters in this order: maxima; distance, from the highest peak down, of equal ones the later first; prominence; width. Time and memory follow the length of the series, times its logarithm."""
    x = np.asarray(x, float)
    peaks = local_maxima_array(x)
    d = math.ceil(distance)
    if d > 1 and len(peaks):
        peaks = _keep_distance(x, peaks, d)
    prom = prominences(x, peaks)
    if prominence is not None:
        peaks, prom = peaks[prom >= prominence], prom[prom >= prominence]
    if width is not None:
        ok = widths(x, peaks, prom) >= width
        peaks, prom = peaks[ok], prom[ok]
    return peaks, prom


def edges(x: np.ndarray, top: int, threshold: float, back: int, ahead: int, upto_top: bool = False) -> tuple[int, int, int]:
    """(rise, top, fall): the last sample before the peak (or at it, with `upto_top`) that is below the threshold, else `back` before it; the first from it on, else `ahead` after; inside the series."""
    low = np.flatnonzero(x < threshold)
    before, after = low[low < top + upto_top], low[low >= top]
    return int(before[-1]) if len(before) else max(0, top - back), top, int(after[0]) if len(after) else min(len(x) - 1, top + ahead)


def find_valleys(x: np.ndarray, distance: int, prominence: float, depth: float) -> np.ndarray:
    """Peaks of -x that lie strictly below the `depth`-th percentile of x."""
    if len(x) < 3:
        return np.zeros(0, int)
    v, _ = find_peaks(-x, distance, prominence)
    return v[x[v] < np.percentile(x, depth)]


def find_peaks_of(x: np.ndarray, starts: np.ndarray, distance: float = 1, prominence: float | None = None, width: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """`find_peaks` of many series that follow each other in `x`, series k from starts[k] on: (indices in x, prominences), in order.

    An infinite sample between neighbours ends every search as the end of a series does, so all series are one array;
    those that hold a sample that is not finite are done by themselves.
    """
    ends = np.append(starts[1:], len(x))
    whole = np.logical_and.reduceat(np.isfinite(x), starts) if len(starts) else np.zeros(0, bool)
    found, proms = [], []
    for k in np.flatnonzero(~whole).tolist():
        at, prom = find_peaks(x[starts[k] : ends[k]], distance, prominence, width)
        found.append(at + starts[k])
        proms.append(prom)
    series = np.repeat(np.arange(len(starts)), ends - starts)
    rows = np.flatnonzero(whole[series]) if len(x) else np.zeros(0, int)
    if len(rows):
        number = np.cumsum(whole)[series[rows]]  # from 1, of the series that are done together
        place = np.arange(len(rows)) + number
        y = np.full(len(rows) + number[-1] + 1, np.inf)
        y[place] = x[rows]
        row = np.zeros(len(y), int)
        row[place] = rows
        at = local_maxima_array(y)
        at = at[np.isfinite(y[at])]
        d = math.ceil(distance)
        if d > 1 and len(at):
            apart = np.zeros(len(y), int)
            apart[place] = number * d
            far = at + apart[at]  # peaks of two series are never within reach
            stay = np.isin(far, _keep_distance_at(y[at], far, d))
            at = at[stay]
        prom = prominences(y, at)
        if prominence is not None:
            at, prom = at[prom >= prominence], prom[prom >= prominence]
        if width is not None:
            ok = widths(y, at, prom) >= width
            at, prom = at[ok], prom[ok]
        found.append(row[at])
        proms.append(prom)
    if not found:
        return np.zeros(0, int), np.zeros(0)
    at, prom = np.concatenate(found).astype(int), np.concatenate(proms)
    order = np.argsort(at, kind="stable")
    return at[order], prom[order]


def find_valleys_of(x: np.ndarray, starts: np.ndarray, distance: int, prominence: float, depth: float) -> np.ndarray:
    """`find_valleys` of many series that follow each other in `x`."""
    v, _ = find_peaks_of(-x, starts, distance, prominence)
    ends = np.append(starts[1:], len(x))
    of = np.searchsorted(starts, v, side="right") - 1
    limits = np.full(len(starts), -np.inf)
    for k in np.unique(of).tolist():
        limits[k] = np.percentile(x[starts[k] : ends[k]], depth)
    return v[x[v] < limits[of]]


def _found(df: DataFrame, keys: list[str], order: str, value: str, search, columns: dict[str, str]) -> DataFrame:
    """Rows (keys, i, x, ...) of what `search(values, starts)` finds: indices and further arrays."""

    def run(table: pa.Table, starts: np.ndarray) -> pa.Table:
        x = table.column("__x").to_numpy().astype(float)
        at, *more = search(x, starts)
        i = at - starts[np.searchsorted(starts, at, side="right") - 1]
        return pa.table([*(table.column(k).take(pa.array(at)) for k in keys), pa.array(i.astype(np.int32)), *(pa.array(v, from_pandas=True) for v in (x[at], *more))], names=[*keys, "i", "x", *columns])

    rows = df.select(*dict.fromkeys([*keys, order]), F.col(value).cast("double").alias("__x"))
    kinds = [f"{k} {df.schema[k].dataType.simpleString()}" for k in keys] + ["i int", "x double"] + [f"{c} {kind}" for c, kind in columns.items()]
    return groups.by_series(rows, keys, [order], run, ", ".join(kinds))


def peaks(df: DataFrame, keys: list[str], order: str, value: str, distance: float = 1, prominence: float | None = None, width: float | None = None) -> DataFrame:
    """(keys, i, x, prominence) of the peaks of each series; a series is in one task, with many others."""
    return _found(df, keys, order, value, lambda x, starts: find_peaks_of(x, starts, distance, prominence, width), {"prominence": "double"})


def valleys(df: DataFrame, keys: list[str], order: str, value: str, distance: int = 30, prominence: float = 1.5, depth: float = 40.0) -> DataFrame:
    """(keys, i, x) of the valleys of each series."""
    return _found(df, keys, order, value, lambda x, starts: (find_valleys_of(x, starts, distance, prominence, depth),), {})


def local_maxima(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows at strict maxima, by window functions alone: (keys, i, value). Flat tops count at their middle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    x = df.withColumn("i", F.row_number().over(w) - 1).withColumn("__new", F.coalesce((F.col(value) != F.lag(value).over(w)).cast("int"), F.lit(1)))
    x = x.withColumn("__run", F.sum("__new").over(w))
    runs = x.groupBy(*keys, "__run").agg(F.min("i").alias("__a"), F.max("i").alias("__b"), F.first(value).alias(value))
    r = Window.partitionBy(*keys).orderBy("__run")
    runs = runs.withColumns({"__p": F.lag(value).over(r), "__n": F.lead(value).over(r)})
    return runs.where((F.col(value) > F.col("__p")) & (F.col(value) > F.col("__n"))).select(*keys, F.floor((F.col("__a") + F.col("__b")) / 2).cast("int").alias("i"), value)


def local_valleys(df: DataFrame, keys: list[str], order: list[str], value: str, depth: float | None = None) -> DataFrame:
    """As `local_maxima` for minima, below the `depth`-th percentile of the series if given."""
    found = local_maxima(df.withColumn(value, -F.col(value)), keys, order, value).withColumn(value, -F.col(value))
    if depth is None:
        return found
    limit = df.groupBy(*keys).agg(F.percentile(value, F.lit(depth / 100)).alias("__q"))
    return found.join(limit, keys).where(F.col(value) < F.col("__q")).drop("__q")


def segments(series: DataFrame, cuts: DataFrame, keys: list[str], order: list[str], value: str, ts: str | None = None) -> DataFrame:
    """Segments between neighbouring cuts (keys, i), ends included on both sides: start_i, end_i, peak_i (first maximum), peak, mean, low, auc (trapezoids), n.

    A row's segment is the number of cuts up to it; a row that is a cut ends the segment before, too. So each row is in
    one segment or two, whatever their number.
    """
    w = Window.partitionBy(*keys).orderBy("i")
    spans = cuts.select(*keys, F.col("i").alias("start_i"), F.lead("i").over(w).alias("end_i"), F.row_number().over(w).alias("segment")).where("end_i IS NOT NULL")
    rows = series.withColumn("i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    rows = rows.withColumn("__next", F.lead(value).over(w)).join(cuts.select(*keys, "i", F.lit(1).alias("__cut")), [*keys, "i"], "left")
    number = F.sum(F.coalesce("__cut", F.lit(0))).over(w).cast("int")
    inside = rows.withColumn("__number", number).withColumn("segment", F.explode(F.when(F.col("__cut") == 1, F.array(F.col("__number"), F.col("__number") - 1)).otherwise(F.array("__number"))))
    out = inside.join(spans, [*keys, "segment"]).groupBy(*keys, "segment", "start_i", "end_i").agg(
        F.max_by("i", F.struct(F.col(value), -F.col("i"))).alias("peak_i"),
        F.max(value).alias("peak"),
        F.avg(value).alias("mean"),
        F.min(value).alias("low"),
        F.sum(F.when(F.col("i") < F.col("end_i"), (F.col(value) + F.col("__next")) / 2)).alias("auc"),
        F.count("*").alias("n"),
        *([F.min(ts).alias("start_time"), F.max(ts).alias("end_time"), F.max_by(ts, F.struct(F.col(value), -F.col("i"))).alias("peak_time")] if ts else []),
    )
    return out


def strongest_peaks(spans: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """For each span (keys, start_i, end_i) the most prominent of the peaks (keys, i, prominence) in it, ends included; without one its middle and 0.

    Spans of a series may meet at their ends but not overlap, so a peak is in the last span that begins before it or at
    it, and where one begins at it, in the one that ends there, too.
    """
    marks = spans.select(*keys, F.col("start_i").alias("i"), F.struct("start_i", "end_i").alias("__s"), F.lit(None).cast("double").alias("prominence"))
    both = marks.unionByName(found.select(*keys, F.col("i").cast(spans.schema["start_i"].dataType).alias("i"), F.lit(None).cast(marks.schema["__s"].dataType).alias("__s"), "prominence"))
    w = Window.partitionBy(*keys).orderBy("i", F.col("__s").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    own = both.withColumn("__s", F.last("__s", True).over(w)).where(F.col("prominence").isNotNull()).select(*keys, "i", "prominence", "__s.start_i", "__s.end_i").where(F.col("i") <= F.col("end_i"))
    ends = spans.select(*keys, "start_i", "end_i", F.col("end_i").alias("i")).join(found.select(*keys, "i", "prominence"), [*keys, "i"]).where("start_i < i")
    best = own.unionByName(ends.select(*own.columns)).groupBy(*keys, "start_i", "end_i").agg(F.max(F.struct("prominence", (-F.col("i")).alias("m"))).alias("b"))
    out = spans.join(best, [*keys, "start_i", "end_i"], "left")
    return out.select(*spans.columns, F.coalesce(-F.col("b.m"), F.floor((F.col("start_i") + F.col("end_i")) / 2)).cast("int").alias("peak_i"), F.coalesce("b.prominence", F.lit(0.0)).alias("peak_prom"))


def rise_and_fall(df: DataFrame, keys: list[str], i: str, value: str, peak_i: str, low: float, share: float, back: int = 15, ahead: int = 25) -> DataFrame:
    """Per series with a peak at row `peak_i`: threshold = q + share * (peak - q) with q its `low` quantile; rise_i, the last row before the peak below it, else `back` rows before; fall_i, the first from the peak on below it, else `ahead` rows after, inside the series."""
    q = df.groupBy(*keys).agg(F.percentile(value, F.lit(low)).alias("__q"), F.max(F.when(F.col(i) == F.col(peak_i), F.col(value))).alias("__top"), F.max(i).alias("__end"))
    x = df.join(q, keys).withColumn("threshold", F.col("__q") + share * (F.col("__top") - F.col("__q")))
    below = F.col(value) < F.col("threshold")
    return x.groupBy(*keys, peak_i, "threshold").agg(
        F.coalesce(F.max(F.when(below & (F.col(i) < F.col(peak_i)), F.col(i))), F.greatest(F.lit(0), F.first(peak_i) - back)).alias("rise_i"),
        F.coalesce(F.min(F.when(below & (F.col(i) >= F.col(peak_i)), F.col(i))), F.least(F.first("__end"), F.first(peak_i) + ahead)).alias("fall_i"),
    )
