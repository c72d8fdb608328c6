"""Operators on ordered series: `keys` name a series, `order` is a total order inside it.

Every window is partitioned by the keys of a series, one night or recording at a time, so nothing is sorted globally.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _over(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def resample_mean(df: DataFrame, keys: list[str], ts: str, values: list[str], unit: str = "minute") -> DataFrame:
    """Means per `unit`, left-closed and left-labelled, in column `minute`."""
    return df.groupBy(*keys, F.date_trunc(unit, F.col(ts).cast("timestamp_ntz")).cast("timestamp_ntz").alias("minute")).agg(*[F.avg(v).alias(v) for v in values])


def dense_grid(df: DataFrame, keys: list[str], ts: str = "minute", step: str = "INTERVAL 1 MINUTE") -> DataFrame:
    """One row per step from the first to the last time of each series; values of steps without a row are null."""
    ends = df.groupBy(*keys).agg(F.min(ts).alias("__a"), F.max(ts).alias("__b"))
    grid = ends.select(*keys, F.explode(F.sequence("__a", "__b", F.expr(step))).alias(ts))
    return grid.join(df, [*keys, ts], "left")


def interpolate(df: DataFrame, keys: list[str], order: list[str], value: str, limit: int = 5, out: str | None = None) -> DataFrame:
    """Linear between valid rows by row number, but only the first `limit` rows of a gap; after the last valid row its value, `limit` rows far."""
    w = _over(keys, order)
    x = df.withColumn("__i", F.row_number().over(w))
    at = F.when(F.col(value).isNotNull(), F.col("__i"))
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    x = x.withColumns({"__p": F.last(at, True).over(back), "__pv": F.last(value, True).over(back), "__n": F.first(at, True).over(ahead), "__nv": F.first(value, True).over(ahead)})
    line = F.col("__pv") + (F.col("__nv") - F.col("__pv")) * (F.col("__i") - F.col("__p")) / F.nullif(F.col("__n") - F.col("__p"), F.lit(0))
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(F.col("__p").isNull() | (F.col("__i") - F.col("__p") > limit), None).when(F.col("__n").isNull(), F.col("__pv")).otherwise(line)
    return x.withColumn(out or value, filled).drop("__i", "__p", "__pv", "__n", "__nv")


def fill_edges(df: DataFrame, keys: list[str], order: list[str], value: str, out: str | None = None) -> DataFrame:
    """Forward fill, then backward fill."""
    w = _over(keys, order)
    x = df.withColumn("__f", F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.withColumn(out or value, F.coalesce("__f", F.first("__f", True).over(w.rowsBetween(0, Window.unboundedFollowing)))).drop("__f")


def minute_series(df: DataFrame, keys: list[str], ts: str, value: str, limit: int = 5) -> DataFrame:
    """Minute means on a dense grid, gaps interpolated, then filled: (keys, minute, value)."""
    grid = dense_grid(resample_mean(df, keys, ts, [value]), keys)
    return fill_edges(interpolate(grid, keys, ["minute"], value, limit), keys, ["minute"], value)


def smoothing_weights(window: int, degree: int) -> np.ndarray:
    """Row r gives the weights of the window's values in the least-squares polynomial at its r-th place."""
    a = np.vander(np.arange(window) - window // 2, degree + 1, increasing=True).astype(float)
    return a @ np.linalg.pinv(a)


def savgol(df: DataFrame, keys: list[str], order: list[str], value: str, window: int, degree: int, out: str = "smooth", at: Column | None = None, n: Column | None = None) -> DataFrame:
    """Savitzky-Golay smoothing; the polynomial of the first or last whole window gives the edges. Series shorter than the window stay as they are. Of a block of a series, `at` and `n` are a row's number and the length in the whole."""
    w = _over(keys, order)
    x = df.withColumns({"__i": F.row_number().over(w) - 1 if at is None else at, "__n": F.count("*").over(Window.partitionBy(*keys)).cast("int") if n is None else n})
    x = x.withColumn("__near", F.collect_list(F.coalesce(F.col(value).cast("double"), F.lit(float("nan")))).over(w.rowsBetween(1 - window, window - 1)))
    begin = F.greatest(F.least(F.col("__i") - window // 2, F.col("__n") - window), F.lit(0))  # first row of the window that is fitted
    first = F.greatest(F.col("__i") - (window - 1), F.lit(0))  # first row that was collected
    rows = F.array(*[F.array(*map(F.lit, r)) for r in smoothing_weights(window, degree).tolist()])
    part = F.slice("__near", begin - first + 1, F.lit(window))
    fitted = F.aggregate(F.zip_with(part, F.get(rows, F.col("__i") - begin), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return x.withColumn(out, F.when(F.col("__n") >= window, F.nanvl(fitted, F.lit(None).cast("double"))).otherwise(F.col(value))).drop("__i", "__n", "__near")


def adaptive_savgol(df: DataFrame, keys: list[str], order: str, value: str, out: str = "smooth") -> DataFrame:
    """Smoothing whose window follows the length n: below 7 a copy; else min(31, the greatest odd <= n) wide and of degree 3, degree 2 when 5 or less. One task per series."""
    schema = df.select("*", F.lit(0.0).alias(out)).schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        pdf[out] = fit_series(pdf[value].to_numpy(float))
        return pdf

    return df.groupBy(*keys).applyInPandas(run, schema)


def fit_series(x: np.ndarray, longest: int = 31) -> np.ndarray:
    n = len(x)
    if n < 7:
        return x.copy()
    w = min(longest, n if n % 2 else n - 1)
    return smooth_array(x, w, 3 if w > 5 else 2)


def smooth_array(x: np.ndarray, window: int, degree: int) -> np.ndarray:
    """`savgol` of one array."""
    n, h = len(x), window // 2
    if n < window:
        return x.copy()
    m = smoothing_weights(window, degree)
    out = np.empty(n)
    out[h : n - h] = np.lib.stride_tricks.sliding_window_view(x, window) @ m[h]
    out[:h] = m[:h] @ x[:window]
    out[n - h :] = m[h + 1 :] @ x[-window:]
    return out


def rolling(df: DataFrame, keys: list[str], order: list[str], value: str, before: int, after: int, mean: str | None = "rolling_mean", std: str | None = None, sample: bool = False) -> DataFrame:
    """Mean and standard deviation over rows -before..after (population, or sample with `sample`); shorter at the ends."""
    w = _over(keys, order).rowsBetween(-before, after)
    if mean:
        df = df.withColumn(mean, F.avg(value).over(w))
    return df.withColumn(std, (F.stddev_samp if sample else F.stddev_pop)(value).over(w)) if std else df


def rolling_trailing(df: DataFrame, keys: list[str], order: list[str], value: str, rows: int = 30) -> DataFrame:
    return rolling(df, keys, order, value, rows - 1, 0, "rolling_mean", "rolling_std")


def rolling_seconds(df: DataFrame, keys: list[str], ts: str, value: str, width: int = 30) -> DataFrame:
    """As `rolling_trailing`, but over the last `width` seconds whatever the sampling rate."""
    w = Window.partitionBy(*keys).orderBy(F.unix_seconds(F.col(ts).cast("timestamp"))).rangeBetween(-(width - 1), 0)
    return df.withColumns({"rolling_mean": F.avg(value).over(w), "rolling_std": F.stddev_pop(value).over(w)})


def rolling_center(df: DataFrame, keys: list[str], order: list[str], value: str, rows: int = 31) -> DataFrame:
    return rolling(df, keys, order, value, rows // 2, rows // 2)


def abs_diff(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "diff") -> DataFrame:
    """Magnitude of the step from the row before; 0 for the first."""
    return df.withColumn(out, F.coalesce(F.abs(F.col(value) - F.lag(value).over(_over(keys, order))), F.lit(0.0)))


def time_gap(df: DataFrame, keys: list[str], order: list[str], ts: str, out: str = "gap_sec") -> DataFrame:
    """Seconds since the row before; null for the first."""
    return df.withColumn(out, F.timestamp_diff("MICROSECOND", F.lag(ts).over(_over(keys, order)), F.col(ts)) / F.lit(1e6))


def boundary_flag(df: DataFrame, keys: list[str], idx: str, edge: int = 25, out: str = "is_boundary") -> DataFrame:
    """1 for the first and last `edge` frames of a recording."""
    n = F.max(idx).over(Window.partitionBy(*keys)) + 1
    return df.withColumn(out, ((F.col(idx) < edge) | (F.col(idx) >= F.greatest(n - edge, F.lit(0)))).cast("int"))


def every_nth(df: DataFrame, keys: list[str], idx: str, n: int = 3, out: str = "frame_idx") -> DataFrame:
    """Rows whose idx is divisible by n, numbered anew from 0."""
    return df.where(F.pmod(F.col(idx), F.lit(n)) == 0).withColumn(out, F.row_number().over(_over(keys, [idx])) - 1)


def activity_index(df: DataFrame, keys: list[str], order: list[str], refs: dict[str, Column | float] | None = None) -> DataFrame:
    """fai: 0.5 motion + 0.25 brightness deviation + 0.25 entropy change, each over its reference (`refs` motion, bstd, entropy; floored at 1e-6)."""
    refs = refs or {"motion": 20.0, "bstd": 60.0, "entropy": 0.3}
    ref = {k: F.greatest(v if isinstance(v, Column) else F.lit(v), F.lit(1e-6)) for k, v in refs.items()}
    x = abs_diff(df, keys, order, "entropy", "__de")
    return x.withColumn("fai", 0.5 * F.col("motion_intensity") / ref["motion"] + 0.25 * F.col("brightness_std") / ref["bstd"] + 0.25 * F.col("__de") / ref["entropy"]).drop("__de")


def centred_std_p90(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Per series the 90th percentile of the centred rolling sample deviation over min(20, max(n div 4, 3)) rows. An even window reaches one row further back than forward."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(order, kind="stable")[value]
        r = x.rolling(min(20, max(len(x) // 4, 3)), center=True, min_periods=1).std().dropna()
        return pd.DataFrame([(*key, float(np.percentile(r, 90)) if len(r) else None)], columns=[*keys, "std_p90"])

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, order, value).groupBy(*keys).applyInPandas(run, f"{kinds}, std_p90 double")
