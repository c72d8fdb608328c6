"""Periodicity: Fourier spectrum and autocorrelation. A series is one Arrow group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ordered(table: pa.Table, order: list[str]) -> np.ndarray:
    """The values of a group in order, nulls as NaN."""
    at = pc.sort_indices(table, [(c, "ascending") for c in order])
    return table.column("__x").take(at).to_numpy().astype(float)


def _per_series(df: DataFrame, keys: list[str], order: list[str], value: str, lines, columns: dict[str, T.DataType]) -> DataFrame:
    """Applies `lines` (array -> arrays of `columns`) to each series; keys are repeated."""

    def run(table: pa.Table) -> pa.Table:
        found = lines(_ordered(table, order))
        first = pa.array(np.zeros(len(found[0]), np.int64))
        return pa.table([*(table.column(c).take(first) for c in keys), *(pa.array(x, from_pandas=True) for x in found)], names=[*keys, *columns])

    rows = df.select(*dict.fromkeys([*keys, *order]), F.col(value).cast("double").alias("__x"))
    return rows.groupBy(*keys).applyInArrow(run, T.StructType([*(rows.schema[c] for c in keys), *(T.StructField(c, k) for c, k in columns.items())]))


def spectrum(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, k, period, amplitude, power) of the demeaned series for k = 1..n div 2; period in rows. Nulls add nothing; a series of nulls alone has null lines."""

    def lines(x: np.ndarray):
        n, none = len(x), bool(np.isnan(x).all())
        c = np.fft.rfft(np.nan_to_num(x - (0 if none else np.nanmean(x))))[1 : n // 2 + 1]
        k = np.arange(1, len(c) + 1, dtype=np.int32)
        power = np.where(none, np.nan, c.real**2 + c.imag**2)
        return k, n / k, np.sqrt(power), power

    return _per_series(df, keys, order, value, lines, {"k": T.IntegerType(), "period": T.DoubleType(), "amplitude": T.DoubleType(), "power": T.DoubleType()})


def best_period(spec: DataFrame, keys: list[str], low: float = 30.0, high: float = 120.0, measure: str = "amplitude") -> DataFrame:
    """(keys, period, peak, mean, snr) in the band low..high: the strongest line, the band's mean and their ratio (divisor floored at 1e-9). `measure` amplitude or power: the lines are the same, the ratios not."""
    band = spec.where(F.col("period").between(low, high))
    return band.groupBy(*keys).agg(F.max_by("period", F.struct(F.col(measure), -F.col("k"))).alias("period"), F.max(measure).alias("peak"), F.avg(measure).alias("mean")).withColumn("snr", F.col("peak") / F.greatest("mean", F.lit(1e-9)))


def autocorrelation(df: DataFrame, keys: list[str], order: list[str], value: str, lags: int = 600) -> DataFrame:
    """(keys, lag, r): Pearson correlation of the series with itself `lag` rows later, lag 1..min(lags, n-2); 0 where a side is constant. Pairs with a null don't count; without any r is null."""

    def lines(x: np.ndarray):
        lag = np.arange(1, min(lags, len(x) - 2) + 1, dtype=np.int32)
        return lag, np.array([_pearson(x[:-k], x[k:]) for k in lag.tolist()], float)

    return _per_series(df, keys, order, value, lines, {"lag": T.IntegerType(), "r": T.DoubleType()})


def _pearson(a: np.ndarray, b: np.ndarray) -> float:
    both = ~(np.isnan(a) | np.isnan(b))
    if not both.all():
        a, b = a[both], b[both]
    if not len(a):
        return np.nan
    a, b = a - a.mean(), b - b.mean()
    spread = np.sqrt((a @ a) / len(a)) * np.sqrt((b @ b) / len(b))
    return 0.0 if spread < 1e-9 else float(a @ b / len(a) / spread)
