"""Long series cut into blocks: each block carries the rows of its neighbours that its windows reach, so one series is many tasks and results don't change."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import groups, series

BLOCK, OWN, AT = "__block", "__own", "__at"


def numbered(df: DataFrame, keys: list[str], order: list[str], bucket: Column, to: str = AT) -> DataFrame:
    """Rows of each series numbered from 0 by `order`, without a window over a whole series: the rows of a bucket are numbered after those of the buckets before. `bucket` must be a function of `order` that never falls when it rises, as an hour of the time is."""
    x = df.withColumn("__bucket", bucket)
    w = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = x.groupBy(*keys, "__bucket").agg(F.count("*").alias("__c")).withColumn("__before", F.coalesce(F.sum("__c").over(w), F.lit(0))).drop("__c")
    number = F.row_number().over(Window.partitionBy(*keys, "__bucket").orderBy(*order)) - 1 + F.col("__before")
    return x.join(before, [*keys, "__bucket"]).withColumn(to, number.cast("long")).drop("__bucket", "__before")


def with_halo(df: DataFrame, size: int, before: int, after: int) -> DataFrame:
    """Numbered rows with their block of `size` rows (`__block`), each also in the blocks whose windows of `before` rows back to `after` rows ahead reach it; `__own` tells which are the block's."""
    last = F.floor((F.col(AT) + before) / size)
    places = F.sequence(F.greatest(F.floor((F.col(AT) - after) / size), F.lit(0)), last)
    return df.withColumn(BLOCK, F.explode(places)).withColumn(OWN, F.col(BLOCK) == F.floor(F.col(AT) / size))


def by_block(df: DataFrame, keys: list[str], order: list[str], bucket: Column, before: int, after: int, apply, size: int = 100_000) -> DataFrame:
    """`apply(rows, keys and block, order)` on blocks with their halo; the own rows of its result. For any operator of `series` whose value depends on so many rows around alone."""
    rows = with_halo(numbered(df, keys, order, bucket), size, before, after)
    return apply(rows, [*keys, BLOCK], [AT]).where(OWN).drop(BLOCK, OWN, AT)


def rolling(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: str, before: int, after: int, size: int = 100_000, **names) -> DataFrame:
    """`series.rolling` of series of any length."""
    return by_block(df, keys, order, bucket, before, after, lambda x, k, o: series.rolling(x, k, o, value, before, after, **names), size)


def abs_diff(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: str, size: int = 100_000) -> DataFrame:
    """`series.abs_diff` of series of any length."""
    return by_block(df, keys, order, bucket, 1, 0, lambda x, k, o: series.abs_diff(x, k, o, value), size)


def time_gap(df: DataFrame, keys: list[str], order: list[str], bucket: Column, ts: str, size: int = 100_000) -> DataFrame:
    """`series.time_gap` of series of any length."""
    return by_block(df, keys, order, bucket, 1, 0, lambda x, k, o: series.time_gap(x, k, o, ts), size)


def savgol(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: str, window: int, degree: int, out: str = "smooth", size: int = 100_000) -> DataFrame:
    """`series.savgol` of series of any length: the first and last rows of a series are fitted by its first or last window, wherever blocks end."""
    x = numbered(df, keys, order, bucket)
    n = x.groupBy(*keys).agg((F.max(AT) + 1).cast("int").alias("__length"))
    rows = with_halo(x.join(n, keys), size, window - 1, window - 1)
    return series.savgol(rows, [*keys, BLOCK], [AT], value, window, degree, out, at=F.col(AT).cast("int"), n=F.col("__length")).where(OWN).drop(BLOCK, OWN, AT, "__length")


def autocorrelation(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: str, lags: int = 600, size: int = 100_000) -> DataFrame:
    """`spectral.autocorrelation` of series of any length: blocks give sums of products per lag, about the mean of the series, and the sums of all blocks the correlations."""
    x = numbered(df.withColumn("__x", F.col(value).cast("double")), keys, order, bucket).select(*keys, AT, "__x")
    whole = x.groupBy(*keys).agg(F.avg("__x").alias("__mean"), F.count("*").alias("__n"))
    rows = with_halo(x, size, 0, lags).join(whole, keys).withColumn("__x", F.col("__x") - F.col("__mean"))

    def sums(table):
        at = np.argsort(table[AT].to_numpy())
        v, own = table["__x"].to_numpy(zero_copy_only=False)[at].astype(float), int(np.count_nonzero(table[OWN].to_numpy(zero_copy_only=False)))
        here, found = ~np.isnan(v), []
        v = np.where(here, v, 0.0)
        for lag in range(1, min(lags, len(v) - 1) + 1):
            k = min(own, len(v) - lag)
            a, b, both = v[:k], v[lag : lag + k], here[:k] & here[lag : lag + k]
            a, b = a * both, b * both
            found.append((lag, int(both.sum()), a.sum(), b.sum(), a @ a, b @ b, a @ b))
        first = pa.array(np.zeros(len(found), np.int64))
        cols = list(zip(*found)) or [[]] * 7
        return pa.table([*(table[k].take(first) for k in keys), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.float64()) for c in cols[2:])], names=[*keys, "lag", "n", "a", "b", "aa", "bb", "ab"])

    kinds = "".join(f"{k} {df.schema[k].dataType.simpleString()}, " for k in keys)
    parts = rows.select(*keys, BLOCK, AT, OWN, "__x").groupBy(*keys, BLOCK).applyInArrow(sums, f"{kinds}lag int, n long, a double, b double, aa double, bb double, ab double")
    s = parts.groupBy(*keys, "lag").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")]).join(whole.select(*keys, "__n"), keys).where(F.col("lag") <= F.col("__n") - 2)
    n = F.nullif(F.col("n"), F.lit(0))
    spread = F.sqrt(F.greatest(F.col("aa") / n - (F.col("a") / n) ** 2, F.lit(0.0))) * F.sqrt(F.greatest(F.col("bb") / n - (F.col("b") / n) ** 2, F.lit(0.0)))
    r = F.when(spread < 1e-9, 0.0).otherwise((F.col("ab") / n - F.col("a") / n * F.col("b") / n) / F.nullif(spread, F.lit(0.0)))
    return s.select(*keys, "lag", r.alias("r"))


def spectrum(df: DataFrame, keys: list[str], order: list[str], bucket: Column, value: str, columns: int = 4096) -> DataFrame:
    """`spectral.spectrum` of long series in two steps: (keys, k, period, amplitude, power).

    A series of n rows is a matrix of p columns, row i at (i div p, i mod p), p the least divisor of n that is `columns`
    or more (n itself, if none is less). Each column is transformed in a task (n / p rows); its lines, turned by their
    phase, meet by line number and are transformed over the columns. No task holds more than a column or a row of the
    matrix; of a prime number of rows, which has no such matrix, one task holds all.
    """
    x = numbered(df.withColumn("__x", F.col(value).cast("double")), keys, order, bucket).select(*keys, AT, "__x")
    whole = x.groupBy(*keys).agg(F.avg("__x").alias("__mean"), F.count("*").alias("__n"))

    def divisor(batches):
        for b in batches:
            n = b.column(len(keys) + 1).to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([_width(v, columns) for v in n], pa.int64())], names=[*b.schema.names, "__p"])

    kinds = "".join(f"{k} {df.schema[k].dataType.simpleString()}, " for k in keys)
    whole = whole.mapInArrow(divisor, f"{kinds}__mean double, __n long, __p long")
    rows = x.join(whole, keys).select(*keys, "__n", "__p", (F.col(AT) % F.col("__p")).alias("__c"), F.floor(F.col(AT) / F.col("__p")).alias("__r"), F.coalesce(F.col("__x") - F.col("__mean"), F.lit(0.0)).alias("__x"), F.col("__mean").isNull().alias("__none"))

    def lines(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Transforms of groups that follow each other, those of a length at once; and each value's place in its group."""
        size = np.diff(np.append(starts, len(values)))
        out = np.empty(len(values), complex)
        for m in np.unique(size).tolist():
            at = starts[size == m][:, None] + np.arange(m)
            out[at] = np.fft.fft(values[at], axis=1)
        return out, np.arange(len(values)) - np.repeat(starts, size)

    def columns_step(t, starts):
        z, q = lines(t["__x"].to_numpy(), starts)
        z = z * np.exp(-2j * np.pi * t["__c"].to_numpy() * q / t["__n"].to_numpy())
        return pa.table([*(t[k] for k in (*keys, "__n", "__p", "__c", "__none")), pa.array(q), pa.array(z.real), pa.array(z.imag)], names=[*keys, "__n", "__p", "__c", "__none", "__q", "re", "im"])

    def rows_step(t, starts):
        z, place = lines(t["re"].to_numpy() + 1j * t["im"].to_numpy(), starts)
        n, p = t["__n"].to_numpy(), t["__p"].to_numpy()
        line = t["__q"].to_numpy() + (n // p) * place
        keep = np.flatnonzero((line >= 1) & (line <= n // 2))
        z, line, n, none = z[keep], line[keep], n[keep], t["__none"].to_numpy()[keep]
        power = np.where(none, np.nan, z.real**2 + z.imag**2)
        held = [t[k].take(pa.array(keep)) for k in keys]
        return pa.table([*held, pa.array(line.astype(np.int32)), pa.array(n / line), pa.array(np.sqrt(power), from_pandas=True), pa.array(power, from_pandas=True)], names=[*keys, "k", "period", "amplitude", "power"])

    turned = groups.by_series(rows, [*keys, "__c"], ["__r"], columns_step, f"{kinds}__n long, __p long, __c long, __none boolean, __q long, re double, im double")
    return groups.by_series(turned, [*keys, "__q"], ["__c"], rows_step, f"{kinds}k int, period double, amplitude double, power double")


def _width(n: int, columns: int) -> int:
    """The least divisor of n of at least `columns`; n where that is all there is."""
    small = [d for d in range(1, int(n**0.5) + 1) if n % d == 0]
    return min([d for d in (*small, *(n // s for s in small)) if d >= min(columns, n)], default=n)
