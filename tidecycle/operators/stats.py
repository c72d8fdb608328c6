"""Rollups, statistics tables, quantiles, evaluation measures and data-set splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import selection


def average_rois(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Means over the regions of an instant; null keys are a group of their own."""
    return df.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


def pivot_rois(df: DataFrame, keys: list[str], roi: str, rois: list[str], values: list[str]) -> DataFrame:
    """Wide table: <roi>_<value> for each region and value. The names are given, so no extra pass looks for them."""
    return df.groupBy(*keys).agg(*[F.avg(F.when(F.col(roi) == r, F.col(v))).alias(f"{r}_{v}") for r in rois for v in values])


def align_sides(left: DataFrame, right: DataFrame, keys: list[str], values: list[str], names: tuple[str, str] = ("left_deck", "right_deck")) -> DataFrame:
    """Full outer join of two regions on their frames, with both sides' values and roi_mean_, roi_diff_ columns; a missing side counts as 0."""
    a = left.select(*keys, *[F.col(v).alias(f"{names[0]}_{v}") for v in values])
    b = right.select(*keys, *[F.col(v).alias(f"{names[1]}_{v}") for v in values])
    x = a.join(b, keys, "full")
    for v in values:
        l, r = (F.coalesce(F.col(f"{n}_{v}"), F.lit(0.0)) for n in names)
        x = x.withColumns({f"{names[0]}_{v}": l, f"{names[1]}_{v}": r, f"roi_mean_{v}": (l + r) / 2, f"roi_diff_{v}": l - r})
    return x


def stats_table(df: DataFrame, columns: list[str], measures: tuple[str, ...] = ("count", "mean", "std", "min", "max"), digits: int = 3, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per column (`name`) with the measures, deviations of samples, rounded half to even."""
    fns = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.groupBy(*keys).agg(*[fns[m](c).cast("double").alias(f"{c}__{m}") for c in columns for m in measures])
    rows = F.array(*[F.struct(F.lit(c).alias("name"), *[F.bround(F.col(f"{c}__{m}"), digits).alias(m) for m in measures]) for c in columns])
    return one.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def quantile_refs(df: DataFrame, columns: list[str], shares: tuple[float, ...] = (0.5, 0.9), keys: tuple[str, ...] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, as <column>_p<percent>, by distributed selection."""
    return selection.exact_quantiles(df, columns, shares, keys)


def trapezoid(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Area under a series at unit steps."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.lead(value).over(w)).groupBy(*keys).agg(F.coalesce(F.sum((F.col(value) + F.col("__n")) / 2), F.lit(0.0)).alias("auc"))


def first_max(df: DataFrame, keys: list[str], value: str, tie: list[str]) -> DataFrame:
    """The row of the greatest value of each group; of equal ones the first by `tie`."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc(), *tie)
    return df.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def top_k(df: DataFrame, keys: list[str], score: str, k: int, tie: list[str]) -> DataFrame:
    """The k rows of greatest score of each group with their `rank`."""
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), *tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def completeness(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Per night: hours, samples, coverage of 12 hours, greatest gap in minutes, warnings and whether there are none."""
    w = Window.partitionBy(*keys).orderBy(ts)
    gap = F.timestamp_diff("MICROSECOND", F.lag(ts).over(w), F.col(ts)) / F.lit(60e6)
    x = df.withColumn("__gap", gap).groupBy(*keys).agg(F.count("*").alias("n_samples"), (F.timestamp_diff("MICROSECOND", F.min(ts), F.max(ts)) / F.lit(3600e6)).alias("__h"), F.coalesce(F.max("__gap"), F.lit(0.0)).alias("__g"))
    h, g, n = F.coalesce("__h", F.lit(0.0)), F.col("__g"), F.col("n_samples")
    # The least length, number of samples, gap and coverage of a complete night.
    warnings = F.array_compact(F.array(
        F.when(h < 4.0, F.format_string("duration=%.1fh < 4.0h minimum", h)),
        F.when(n < 30, F.format_string("samples=%d < 30 minimum", n)),
        F.when(g > 180, F.format_string("large gap=%.0fmin > 180min threshold", g)),
        F.when(h / 12 < 0.33, F.format_string("coverage=%.1f%% < 33%% minimum", h / 12 * 100)),
    ))
    return x.select(*keys, "n_samples", F.bround(h, 1).alias("duration_hours"), F.bround(h / 12, 2).alias("coverage_ratio"), F.bround(g, 0).alias("max_gap_minutes"), warnings.alias("warnings"), (F.size(warnings) == 0).alias("is_complete"))


def manifest_rollup(df: DataFrame, date: str, size_bytes: str, start: str, end: str, minutes: str) -> DataFrame:
    """Per date: files, GB (10^9, rounded to 1), minutes, first start, last end, hours at 60 times real time."""
    return df.groupBy(date).agg(F.count("*").alias("files"), F.bround(F.sum(size_bytes) / 1e9, 1).alias("size_gb"), F.sum(minutes).alias("minutes"), F.min(start).alias("first_start"), F.max(end).alias("last_end"), F.bround(F.sum(minutes) / 60 / 60, 2).alias("est_hours"))


def cycle_rollup(df: DataFrame, keys: list[str], duration: str, at: str, peak: str) -> DataFrame:
    """Per night: cycles, mean, deviation (0 for one), min, max of durations, times joined by " | ", mean peak."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("cycles"), F.bround(F.avg(duration), 1).alias("mean_min"), F.bround(F.coalesce(F.stddev_samp(duration), F.lit(0.0)), 1).alias("std_min"),
        F.min(duration).alias("min_min"), F.max(duration).alias("max_min"), F.array_join(F.sort_array(F.collect_list(at)), " | ").alias("times"), F.avg(peak).alias("peak_mean"),
    )


def confusion(df: DataFrame, true: str, pred: str, labels: list) -> DataFrame:
    """Rows of true labels, a column pred_<label> for each predicted one; labels without rows have zeros."""
    one = df.groupBy().agg(*[F.count_if((F.col(true) == a) & (F.col(pred) == b)).alias(f"{i}_{j}") for i, a in enumerate(labels) for j, b in enumerate(labels)])
    rows = F.array(*[F.struct(F.lit(a).alias("label"), *[F.col(f"{i}_{j}").alias(f"pred_{b}") for j, b in enumerate(labels)]) for i, a in enumerate(labels)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def precision_recall(df: DataFrame, true: str, pred: str, labels: list) -> DataFrame:
    """(label, precision, recall, f1, support); 0 where a divisor is 0."""
    aggs = []
    for i, c in enumerate(labels):
        t, p = F.col(true) == c, F.col(pred) == c
        aggs += [F.count_if(t & p).alias(f"{i}_tp"), F.count_if(p).alias(f"{i}_p"), F.count_if(t).alias(f"{i}_t")]

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))

    rows = F.array(*[F.struct(F.lit(c).alias("label"), ratio(F.col(f"{i}_tp"), F.col(f"{i}_p")).alias("precision"), ratio(F.col(f"{i}_tp"), F.col(f"{i}_t")).alias("recall"), ratio(2.0 * F.col(f"{i}_tp"), F.col(f"{i}_p") + F.col(f"{i}_t")).alias("f1"), F.col(f"{i}_t").alias("support")) for i, c in enumerate(labels)])
    return df.groupBy().agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share in %, ratio of the greatest to the smallest class, verdict)."""
    n = df.groupBy(label).agg(F.count("*").alias("n"))
    ends = n.agg(F.sum("n").alias("t"), F.max("n").alias("a"), F.min("n").alias("b")).withColumn("one", F.lit(1))
    x = n.withColumn("one", F.lit(1)).join(F.broadcast(ends), "one")  # one row
    ratio = F.col("a") / F.col("b")
    verdict = F.when(ratio < 1.5, "balanced").when(ratio < 3, "slightly imbalanced").when(ratio < 10, "imbalanced").otherwise("severely imbalanced")
    return x.select(label, "n", F.bround(100 * F.col("n") / F.col("t"), 1).alias("share"), F.bround(ratio, 2).alias("ratio"), verdict.alias("verdict"))


def detection_metrics(df: DataFrame, keys: list[str], conf: str, area: str) -> DataFrame:
    """Frames, detections (conf > 0), rate, mean and greatest confidence and area of detections; 0 when none."""
    hit = F.col(conf) > 0
    return df.groupBy(*keys).agg(
        F.count("*").alias("frames"), F.count_if(hit).alias("detections"), F.avg(hit.cast("int")).alias("rate"),
        *[F.coalesce(f(F.when(hit, F.col(c))), F.lit(0.0)).alias(f"{n}_{c}") for c in (conf, area) for n, f in (("avg", F.avg), ("max", F.max))],
    )


def feature_diff(a: DataFrame, b: DataFrame, keys: list[str], group: list[str], values: list[str]) -> DataFrame:
    """Two implementations of features compared where both have a frame: (group, feature, n, mean_a, mean_b, mad_rel); groups of fewer than two frames are left out."""
    y = b.select(*keys, *[F.col(v).alias(f"{v}__b") for v in values])
    x = a.select(*dict.fromkeys([*keys, *group, *values])).join(y, keys)
    rows = F.array(*[F.struct(F.lit(v).alias("feature"), F.col(v).cast("double").alias("a"), F.col(f"{v}__b").cast("double").alias("b")) for v in values])
    return difference_table(x.select(*group, F.explode(rows).alias("r")).select(*group, "r.*"), [*group, "feature"])


def difference_table(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, mean_a, mean_b, mad_rel) of columns a and b; groups of fewer than two rows are left out."""
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("a").alias("mean_a"), F.avg("b").alias("mean_b"), (F.avg(F.abs(F.col("a") - F.col("b"))) / (F.avg(F.abs("a")) + 1e-9)).alias("mad_rel"))
    return out.where("n >= 2")


def confidence_counts(core: DataFrame) -> DataFrame:
    """(confidence, n, minutes): reviewed core windows by confidence, with their mean length."""
    return core.groupBy("confidence").agg(F.count("*").alias("n"), F.avg("duration_core_window_min").alias("minutes"))


def scaling(df: DataFrame, workers: str, seconds: str, media_seconds: str, keys: list[str] | None = None) -> DataFrame:
    """Benchmark rows with real-time factor, speed-up and efficiency against the run of fewest workers, and whether it is the best."""
    w = Window.partitionBy(*(keys or [])).orderBy(workers)
    rt = F.col(media_seconds) / F.col(seconds)
    x = df.withColumn("realtime", rt).withColumn("__r0", F.first("realtime").over(w)).withColumn("__w0", F.first(workers).over(w))
    x = x.withColumn("speedup", F.col("realtime") / F.col("__r0")).withColumn("efficiency", F.col("speedup") / (F.col(workers) / F.col("__w0")))
    best = F.row_number().over(Window.partitionBy(*(keys or [])).orderBy(F.col("realtime").desc(), workers)) == 1
    return x.withColumn("is_best", best).drop("__r0", "__w0")


def missing(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose output is not there yet."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def skip_reasons(df: DataFrame, files: DataFrame, status: str, path: str) -> DataFrame:
    """`df` with segmented and skip_reason: rows whose status is not ok or whose path is null, and rows whose file is not among `files` (path), are skipped; of the others the reason is empty."""
    x = df.join(files.select(F.col(path)).distinct().withColumn("__there", F.lit(True)), path, "left")
    # The reasons.
    reason = F.when(~F.coalesce(F.col(status) == "ok", F.lit(False)) | F.col(path).isNull(), "keyframe_status_not_ok").when(F.col("__there").isNull(), "roi_file_not_found").otherwise("")
    return x.withColumn("skip_reason", reason).withColumn("segmented", F.col("skip_reason") == "").drop("__there")


def stratified_split(df: DataFrame, label: str, name: str, share: float = 0.2, seed: str = "", whole: bool = False) -> DataFrame:
    """`df` with split train or val: of each class the round(share * n) rows of least md5(seed, name); `whole` cuts instead of rounding.

    Ties (repeated names) go by name. No class is gathered (`selection.least_rows`).
    """
    n = F.col("__n") * share
    out = selection.least_rows(df, [label], F.floor(n) if whole else F.bround(n), _digest(seed, name), name, "__val")
    return out.withColumn("split", F.when(F.col("__val"), "val").otherwise("train")).drop("__val")


def _digest(seed: str, name: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(F.col(name).cast("string"), F.lit(""))))


def oversample(df: DataFrame, where: Column, times: int, name: str) -> DataFrame:
    """Rows of `where` `times` times: the copies' names end in _os1, _os2, ...; others once. Column `replica`."""
    x = df.withColumn("replica", F.explode(F.when(where, F.sequence(F.lit(0), F.lit(times - 1))).otherwise(F.array(F.lit(0)))))
    return x.withColumn(name, F.when(F.col("replica") > 0, F.concat(F.col(name).cast("string"), F.lit("_os"), F.col("replica"))).otherwise(F.col(name).cast("string")))


def random_sample(df: DataFrame, name: str, n: int, seed: str) -> DataFrame:
    """n rows, the same ones whatever the partitioning: those of least md5(seed, name)."""
    return selection.least_rows(df, [], F.lit(n), _digest(seed, name), name, "__in").where("__in").drop("__in")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are null."""
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out
