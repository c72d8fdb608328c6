"""State timelines: smoothing, runs, transitions, durations and legality."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The states of the cycle in order, and the legal steps between different states.
CYCLE = ["waiting", "hauling", "on_deck", "sorting", "netdown"]
LEGAL = [("waiting", "hauling"), ("hauling", "on_deck"), ("on_deck", "sorting"), ("sorting", "waiting"), ("sorting", "netdown"), ("netdown", "waiting")]


def _over(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def majority_vote(df: DataFrame, keys: list[str], order: list[str], state: str, scores: str | None = None, names: list[str] | None = None, width: int = 5, out: str = "smoothed") -> DataFrame:
    """Most frequent state among the centred `width` rows, fewer at the ends. Ties: greater sum of the state's score in the window (`scores`: array in the order of `names`), then the one that comes first in the window."""
    h = width // 2
    w = _over(keys, order).rowsBetween(-h, h)
    zero = F.array().cast("array<double>")
    x = df.withColumn("__near", F.collect_list(F.struct(F.col(state).alias("s"), (F.coalesce(F.col(scores).cast("array<double>"), zero) if scores else zero).alias("p"))).over(w))
    labels = F.transform("__near", lambda n: n["s"])

    def rank(s: Column) -> Column:
        votes = F.size(F.filter(labels, lambda t: t == s))
        place = F.array_position(F.array(*map(F.lit, names or ["-"])), s)
        total = F.aggregate("__near", F.lit(0.0), lambda a, n: a + F.coalesce(F.get(n["p"], (place - 1).cast("int")), F.lit(0.0)))
        return F.struct(votes.alias("v"), total.alias("t"), (-F.array_position(labels, s)).alias("f"), s.alias("s"))

    return x.withColumn(out, F.array_max(F.transform(F.array_distinct(labels), rank))["s"]).drop("__near")


def runs(df: DataFrame, keys: list[str], order: list[str], state: str, ts: str) -> DataFrame:
    """Runs of equal state: (keys, run, state, first, last, n)."""
    w = _over(keys, order)
    x = df.withColumn("__new", F.when(F.lag(F.col(state)).over(w).eqNullSafe(F.col(state)) & (F.row_number().over(w) > 1), 0).otherwise(1))
    x = x.withColumn("run", F.sum("__new").over(w))
    return x.groupBy(*keys, "run").agg(F.first(state).alias(state), F.min(ts).alias("first"), F.max(ts).alias("last"), F.count("*").alias("n"))


def collapse(df: DataFrame, keys: list[str], order: list[str], state: str, ts: str) -> DataFrame:
    """(keys, states): the sequence without repeats, as an array."""
    return runs(df, keys, order, state, ts).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("run", state))), lambda r: r[state]).alias("states"))


def state_windows(df: DataFrame, keys: list[str], order: list[str], state: str, ts: str, target: str, pad_sec: int = 0) -> DataFrame:
    """Runs of `target` as intervals, widened by `pad_sec` on both sides."""
    pad = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(pad_sec).cast("decimal(18,6)"))
    return runs(df, keys, order, state, ts).where(F.col(state) == target).select(*keys, (F.col("first") - pad).alias("start"), (F.col("last") + pad).alias("end"), "n")


def transitions(df: DataFrame, keys: list[str], order: list[str], state: str) -> DataFrame:
    """Rows whose state differs from that of the row before, with column `previous`."""
    return df.withColumn("previous", F.lag(state).over(_over(keys, order))).where(F.col("previous") != F.col(state))


def transition_windows(df: DataFrame, keys: list[str], order: list[str], state: str, ts: str, pair: tuple[str, str], pad_sec: int = 30) -> DataFrame:
    """Neighbourhoods of changes between the two states of `pair`, either way."""
    pad = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(pad_sec).cast("decimal(18,6)"))
    hit = transitions(df, keys, order, state).where(F.col(state).isin(*pair) & F.col("previous").isin(*pair))
    return hit.select(*keys, (F.col(ts) - pad).alias("start"), (F.col(ts) + pad).alias("end"))


def is_legal(previous: Column, state: Column, legal: list[tuple[str, str]] | None = None) -> Column:
    ok = F.lit(False)
    for a, b in legal or LEGAL:
        ok = ok | ((previous == a) & (state == b))
    return ok


def transition_counts(df: DataFrame, keys: list[str], order: list[str], state: str, legal: list[tuple[str, str]] | None = None) -> DataFrame:
    """(keys, changes, illegal); series without a change have zeros."""
    t = df.withColumn("previous", F.lag(state).over(_over(keys, order)))
    changed = F.col("previous").isNotNull() & (F.col("previous") != F.col(state))
    return t.groupBy(*keys).agg(F.count_if(changed).alias("changes"), F.count_if(changed & ~is_legal(F.col("previous"), F.col(state), legal)).alias("illegal"))


def all_legal(df: DataFrame, keys: list[str], order: list[str], state: str, legal: list[tuple[str, str]] | None = None) -> DataFrame:
    return transition_counts(df, keys, order, state, legal).select(*keys, (F.col("illegal") == 0).alias("legal"))


def durations(df: DataFrame, keys: list[str], state: str, step_sec: float) -> DataFrame:
    """(keys, state, n, seconds): rows times the sampling step."""
    return df.groupBy(*keys, state).agg(F.count("*").alias("n")).withColumn("seconds", F.col("n") * step_sec)


def first_last(df: DataFrame, keys: list[str], state: str, ts: str, states: list[str]) -> DataFrame:
    """(keys, <state>_first, <state>_last for each state); null where it does not occur."""
    at = {s: F.when(F.col(state) == s, F.col(ts)) for s in states}
    return df.groupBy(*keys).agg(*[f(at[s]).alias(f"{s}_{n}") for s in states for f, n in ((F.min, "first"), (F.max, "last"))])


def active_runs(df: DataFrame, keys: list[str], order: list[str], value: str, threshold: float) -> DataFrame:
    """(keys, active_fraction, n_runs): share of rows above the threshold and number of runs of such rows."""
    on = (F.col(value) > threshold).cast("int")
    x = df.withColumn("__on", on).withColumn("__was", F.coalesce(F.lag(on).over(_over(keys, order)), F.lit(0)))
    return x.groupBy(*keys).agg(F.avg("__on").alias("active_fraction"), F.count_if((F.col("__on") == 1) & (F.col("__was") == 0)).alias("n_runs"))


def abnormal_marks(df: DataFrame, keys: list[str], order: list[str], state: str, ts: str, pad_sec: float = 30.0) -> DataFrame:
    """Rows within `pad_sec` of an abnormal change, with the tag of the earliest such change: os (on_deck, sorting), hw (hauling, waiting), ill (not legal)."""
    from .intervals import band_join

    t = transitions(df, keys, order, state)
    a, b = F.col("previous"), F.col(state)
    tag = F.when(a.isin("on_deck", "sorting") & b.isin("on_deck", "sorting"), "os").when(a.isin("hauling", "waiting") & b.isin("hauling", "waiting"), "hw").when(~is_legal(a, b), "ill")
    marks = t.select(*keys, F.col(ts).alias("mark_ts"), tag.alias("tag")).where("tag IS NOT NULL")
    near = band_join(df.withColumn("__row", F.monotonically_increasing_id()), marks, ts, "mark_ts", pad_sec, keys)  # repeated rows count each
    found = near.groupBy("__row").agg(F.first(F.struct(*df.columns)).alias("__r"), F.min_by("tag", F.struct("mark_ts", "tag")).alias("tag"))
    return found.select("__r.*", "tag")


def viterbi(df: DataFrame, keys: list[str], order: str, probs: str, names: list[str] | None = None, stay: float = 0.85, out: str = "state") -> DataFrame:
    """Most likely path of a cycle in which a state stays or goes on to the next: (keys, order, state). `probs` is in the order of `names`.

    Ties take the state of lower number. Emissions have 1e-9 added. A series is one group, read and decoded in time and
    space in proportion to its rows.
    """
    names = names or CYCLE

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        path = viterbi_path(np.log(np.stack([np.asarray(p, float) for p in pdf[probs]]) + 1e-9), stay)
        return pd.DataFrame({**{k: [v] * len(pdf) for k, v in zip(keys, key)}, order: pdf[order].to_numpy(), out: np.array(names, object)[path]})

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in [*keys, order])
    return df.select(*keys, order, probs).groupBy(*keys).applyInPandas(run, f"{kinds}, {out} string")


def viterbi_path(emission: np.ndarray, stay: float) -> np.ndarray:
    """States of the best path for log emissions (rows, states)."""
    rows, n = emission.shape
    step, go = math.log(stay), math.log(1 - stay)
    score = emission[0] - math.log(n)
    came = np.zeros((rows, n), bool)  # from the state before, not from itself
    for t in range(1, rows):
        kept, moved = score + step, np.roll(score, 1) + go
        came[t] = moved >= kept  # of equal scores the lower number wins, which for state 0 is itself
        came[t, 0] = moved[0] > kept[0]
        score = np.maximum(kept, moved) + emission[t]
    path = np.empty(rows, np.int64)
    path[-1] = int(score.argmax())
    for t in range(rows - 1, 0, -1):
        path[t - 1] = (path[t] - came[t, path[t]]) % n
    return path


def adaptive_sampling(df: DataFrame, keys: list[str], order: str, ts_sec: str, corr: str, threshold: float = 0.9, burst_sec: float = 10.0) -> DataFrame:
    """State machine per recording, with columns mode (before the row is taken in) and next_mode: NORMAL goes to BURST where the scene correlation falls below the threshold, BURST back to NORMAL once it has lasted longer than `burst_sec`. A null correlation or time changes nothing."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        burst, since, modes = False, 0.0, [False]
        for t, low in zip(pdf["__t"].to_numpy(float).tolist(), (pdf["__c"].to_numpy(float) < threshold).tolist()):
            if not burst and low:
                burst, since = True, t
            elif burst and t - since > burst_sec:
                burst = False
            modes.append(burst)
        names = np.where(modes, "BURST", "NORMAL")
        return pd.DataFrame({**{k: [v] * len(pdf) for k, v in zip(keys, key)}, order: pdf[order].to_numpy(), "mode": names[:-1], "next_mode": names[1:]})

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in [*keys, order])
    rows = df.select(*keys, order, F.col(ts_sec).cast("double").alias("__t"), F.col(corr).cast("double").alias("__c"))
    return rows.groupBy(*keys).applyInPandas(run, f"{kinds}, mode string, next_mode string")
