"""Registered queries of the time-series engine over the driver's tables, and the SQL that checks them.

The tables stand for what the engine is made for: `events` is a feature series per user, or per night; event types,
conversation roles and order statuses are states; orders and line items give intervals, manifests and statistics.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars, temporal
from .operators import intervals, peaks, series, spectral, states, stats
from .plans import night

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TIME = "yyyy-MM-dd HH:mm:ss"


def text(c: str) -> F.Column:
    return F.date_format(F.col(c), TIME).alias(c)


def r6(c, name: str | None = None, digits: int = 6) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits).alias(name) if name else F.round(c, digits)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")


NIGHT = """CASE WHEN hour(ts) >= 18 THEN strftime(ts, '%Y-%m-%d') WHEN hour(ts) < 6 THEN strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') ELSE 'daytime' END"""
MIN = "strftime(minute, '%Y-%m-%d %H:%M:%S')"


def grid_ctes(source: str, value: str, p: str = "") -> str:
    """SQL of the minute means of `value` of each night of `source`, on a dense grid, interpolated five rows far, then filled both ways: <p>filled (night, minute, i, value)."""
    return f"""
{p}m AS (SELECT {NIGHT} AS night, date_trunc('minute', ts) AS minute, avg({value}) AS value FROM {source} WHERE hour(ts) >= 18 OR hour(ts) < 6 GROUP BY 1, 2),
{p}e AS (SELECT night, unnest(generate_series(min(minute), max(minute), INTERVAL 1 MINUTE)) AS minute FROM {p}m GROUP BY night),
{p}g AS (SELECT night, minute, value, row_number() OVER (PARTITION BY night ORDER BY minute) AS i FROM {p}e LEFT JOIN {p}m USING (night, minute)),
{p}k AS (
  SELECT *, max(CASE WHEN value IS NOT NULL THEN i END) OVER (PARTITION BY night ORDER BY i ROWS UNBOUNDED PRECEDING) AS p,
         min(CASE WHEN value IS NOT NULL THEN i END) OVER (PARTITION BY night ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM {p}g),
{p}t AS (
  SELECT k.night, k.minute, k.i, CASE WHEN k.value IS NOT NULL THEN k.value WHEN k.p IS NULL OR k.i - k.p > 5 THEN NULL WHEN k.n IS NULL THEN a.value
         ELSE a.value + (b.value - a.value) * (k.i - k.p) / (k.n - k.p) END AS value
  FROM {p}k k LEFT JOIN {p}g a ON a.night = k.night AND a.i = k.p LEFT JOIN {p}g b ON b.night = k.night AND b.i = k.n),
{p}filled AS (
  SELECT night, minute, i, coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY night ORDER BY i ROWS UNBOUNDED PRECEDING),
         first_value(value IGNORE NULLS) OVER (PARTITION BY night ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM {p}t)"""


GRID_SQL = grid_ctes("events", "value")
#: Events of a user in order, numbered from 0.
ROWS_SQL = "x AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)"
ORDER = ["ts", "event_id"]


@query(f"SELECT user_id, {MIN} AS minute, round(avg(value), 6) AS value FROM (SELECT user_id, date_trunc('minute', ts) AS minute, value FROM events) GROUP BY user_id, minute")
def resample_mean(spark, d):
    return series.resample_mean(events(spark, d), ["user_id"], "ts", ["value"]).select("user_id", text("minute"), r6("value", "value"))


@query(f"WITH m AS (SELECT {NIGHT} AS night, value FROM events) SELECT night, count(*) AS n, round(avg(value), 6) AS mean_value FROM m GROUP BY night")
def night_label_counts(spark, d):
    return events(spark, d).groupBy(temporal.night_label(F.col("ts")).alias("night")).agg(F.count("*").alias("n"), r6(F.avg("value"), "mean_value"))


@query("SELECT user_id, event_type, round(avg(value), 6) AS value FROM events GROUP BY user_id, event_type")
def roi_average(spark, d):
    return stats.average_rois(events(spark, d), ["user_id", "event_type"], ["value"]).select("user_id", "event_type", r6("value", "value"))


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS value_p50, round(quantile_cont(value, 0.9), 6) AS value_p90 FROM events GROUP BY event_type")
def quantile_refs(spark, d):
    return stats.quantile_refs(events(spark, d), ["value"], keys=("event_type",)).select("event_type", r6("value_p50", "value_p50"), r6("value_p90", "value_p90"))


@query(r"""
SELECT event_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS s, strftime(CASE WHEN e < s THEN e + INTERVAL 1 DAY ELSE e END, '%Y-%m-%d %H:%M:%S') AS e,
       strftime(CASE WHEN e <= s THEN e + INTERVAL 1 DAY ELSE e END, '%Y-%m-%d %H:%M:%S') AS e_next
FROM (SELECT event_id, date_trunc('second', ts) AS s, date_trunc('day', ts) + (event_id % 24) * INTERVAL 1 HOUR AS e FROM events)""")
def parse_name(spark, d):
    end = F.date_trunc("day", "ts").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("event_id") % 24).cast("int"))
    x = events(spark, d).select("event_id", F.concat(F.lit("ch02_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("_"), F.date_format(end, "HHmmss"), F.lit(".mp4")).alias("name"))
    a, b = temporal.span_of_name(F.col("name"))
    _, c = temporal.span_of_name(F.col("name"), True)
    return x.select("event_id", F.date_format(temporal.start_of_name(F.col("name")), TIME).alias("s"), F.date_format(b, TIME).alias("e"), F.date_format(c, TIME).alias("e_next"))


@query(r"SELECT page_id, regexp_extract(url, '://([^/]+)', 1) AS host, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1) AS lang, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) AS num FROM pages")
def parse_url(spark, d):
    return read(spark, d, "pages").select("page_id", F.regexp_extract("url", "://([^/]+)", 1).alias("host"), F.regexp_extract("url", "/([a-z]{2})/([0-9]+)", 1).alias("lang"), F.regexp_extract("url", "/([a-z]{2})/([0-9]+)", 2).alias("num"))


def exact_weights(window: int, degree: int) -> list[list[Fraction]]:
    """Least-squares projector in fractions, by Gram-Schmidt on the powers: what the SQL is given."""
    t = [Fraction(i - window // 2) for i in range(window)]
    basis: list[list[Fraction]] = []
    for p in range(degree + 1):
        v = [x**p for x in t]
        for b in basis:
            c = sum(x * y for x, y in zip(v, b)) / sum(y * y for y in b)
            v = [x - c * y for x, y in zip(v, b)]
        basis.append(v)
    return [[sum(b[i] * b[j] / sum(y * y for y in b) for b in basis) for j in range(window)] for i in range(window)]


def savgol_sql(window: int, degree: int) -> str:
    weights = ", ".join(f"({i}, {j}, {float(w)!r})" for i, row in enumerate(exact_weights(window, degree)) for j, w in enumerate(row))
    return f"""
WITH {ROWS_SQL}, w(r, j, c) AS (VALUES {weights}),
a AS (SELECT user_id, event_id, i, n, value, greatest(least(i - {window // 2}, n - {window}), 0) AS b FROM x),
f AS (SELECT a.user_id, a.event_id, sum(w.c * y.value) AS s FROM a JOIN w ON w.r = a.i - a.b JOIN x y ON y.user_id = a.user_id AND y.i = a.b + w.j WHERE a.n >= {window} GROUP BY 1, 2)
SELECT a.user_id, a.event_id, round(CASE WHEN a.n >= {window} THEN s ELSE value END, 6) AS smooth FROM a LEFT JOIN f USING (user_id, event_id)"""


def _savgol(spark, d, window, degree):
    return series.savgol(events(spark, d), ["user_id"], ORDER, "value", window, degree).select("user_id", "event_id", r6("smooth", "smooth"))


@query(savgol_sql(11, 2))
def savgol_11_2(spark, d):
    return _savgol(spark, d, 11, 2)


@query(savgol_sql(7, 2))
def savgol_7_2(spark, d):
    return _savgol(spark, d, 7, 2)


@query(savgol_sql(7, 3))
def savgol_7_3(spark, d):
    return _savgol(spark, d, 7, 3)


ADAPTIVE_SQL = ", ".join(f"({w}, {i}, {j}, {float(c)!r})" for w in range(7, 33, 2) for i, row in enumerate(exact_weights(w, 3)) for j, c in enumerate(row))


@query(f"""
WITH x AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
w(w, r, j, c) AS (VALUES {ADAPTIVE_SQL}),
a AS (SELECT *, greatest(least(i - w // 2, n - w), 0) AS b FROM (SELECT *, least(31, CASE WHEN n % 2 = 1 THEN n ELSE n - 1 END) AS w FROM x)),
f AS (SELECT a.user_id, a.event_id, sum(w.c * y.value) AS s FROM a JOIN w ON w.w = a.w AND w.r = a.i - a.b JOIN x y ON y.user_id = a.user_id AND y.i = a.b + w.j GROUP BY 1, 2)
SELECT a.user_id, a.event_id, round(CASE WHEN a.n >= 7 THEN s ELSE value END, 6) AS smooth FROM a LEFT JOIN f USING (user_id, event_id)""")
def adaptive_savgol(spark, d):
    return series.adaptive_savgol(events(spark, d).select("user_id", "event_id", "value"), ["user_id"], "event_id", "value").select("user_id", "event_id", r6("smooth", "smooth"))


def night_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(temporal.night_label(F.col("ts")).alias("night"), "ts", "value").where("night <> 'daytime'")


@query(f"WITH {GRID_SQL} SELECT night, {MIN} AS minute, round(value, 10) AS value FROM filled")
def grid_fill(spark, d):
    return series.minute_series(night_events(spark, d), ["night"], "ts", "value").select("night", text("minute"), r6("value", "value", 10))


@query(f"WITH {ROWS_SQL} SELECT user_id, event_id, round(avg(value) OVER w, 6) AS rolling_mean, round(stddev_pop(value) OVER w, 5) AS rolling_std FROM x WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)")
def rolling_trailing_30(spark, d):
    return series.rolling_trailing(events(spark, d), ["user_id"], ORDER, "value").select("user_id", "event_id", r6("rolling_mean", "rolling_mean"), r6("rolling_std", "rolling_std", 5))


@query(f"WITH {ROWS_SQL} SELECT user_id, event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING), 6) AS rolling_mean FROM x")
def rolling_center_31(spark, d):
    return series.rolling_center(events(spark, d), ["user_id"], ORDER, "value").select("user_id", "event_id", r6("rolling_mean", "rolling_mean"))


@query("SELECT user_id, event_id, round(avg(value) OVER w, 6) AS rolling_mean FROM (SELECT *, epoch(date_trunc('second', ts))::BIGINT AS s FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW)")
def rolling_range_1h(spark, d):
    return series.rolling_seconds(events(spark, d), ["user_id"], "ts", "value", 3600).select("user_id", "event_id", r6("rolling_mean", "rolling_mean"))


@query("""WITH g AS (
  SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events),
k AS (SELECT *, least(20, greatest(n // 4, 3)) AS w FROM g),
s AS (SELECT a.event_type, a.i, stddev_samp(b.value) AS s FROM k a JOIN k b ON b.event_type = a.event_type AND b.i BETWEEN a.i - a.w // 2 AND a.i - a.w // 2 + a.w - 1 GROUP BY 1, 2)
SELECT event_type, round(quantile_cont(s, 0.9), 5) AS std_p90 FROM s WHERE s IS NOT NULL GROUP BY 1""")
def rolling_std_p90(spark, d):
    x = events(spark, d).select("event_type", F.row_number().over(peaks.Window.partitionBy("event_type").orderBy(*ORDER)).alias("i"), "value")
    return series.centred_std_p90(x, ["event_type"], "i", "value").select("event_type", r6("std_p90", "std_p90", 5))


@query(f"WITH {ROWS_SQL} SELECT user_id, event_id, round(coalesce(abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY i)), 0), 6) AS diff FROM x")
def abs_diff(spark, d):
    return series.abs_diff(events(spark, d), ["user_id"], ORDER, "value").select("user_id", "event_id", r6("diff", "diff"))


@query(f"WITH {ROWS_SQL} SELECT user_id, event_id, round(date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY i), ts) / 1e6, 6) AS gap_sec FROM x")
def gaps(spark, d):
    return series.time_gap(events(spark, d), ["user_id"], ORDER, "ts").select("user_id", "event_id", r6("gap_sec", "gap_sec"))


@query(f"WITH {ROWS_SQL} SELECT user_id, event_id, CAST(i < 5 OR i >= greatest(n - 5, 0) AS INTEGER) AS is_boundary FROM x")
def boundary_flag(spark, d):
    x = events(spark, d).withColumn("i", F.row_number().over(peaks.Window.partitionBy("user_id").orderBy(*ORDER)) - 1)
    return series.boundary_flag(x, ["user_id"], "i", 5).select("user_id", "event_id", "is_boundary")


@query(f"WITH {ROWS_SQL} SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY i) - 1 AS frame_idx FROM x WHERE i % 3 = 0")
def keyframe_subsample(spark, d):
    x = events(spark, d).withColumn("i", F.row_number().over(peaks.Window.partitionBy("user_id").orderBy(*ORDER)) - 1)
    return series.every_nth(x, ["user_id"], "i").select("user_id", "event_id", F.col("frame_idx").cast("long").alias("frame_idx"))


@query("""WITH s AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id),
w AS (SELECT user_id, date_trunc('day', t0) + INTERVAL 18 HOUR AS a, date_trunc('day', t0) + INTERVAL 30 HOUR AS b FROM s)
SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events JOIN w USING (user_id) WHERE ts BETWEEN a AND b GROUP BY user_id""")
def night_mask(spark, d):
    x = events(spark, d).withColumn("t0", F.min("ts").over(peaks.Window.partitionBy("user_id")))
    return x.where(temporal.in_night_of(F.col("ts"), F.col("t0"))).groupBy("user_id").agg(F.count("*").alias("n"), r6(F.sum("value"), "total", 4))


@query(f"""WITH {ROWS_SQL},
f AS (SELECT user_id, event_id, i, value AS motion, value * 2 + (event_id % 7) AS bstd, abs(coalesce((event_id % 11) / 10.0 - lag((event_id % 11) / 10.0) OVER (PARTITION BY user_id ORDER BY i), 0)) AS de FROM x),
q AS (SELECT quantile_cont(motion, 0.9) AS m, quantile_cont(bstd, 0.9) AS b FROM f)
SELECT user_id, event_id, round(0.5 * motion / greatest(m, 1e-6) + 0.25 * bstd / greatest(b, 1e-6) + 0.25 * de / 0.3, 6) AS fai FROM f, q""")
def fai(spark, d):
    x = events(spark, d).select("user_id", "event_id", "ts", F.col("value").alias("motion_intensity"), (F.col("value") * 2 + F.col("event_id") % 7).alias("brightness_std"), ((F.col("event_id") % 11) / 10.0).alias("entropy"))
    m, b = stats.quantile_refs(x, ["motion_intensity", "brightness_std"], (0.9,)).first()
    return series.activity_index(x, ["user_id"], ORDER, {"motion": m, "bstd": b, "entropy": 0.3}).select("user_id", "event_id", r6("fai", "fai"))


ISLANDS_SQL = f"""{ROWS_SQL}, c AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY i) THEN 0 ELSE 1 END AS new FROM x),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY i) AS run FROM c),
runs AS (SELECT user_id, run, min(event_type) AS event_type, min(ts) AS a, max(ts) AS b, count(*) AS n FROM r GROUP BY user_id, run)"""


@query(f"WITH {ISLANDS_SQL} SELECT user_id, CAST(run AS BIGINT) AS run, event_type, strftime(a, '%Y-%m-%d %H:%M:%S') AS first, strftime(b, '%Y-%m-%d %H:%M:%S') AS last, n FROM runs")
def state_islands(spark, d):
    return states.runs(events(spark, d), ["user_id"], ORDER, "event_type", "ts").select("user_id", "run", "event_type", text("first"), text("last"), "n")


@query(f"WITH {ISLANDS_SQL} SELECT user_id, string_agg(event_type, '>' ORDER BY run) AS states FROM runs GROUP BY user_id")
def collapse(spark, d):
    return states.collapse(events(spark, d), ["user_id"], ORDER, "event_type", "ts").select("user_id", F.array_join("states", ">").alias("states"))


PAIRS = [("user", "assistant"), ("assistant", "user"), ("system", "user")]


@query("""WITH t AS (SELECT conv_id, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations)
SELECT conv_id, count(*) FILTER (WHERE p <> role) AS changes,
       count(*) FILTER (WHERE p <> role AND (p, role) NOT IN (('user', 'assistant'), ('assistant', 'user'), ('system', 'user'))) AS illegal FROM t GROUP BY conv_id""")
def illegal_transitions(spark, d):
    return states.transition_counts(read(spark, d, "conversations"), ["conv_id"], ["turn"], "role", PAIRS)


@query(f"WITH {ROWS_SQL}, t AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY i) AS previous FROM x) SELECT previous, event_type, count(*) AS n FROM t WHERE previous <> event_type GROUP BY 1, 2")
def transitions(spark, d):
    return states.transitions(events(spark, d), ["user_id"], ORDER, "event_type").groupBy("previous", "event_type").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_type, count(*) AS n, CAST(count(*) * 4.0 AS DOUBLE) AS seconds FROM events GROUP BY user_id, event_type")
def durations(spark, d):
    return states.durations(events(spark, d), ["user_id"], "event_type", 4.0)


@query("""SELECT user_id, strftime(min(ts) FILTER (WHERE event_type = 'click'), '%Y-%m-%d %H:%M:%S') AS click_first, strftime(max(ts) FILTER (WHERE event_type = 'click'), '%Y-%m-%d %H:%M:%S') AS click_last,
 strftime(min(ts) FILTER (WHERE event_type = 'error'), '%Y-%m-%d %H:%M:%S') AS error_first, strftime(max(ts) FILTER (WHERE event_type = 'error'), '%Y-%m-%d %H:%M:%S') AS error_last FROM events GROUP BY user_id""")
def state_window(spark, d):
    x = states.first_last(events(spark, d), ["user_id"], "event_type", "ts", ["click", "error"])
    return x.select("user_id", *[text(c) for c in x.columns[1:]])


@query(f"WITH {ROWS_SQL}, f AS (SELECT user_id, i, CAST(value > 50 AS INTEGER) AS o, coalesce(lag(CAST(value > 50 AS INTEGER)) OVER (PARTITION BY user_id ORDER BY i), 0) AS w FROM x) SELECT user_id, round(avg(o), 6) AS active_fraction, count(*) FILTER (WHERE o = 1 AND w = 0) AS n_runs FROM f GROUP BY user_id")
def active_runs(spark, d):
    return states.active_runs(events(spark, d), ["user_id"], ORDER, "value", 50.0).select("user_id", r6("active_fraction", "active_fraction"), "n_runs")


@query(f"""WITH {ROWS_SQL},
w AS (SELECT a.user_id, a.event_id, a.i, b.event_type AS s, b.i AS j FROM x a JOIN x b ON a.user_id = b.user_id AND b.i BETWEEN a.i - 2 AND a.i + 2),
v AS (SELECT user_id, event_id, s, count(*) AS n, min(j) AS f FROM w GROUP BY 1, 2, 3)
SELECT user_id, event_id, s AS smoothed FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_id ORDER BY n DESC, f) AS k FROM v) WHERE k = 1""")
def majority_vote(spark, d):
    return states.majority_vote(events(spark, d), ["user_id"], ORDER, "event_type").select("user_id", "event_id", "smoothed")


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS cls, label FROM embeddings")
def argmax_class(spark, d):
    return read(spark, d, "embeddings").select("vec_id", scalars.argmax(F.col("embedding")).cast("long").alias("cls"), "label")


def _series_of_probs(spark, d):
    """Class probabilities: a softmax of the first five dimensions, in series of 50 vectors."""
    p = F.transform(F.slice("embedding", 1, 5), lambda e: F.exp(10 * e.cast("double")))
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    return read(spark, d, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 50).cast("long").alias("s"), p.alias("p")).select("vec_id", "s", F.transform("p", lambda x: x / total).alias("p"))


VOTES_SQL = """e AS (SELECT vec_id, vec_id // 50 AS s, list_transform(embedding[1:5], lambda v: exp(10 * CAST(v AS DOUBLE))) AS w FROM embeddings),
p AS (SELECT vec_id, s, row_number() OVER (PARTITION BY s ORDER BY vec_id) AS i, list_transform(w, lambda v: v / list_sum(w)) AS p, list_position(w, list_max(w)) AS c FROM e),
n AS (SELECT a.vec_id, a.s, b.c, b.p, b.i FROM p a JOIN p b ON b.s = a.s AND b.i BETWEEN a.i - 2 AND a.i + 2),
t AS (SELECT vec_id, any_value(s) AS s, list(p) AS near FROM n GROUP BY 1),
v AS (SELECT vec_id, c, count(*) AS votes, min(i) AS first FROM n GROUP BY 1, 2),
k AS (SELECT v.vec_id, t.s, c, row_number() OVER (PARTITION BY v.vec_id ORDER BY votes DESC, list_sum(list_transform(near, lambda x: x[v.c])) DESC, first) AS k FROM v JOIN t USING (vec_id))"""
SMOOTHED_STATES = "SELECT vec_id, s, ['waiting', 'hauling', 'on_deck', 'sorting', 'netdown'][c] AS smoothed FROM k WHERE k = 1"


def series_of_states(spark, d):
    """Class probabilities with the likeliest state of each row."""
    return _series_of_probs(spark, d).withColumn("st", F.element_at(F.array(*map(F.lit, states.CYCLE)), (scalars.argmax(F.col("p")) + 1).cast("int")))


@query(f"WITH {VOTES_SQL} {SMOOTHED_STATES}")
def majority_vote_scores(spark, d):
    """Votes of five rows; equal ones are told apart by the sum of the state's probability."""
    names = states.CYCLE
    return states.majority_vote(series_of_states(spark, d), ["s"], ["vec_id"], "st", "p", names).select("vec_id", "s", "smoothed")


@query("""WITH RECURSIVE e AS (SELECT vec_id, vec_id // 50 AS s, list_transform(embedding[1:5], lambda v: exp(10 * CAST(v AS DOUBLE))) AS p FROM embeddings),
o AS (SELECT vec_id, s, row_number() OVER (PARTITION BY s ORDER BY vec_id) AS i, list_transform(p, lambda v: ln(v / list_sum(p) + 1e-9)) AS g FROM e),
f AS (
  SELECT s, i, list_transform(g, lambda v: v + ln(0.2)) AS dp, [0, 0, 0, 0, 0] AS bp FROM o WHERE i = 1
  UNION ALL
  SELECT o.s, o.i, [greatest(dp[1] + ln(0.85), dp[5] + ln(0.15)) + g[1], greatest(dp[2] + ln(0.85), dp[1] + ln(0.15)) + g[2], greatest(dp[3] + ln(0.85), dp[2] + ln(0.15)) + g[3],
         greatest(dp[4] + ln(0.85), dp[3] + ln(0.15)) + g[4], greatest(dp[5] + ln(0.85), dp[4] + ln(0.15)) + g[5]],
         [CASE WHEN dp[5] + ln(0.15) > dp[1] + ln(0.85) THEN 5 ELSE 1 END, CASE WHEN dp[1] + ln(0.15) >= dp[2] + ln(0.85) THEN 1 ELSE 2 END, CASE WHEN dp[2] + ln(0.15) >= dp[3] + ln(0.85) THEN 2 ELSE 3 END,
          CASE WHEN dp[3] + ln(0.15) >= dp[4] + ln(0.85) THEN 3 ELSE 4 END, CASE WHEN dp[4] + ln(0.15) >= dp[5] + ln(0.85) THEN 4 ELSE 5 END]
  FROM f JOIN o ON o.s = f.s AND o.i = f.i + 1),
b AS (
  SELECT s, i, CAST(list_position(dp, list_max(dp)) AS INTEGER) AS st FROM f WHERE (s, i) IN (SELECT (s, max(i)) FROM o GROUP BY s)
  UNION ALL
  SELECT b.s, b.i - 1, CAST(f.bp[b.st] AS INTEGER) FROM b JOIN f ON f.s = b.s AND f.i = b.i WHERE b.i > 1)
SELECT o.vec_id, o.s, ['waiting', 'hauling', 'on_deck', 'sorting', 'netdown'][b.st] AS state FROM b JOIN o USING (s, i)""")
def viterbi(spark, d):
    return states.viterbi(_series_of_probs(spark, d), ["s"], "vec_id", "p").select("vec_id", "s", "state")


@query("""SELECT o.o_orderkey, l.l_linenumber, strftime(greatest(o_orderdate, l_shipdate - INTERVAL 5 DAY), '%Y-%m-%d') AS a, strftime(least(o_orderdate + INTERVAL 30 DAY, l_shipdate + INTERVAL 5 DAY), '%Y-%m-%d') AS b
FROM orders o JOIN lineitem l ON l_orderkey = o_orderkey WHERE o_orderdate < l_shipdate + INTERVAL 5 DAY AND o_orderdate + INTERVAL 30 DAY > l_shipdate - INTERVAL 5 DAY""")
def interval_overlap(spark, d):
    day = F.expr("INTERVAL 1 DAY")
    a = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("timestamp_ntz").alias("start")).withColumn("end", F.col("start") + 30 * day)
    s = F.col("l_shipdate").cast("timestamp_ntz")
    b = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", (s - 5 * day).alias("r_start"), (s + 5 * day).alias("r_end"))
    x = intervals.overlap_join(a, b, ["k"], 30 * 86400.0)
    return x.select(F.col("k").alias("o_orderkey"), "l_linenumber", F.date_format("clip_start", "yyyy-MM-dd").alias("a"), F.date_format("clip_end", "yyyy-MM-dd").alias("b"))


def _videos(spark, d):
    """Recordings: of 90 minutes from every click on."""
    return events(spark, d).where("event_type = 'click'").select("user_id", F.col("event_id").alias("video"), F.col("ts").alias("start"), (F.col("ts") + F.expr("INTERVAL 90 MINUTE")).alias("end"))


VIDEOS_SQL = "v AS (SELECT user_id, event_id AS video, ts AS a, ts + INTERVAL 90 MINUTE AS b FROM events WHERE event_type = 'click'), p AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'purchase')"


@query(f"""WITH {VIDEOS_SQL}, h AS (SELECT p.event_id, v.video, row_number() OVER (PARTITION BY p.event_id ORDER BY a, video) AS k FROM p JOIN v ON p.user_id = v.user_id AND ts >= a AND ts < b)
SELECT p.event_id, coalesce(h.video, -1) AS video FROM p LEFT JOIN h ON h.event_id = p.event_id AND k = 1""")
def point_in_interval(spark, d):
    p = events(spark, d).where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return intervals.covering(p, _videos(spark, d), "ts", "event_id", ["user_id"], 5400.0, tie="video").select("event_id", F.coalesce("video", F.lit(-1)).alias("video"))


@query(f"""WITH {VIDEOS_SQL}, h AS (
  SELECT p.event_id, v.video, ts >= a AND ts < b AS x, row_number() OVER (PARTITION BY p.event_id ORDER BY ts >= a AND ts < b DESC, a, video) AS k FROM p JOIN v ON p.user_id = v.user_id
  WHERE (ts >= a AND ts < b) OR abs(date_diff('microsecond', a, ts)) < 3600e6 OR abs(date_diff('microsecond', b, ts)) < 3600e6)
SELECT p.event_id, coalesce(h.video, -1) AS video, coalesce(h.x, false) AS is_exact FROM p LEFT JOIN h ON h.event_id = p.event_id AND k = 1""")
def asof_tolerance(spark, d):
    p = events(spark, d).where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return intervals.nearest_with_tolerance(p, _videos(spark, d), "ts", "event_id", 3600.0, ["user_id"], 5400.0, tie="video").select("event_id", F.coalesce("video", F.lit(-1)).alias("video"), F.coalesce("is_exact", F.lit(False)).alias("is_exact"))


@query("""WITH v AS (SELECT o_custkey, o_orderkey, o_orderdate AS a, o_orderdate + INTERVAL 60 DAY AS b FROM orders),
w AS (SELECT o_custkey, o_orderkey AS win, o_orderdate + INTERVAL 10 DAY AS ws, o_orderdate + INTERVAL 20 DAY AS we FROM orders WHERE o_orderstatus = 'F')
SELECT win, o_orderkey AS video FROM (SELECT win, o_orderkey, row_number() OVER (PARTITION BY win ORDER BY a, o_orderkey) AS k FROM w JOIN v USING (o_custkey) WHERE a <= ws AND b >= we) WHERE k = 1""")
def containment_join(spark, d):
    day = F.expr("INTERVAL 1 DAY")
    o = read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("timestamp_ntz").alias("t"))
    v = o.select("o_custkey", F.col("o_orderkey").alias("video"), F.col("t").alias("start"), (F.col("t") + 60 * day).alias("end"))
    w = o.where("o_orderstatus = 'F'").select("o_custkey", F.col("o_orderkey").alias("win"), (F.col("t") + 10 * day).alias("ws"), (F.col("t") + 20 * day).alias("we"))
    return intervals.containing(w, v, "win", ["o_custkey"], 30 * 86400.0, tie="video").select("win", "video")


@query("SELECT a.event_id, b.event_id AS mark, a.user_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.event_type = 'error' AND abs(date_diff('microsecond', a.ts, b.ts)) <= 1800e6")
def band_self_join(spark, d):
    e = events(spark, d)
    marks = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("mark"), F.col("ts").alias("mark_ts"))
    return intervals.band_join(e.select("event_id", "user_id", "ts"), marks, "ts", "mark_ts", 1800.0, ["user_id"]).select("event_id", "mark", "user_id")


@query("""WITH w AS (SELECT event_type, user_id, ts - INTERVAL 30 MINUTE AS a, ts + INTERVAL 30 MINUTE AS b FROM events),
n AS (SELECT *, CASE WHEN a > max(b) OVER (PARTITION BY user_id ORDER BY a, b, event_type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM w),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY a, b, event_type ROWS UNBOUNDED PRECEDING) AS g FROM n)
SELECT user_id, strftime(min(a), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(b), '%Y-%m-%d %H:%M:%S') AS "end", count(*) AS n,
  list_reduce(list(event_type ORDER BY a, b, event_type), lambda x, t: CASE WHEN contains(x, t) THEN x ELSE x || '+' || t END) AS tags FROM g GROUP BY user_id, g""")
def interval_merge(spark, d):
    half = F.expr("INTERVAL 30 MINUTE")
    x = events(spark, d).select("user_id", "event_type", (F.col("ts") - half).alias("start"), (F.col("ts") + half).alias("end"))
    return intervals.merge_intervals(x, ["user_id"], tag="event_type").select("user_id", text("start"), text("end"), "n", "tags")


@query("""SELECT user_id, round(avg(value) FILTER (WHERE event_type = 'click'), 6) AS click_value, round(avg(value) FILTER (WHERE event_type = 'view'), 6) AS view_value FROM events GROUP BY user_id""")
def pivot_rois(spark, d):
    return stats.pivot_rois(events(spark, d), ["user_id"], "event_type", ["click", "view"], ["value"]).select("user_id", r6("click_value", "click_value"), r6("view_value", "view_value"))


@query("""WITH a AS (SELECT user_id, avg(value) AS l FROM events WHERE event_type = 'signup' GROUP BY user_id), b AS (SELECT user_id, avg(value) AS r FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT user_id, round(coalesce(l, 0), 6) AS left_deck_value, round(coalesce(r, 0), 6) AS right_deck_value, round((coalesce(l, 0) + coalesce(r, 0)) / 2, 6) AS roi_mean_value, round(coalesce(l, 0) - coalesce(r, 0), 6) AS roi_diff_value FROM a FULL JOIN b USING (user_id)""")
def full_outer_rois(spark, d):
    e = events(spark, d)
    a, b = (e.where(F.col("event_type") == t).groupBy("user_id").agg(F.avg("value").alias("value")) for t in ("signup", "error"))
    x = stats.align_sides(a, b, ["user_id"], ["value"])
    return x.select("user_id", *[r6(c, c) for c in x.columns if c != "user_id"])


DIFF_SQL = """a AS (SELECT event_id, event_type, value, value * 2 AS twice FROM events WHERE event_type <> 'signup'), b AS (SELECT event_id, value * 1.01 + event_id % 3 AS value, value * 2 AS twice FROM events WHERE event_type <> 'error'),
j AS (SELECT event_type, a.value AS va, b.value AS vb, a.twice AS ta, b.twice AS tb FROM a JOIN b USING (event_id)),
r AS (SELECT event_type, 'value' AS feature, va AS a, vb AS b FROM j UNION ALL SELECT event_type, 'twice', ta, tb FROM j)"""


@query(f"WITH {DIFF_SQL} SELECT event_type, feature, count(*) AS n, round(avg(a), 4) AS mean_a, round(avg(b), 4) AS mean_b, round(avg(abs(a - b)) / (avg(abs(a)) + 1e-9), 6) AS mad_rel FROM r GROUP BY 1, 2 HAVING count(*) >= 2")
def feature_diff(spark, d):
    """Two implementations of features, joined on their frames."""
    e = events(spark, d)
    a = e.where("event_type <> 'signup'").select("event_id", "event_type", "value", (F.col("value") * 2).alias("twice"))
    b = e.where("event_type <> 'error'").select("event_id", (F.col("value") * 1.01 + F.col("event_id") % 3).alias("value"), (F.col("value") * 2).alias("twice"))
    return stats.feature_diff(a, b, ["event_id"], ["event_type"], ["value", "twice"]).select("event_type", "feature", "n", r6("mean_a", "mean_a", 4), r6("mean_b", "mean_b", 4), r6("mad_rel", "mad_rel"))


@query("""WITH r AS (SELECT l_returnflag, l_quantity AS a, l_quantity * (1 + l_tax) AS b, 'quantity' AS feature FROM lineitem UNION ALL SELECT l_returnflag, l_extendedprice, l_extendedprice * (1 - l_discount), 'price' FROM lineitem)
SELECT l_returnflag, feature, count(*) AS n, round(avg(a), 4) AS mean_a, round(avg(b), 4) AS mean_b, round(avg(abs(a - b)) / (avg(abs(a)) + 1e-9), 6) AS mad_rel FROM r GROUP BY 1, 2 HAVING count(*) >= 2""")
def difference_table(spark, d):
    x = read(spark, d, "lineitem")
    both = x.select("l_returnflag", F.explode(F.array(F.struct(F.lit("quantity").alias("feature"), F.col("l_quantity").alias("a"), (F.col("l_quantity") * (1 + F.col("l_tax"))).alias("b")), F.struct(F.lit("price").alias("feature"), F.col("l_extendedprice").alias("a"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("b")))).alias("r")).select("l_returnflag", "r.*")
    return stats.difference_table(both, ["l_returnflag", "feature"]).select("l_returnflag", "feature", "n", r6("mean_a", "mean_a", 4), r6("mean_b", "mean_b", 4), r6("mad_rel", "mad_rel"))


MAXIMA_SQL = f"""{ROWS_SQL}, c AS (SELECT user_id, i, value, CASE WHEN value = lag(value) OVER (PARTITION BY user_id ORDER BY i) THEN 0 ELSE 1 END AS new FROM x),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY i) AS g FROM c),
f AS (SELECT user_id, g, min(i) AS a, max(i) AS b, min(value) AS value FROM r GROUP BY user_id, g),
q AS (SELECT *, lag(value) OVER w AS p, lead(value) OVER w AS s FROM f WINDOW w AS (PARTITION BY user_id ORDER BY g)),
maxima AS (SELECT user_id, CAST((a + b) // 2 AS INTEGER) AS i, value FROM q WHERE value > p AND value > s)"""


@query(f"WITH {MAXIMA_SQL} SELECT user_id, i, value FROM maxima")
def local_peaks(spark, d):
    return peaks.local_maxima(events(spark, d), ["user_id"], ORDER, "value")


@query(f"""WITH {MAXIMA_SQL},
s AS (SELECT m.user_id, m.i, m.value, max(CASE WHEN x.i < m.i AND x.value > m.value THEN x.i END) AS l, min(CASE WHEN x.i > m.i AND x.value > m.value THEN x.i END) AS r FROM maxima m JOIN x ON x.user_id = m.user_id GROUP BY 1, 2, 3),
v AS (SELECT s.user_id, s.i, s.value, min(CASE WHEN x.i <= s.i THEN x.value END) AS lo, min(CASE WHEN x.i >= s.i THEN x.value END) AS hi FROM s JOIN x ON x.user_id = s.user_id AND x.i > coalesce(l, -1) AND x.i < coalesce(r, 1000000000) GROUP BY 1, 2, 3)
SELECT user_id, i, round(value - greatest(lo, hi), 6) AS prominence FROM v""")
def peak_prominence(spark, d):
    x = events(spark, d).withColumn("o", F.row_number().over(peaks.Window.partitionBy("user_id").orderBy(*ORDER)))
    return peaks.peaks(x, ["user_id"], "o", "value").select("user_id", "i", r6("prominence", "prominence"))


def peak_ctes(src: str, key: str, tag: str, distance: str = "1", value: str = "value") -> str:
    """SQL of the peaks (key, i, v, prominence) of `src` (key, i, value), in <tag>p: flat tops in the middle, then distance from the highest down, then prominence. Needs WITH RECURSIVE."""
    return f"""
{tag}c AS (SELECT {key}, i, {value} AS v, {distance} AS dist, CASE WHEN {value} = lag({value}) OVER (PARTITION BY {key} ORDER BY i) THEN 0 ELSE 1 END AS new FROM {src}),
{tag}r AS (SELECT *, sum(new) OVER (PARTITION BY {key} ORDER BY i) AS g FROM {tag}c),
{tag}f AS (SELECT {key}, g, min(i) AS a, max(i) AS b, min(v) AS v, any_value(dist) AS dist FROM {tag}r GROUP BY {key}, g),
{tag}q AS (SELECT *, lag(v) OVER (PARTITION BY {key} ORDER BY g) AS p, lead(v) OVER (PARTITION BY {key} ORDER BY g) AS s FROM {tag}f),
{tag}m AS (SELECT {key}, CAST((a + b) // 2 AS BIGINT) AS i, v, dist FROM {tag}q WHERE v > p AND v > s),
{tag}d AS (
  SELECT {key}, any_value(dist) AS dist, list({{'i': i, 'v': v}} ORDER BY v DESC, i DESC) AS todo, list({{'i': i, 'v': v}})[1:0] AS kept FROM {tag}m GROUP BY {key}
  UNION ALL
  SELECT {key}, dist, list_filter(todo[2:], lambda x: abs(x.i - todo[1].i) >= dist), list_append(kept, todo[1]) FROM {tag}d WHERE len(todo) > 0),
{tag}k AS (SELECT {key}, e.i AS i, e.v AS v FROM (SELECT {key}, unnest(kept) AS e FROM {tag}d WHERE len(todo) = 0)),
{tag}s AS (SELECT k.{key}, k.i, k.v, max(CASE WHEN x.i < k.i AND x.v > k.v THEN x.i END) AS l, min(CASE WHEN x.i > k.i AND x.v > k.v THEN x.i END) AS r FROM {tag}k k JOIN {tag}c x ON x.{key} = k.{key} GROUP BY 1, 2, 3),
{tag}p AS (
  SELECT s.{key}, s.i, s.v, s.v - greatest(min(CASE WHEN x.i <= s.i THEN x.v END), min(CASE WHEN x.i >= s.i THEN x.v END)) AS prominence
  FROM {tag}s s JOIN {tag}c x ON x.{key} = s.{key} AND x.i > coalesce(s.l, -1) AND x.i < coalesce(s.r, 1000000000) GROUP BY 1, 2, 3)"""


@query(f"""WITH RECURSIVE {ROWS_SQL}, {peak_ctes("x", "user_id", "v", "5", "-value")}, q AS (SELECT user_id, quantile_cont(value, 0.4) AS q FROM x GROUP BY 1)
SELECT user_id, CAST(i AS INTEGER) AS i, -v AS x FROM vp JOIN q USING (user_id) WHERE prominence >= 1.0 AND -v < q""")
def valleys(spark, d):
    x = events(spark, d).withColumn("o", F.row_number().over(peaks.Window.partitionBy("user_id").orderBy(*ORDER)))
    return peaks.valleys(x, ["user_id"], "o", "value", 5, 1.0, 40.0)


def wide_ctes(tag: str, key: str, least: float) -> str:
    """SQL of the peaks of <tag>p whose width at half prominence is `least` or more, in <tag>w."""
    return f"""
{tag}h AS (
  SELECT p.{key}, p.i, p.v, p.prominence, p.v - p.prominence / 2 AS level, max(x.i) AS last, max(CASE WHEN x.i < p.i AND x.v <= p.v - p.prominence / 2 THEN x.i END) AS l, min(CASE WHEN x.i > p.i AND x.v <= p.v - p.prominence / 2 THEN x.i END) AS r
  FROM {tag}p p JOIN {tag}c x ON x.{key} = p.{key} GROUP BY 1, 2, 3, 4, 5),
{tag}w AS (
  SELECT h.{key}, h.i, h.v, h.prominence FROM {tag}h h
  LEFT JOIN {tag}c a ON a.{key} = h.{key} AND a.i = h.l LEFT JOIN {tag}c b ON b.{key} = h.{key} AND b.i = h.l + 1
  LEFT JOIN {tag}c y ON y.{key} = h.{key} AND y.i = h.r LEFT JOIN {tag}c z ON z.{key} = h.{key} AND z.i = h.r - 1
  WHERE coalesce(h.r - (level - y.v) / (z.v - y.v), last) - coalesce(h.l + (level - a.v) / (b.v - a.v), 0) >= {least})"""


@query(f"WITH RECURSIVE {ROWS_SQL}, {peak_ctes('x', 'user_id', 'p')}, {wide_ctes('p', 'user_id', 2.5)} SELECT user_id, CAST(i AS INTEGER) AS i, v AS x, round(prominence, 6) AS prominence FROM pw")
def wide_peaks(spark, d):
    """Peaks by their width at half prominence."""
    x = events(spark, d).withColumn("o", F.row_number().over(peaks.Window.partitionBy("user_id").orderBy(*ORDER)))
    return peaks.peaks(x, ["user_id"], "o", "value", width=2.5).select("user_id", "i", "x", r6("prominence", "prominence"))


@query(f"""WITH RECURSIVE {ROWS_SQL}, {peak_ctes('x', 'user_id', 'p')}, cut AS (SELECT user_id, i AS start_i, lead(i) OVER (PARTITION BY user_id ORDER BY i) AS end_i FROM x WHERE event_type = 'signup'),
b AS (SELECT c.user_id, start_i, end_i, max(prominence) AS top, arg_max(p.i, (prominence, -p.i)) AS spot FROM cut c LEFT JOIN pp p ON p.user_id = c.user_id AND p.i BETWEEN start_i AND end_i WHERE end_i IS NOT NULL GROUP BY 1, 2, 3)
SELECT user_id, CAST(start_i AS INTEGER) AS start_i, CAST(end_i AS INTEGER) AS end_i, CAST(coalesce(spot, (start_i + end_i) // 2) AS INTEGER) AS peak_i, round(coalesce(top, 0), 6) AS peak_prom FROM b""")
def strongest_peaks(spark, d):
    """The most prominent peak between neighbouring signups of a user."""
    w = peaks.Window.partitionBy("user_id")
    x = events(spark, d).withColumn("i", F.row_number().over(w.orderBy(*ORDER)) - 1)
    spans = x.where("event_type = 'signup'").select("user_id", F.col("i").alias("start_i"), F.lead("i").over(w.orderBy("i")).alias("end_i")).where("end_i IS NOT NULL")
    return peaks.strongest_peaks(spans, peaks.peaks(x, ["user_id"], "i", "value"), ["user_id"]).withColumn("peak_prom", F.round("peak_prom", 6))


def smooth_ctes(source: str, key: str, out: str, window: int, degree: int, value: str = "value", digits: int | None = None) -> str:
    """SQL of a smoothed series: <out> (key, i, v) from `source` (key, i, value), i from 0; series shorter than the window stay as they are."""
    weights = ", ".join(f"({i}, {j}, {float(w)!r})" for i, row in enumerate(exact_weights(window, degree)) for j, w in enumerate(row))
    fit = f"round(sum(w.c * y.{value}), {digits})" if digits else f"sum(w.c * y.{value})"
    same = f"round({value}, {digits})" if digits else value
    return f"""
{out}_w(r, j, c) AS (VALUES {weights}),
{out}_a AS (SELECT *, greatest(least(i - {window // 2}, n - {window}), 0) AS first_ FROM (SELECT {key}, i, {value}, count(*) OVER (PARTITION BY {key}) AS n FROM {source})),
{out} AS (
  SELECT a.{key}, a.i, {fit} AS v FROM {out}_a a JOIN {out}_w w ON w.r = a.i - a.first_ JOIN {out}_a y ON y.{key} = a.{key} AND y.i = a.first_ + w.j WHERE a.n >= {window} GROUP BY 1, 2
  UNION ALL SELECT {key}, i, {same} FROM {out}_a WHERE n < {window})"""


SMOOTH_SQL = f"""{GRID_SQL}, x AS (SELECT night, minute, value, i - 1 AS i FROM filled), {smooth_ctes("x", "night", "s", 11, 2)}"""


@query(f"""WITH {SMOOTH_SQL}
SELECT night, count(*) AS n, round(sum(v), 3) AS total, round(quantile_cont(v, 0.4), 6) AS p40 FROM s GROUP BY 1""")
def night_series(spark, d):
    s = series.savgol(series.minute_series(night_events(spark, d), ["night"], "ts", "value"), ["night"], ["minute"], "value", 11, 2)
    return s.groupBy("night").agg(F.count("*").alias("n"), r6(F.sum("smooth"), "total", 3), r6(F.percentile("smooth", F.lit(0.4)), "p40"))


SMOOTHED_SQL = f"{SMOOTH_SQL}, y AS (SELECT s.night, x.minute, s.i, round(s.v, 9) AS value, lead(round(s.v, 9)) OVER (PARTITION BY s.night ORDER BY s.i) AS nv FROM s JOIN x ON x.night = s.night AND x.i = s.i), q AS (SELECT night, quantile_cont(value, 0.4) AS q FROM y GROUP BY 1)"
#: Segments between neighbouring cuts (night, i) with the sums of their rows.
SEGMENTS_SQL = """spans AS (SELECT *, row_number() OVER (PARTITION BY night ORDER BY start_i) AS segment FROM (SELECT night, i AS start_i, lead(i) OVER (PARTITION BY night ORDER BY i) AS end_i FROM cut) WHERE end_i IS NOT NULL),
seg AS (
  SELECT g.night, segment, start_i, end_i, min(minute) AS a, max(minute) AS b, arg_max(minute, (value, -y.i)) AS top_at, max(value) AS peak, avg(value) AS mean, min(value) AS low, sum(CASE WHEN y.i < end_i THEN (value + nv) / 2 END) AS auc, count(*) AS n
  FROM spans g JOIN y ON y.night = g.night AND y.i BETWEEN start_i AND end_i GROUP BY 1, 2, 3, 4)"""
SEGMENT_COLUMNS = """strftime(a, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(top_at, '%Y-%m-%d %H:%M:%S') AS peak_time, strftime(b, '%Y-%m-%d %H:%M:%S') AS end_time, round_even(date_diff('second', a, b) / 60, 1) AS duration_min,
round(peak, 6) AS peak, round(mean, 6) AS mean, round(low, 6) AS low, round(auc, 5) AS auc, n"""


def _segment_columns():
    return [text("start_time"), text("peak_time"), text("end_time"), "duration_min", r6("peak", "peak"), r6("mean", "mean"), r6("low", "low"), r6("auc", "auc", 5), "n"]


@query(f"""WITH RECURSIVE {SMOOTHED_SQL}, {peak_ctes("y", "night", "v", "30", "-value")}, {peak_ctes("y", "night", "p")}, {wide_ctes("p", "night", 5)},
cut AS (SELECT night, i FROM vp JOIN q USING (night) WHERE prominence >= 1.5 AND -v < q), {SEGMENTS_SQL},
best AS (SELECT g.night, g.start_i, max(prominence) AS top, arg_max(w.i, (prominence, -w.i)) AS spot FROM seg g JOIN pw w ON w.night = g.night AND w.i BETWEEN g.start_i AND g.end_i GROUP BY 1, 2)
SELECT night, CAST(segment AS INTEGER) AS segment, CAST(start_i AS INTEGER) AS start_i, CAST(end_i AS INTEGER) AS end_i, CAST(coalesce(spot, (start_i + end_i) // 2) AS INTEGER) AS peak_i, round(coalesce(top, 0), 6) AS peak_prom, {SEGMENT_COLUMNS}
FROM seg LEFT JOIN best USING (night, start_i)""")
def cycles(spark, d):
    """Cycles between valleys that keep a distance of 30 minutes and a prominence of 1.5 below the 40th percentile, with the strongest wide peak of each."""
    minute = series.minute_series(night_events(spark, d), ["night"], "ts", "value")
    x = night.detect_cycles(minute, ["night"], "minute", "value").withColumn("duration_min", temporal.minutes(temporal.seconds(F.col("start_time"), F.col("end_time"))))
    return x.select("night", "segment", "start_i", "end_i", "peak_i", r6("peak_prom", "peak_prom"), *_segment_columns())


@query(f"""WITH RECURSIVE {SMOOTHED_SQL}, {peak_ctes("y", "night", "v", "1", "-value")}, cut AS (SELECT night, i FROM vm JOIN q USING (night) WHERE -v < q), {SEGMENTS_SQL} SELECT night, CAST(segment AS INTEGER) AS segment, {SEGMENT_COLUMNS} FROM seg""")
def simple_cycles(spark, d):
    """Cycles between all strict valleys below the 40th percentile, by window functions alone."""
    return night.simple_cycles(events(spark, d), "ts", "value").select("night", "segment", *_segment_columns())


@query(f"""WITH {ROWS_SQL}, cut AS (SELECT user_id, i, lead(i) OVER (PARTITION BY user_id ORDER BY i) AS e FROM x WHERE event_type = 'signup'),
nx AS (SELECT *, lead(value) OVER (PARTITION BY user_id ORDER BY i) AS nv FROM x)
SELECT c.user_id, CAST(c.i AS INTEGER) AS start_i, CAST(c.e AS INTEGER) AS end_i, round(max(value), 6) AS peak, CAST(arg_max(nx.i, (value, -nx.i)) AS INTEGER) AS peak_i, round(avg(value), 6) AS mean,
       round(sum(CASE WHEN nx.i < c.e THEN (value + nv) / 2 END), 5) AS auc, count(*) AS n
FROM cut c JOIN nx ON nx.user_id = c.user_id AND nx.i BETWEEN c.i AND c.e WHERE c.e IS NOT NULL GROUP BY 1, 2, 3""")
def segments(spark, d):
    e = events(spark, d)
    cuts = e.withColumn("i", F.row_number().over(peaks.Window.partitionBy("user_id").orderBy(*ORDER)) - 1).where("event_type = 'signup'").select("user_id", "i")
    return peaks.segments(e, cuts, ["user_id"], ORDER, "value").select("user_id", "start_i", "end_i", r6("peak", "peak"), "peak_i", r6("mean", "mean"), r6("auc", "auc", 5), "n")


@query(f"""WITH {ROWS_SQL}, t AS (SELECT user_id, i AS peak_i, value AS top FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, i) AS k FROM x) WHERE k = 1),
q AS (SELECT user_id, quantile_cont(value, 0.3) AS q, max(i) AS last FROM x GROUP BY user_id),
h AS (SELECT x.user_id, peak_i, last, x.i, x.value, q + 0.7 * (top - q) AS threshold FROM x JOIN t USING (user_id) JOIN q USING (user_id))
SELECT user_id, CAST(peak_i AS INTEGER) AS peak_i, round(threshold, 6) AS threshold, CAST(coalesce(max(CASE WHEN value < threshold AND i < peak_i THEN i END), greatest(0, peak_i - 15)) AS INTEGER) AS rise_i,
       CAST(coalesce(min(CASE WHEN value < threshold AND i >= peak_i THEN i END), least(any_value(last), peak_i + 25)) AS INTEGER) AS fall_i FROM h GROUP BY user_id, peak_i, threshold""")
def rise_fall(spark, d):
    w = peaks.Window.partitionBy("user_id")
    x = events(spark, d).withColumn("i", F.row_number().over(w.orderBy(*ORDER)) - 1)
    x = x.withColumn("peak_i", -F.max(F.struct("value", -F.col("i"))).over(w)["col2"])
    return peaks.rise_and_fall(x, ["user_id"], "i", "value", "peak_i", 0.3, 0.7).select("user_id", "peak_i", r6("threshold", "threshold"), "rise_i", "fall_i")


LEFT, RIGHT = (f"CASE WHEN event_type {x} IN ('click', 'view') THEN value END" for x in ("", "NOT"))
CORE_SQL = f"""{grid_ctes("events", LEFT, "l")}, {grid_ctes("events", RIGHT, "r")},
rows_ AS (
  SELECT night || '#' || k AS ck, night, k AS cycle_id, minute, l.value AS a, r.value AS b
  FROM lfilled l JOIN rfilled r USING (night, minute), range(6) t(k)
  WHERE l.value IS NOT NULL AND r.value IS NOT NULL AND minute BETWEEN strptime(night || ' 18:00:00', '%Y-%m-%d %H:%M:%S') + k * INTERVAL 2 HOUR AND strptime(night || ' 18:00:00', '%Y-%m-%d %H:%M:%S') + (k + 1) * INTERVAL 2 HOUR),
numbered AS (SELECT *, row_number() OVER (PARTITION BY ck ORDER BY minute) - 1 AS i, count(*) OVER (PARTITION BY ck) AS n FROM rows_),
ok AS (SELECT * FROM numbered WHERE n >= 10),
{smooth_ctes("ok", "ck", "sl", 7, 2, "a", 9)}, {smooth_ctes("ok", "ck", "sr", 7, 2, "b", 9)},
f AS (SELECT ok.*, sl.v AS sa, sr.v AS sb FROM ok JOIN sl USING (ck, i) JOIN sr USING (ck, i)),
q AS (SELECT ck, quantile_cont(a, 0.3) AS qa, quantile_cont(b, 0.4) AS qb FROM ok GROUP BY 1),
head AS (SELECT ck, i, sa AS value FROM f WHERE i < greatest(1, floor(n * CAST(0.7 AS DOUBLE)))),
{peak_ctes("head", "ck", "h", "10")},
tops AS (
  SELECT ck, coalesce(p.i, m.i) AS top FROM (SELECT ck, arg_max(i, (value, -i)) AS i FROM head GROUP BY 1) m
  LEFT JOIN (SELECT ck, arg_max(i, (v, -i)) AS i FROM hp WHERE prominence >= 0.008 GROUP BY 1) p USING (ck)),
deck AS (
  SELECT t.ck, t.top, coalesce(max(CASE WHEN f.i < t.top AND f.sa < qa + 0.7 * (z.sa - qa) THEN f.i END), greatest(0, t.top - 15)) AS start_
  FROM tops t JOIN q USING (ck) JOIN f z ON z.ck = t.ck AND z.i = t.top JOIN f ON f.ck = t.ck GROUP BY 1, 2),
tail_ AS (SELECT f.ck, f.i - top AS i, f.sb AS value, count(*) OVER (PARTITION BY f.ck) AS n FROM f JOIN tops USING (ck) WHERE f.i >= top),
{peak_ctes("tail_", "ck", "u", "15")},
best AS (SELECT ck, arg_max(i, (prominence, -i)) AS spot FROM up WHERE prominence >= 0.008 GROUP BY 1),
lim AS (SELECT b.ck, spot, x.n, qb + 0.3 * (x.value - qb) AS lim FROM best b JOIN q USING (ck) JOIN tail_ x ON x.ck = b.ck AND x.i = b.spot),
around AS (
  SELECT l.ck, coalesce(max(CASE WHEN x.i <= spot AND x.value < lim THEN x.i END), greatest(0, spot - 20)) AS a, coalesce(min(CASE WHEN x.i >= spot AND x.value < lim THEN x.i END), least(l.n - 1, spot + 25)) AS b
  FROM lim l JOIN tail_ x ON x.ck = l.ck GROUP BY l.ck, spot, l.n),
high AS (SELECT ck, quantile_cont(value, 0.7) AS q FROM tail_ GROUP BY 1),
flat AS (SELECT ck, min(i) AS a, max(i) AS b FROM tail_ JOIN high USING (ck) WHERE value >= q AND ck NOT IN (SELECT ck FROM best) GROUP BY 1),
move AS (SELECT ck, top, start_, top + a AS begin_, top + b AS end_ FROM deck JOIN (SELECT * FROM around UNION ALL SELECT * FROM flat) USING (ck)),
core AS (
  SELECT m.ck, any_value(night) AS night, any_value(cycle_id) AS cycle_id, max(CASE WHEN i = start_ THEN minute END) AS t0, max(CASE WHEN i = top THEN minute END) AS t1, max(CASE WHEN i = begin_ THEN minute END) AS t2, max(CASE WHEN i = end_ THEN minute END) AS t3,
         min(minute) AS t_first, max(minute) AS t_last, max(CASE WHEN i = top THEN sa END) AS left_top, max(CASE WHEN i BETWEEN begin_ AND end_ THEN sb END) AS right_top,
         CASE WHEN top > 0 THEN avg(CASE WHEN i BETWEEN top AND end_ THEN b END) / (avg(CASE WHEN i < top THEN b END) + 1e-6) END AS gain
  FROM move m JOIN f USING (ck) GROUP BY m.ck, top),
span AS (
  SELECT *, round_even(date_diff('second', t0, t1) / 60, 1) AS rising, round_even(date_diff('second', t2, t3) / 60, 1) AS transfer, round_even(date_diff('second', t1, t3) / 60, 1) AS window_, round_even(date_diff('second', t_first, t_last) / 60, 1) AS total, round_even(gain, 2) AS inc FROM core),
told AS (
  SELECT *, list_filter([CASE WHEN window_ < 15 THEN 'core window too short' END, CASE WHEN window_ > 30 THEN 'core window too long' END, CASE WHEN inc < 1.05 THEN 'weak right-deck signal' END, CASE WHEN total > 60 THEN 'abnormally long cycle' END], lambda x: x IS NOT NULL) AS issues FROM span)"""


def _core(spark, d):
    """Both decks from event types, per night; cycles of two hours from 18:00 on."""
    e = events(spark, d).withColumn("night", temporal.night_label(F.col("ts"))).where("night <> 'daytime'")
    m = series.resample_mean(e.withColumns({"l": F.when(F.col("event_type").isin("click", "view"), F.col("value")), "r": F.when(~F.col("event_type").isin("click", "view"), F.col("value"))}), ["night"], "ts", ["l", "r"])
    m = series.dense_grid(m, ["night"])
    for c in ("l", "r"):
        m = series.fill_edges(series.interpolate(m, ["night"], ["minute"], c), ["night"], ["minute"], c)
    start = F.to_timestamp_ntz(F.concat("night", F.lit(" 18:00:00")))
    c = m.select("night").distinct().withColumn("cycle_id", F.explode(F.sequence(F.lit(0), F.lit(5))))
    c = c.withColumn("start", start + F.make_dt_interval(F.lit(0), 2 * F.col("cycle_id"))).withColumn("end", F.col("start") + F.expr("INTERVAL 2 HOUR"))
    return night.review(night.core_windows(m.where("l IS NOT NULL AND r IS NOT NULL"), c, "minute", "l", "r", ["night"]))


@query(f"""WITH RECURSIVE {CORE_SQL}
SELECT night, CAST(cycle_id AS INTEGER) AS cycle_id, strftime(t0, '%Y-%m-%d %H:%M:%S') AS net_start_time, strftime(t1, '%Y-%m-%d %H:%M:%S') AS net_on_deck_time, strftime(t2, '%Y-%m-%d %H:%M:%S') AS fish_start_time, strftime(t3, '%Y-%m-%d %H:%M:%S') AS fish_end_time,
       rising AS duration_net_rising_min, transfer AS duration_fish_transfer_min, window_ AS duration_core_window_min, total AS duration_total_cycle_min, round(left_top, 5) AS left_edge_peak, round(right_top, 5) AS right_edge_peak, inc AS right_edge_increase_vs_pre,
       array_to_string(issues, '; ') AS issues, CASE len(issues) WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM told""")
def core_windows(spark, d):
    x = _core(spark, d)
    times = ("net_start_time", "net_on_deck_time", "fish_start_time", "fish_end_time")
    return x.withColumns({"issues": F.array_join("issues", "; "), **{c: F.date_format(c, TIME) for c in times}})


@query(f"""WITH RECURSIVE {CORE_SQL},
p AS (
  SELECT night, cycle_id, 0 AS g, 'net_landing' AS "group", t1 + CAST(unnest([-5, 10, 25]) AS INTEGER) * INTERVAL 1 SECOND AS t FROM core
  UNION ALL SELECT night, cycle_id, 1, 'net_settled', t1 + CAST(date_diff('second', t1, t2) / 2 * 1000 + unnest([-4, 4]) * 1000 AS BIGINT) * INTERVAL 1 MILLISECOND FROM core WHERE t2 > t1
  UNION ALL SELECT night, cycle_id, 2, 'fish_transfer', t2 + CAST(30000 + unnest(range(5)) * 1000 * greatest((date_diff('second', t2, t3) - 60) / 4, 1) AS BIGINT) * INTERVAL 1 MILLISECOND FROM core WHERE date_diff('second', t2, t3) > 60)
SELECT night, CAST(cycle_id AS INTEGER) AS cycle_id, "group", CAST(row_number() OVER (PARTITION BY night, cycle_id ORDER BY g, t) - 1 AS INTEGER) AS k, strftime(t, '%Y-%m-%d %H:%M:%S.%g') AS wall_time FROM p""")
def keyframe_plan(spark, d):
    """When pictures of each core window are taken."""
    return night.sample_plan(_core(spark, d), ["night", "cycle_id"]).withColumn("wall_time", F.date_format("wall_time", TIME + ".SSS"))


@query(f"""WITH RECURSIVE inst AS (SELECT ts, avg(value) AS motion, avg(value) * 2 + min(event_id % 7) AS bstd, min((event_id % 11) / 10) AS entropy FROM events GROUP BY ts),
nt AS (SELECT *, {NIGHT} AS night, row_number() OVER (ORDER BY ts) AS o FROM inst WHERE hour(ts) >= 18 OR hour(ts) < 6),
steps AS (SELECT *, coalesce(abs(entropy - lag(entropy) OVER (ORDER BY ts)), 0) AS across, coalesce(abs(entropy - lag(entropy) OVER (PARTITION BY night ORDER BY ts)), 0) AS de, row_number() OVER (PARTITION BY night ORDER BY ts) - 1 AS i FROM nt),
refs AS (SELECT quantile_cont(motion, 0.9) AS m, quantile_cont(bstd, 0.9) AS b, quantile_cont(across, 0.9) AS e FROM steps),
fai AS (SELECT night, i, 0.5 * motion / greatest(m, 1e-6) + 0.25 * bstd / greatest(b, 1e-6) + 0.25 * de / greatest(e, 1e-6) AS value FROM steps, refs),
{smooth_ctes("fai", "night", "fs", 7, 3)},
act AS (SELECT night, avg(o) AS active_fraction, count(*) FILTER (WHERE o = 1 AND was = 0) AS n_runs FROM (SELECT night, CAST(v > 0.55 AS INTEGER) AS o, coalesce(lag(CAST(v > 0.55 AS INTEGER)) OVER (PARTITION BY night ORDER BY i), 0) AS was FROM fs) GROUP BY 1),
wn AS (SELECT night, i, v, least(20, greatest(count(*) OVER (PARTITION BY night) // 4, 3)) AS w FROM fs),
sd AS (SELECT a.night, a.i, stddev_samp(b.v) AS s FROM wn a JOIN wn b ON b.night = a.night AND b.i BETWEEN a.i - a.w // 2 AND a.i - a.w // 2 + a.w - 1 GROUP BY 1, 2),
spread AS (SELECT night, quantile_cont(s, 0.9) AS std_p90 FROM sd WHERE s IS NOT NULL GROUP BY 1),
{grid_ctes("inst", "motion")}, x AS (SELECT night, value, i - 1 AS i FROM filled), {smooth_ctes("x", "night", "s", 11, 2, digits=9)},
y AS (SELECT night, i, v AS value, count(*) OVER (PARTITION BY night) AS n, v - avg(v) OVER (PARTITION BY night) AS c FROM s),
lines AS (SELECT night, k, n, sqrt(pow(sum(c * cos(2 * pi() * ((k * i) % n) / n)), 2) + pow(sum(c * sin(2 * pi() * ((k * i) % n) / n)), 2)) AS amp FROM (SELECT *, unnest(range(CAST(ceil(n / 120) AS BIGINT), n // 30 + 1)) AS k FROM y WHERE n >= 30) WHERE k >= 1 GROUP BY 1, 2, 3),
per AS (SELECT night, any_value(n) / arg_max(k, (amp, -k)) AS period, max(amp) / greatest(avg(amp), 1e-9) AS snr FROM lines GROUP BY 1),
depth AS (SELECT night, quantile_cont(value, 0.4) AS q, count(*) AS n FROM y GROUP BY 1),
{peak_ctes("y", "night", "v", "15", "-value")},
firsts AS (SELECT night, count(*) AS k FROM vp JOIN depth USING (night) WHERE n >= 30 AND prominence >= 0.8 AND -v < q GROUP BY 1),
rule AS (
  SELECT night, n, period, coalesce(snr, 0) AS snr, CASE WHEN n < 30 THEN NULL WHEN period IS NULL OR snr < 3 THEN CASE WHEN coalesce(k, 0) >= 2 THEN 30 END ELSE greatest(30, least(CAST(floor(period * CAST(0.4 AS DOUBLE)) AS BIGINT), 45)) END AS distance
  FROM depth LEFT JOIN per USING (night) LEFT JOIN firsts USING (night)),
y2 AS (SELECT y.night, i, value, distance FROM y JOIN rule USING (night) WHERE distance IS NOT NULL AND rule.n >= 2 * distance),
{peak_ctes("y2", "night", "z", "distance", "-value")},
found AS (SELECT night, count(*) AS k, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS valleys FROM zp JOIN depth USING (night) WHERE prominence >= 1.5 AND -v < q GROUP BY 1 HAVING count(*) >= 2),
gap AS (SELECT night, ts, date_diff('microsecond', lag(ts) OVER (PARTITION BY night ORDER BY ts), ts) / 60e6 AS gap FROM nt),
done AS (SELECT night, count(*) AS n_samples, date_diff('microsecond', min(ts), max(ts)) / 3600e6 AS h, coalesce(max(gap), 0) AS g FROM gap GROUP BY 1),
whole AS (SELECT *, round_even(h, 1) AS hours, h >= 4 AND n_samples >= 30 AND g <= 180 AND h / 12 >= 0.33 AS ok FROM done WHERE n_samples >= 10),
res AS (SELECT w.*, a.active_fraction AS af, a.n_runs AS runs, coalesce(std_p90, 0) AS sp, greatest(0, coalesce(f.k, 0) - 1) AS nets, r.period, r.snr, coalesce(f.valleys, '') AS valleys FROM whole w JOIN act a USING (night) JOIN spread USING (night) JOIN rule r USING (night) LEFT JOIN found f USING (night))
SELECT night, ok AS is_complete, ok AND ((nets >= 3 AND af >= 0.18) OR (nets >= 2 AND snr >= 5)) AS is_operating, CAST(CASE WHEN ok THEN nets ELSE 0 END AS INTEGER) AS net_count, CAST(CASE WHEN ok THEN runs ELSE 0 END AS BIGINT) AS n_runs,
       round_even(CASE WHEN ok THEN af ELSE 0 END, 3) AS active_fraction, round_even(CASE WHEN ok THEN 0.5 * least(least(runs / greatest(hours, 0.5) / 1.5, 1), 1) + 0.3 * least(af / 0.15, 1) + 0.2 * least(sp / 0.15, 1) ELSE 0 END, 4) AS activity_score,
       round_even(CASE WHEN ok THEN period END, 1) AS fft_period_min, round_even(CASE WHEN ok THEN snr ELSE 0 END, 1) AS fft_snr, hours AS duration_hours, n_samples, round_even(g, 0) AS max_gap_minutes, round_even(h / 12, 2) AS coverage_ratio,
       array_to_string(list_filter([CASE WHEN h < 4 THEN printf('duration=%.1fh < 4.0h minimum', h) END, CASE WHEN n_samples < 30 THEN printf('samples=%d < 30 minimum', n_samples) END, CASE WHEN g > 180 THEN printf('large gap=%.0fmin > 180min threshold', g) END,
         CASE WHEN h / 12 < 0.33 THEN printf('coverage=%.1f%% < 33%% minimum', h / 12 * 100) END], lambda x: x IS NOT NULL), '; ') AS warnings, valleys FROM res""")
def night_summary(spark, d):
    x = events(spark, d).groupBy("ts").agg(F.avg("value").alias("motion_intensity"), (F.avg("value") * 2 + F.min(F.col("event_id") % 7)).alias("brightness_std"), F.min((F.col("event_id") % 11) / 10.0).alias("entropy"))
    out = night.night_summary(x, "ts")
    return out.withColumns({"warnings": F.array_join("warnings", "; "), "valleys": F.array_join(F.col("valleys").cast("array<string>"), ",")})


@query(f"""WITH n AS (SELECT {NIGHT} AS night, ts FROM events), m AS (SELECT *, date_diff('microsecond', lag(ts) OVER (PARTITION BY night ORDER BY ts), ts) / 60e6 AS gap FROM n WHERE night <> 'daytime'),
a AS (SELECT night, count(*) AS n_samples, date_diff('microsecond', min(ts), max(ts)) / 3600e6 AS h, coalesce(max(gap), 0) AS g FROM m GROUP BY night)
SELECT night, n_samples, round_even(h, 1) AS duration_hours, round_even(h / 12, 2) AS coverage_ratio, round_even(g, 0) AS max_gap_minutes, h >= 4 AND n_samples >= 30 AND g <= 180 AND h / 12 >= 0.33 AS is_complete,
array_to_string(list_filter([CASE WHEN h < 4 THEN printf('duration=%.1fh < 4.0h minimum', h) END, CASE WHEN n_samples < 30 THEN printf('samples=%d < 30 minimum', n_samples) END, CASE WHEN g > 180 THEN printf('large gap=%.0fmin > 180min threshold', g) END,
  CASE WHEN h / 12 < 0.33 THEN printf('coverage=%.1f%% < 33%% minimum', h / 12 * 100) END], lambda x: x IS NOT NULL), '; ') AS warnings FROM a""")
def completeness(spark, d):
    return stats.completeness(night_events(spark, d), ["night"], "ts").withColumn("warnings", F.array_join("warnings", "; "))


def _truth(spark, d):
    """True and predicted classes: quality, and the hash of the id."""
    return read(spark, d, "labels").select(F.col("quality").cast("int").alias("t"), ((F.col("doc_id") * 7 + 3) % 3 % 2).cast("int").alias("p"))


TRUTH_SQL = "x AS (SELECT quality AS t, CAST((doc_id * 7 + 3) % 3 % 2 AS INTEGER) AS p FROM labels)"


@query(f"WITH {TRUTH_SQL}, l(label) AS (VALUES (0), (1), (2)) SELECT label, count(*) FILTER (WHERE t = label AND p = 0) AS pred_0, count(*) FILTER (WHERE t = label AND p = 1) AS pred_1, count(*) FILTER (WHERE t = label AND p = 2) AS pred_2 FROM l, x GROUP BY label")
def confusion_matrix(spark, d):
    return stats.confusion(_truth(spark, d), "t", "p", [0, 1, 2])


@query(f"""WITH {TRUTH_SQL}, l(label) AS (VALUES (0), (1), (2)), c AS (SELECT label, count(*) FILTER (WHERE t = label AND p = label) AS tp, count(*) FILTER (WHERE p = label) AS np, count(*) FILTER (WHERE t = label) AS nt FROM l, x GROUP BY label)
SELECT label, round(coalesce(tp / nullif(np, 0), 0), 6) AS precision, round(coalesce(tp / nullif(nt, 0), 0), 6) AS recall, round(coalesce(2.0 * tp / nullif(np + nt, 0), 0), 6) AS f1, nt AS support FROM c""")
def prf1(spark, d):
    x = stats.precision_recall(_truth(spark, d), "t", "p", [0, 1, 2])
    return x.select("label", *[r6(c, c) for c in ("precision", "recall", "f1")], "support")


@query("""WITH n AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), r AS (SELECT *, sum(n) OVER () AS t, max(n) OVER () / min(n) OVER () AS q FROM n)
SELECT event_type, n, round_even(100 * n / t, 1) AS share, round_even(q, 2) AS ratio, CASE WHEN q < 1.5 THEN 'balanced' WHEN q < 3 THEN 'slightly imbalanced' WHEN q < 10 THEN 'imbalanced' ELSE 'severely imbalanced' END AS verdict FROM r""")
def class_balance(spark, d):
    return stats.class_balance(events(spark, d), "event_type")


@query("""WITH s AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) AS rank FROM s) SELECT p_brand, p_size, n, rank FROM r WHERE rank <= 3""")
def topk_sizes(spark, d):
    x = read(spark, d, "part").groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    return stats.top_k(x, ["p_brand"], "n", 3, ["p_size"]).withColumn("rank", F.col("rank").cast("long"))


@query("SELECT user_id, event_id, ts_s, value FROM (SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_s, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) AS k FROM events) WHERE k = 1")
def first_max(spark, d):
    return stats.first_max(events(spark, d), ["user_id"], "value", ORDER).select("user_id", "event_id", F.date_format("ts", TIME).alias("ts_s"), "value")


SPLIT_SQL = "r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('s' || CAST(doc_id AS VARCHAR)), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents)"


@query(f"WITH {SPLIT_SQL} SELECT doc_id, lang, CASE WHEN k <= round_even(n * 0.2, 0) THEN 'val' ELSE 'train' END AS split FROM r")
def stratified_split(spark, d):
    return stats.stratified_split(read(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 0.2, "s")


@query(f"""WITH {SPLIT_SQL}, s AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CASE WHEN k <= round_even(n * 0.2, 0) THEN 'val' ELSE 'train' END AS split FROM r)
SELECT CASE WHEN k > 0 THEN doc_id || '_os' || k ELSE doc_id END AS doc_id, lang, split, CAST(k AS INTEGER) AS replica FROM (SELECT *, unnest(range(CASE WHEN lang = 'de' AND split = 'train' THEN 5 ELSE 1 END)) AS k FROM s)""")
def oversample(spark, d):
    x = stats.stratified_split(read(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 0.2, "s")
    return stats.oversample(x, (F.col("lang") == "de") & (F.col("split") == "train"), 5, "doc_id")


@query("SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY md5('123' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 20)")
def random_sample(spark, d):
    return stats.random_sample(read(spark, d, "documents").select("doc_id"), "doc_id", 20, "123")


@query("""WITH c AS (SELECT o_orderkey, o_totalprice / 10000 AS core, o_totalprice / 200000 AS inc, o_custkey % 90 AS cyc FROM orders),
i AS (SELECT o_orderkey, CAST(core < 15 AS INTEGER) + CAST(core > 30 AS INTEGER) + CAST(inc < 1.05 AS INTEGER) + CAST(cyc > 60 AS INTEGER) AS n FROM c)
SELECT o_orderkey, CAST(n AS INTEGER) AS n_issues, CASE n WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM i""")
def confidence_flags(spark, d):
    x = read(spark, d, "orders")
    issues = scalars.window_issues(F.col("o_totalprice") / 10000, F.col("o_totalprice") / 200000, F.col("o_custkey") % 90)
    return x.select("o_orderkey", F.size(issues).alias("n_issues"), scalars.confidence(issues).alias("confidence"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS date, count(*) AS files, round_even(sum(o_totalprice * 1000) / 1e9, 1) AS size_gb, round(sum(o_custkey), 2) AS minutes, strftime(min(o_orderdate), '%Y-%m-%d') AS first_start, strftime(max(o_orderdate), '%Y-%m-%d') AS last_end,
round_even(sum(o_custkey) / 60 / 60, 2) AS est_hours FROM orders GROUP BY 1""")
def manifest_rollup(spark, d):
    x = read(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("date"), (F.col("o_totalprice") * 1000).alias("size"), "o_orderdate", F.col("o_custkey").cast("double").alias("minutes"))
    out = stats.manifest_rollup(x, "date", "size", "o_orderdate", "o_orderdate", "minutes")
    return out.select("date", "files", "size_gb", r6("minutes", "minutes", 2), F.date_format("first_start", "yyyy-MM-dd").alias("first_start"), F.date_format("last_end", "yyyy-MM-dd").alias("last_end"), "est_hours")


@query("""SELECT 'l_quantity' AS name, CAST(count(l_quantity) AS DOUBLE) AS count, round_even(avg(l_quantity), 3) AS mean, round_even(stddev_samp(l_quantity), 3) AS std, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem
UNION ALL SELECT 'l_discount', CAST(count(l_discount) AS DOUBLE), round_even(avg(l_discount), 3), round_even(stddev_samp(l_discount), 3), min(l_discount), max(l_discount) FROM lineitem""")
def stats_table(spark, d):
    return stats.stats_table(read(spark, d, "lineitem"), ["l_quantity", "l_discount"])


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS cycles, round_even(avg(o_totalprice), 1) AS mean_min, round_even(coalesce(stddev_samp(o_totalprice), 0), 1) AS std_min, min(o_totalprice) AS min_min, max(o_totalprice) AS max_min,
string_agg(strftime(o_orderdate, '%m%d'), ' | ' ORDER BY strftime(o_orderdate, '%m%d')) AS times, round(avg(o_custkey), 4) AS peak_mean FROM orders GROUP BY 1, 2""")
def cycle_rollup(spark, d):
    x = read(spark, d, "orders").withColumn("at", F.date_format("o_orderdate", "MMdd"))
    return stats.cycle_rollup(x, ["o_orderstatus", "o_orderpriority"], "o_totalprice", "at", "o_custkey").withColumn("peak_mean", F.round("peak_mean", 4))


@query("""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(hex(encode(text)), '..')) AS b FROM documents), n AS (SELECT doc_id, b, count(*) AS n FROM c GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY doc_id) AS t FROM n),
e AS (SELECT doc_id, round(-sum(n / t * log2(n / t)), 6) + 0.0 AS entropy FROM t GROUP BY doc_id) SELECT doc_id, coalesce(entropy, 0.0) AS entropy FROM documents LEFT JOIN e USING (doc_id)""")
def text_entropy(spark, d):
    return read(spark, d, "documents").select("doc_id", (F.round(scalars.byte_entropy("text"), 6) + 0.0).alias("entropy"))


@query("""WITH s AS (SELECT o_orderkey, o_custkey % 37 + 0.0 AS dur FROM orders), k AS (SELECT o_orderkey, dur, unnest(range(0, CAST(floor(dur / 5) AS BIGINT) + 1)) * 5.0 AS t FROM s)
SELECT o_orderkey, CAST(t AS DOUBLE) AS t FROM k UNION ALL SELECT o_orderkey, CAST(dur AS DOUBLE) FROM s WHERE dur - floor(dur / 5) * 5 > 2.5""")
def sample_plan(spark, d):
    x = read(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 37).cast("double").alias("dur"))
    return x.select("o_orderkey", F.explode(temporal.fixed_steps(F.col("dur"), 5)).alias("t"))


@query("SELECT o_orderkey, CAST(f AS INTEGER) AS first, CAST(least(300, n - f) AS INTEGER) AS \"count\" FROM (SELECT o_orderkey, o_custkey AS n, unnest(range(0, o_custkey, 300)) AS f FROM orders)")
def chunk_plan(spark, d):
    return temporal.exploded_chunks(read(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey").select("o_orderkey", "first", "count")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, d):
    return events(spark, d).select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_existing(spark, d):
    return stats.missing(read(spark, d, "documents").select("doc_id", "lang"), read(spark, d, "labels"), ["doc_id"])


@query("SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_all(spark, d):
    a = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    return stats.union_all([a, read(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))])


@query("""WITH m AS (SELECT l_orderkey, l_linenumber, l_quantity * 20 AS area, l_partkey % 640 AS x, 5 + l_suppkey % 60 AS w, 30 + l_quantity * 6 AS h FROM lineitem),
g AS (SELECT *, (h / 360) * (h / greatest(w, 1)) * greatest(0, 1 - w / 640) * (area / greatest(w * h, 1)) AS score FROM m
  WHERE h / greatest(w, 1) >= 1.5 AND h / 360 >= 0.25 AND (x + w / 2) / 640 BETWEEN 0.4 AND 0.9 AND area / greatest(w * h, 1) >= 0.3)
SELECT l_orderkey, l_linenumber, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_linenumber) AS k FROM g) WHERE k = 1""")
def geometry_best(spark, d):
    # Some keys repeat in the table; of equal scores and lines either row gives the same result.
    m = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 20).alias("area"), (F.col("l_partkey") % 640).alias("x"), (5 + F.col("l_suppkey") % 60).alias("w"), (30 + F.col("l_quantity") * 6).alias("h"))
    a, x, w, h, rw, rh = (F.col(c).cast("double") if isinstance(c, str) else F.lit(float(c)) for c in ("area", "x", "w", "h", 640, 360))
    g = m.where(scalars.mask_ok(a, x, w, h, rw, rh)).withColumn("score", scalars.mask_score(a, w, h, rw, rh))
    return stats.first_max(g, ["l_orderkey"], "score", ["l_linenumber"]).select("l_orderkey", "l_linenumber", r6("score", "score"))


@query("""WITH x AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 0.0 ELSE o_totalprice / 500000 END AS conf, o_totalprice AS area FROM orders)
SELECT o_custkey, count(*) AS frames, count(*) FILTER (WHERE conf > 0) AS detections, round(avg(CAST(conf > 0 AS INTEGER)), 6) AS rate, round(coalesce(avg(conf) FILTER (WHERE conf > 0), 0), 6) AS avg_conf, round(coalesce(max(conf) FILTER (WHERE conf > 0), 0), 6) AS max_conf,
round(coalesce(avg(area) FILTER (WHERE conf > 0), 0), 5) AS avg_area, round(coalesce(max(area) FILTER (WHERE conf > 0), 0), 3) AS max_area FROM x GROUP BY 1""")
def detection_metrics(spark, d):
    x = read(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "O", 0.0).otherwise(F.col("o_totalprice") / 500000).alias("conf"), F.col("o_totalprice").alias("area"))
    out = stats.detection_metrics(x, ["o_custkey"], "conf", "area")
    return out.select("o_custkey", "frames", "detections", r6("rate", "rate"), r6("avg_conf", "avg_conf"), r6("max_conf", "max_conf"), r6("avg_area", "avg_area", 5), r6("max_area", "max_area", 3))


@query(f"WITH {ROWS_SQL}, n AS (SELECT *, lead(value) OVER (PARTITION BY user_id ORDER BY i) AS nv FROM x) SELECT user_id, round(coalesce(sum((value + nv) / 2), 0), 5) AS auc FROM n GROUP BY user_id")
def trapezoid_auc(spark, d):
    return stats.trapezoid(events(spark, d), ["user_id"], ORDER, "value").select("user_id", r6("auc", "auc", 5))


SPECTRUM_SQL = f"""{ROWS_SQL}, c AS (SELECT user_id, i, n, value - avg(value) OVER (PARTITION BY user_id) AS v FROM x),
k AS (SELECT *, unnest(range(1, n // 2 + 1)) AS k FROM c),
s AS (SELECT user_id, k, n / k AS period, sum(v * cos(2 * pi() * ((k * i) % n) / n)) AS re, sum(v * sin(2 * pi() * ((k * i) % n) / n)) AS im FROM k GROUP BY user_id, k, n),
a AS (SELECT user_id, k, period, sqrt(re * re + im * im) AS amplitude FROM s)"""


@query(f"WITH {SPECTRUM_SQL} SELECT user_id, round(arg_max(period, (amplitude, -k)), 4) AS period, round(max(amplitude), 4) AS peak, round(avg(amplitude), 4) AS mean, round(max(amplitude) / greatest(avg(amplitude), 1e-9), 4) AS snr FROM a WHERE period BETWEEN 3 AND 30 GROUP BY user_id")
def fft_period(spark, d):
    x = spectral.best_period(spectral.spectrum(events(spark, d), ["user_id"], ORDER, "value"), ["user_id"], 3.0, 30.0)
    return x.select("user_id", *[r6(c, c, 4) for c in ("period", "peak", "mean", "snr")])


@query(f"WITH {SPECTRUM_SQL} SELECT user_id, k, round(period, 4) AS period, round(amplitude, 4) AS amplitude FROM a")
def fft_spectrum(spark, d):
    return spectral.spectrum(events(spark, d), ["user_id"], ORDER, "value").select("user_id", F.col("k").cast("long").alias("k"), r6("period", "period", 4), r6("amplitude", "amplitude", 4))


@query(f"WITH {ROWS_SQL}, p AS (SELECT a.user_id, CAST(b.i - a.i AS INTEGER) AS lag, a.value AS x, b.value AS y FROM x a JOIN x b ON a.user_id = b.user_id AND b.i - a.i BETWEEN 1 AND least(600, a.n - 2) WHERE a.n > 2) SELECT user_id, lag, round(CASE WHEN stddev_pop(x) * stddev_pop(y) < 1e-9 THEN 0 ELSE corr(x, y) END, 6) AS r FROM p GROUP BY 1, 2")
def autocorr(spark, d):
    return spectral.autocorrelation(events(spark, d), ["user_id"], ORDER, "value").select("user_id", "lag", r6("r", "r"))


@query(f"WITH {ISLANDS_SQL} SELECT user_id, strftime(a - INTERVAL 30 SECOND, '%Y-%m-%d %H:%M:%S') AS start, strftime(b + INTERVAL 30 SECOND, '%Y-%m-%d %H:%M:%S') AS \"end\", n FROM runs WHERE event_type = 'view'")
def state_run_windows(spark, d):
    return states.state_windows(events(spark, d), ["user_id"], ORDER, "event_type", "ts", "view", 30).select("user_id", text("start"), text("end"), "n")


@query(f"WITH {ROWS_SQL}, t AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY i) AS p FROM x) SELECT user_id, strftime(ts - INTERVAL 30 SECOND, '%Y-%m-%d %H:%M:%S') AS start, strftime(ts + INTERVAL 30 SECOND, '%Y-%m-%d %H:%M:%S') AS \"end\" FROM t WHERE (p = 'click' AND event_type = 'purchase') OR (p = 'purchase' AND event_type = 'click')")
def transition_windows(spark, d):
    return states.transition_windows(events(spark, d), ["user_id"], ORDER, "event_type", "ts", ("click", "purchase")).select("user_id", text("start"), text("end"))


ABNORMAL_SQL = """s AS (SELECT user_id, event_id, ts, CASE event_type WHEN 'click' THEN 'waiting' WHEN 'error' THEN 'hauling' WHEN 'purchase' THEN 'on_deck' WHEN 'signup' THEN 'sorting' ELSE 'netdown' END AS st FROM events),
t AS (SELECT *, lag(st) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM s),
m AS (SELECT user_id, ts AS mt, CASE WHEN p IN ('on_deck', 'sorting') AND st IN ('on_deck', 'sorting') THEN 'os' WHEN p IN ('hauling', 'waiting') AND st IN ('hauling', 'waiting') THEN 'hw'
  WHEN (p, st) NOT IN (('waiting', 'hauling'), ('hauling', 'on_deck'), ('on_deck', 'sorting'), ('sorting', 'waiting'), ('sorting', 'netdown'), ('netdown', 'waiting')) THEN 'ill' END AS tag FROM t WHERE p <> st)"""


@query(f"WITH {ABNORMAL_SQL} SELECT s.event_id, arg_min(tag, (mt, tag)) AS tag FROM s JOIN m ON s.user_id = m.user_id AND abs(date_diff('microsecond', s.ts, mt)) <= 1800e6 WHERE tag IS NOT NULL GROUP BY 1")
def abnormal_marks(spark, d):
    names = {"click": "waiting", "error": "hauling", "purchase": "on_deck", "signup": "sorting", "view": "netdown"}
    st = F.element_at(F.create_map(*[F.lit(v) for kv in names.items() for v in kv]), F.col("event_type"))
    x = events(spark, d).select("user_id", "event_id", "ts", st.alias("st"))
    return states.abnormal_marks(x, ["user_id"], ORDER, "st", "ts", 1800.0).select("event_id", "tag")


@query("""WITH RECURSIVE o AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t, value % 10 / 10 AS c, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
f AS (
  SELECT user_id, event_id, i, 'NORMAL' AS mode, CASE WHEN c < 0.3 THEN 'BURST' ELSE 'NORMAL' END AS next_mode, CASE WHEN c < 0.3 THEN t ELSE 0 END AS since FROM o WHERE i = 1
  UNION ALL
  SELECT o.user_id, o.event_id, o.i, next_mode, CASE WHEN next_mode = 'NORMAL' AND c < 0.3 THEN 'BURST' WHEN next_mode = 'BURST' AND t - since > 7200 THEN 'NORMAL' ELSE next_mode END, CASE WHEN next_mode = 'NORMAL' AND c < 0.3 THEN t ELSE since END
  FROM f JOIN o ON o.user_id = f.user_id AND o.i = f.i + 1)
SELECT user_id, event_id, mode, next_mode FROM f""")
def adaptive_sampling(spark, d):
    x = events(spark, d).select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("sec"), (F.col("value") % 10 / 10).alias("corr"))
    return states.adaptive_sampling(x, ["user_id"], "event_id", "sec", "corr", 0.3, 7200.0)


@query("""WITH s AS (SELECT user_id, ts, event_id, CASE WHEN date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) < 7200e6 THEN 0 ELSE 1 END AS new FROM events),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM s) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM g GROUP BY user_id, g""")
def session_windows(spark, d):
    x = events(spark, d).withColumn("t", F.col("ts").cast("timestamp")).groupBy("user_id", F.session_window("t", "2 hours")).agg(F.count("*").alias("n"))
    return x.select("user_id", F.date_format("session_window.start", TIME).alias("start"), "n")


@query("""WITH r AS (SELECT l_suppkey, CAST(l_linenumber AS BIGINT) AS workers, avg(l_extendedprice) AS sec, sum(l_quantity) * 100 AS media FROM lineitem GROUP BY 1, 2),
q AS (SELECT *, media / sec AS rt FROM r), f AS (SELECT *, first_value(rt) OVER w AS r0, first_value(workers) OVER w AS w0 FROM q WINDOW w AS (PARTITION BY l_suppkey ORDER BY workers))
SELECT l_suppkey, workers, round(rt, 6) AS realtime, round(rt / r0, 6) AS speedup, round(rt / r0 / (workers / w0), 6) AS efficiency FROM f""")
def scaling_table(spark, d):
    x = read(spark, d, "lineitem").groupBy("l_suppkey", F.col("l_linenumber").cast("long").alias("workers")).agg(F.avg("l_extendedprice").alias("sec"), (F.sum("l_quantity") * 100).alias("media"))
    out = stats.scaling(x, "workers", "sec", "media", ["l_suppkey"])
    return out.select("l_suppkey", "workers", *[r6(c, c) for c in ("realtime", "speedup", "efficiency")])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity * l_extendedprice, 4) AS area, round((l_quantity + l_quantity + l_discount * 100) / 2 / 2560, 10) AS rel_cx FROM lineitem""")
def box_geometry(spark, d):
    q = F.col("l_quantity")
    g = scalars.box_geometry(q, F.lit(0.0), q + F.col("l_discount") * 100, q, F.lit(2560), F.lit(1440))
    x = read(spark, d, "lineitem")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", F.round(q * F.col("l_extendedprice"), 4).alias("area"), F.round(g["rel_cx"], 10).alias("rel_cx"))
