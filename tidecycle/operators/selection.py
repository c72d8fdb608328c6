"""Selection by rank without gathering a class or a table: counts by range first, ranks only inside the range that holds the boundary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Relative rank error of the sketch that brackets a quantile is 1 / SKETCH; exact ranks are counted inside 8 / SKETCH of the rows, or among all of a group of fewer than 2 * SKETCH.
SKETCH = 10_000
#: Leading hex digits of a digest that rows are counted by: 65,536 ranges a class at most.
DIGITS = 4


def _join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which null equals null; the left side's stay. Without keys `b` is one row at most."""
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return a.join(b.withColumnsRenamed(names) if keys else F.broadcast(b), reduce(Column.__and__, on, F.lit(True)), how).drop(*names.values())


def exact_quantiles(df: DataFrame, columns: list[str], shares: tuple[float, ...], keys: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """(keys, <column>_p<percent>): exact quantiles with linear interpolation of each group; null where it has no value.

    1. A mergeable sketch of each group and column brackets every quantile: two values of the column between which it lies.
    2. One aggregate counts the rows below a bracket and, in it, those of each distinct value.
    3. Running counts inside the bracket, a thousandth of the rows at most, tell the two order statistics. A bracket
       that missed them (the sketch's bound excludes it) would raise an error, not give another value.
    """
    keys = list(keys)
    values = F.array(*[F.struct(F.lit(c).alias("__name"), F.col(c).cast("double").alias("__v")) for c in dict.fromkeys(columns)])
    long = df.select(*keys, F.explode(values).alias("__x")).select(*keys, "__x.*")
    at = [*keys, "__name"]
    slack, few = 4 / SKETCH, F.col("__n") < 2 * SKETCH
    ends = [min(max(q + d, 0.0), 1.0) for q in shares for d in (-slack, slack)]
    held = long.groupBy(*at).agg(F.count("__v").alias("__n"), F.percentile_approx("__v", F.array(*map(F.lit, ends)), F.lit(SKETCH)).alias("__s"))
    bracket = [
        F.struct(F.lit(i).alias("q"), F.when(~few & F.lit(q > slack), F.col("__s")[2 * i]).alias("lo"), F.when(~few & F.lit(q < 1 - slack), F.col("__s")[2 * i + 1]).alias("hi"), ((F.col("__n") - 1) * F.lit(float(q))).alias("pos"))
        for i, q in enumerate(shares)
    ]
    held = held.select(*at, F.array(*bracket).alias("__asked"))
    rows = _join(long.where("__v IS NOT NULL"), held, at)
    places = F.filter("__asked", lambda a: a["hi"].isNull() | (F.col("__v") <= a["hi"]))
    spots = F.transform(places, lambda a: F.struct(a["q"].alias("q"), a["pos"].alias("pos"), F.when(a["lo"].isNull() | (F.col("__v") >= a["lo"]), F.col("__v")).alias("v")))
    counted = rows.select(*at, F.explode(spots).alias("__p")).groupBy(*at, "__p").agg(F.count("*").alias("__c")).select(*at, "__p.*", "__c")
    upto = F.sum("__c").over(Window.partitionBy(*at, "q").orderBy(F.col("v").asc_nulls_first()))
    found = counted.withColumn("__upto", upto).where("v IS NOT NULL OR __upto > floor(pos)").groupBy(*at, "q", "pos").agg(
        F.count_if(F.col("v").isNull()).alias("missed"),
        F.min(F.when(F.col("__upto") > F.floor("pos"), F.col("v"))).alias("a"),
        F.min(F.when(F.col("__upto") > F.ceil("pos"), F.col("v"))).alias("b"),
    )
    between = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((F.ceil("pos") - F.col("pos")) * F.col("a") + (F.col("pos") - F.floor("pos")) * F.col("b"))
    value = F.when((F.col("missed") > 0) | F.col("a").isNull() | F.col("b").isNull(), F.raise_error(F.lit("the bracket of a quantile missed it"))).otherwise(between)
    found = found.select(*at, "q", value.alias("value"))
    wide = [F.max(F.when((F.col("__name") == c) & (F.col("q") == i), F.col("value"))).alias(f"{c}_p{round(100 * q)}") for c in columns for i, q in enumerate(shares)]
    return _join(held.select(*at), found, at, "left").groupBy(*keys).agg(*wide)


def least_rows(df: DataFrame, keys: list[str], k: Column, digest: Column, tie: str, to: str = "chosen") -> DataFrame:
    """`df` with a boolean column `to`: whether the row is one of the `k` of least (digest, tie) of its class; `k` is an expression over the number of its rows, `__n`. `digest` is lower-case hex.

    Rows of each (class, range of digests) are counted; ranges under the class's boundary are in, those over it out, and
    only the rows of the one range that the boundary cuts are ranked: one in 65,536. The others are not shuffled.
    """
    x = df.withColumns({"__h": digest}).withColumn("__r", F.substring("__h", 1, DIGITS))
    w = Window.partitionBy(*keys)
    counts = x.groupBy(*keys, "__r").agg(F.count("*").alias("__c"))
    counts = counts.withColumns({"__n": F.sum("__c").over(w), "__upto": F.sum("__c").over(w.orderBy("__r"))}).withColumn("__k", k.cast("long"))
    cut = counts.where("__k > 0 AND __upto - __c < __k AND (__upto >= __k OR __upto = __n)").select(*keys, F.col("__r").alias("__cut"), (F.col("__k") - F.col("__upto") + F.col("__c")).alias("__left"))
    joined = _join(x, cut, keys, "left")
    sure = joined.where("__cut IS NULL OR __r <> __cut").withColumn(to, F.coalesce(F.col("__r") < F.col("__cut"), F.lit(False)))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("__h", tie))
    close = joined.where("__r = __cut").withColumn(to, rank <= F.col("__left"))
    return sure.unionByName(close).select(*df.columns, to)
