"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import materialize

#: The multipliers and shifts of the splitmix64 finaliser.
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


class Feistel:
    """A permutation of 0..n-1: a balanced Feistel network over the next even number of bits, walked until it is below n."""

    def __init__(self, n: int, seed: int = 0, rounds: int = 6):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        with np.errstate(over="ignore"):
            self.keys = _mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % 2**64))

    def _once(self, x: np.ndarray, keys) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & self.mask)
        return (right << self.half) | left  # halves swapped: the same walk with the keys reversed undoes it

    def _walk(self, x, keys) -> np.ndarray:
        x = np.asarray(x, dtype=np.uint64).copy()
        todo = np.arange(len(x))
        with np.errstate(over="ignore"):
            while len(todo):
                x[todo] = self._once(x[todo], keys)
                todo = todo[x[todo] >= np.uint64(self.n)]
        return x.astype(np.int64)

    def forward(self, x) -> np.ndarray:
        return self._walk(x, self.keys)

    def inverse(self, y) -> np.ndarray:
        return self._walk(y, self.keys[::-1])


def number_rows(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `row_number`, 0..n-1 in the total order of `order`, without gathering rows: a range shuffle, then offsets from one count per partition."""
    placed = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__at", 33)).withColumn("__in", F.col("__at").bitwiseAND(F.lit(2**33 - 1)))
    counts = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    # One row per partition of the range shuffle: its size is the number of partitions, not of rows.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return placed.join(F.broadcast(offsets), "__part").withColumn("row_number", F.col("__offset") + F.col("__in")).drop("__at", "__part", "__in", "__offset", "__n")


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, row_number, position, shard, slot.

    Rows are numbered in the order of (id, hash and size of the text); a Feistel permutation turns that number into
    a position, `shard = position mod shards` and `slot = position div shards`. Counts of shards therefore differ by
    one at most whatever the groups of equal texts, whose rows are scattered like all others; slots are gapless, and anyone can compute the place of a row number, or the row number of a place,
    from (n, seed) alone. A null text has size 16 and checksum 0; null ids sort first; identical rows take
    neighbouring numbers in any order, which no result can tell. Other columns are not read; an empty table gives none.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(F.col(text_col), "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("__h"),
    )
    numbered = number_rows(rows, ["id", "__h", "size", "text_crc32"])
    n = numbered.count()

    @pandas_udf("long")
    def position(x: pd.Series) -> pd.Series:
        return pd.Series(Feistel(n, seed).forward(x.to_numpy()))

    return numbered.withColumn("position", position("row_number")).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "row_number",
        "position",
        (F.col("position") % shards).cast("int").alias("shard"),
        F.expr(f"position div {shards}").alias("slot"),
    )
