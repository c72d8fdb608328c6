"""SimHash near-duplicates: fingerprints that differ in few bits, found by vantage-point trees."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices, utf8
from .near_dedup import _components, _tops, _unite

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Fingerprints that are compared at a time, one side and the other: an array of 1 MB.
BLOCK, OTHERS = 256, 4096
#: A node of a local tree with so few targets is a leaf.
LEAF = 256
#: From so many targets on, a leaf that no vantage point splits is searched by flipping bits: its cost no longer follows the square.
DENSE = 200_000


def fingerprint(text: bytes | None, n: int = 3, seed: int = 42) -> int:
    """Bit i is 1 if it is set in over half the XXH64 hashes of the n-word shingles, repeats included; a text of fewer words is one shingle, without words the fingerprint is 0."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    m = min(n, len(words))
    count = len(words) - m + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[:count].tolist(), ends[m - 1 :].tolist())), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for lo in range(0, count, 1 << 14):
        ones += np.unpackbits(hashes[lo : lo + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(np.uint64)[0])


def fingerprints(docs: DataFrame, n: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed long."""

    def run(batches):
        for batch in slices(batches, 1):
            prints = np.array([fingerprint(t, n, seed) for t in utf8(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def _split(points: np.ndarray, others: np.ndarray, reach: int) -> tuple[np.uint64, int] | None:
    """A vantage point of `points` and a radius that leave a fifth of the points at least on either side and fewest of `others` within `reach` of the boundary; None if there is none."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, 12).astype(np.int64)]:
        inside = np.cumsum(np.bincount(np.bitwise_count(points ^ v), minlength=65))
        near = np.cumsum(np.bincount(np.bitwise_count(others ^ v), minlength=65))
        for mu in np.flatnonzero((inside >= len(points) // 5) & (inside <= len(points) - len(points) // 5)).tolist():
            both = int(near[min(64, mu + reach)] - (near[mu - reach] if mu >= reach else 0))
            cost = both + abs(2 * int(inside[mu]) - len(points)) * len(others) // (4 * len(points))
            if best is None or cost < best[0]:
                best = cost, v, mu
    return best and best[1:]


class Tree:
    """A vantage-point tree over a sample: leaves are shards. A node is (vantage point, radius, inner, outer), a leaf its number."""

    def __init__(self, sample: np.ndarray, leaves: int, reach: int):
        self.reach, self.leaves = reach, 0
        self.top = self._grow(np.sort(sample), max(64, len(sample) // max(1, leaves)))

    def _grow(self, points: np.ndarray, least: int):
        if len(points) <= least or not (cut := _split(points, points, self.reach)):
            self.leaves += 1
            return self.leaves - 1
        v, mu = cut
        inner = np.bitwise_count(points ^ v) <= mu
        return v, mu, self._grow(points[inner], least), self._grow(points[~inner], least)

    def deal(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, home): each fingerprint in its home, and as a visitor in every shard that may hold one within `reach` of it.

        By the triangle inequality, what is within `reach` of x has a distance to the vantage point within `reach` of x's
        own; only a boundary in between keeps both sides open.
        """
        out = []

        def walk(node, at: np.ndarray, home: np.ndarray) -> None:
            if isinstance(node, int):
                out.append((at, np.full(len(at), node), home))
            elif len(at):
                v, mu, inner, outer = node
                d = np.bitwise_count(prints[at] ^ v).astype(np.int64)
                for side, goes, own in ((inner, d <= mu + self.reach, d <= mu), (outer, d > mu - self.reach, d > mu)):
                    walk(side, at[goes], (home & own)[goes])

        walk(self.top, np.arange(len(prints)), np.ones(len(prints), bool))
        return tuple(np.concatenate(x) for x in zip(*out))


def _flips(reach: int) -> np.ndarray:
    """All masks of 1 to `reach` bits."""
    one = [np.uint64(1) << np.uint64(i) for i in range(64)]
    return np.array([np.bitwise_or.reduce(c) for k in range(1, reach + 1) for c in combinations(one, k)], np.uint64)


def forest(prints: np.ndarray, home: np.ndarray, reach: int, dense: int = DENSE) -> np.ndarray:
    """For each of these distinct fingerprints the index of the root of its component under links between a home one and any other within `reach` bits.

    The targets (home ones) are split by vantage points; searchers go wherever a target within reach may be. A leaf
    compares blocks; one of `dense` targets that no vantage point splits looks up each searcher with up to `reach` bits
    flipped instead. Links are united as they are found and never held.
    """
    root = np.arange(len(prints))

    def leaf(t: np.ndarray, q: np.ndarray) -> None:
        for lo in range(0, len(t), BLOCK):
            a = t[lo : lo + BLOCK]
            for ro in range(0, len(q), OTHERS):
                b = q[ro : ro + OTHERS]
                x, y = np.nonzero(np.bitwise_count(prints[a][:, None] ^ prints[b][None, :]) <= reach)
                _unite(root, a[x], b[y])

    def flipped(t: np.ndarray, q: np.ndarray) -> None:
        t = t[np.argsort(prints[t])]
        held = prints[t]
        for mask in _flips(reach):
            asked = prints[q] ^ mask
            at = np.minimum(np.searchsorted(held, asked), len(t) - 1)
            hit = held[at] == asked
            _unite(root, t[at[hit]], q[hit])

    def search(t: np.ndarray, q: np.ndarray) -> None:
        if not len(t) or len(q) < 2:
            return
        cut = _split(prints[t], prints[q], reach) if len(t) > LEAF else None
        if cut:
            v, mu = cut
            dt, dq = (np.bitwise_count(prints[x] ^ v).astype(np.int64) for x in (t, q))
            inner, outer = dq <= mu + reach, dq > mu - reach
            if inner.sum() + outer.sum() < 1.9 * len(q):  # else the boundary holds nearly all
                search(t[dt <= mu], q[inner])
                search(t[dt > mu], q[outer])
                return
        (flipped if len(t) >= dense else leaf)(t, q)

    search(np.flatnonzero(home), np.arange(len(prints)))
    return _tops(root)


def near_fingerprints(docs: DataFrame, reach: int = 2, n: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", per_shard: int = 8192, sample: int = 1 << 16) -> DataFrame:
    """One row per input row: id, fp, component_id, the least id that links of fingerprints within `reach` bits reach.

    1. A scan makes the fingerprints. Equal ones are one from here on, with their least id.
    2. A vantage-point tree over about `sample` distinct fingerprints (all, if fewer; chosen by hash; the only ones the
       driver sees) deals all of them into shards of about `per_shard`, and those near a boundary into the shards beyond it too.
    3. A task finds all links of a shard in a tree of its own and returns a spanning forest, a row per fingerprint at most.
    4. Components of the forests of all shards are the result.

    Every pair within `reach` is found. Null, empty and blank texts have the fingerprint 0, which links as any other.
    Null ids count last: a component of null ids alone has a null component_id. Repeated rows are returned each; other
    columns are not read; an empty table gives none.
    """
    prints = materialize(fingerprints(docs, n, seed, id_col, text_col))
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")))
    total = distinct.count()
    every = max(1, round(total / sample))
    seen = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).select("fp").limit(2 * sample).toArrow()["fp"].to_numpy().view(np.uint64)
    tree = Tree(seen, -(-total // per_shard), reach)

    def deal(batches):
        for batch in batches:
            row, shard, home = tree.deal(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), batch.column(0).take(pa.array(row)), pa.array(home)], names=["shard", "fp", "home"])

    def link(table):
        fp = table["fp"].to_numpy().view(np.uint64)
        root = forest(fp, table["home"].to_numpy(zero_copy_only=False), reach)
        hung = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(fp[hung].view(np.int64)), "b": pa.array(fp[root[hung]].view(np.int64))})

    dealt = distinct.select("fp").mapInArrow(deal, "shard int, fp long, home boolean")
    edges = materialize(dealt.groupBy("shard").applyInArrow(link, "a long, b long"))
    final = distinct.join(_components(edges).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = final.groupBy("root").agg(F.min("least").alias("component_id"))
    # Written, so that the join with the rows is between two plain shuffles, whose hot fingerprints AQE may split.
    final = materialize(final.join(least, "root").select("fp", "component_id"))
    return prints.join(final, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
