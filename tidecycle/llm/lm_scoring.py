"""Stupid-backoff scores from n-gram counts of the whole corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import BASE, materialize, mix, utf8, word_hashes, words

def _grams(texts: list[bytes | None], order: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Of a block: the document of each word and, for each order up to `order`, the hash of the n-gram that ends at each word and whether its document has one there."""
    flat: list[bytes] = []
    sizes = []
    for t in texts:
        ws = words(t)
        sizes.append(len(ws))
        flat += ws
    h = word_hashes(flat)
    doc = np.repeat(np.arange(len(texts)), sizes)
    grams, inside, out = h, np.ones(len(h), bool), []
    for k in range(1, order + 1):
        if k > 1:
            inside = np.zeros(len(h), bool)
            inside[k - 1 :] = doc[k - 1 :] == doc[: len(doc) - k + 1]
            with np.errstate(over="ignore"):
                grams = mix(np.concatenate([h[:1], grams[:-1] * BASE + h[1:]]))
        out.append((grams, inside))
    return doc, out


def _pack(keys: np.ndarray) -> bytes:
    """Ascending keys by byte planes: the upper bytes, which hardly change, then compress well in the shuffle."""
    return keys.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _bucket(sorted_grams: np.ndarray, buckets: int) -> np.ndarray:
    """Range partition of the hash space: ascending, so a bucket is a slice."""
    return ((sorted_grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _request(buckets: int, order: int):
    """The count table of a block: its distinct n-grams with their counts, one row per order and hash partition."""

    def run(table: pa.Table) -> pa.Table:
        _, grams = _grams(utf8(table.column("text")), order)
        block, rows = table.column("block")[0].as_py(), []
        for n, (codes, inside) in enumerate(grams, 1):
            keys, counts = np.unique(codes[inside], return_counts=True)
            which = _bucket(keys, buckets)
            cut = np.flatnonzero(np.diff(which)) + 1
            for k, c, b in zip(np.split(keys, cut), np.split(counts.astype(np.uint32), cut), np.split(which, cut)):
                if len(b):
                    rows.append((block, n, int(b[0]), _pack(k), c.tobytes()))
        cols = list(zip(*rows)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["block", "n", "bucket", "grams", "counts"])

    return run


def _total(table: pa.Table) -> pa.Table:
    """Joins the requests of a hash partition and order with its count table: for each the totals of its n-grams, in its order."""
    grams = [_unpack(x) for x in table.column("grams").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()])
    _, at = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.bincount(at, weights=counts)[at].astype(np.uint32)
    parts = np.split(totals, np.cumsum([len(g) for g in grams])[:-1])
    return pa.table([table.column("block"), table.column("n"), table.column("bucket"), pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "n", "bucket", "totals"])


def _own(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How often the document of each place holds its n-gram."""
    if not len(at):
        return np.zeros(0, np.int64)
    _, back, counts = np.unique(doc.astype(np.int64) * (int(at.max()) + 1) + at, return_inverse=True, return_counts=True)
    return counts[back]


def _score(backoff: float, exclude_own: bool, order: int, id_type: pa.DataType):
    penalty = float(np.log10(backoff))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        doc, grams = _grams(utf8(left.column("text")), order)
        rows = left.num_rows
        replies = sorted(zip(right.column("n").to_pylist(), right.column("bucket").to_pylist(), right.column("totals").to_pylist()))
        seen = []
        for n, (codes, inside) in enumerate(grams, 1):
            totals = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(t, np.uint32) for o, _, t in replies if o == n)]).astype(np.int64)
            _, at = np.unique(codes[inside], return_inverse=True)
            count = np.zeros(len(doc), np.int64)
            count[inside] = totals[at] - (_own(doc[inside], at) if exclude_own else 0)
            seen.append(count)
        longest = sum(inside.astype(np.int64) for _, inside in grams)
        value = np.log10(np.maximum(seen[0], 1)) + penalty * (longest - 1) + np.where(seen[0] > 0, 0, penalty)
        hit = np.zeros(len(doc), bool)
        for n in range(2, order + 1):  # the longest n-gram that is known counts
            known = seen[n - 1] > 0
            before = np.concatenate([seen[n - 2][:1], seen[n - 2][:-1]])
            value[known] = np.log10(seen[n - 1][known]) - np.log10(before[known]) + penalty * (longest[known] - n)
            hit |= known
        size = np.bincount(doc, minlength=rows)
        return pa.table([left.column("id").cast(id_type), pa.array(size, pa.int64()), pa.array(np.bincount(doc, value, rows), pa.float64()), pa.array(np.bincount(doc, ~hit, rows).astype(np.int64), pa.int64())], names=["id", "n_words", "log_sum", "n_unigram"])

    return run


def stupid_backoff(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text", backoff: float = 0.4, exclude_own: bool = True, block_bytes: int = 8 << 20) -> DataFrame:
    """One row per input row: id, n_words, score - the mean log10 of the stupid-backoff score of its words, by n-grams of up to `order` words.

    S(w | u..v) = c(u..v w) / c(u..v) where c(u..v w) > 0, else backoff * S(w | ..v), down to S(w) = c(w) / N, and
    backoff / N where c(w) = 0. The first words have shorter contexts. Counts are over all rows; with `exclude_own` those
    of the document itself are taken off, so that it doesn't vouch for itself (N is at least 1). Words as in
    `common.words`; a text without words (null, empty) has score null. Repeated rows count each. Other columns are not
    read; an empty table gives none.

    Relational, with columnar rows: documents are dealt into blocks of about `block_bytes`; a block sends its distinct
    n-grams with counts to hash partitions, packed as one row per partition, so that a frequent n-gram arrives once per
    block and not once per place. A partition adds up its count table and joins it back to the requests; a block joins
    the answers to its exploded n-grams and sums per document. Numbers of blocks and partitions grow with the input.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    buckets = max(1, -(-size // (2 * block_bytes)))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    id_type = rows.schema["id"].dataType
    asked = dealt.groupBy("block").applyInArrow(_request(buckets, order), "block long, n int, bucket long, grams binary, counts binary")
    answered = asked.groupBy("bucket", "n").applyInArrow(_total, "block long, n int, bucket long, totals binary")
    summed = dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(_score(backoff, exclude_own, order, to_arrow_type(id_type)), f"id {id_type.simpleString()}, n_words long, log_sum double, n_unigram long")
    summed = materialize(summed)
    total = summed.agg(F.sum("n_words")).first()[0] or 0
    rest = F.greatest(F.lit(total) - (F.col("n_words") if exclude_own else F.lit(0)), F.lit(1))
    score = (F.col("log_sum") - F.col("n_unigram") * F.log10(rest)) / F.nullif(F.col("n_words"), F.lit(0))
    return summed.select(F.col("id").alias(id_col), "n_words", score.alias("score"))
