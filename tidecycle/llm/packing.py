"""Best-fit packing of token sequences, certified by dual-feasible-function bounds."""

from __future__ import annotations

import itertools
import json
import os
import zlib
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices

#: The pre-tokenisation pattern of the byte-level vocabulary, and the string of its special token.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 200_000


class Ids(dict):
    """Piece of text -> its ids as little-endian bytes, None for one that is not taken alone; forgets all when it holds CACHE_WORDS pieces."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that the vocabulary file writes as themselves
        names = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(names[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        odd = piece[:1] == " " and not piece[1:2].strip()  # white space that may belong to a run before it
        self[piece] = out = None if odd else np.array(self.fast(piece), "<u4").tobytes()
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text. A token never crosses a single blank before what isn't white space, so pieces split there are independent."""
        if any(x in text for x in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        parts = text.split(" ")
        if "" in parts:
            return np.array(self.fast(text), "<u4").tobytes()
        ids = [self[parts[0]], *map(self.__getitem__, [" " + x for x in parts[1:]])]
        return np.array(self.fast(text), "<u4").tobytes() if None in ids else b"".join(ids)


@lru_cache(2)
def _ids(path: str) -> Ids:
    return Ids(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole when they fit, else full pieces after a first one that takes the rest."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32) of all texts; ids are not kept."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        ids = _ids(tokenizer)
        for batch in slices(batches, 1):
            names, rows = batch.column(0), []
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = (ids.encode(text) if text else b"") + end
                rows += [(i, k, s, n, zlib.crc32(data[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(data) // 4, capacity))]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([names.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])], names=["id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual-feasible functions.

    For a threshold t <= capacity/2: lengths above capacity - t count as a whole bin, those from t on by their length,
    smaller ones not at all. For k: length x counts as floor((k+1)x/C)/k bins, or x/C where (k+1)x/C is whole.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])  # of lengths below i
    many = np.concatenate([[0], np.cumsum(count)])
    t = np.arange(0, capacity // 2 + 1)
    whole = many[-1] - many[capacity - t + 1]
    best = int(np.max(whole + -(-(total[capacity - t + 1] - total[t]) // capacity)))
    x = np.arange(capacity + 1)
    for k in range(1, 21):
        up = (k + 1) * x
        num = np.where(up % capacity == 0, k * x, up // capacity * capacity)  # in units of 1/(k * capacity) bins
        best = max(best, int(-(-int((count * num).sum()) // (k * capacity))))
    return best


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing of lengths that are sorted downwards: bin and offset of each, free room of each bin.

    Open bins are kept by free room with a bit mask over the room sizes, so each item takes constant time.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins, offsets, free = 0, [], [], []
    for n in lengths:
        fit = mask >> n
        if fit:
            room = (fit & -fit).bit_length() - 1 + n
            b = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        bins.append(b)
        offsets.append(capacity - room)
        free[b] = left = room - n
        if left:
            rooms[left].append(b)
            mask |= 1 << left
    return bins, offsets, free


def _pack_group(capacity: int, round_no: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True], kind="stable")
        lengths = pdf["length"].to_numpy()
        bins, offsets, free = best_fit(lengths.tolist(), capacity)
        bound = lower_bound(lengths, capacity)
        gap = len(free) - bound
        # A certified partition is final. Otherwise the bins with the most room go back: enough of them to hold the gap's worth of documents.
        open_bins = np.zeros(len(free), bool)
        if gap > 0 and not last:
            room = np.array(free)
            open_bins = room >= max(1, min(capacity // 8, int(np.sort(room)[-min(len(room), 8 * gap)])))
        b = np.array(bins)
        return pd.DataFrame({"uid": pdf["uid"].to_numpy(), "length": lengths, "sequence_id": (round_no << 52) + (pdf["pid"].to_numpy() << 24) + b, "offset": np.array(offsets, np.int64), "final": ~open_bins[b], "bound": bound, "bins": len(free)})

    return run


PLACED = "uid long, length long, sequence_id long, offset long, final boolean, bound long, bins long"


def pack_lengths(items: DataFrame, capacity: int, per_partition: int = 40_000) -> DataFrame:
    """Packs rows (uid, length), 0 < length <= capacity: uid, sequence_id, offset, bound and bins of the partition that placed it.

    Items are dealt at random into partitions of about `per_partition` (the memory of a task is bounded by it at any
    size), packed best-fit decreasing, and certified by `lower_bound`. Partitions with a gap give back their emptiest
    bins; those documents are dealt anew among fewer partitions and packed again, until all are certified, one
    partition is left, or a round gave back over nine tenths of what it was given. Ids hold 2**10 rounds, 2**28
    partitions and 2**24 bins in each.
    """
    if per_partition > 1 << 23:
        raise ValueError("per_partition is 2**23 at most")
    left, done, before = items.select("uid", "length"), [], None
    for k in itertools.count():
        n = left.count()
        if not n:
            break
        parts = -(-n // per_partition)
        last = parts == 1 or (before is not None and n > 0.9 * before)
        before = n
        dealt = left.withColumn("pid", F.pmod(F.xxhash64("uid", F.lit(k)), F.lit(parts)))
        packed = materialize(dealt.groupBy("pid").applyInPandas(_pack_group(capacity, k, last), PLACED))
        done.append(packed.where("final"))
        left = packed.where("not final").select("uid", "length")
        if last:
            break
    if not done:
        return items.sparkSession.createDataFrame([], PLACED).drop("length", "final")
    return reduce(DataFrame.unionByName, done).drop("length", "final")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", per_partition: int = 40_000) -> DataFrame:
    """Packs whole texts into as few sequences of at most `capacity` ids as it can.

    One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset, and of the partition that packed it the
    certificate: bound (sequences that any packing of its pieces needs) and bins (sequences made). Only documents
    longer than a sequence are cut; their first piece takes the rest, the others are full and make sequences of their
    own (bound and bins 1). A null or empty text is its end id alone. Repeated rows are packed each. Other columns are
    not read; an empty table gives none.
    """
    pieces = materialize(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()))
    placed = pack_lengths(pieces.where(F.col("length") < capacity), capacity, per_partition)
    cols = [F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32"]
    one = F.lit(1).cast("long")
    full = pieces.where(F.col("length") == capacity).select(*cols, (F.col("uid") + F.lit(2**62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), one.alias("bound"), one.alias("bins"))
    return pieces.where(F.col("length") < capacity).join(placed, "uid").select(*cols, "sequence_id", "offset", "bound", "bins").unionByName(full)
