"""Alignment of two tokenizers: token intervals of each text, cut where both end a token, and counts of the tokens that end together."""

from __future__ import annotations

import hashlib
import re
from contextlib import contextmanager
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices
from .packing import Ids

#: Between two characters that are no white space a single blank begins a piece: no token of either kind crosses it.
CUT = re.compile(r"(?<=\S)(?= \S)")
#: Pieces that a worker remembers, of eight links on average at most, and aligns at a time; those of over LONG characters go through the library that needs no square time.
KNOWN, LONG, AT_ONCE = 80_000, 1000, 8_000

#: Of tokens A and B (s, e: start and end on one axis that both cover without gaps; id): which token of B covers the last byte of each token of A, whether both end there, and how many such cuts lie before.
OVER = """
WITH over AS (SELECT a.e, a.id, b.id AS other, (b.e = a.e)::INT AS cut FROM a ASOF JOIN b ON a.e > b.s)
SELECT e, (id << 32) | other AS link, cut, (sum(cut) OVER (ORDER BY e ROWS UNBOUNDED PRECEDING) - cut)::BIGINT AS g FROM over ORDER BY e
"""
#: The group of each token of B: that of the first cut at its end or after.
WITHIN = "SELECT b.e, cuts.g FROM b ASOF JOIN cuts ON b.e <= cuts.e ORDER BY b.e"


def pieces(text: str | None) -> list[str]:
    """A blank and the text, cut at single blanks; nothing for a null or empty text. If one is `odd`, only `careful_pieces` are taken alone by both tokenizers."""
    return [" " + x for x in text.split(" ")] if text else []


def odd(piece: str) -> bool:
    """Whether a piece is a blank and then white space or nothing: it may belong to a run of white space that began before it."""
    return not piece[1:2].strip()


def careful_pieces(text: str) -> list[str]:
    return CUT.split(" " + text)


class Aligner:
    """Aligns texts by both tokenizers. What it holds of the pieces it knows: tokens of A and B, groups, links, the text of the groups; `odd` ones, and `bad` ones, which don't give their own bytes back."""

    def __init__(self, byte_path: str, piece_path: str):
        import duckdb
        import sentencepiece

        self.byte_path, self.fast = byte_path, Ids(byte_path).fast
        self.sp = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.a = [self.fast.__self__.decode_single_token_bytes(i) for i in range(self.fast.__self__.n_vocab)]
        spelt = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.b = [bytes([int(x[3:5], 16)]) if self.sp.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(spelt)]
        self.a_size, self.b_size = (np.array([len(x) for x in v]) for v in (self.a, self.b))
        #: Each id as text, followed by what may follow it.
        self.a_comma, self.a_last = (np.array([f"{i}{c}" for i in range(len(self.a))], object) for c in ",|")
        self.b_comma, self.b_last = (np.array([f"{i}{c}" for i in range(len(self.b))], object) for c in ",;")
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.counts, self.bad, self.odd = np.zeros((0, 3), np.int64), np.zeros(0, bool), np.zeros(0, bool)
        self.links, self.ends, self.texts = np.zeros(0, np.int64), np.zeros(1, np.int64), []

    @cached_property
    def slow(self):
        """The library that takes long pieces in less than square time."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.byte_path)
        out.encode_special_tokens = True
        return out

    def _tokens(self, many: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [self.fast(x) if len(x) <= LONG else self.slow.encode(x, add_special_tokens=False).ids for x in many]
        return a, self.sp.encode([x[1:] for x in many], num_threads=1)

    def _ask(self, sql: str, **tables: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        for name, t in tables.items():
            self.db.register(name, pa.table(t))
        out = self.db.sql(sql).fetchnumpy()
        for name in tables:
            self.db.unregister(name)
        return out

    def learn(self, many: list[str]) -> None:
        """Align these pieces: all their tokens one after the other are one table of intervals each way."""
        a, b = self._tokens(many)
        raw = [x.encode() for x in many]
        bad = np.array([b"".join(map(self.a.__getitem__, x)) != t or b"".join(map(self.b.__getitem__, y)) != t for x, y, t in zip(a, b, raw)], bool)
        n = np.array([[len(x), len(y), 0] for x, y in zip(a, b)], np.int64).reshape(-1, 3)
        n[bad] = 0
        sides = []
        for tokens, sizes in ((a, self.a_size), (b, self.b_size)):
            ids = np.fromiter((i for x, no in zip(tokens, bad.tolist()) if not no for i in x), np.int64)
            e = np.cumsum(sizes[ids])
            sides.append({"s": e - sizes[ids], "e": e, "id": ids})
        over = self._ask(OVER, a=sides[0], b=sides[1])
        cut = over["cut"] == 1
        group = over["g"], self._ask(WITHIN, b=sides[1], cuts={"e": over["e"][cut], "g": over["g"][cut]})["g"]
        n[:, 2] = np.diff(np.concatenate([[0], np.cumsum(cut)])[np.concatenate([[0], np.cumsum(n[:, 0])])])
        # The groups' text: tokens of A, then of B, group by group.
        last = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in group]
        said = np.concatenate([np.where(last[0], self.a_last[sides[0]["id"]], self.a_comma[sides[0]["id"]]), np.where(last[1], self.b_last[sides[1]["id"]], self.b_comma[sides[1]["id"]])])
        said = said[np.argsort(np.concatenate([group[0] * 2, group[1] * 2 + 1]), kind="stable")].tolist()
        ends = np.cumsum(n[:, 0] + n[:, 1]).tolist()
        texts = ["".join(said[i:j])[:-1] for i, j in zip([0, *ends], ends)]
        first = len(self.known)
        self.known |= {x: first + i for i, x in enumerate(many)}
        self.counts, self.bad, self.odd = np.concatenate([self.counts, n]), np.concatenate([self.bad, bad]), np.concatenate([self.odd, np.array([odd(x) for x in many], bool)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(n[:, 2])])
        self.links = np.concatenate([self.links, over["link"][cut]])
        self.texts += texts

    def _rows(self, parts: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the pieces, after learning the unknown ones."""
        new = list({x: None for p in parts for x in p if x not in self.known})
        for i in range(0, len(new), AT_ONCE):
            self.learn(new[i : i + AT_ONCE])
        return [np.fromiter(map(self.known.__getitem__, p), np.int64, len(p)) for p in parts]

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], pa.Array]:
        """Of each text: (tokens of A, tokens of B, groups), the text of its groups, its links as A id << 32 | B id."""
        if max(len(self.known), len(self.links) // 8) > KNOWN:
            self.forget()
        rows = self._rows([pieces(t) for t in texts])
        for cut, flag in ((careful_pieces, "odd"), (lambda t: [" " + t], "bad")):  # at last the whole text, as one piece, decides
            again = [k for k, r in enumerate(rows) if getattr(self, flag)[r].any()]
            for k, r in zip(again, self._rows([cut(texts[k]) for k in again])):
                rows[k] = r
        rows = [r[~self.bad[r]] for r in rows]
        flat, size = np.concatenate([np.zeros(0, np.int64), *rows]), np.array([len(r) for r in rows])
        doc = np.repeat(np.arange(len(rows)), size)
        n = np.stack([np.bincount(doc, self.counts[flat, j], len(rows)) for j in range(3)], 1).astype(np.int64)
        much = self.counts[flat, 2]
        starts = np.repeat(self.ends[flat] - np.concatenate([[0], np.cumsum(much)[:-1]]), much) if len(flat) else flat
        links = self.links[starts + np.arange(len(starts))]
        offsets = np.concatenate([[0], np.cumsum(n[:, 2])]).astype(np.int32)
        said = [";".join([self.texts[i] for i in r.tolist()]) for r in rows]
        return n, said, pa.ListArray.from_arrays(pa.array(offsets), pa.array(links))


@lru_cache(2)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


def alignments(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, groups_sha256, links) of each row; links: A id << 32 | B id of each pair of tokens that end together."""

    def run(batches):
        for batch in slices(batches, 1, 1 << 20):
            n, said, links = _aligner(byte_path, piece_path).align(batch.column(1).to_pylist())
            sha = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in said]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(n[:, j]) for j in range(3)), pa.array(sha, pa.string()), links], names=["id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, groups_sha256 string, links array<long>")


@contextmanager
def _arrow_rows(spark, rows: int):
    """At most so many rows in an Arrow batch of what is run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n): how many links of all rows hold the pair. Each task counts its own first."""

    def run(batches):
        held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            links = batch.column(0).flatten().to_numpy()
            held, at = np.unique(np.concatenate([held, links]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, np.ones(len(links), np.int64)]), len(held)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["pair", "n"])

    counted = aligned.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return counted.select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"), "n")


def most_pairs(aligner: Aligner) -> int:
    """No corpus has more pairs: of two tokens that end together, one's bytes end with the other's, a token has as many suffixes as bytes, and each is at most so many tokens of the other kind as share their bytes."""

    def same(tokens: list[bytes]) -> int:
        return int(np.unique(np.array([hash(x) for x in tokens]), return_counts=True)[1].max())

    return int(aligner.a_size.sum()) * same([x for x in aligner.b if x]) + int(aligner.b_size.sum()) * same([x for x in aligner.a if x])


def align_tokenizers(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 - how the tokens of a byte-level vocabulary (A) and of a piece model with byte fallback (B) lie over each other.

    A encodes a blank and the text, B the text (and adds the blank itself), strings of special tokens as plain text.
    Offsets where both end a token cut the tokens into groups. A link is a pair of tokens that end together; its count is
    how many links of all rows hold the same two ids; it is a best one if no other A id is linked with its B id more often.

    1. In each Arrow slice, distinct pieces of texts become two tables of token intervals; DuckDB finds by as-of joins
       which token of B covers the end of each token of A and in which group each token of B lies, and groups by window
       sums. (Both tables cover one axis without gaps, so an as-of join finds what a range join of the intervals would.)
    2. Each task counts its pairs; Spark adds them up. Their number is bounded by the vocabularies (`most_pairs`), not by
       the corpus, so all tasks get them.
    3. A scan over the written links sums up each row's counts.

    Null and empty texts and those that either tokenizer doesn't give back have zeros and an empty hash. Repeated rows
    count each; other columns are not read; an empty table gives none.
    """
    with _arrow_rows(docs.sparkSession, 1000):  # of whole texts; an executor holds some batches on either side
        aligned = materialize(alignments(docs, byte_path, piece_path, id_col, text_col), **{"parquet.block.size": 8 << 20})
    pairs = pair_counts(aligned).toArrow()
    if pairs.num_rows > most_pairs(_aligner(byte_path, piece_path)):
        raise AssertionError("more pairs than the vocabularies allow")
    b, n = pairs["b"].to_numpy().astype(np.int64), pairs["n"].to_numpy()
    key = (pairs["a"].to_numpy().astype(np.int64) << 32) | b
    most = np.zeros(b.max(initial=0) + 1, np.int64)
    np.maximum.at(most, b, n)
    order = np.argsort(key)
    shared = docs.sparkSession.sparkContext.broadcast((key[order], n[order], (n == most[b])[order]))

    def run(batches):
        key, n, best = shared.value
        for batch in batches:
            links = batch.column(5)
            row = np.repeat(np.arange(batch.num_rows), np.diff(links.offsets.to_numpy()))
            at = np.searchsorted(key, links.flatten().to_numpy())
            count = np.zeros(batch.num_rows, np.int64)
            np.add.at(count, row, n[at])
            sums = [np.bincount(row, minlength=batch.num_rows), np.bincount(row[best[at]], minlength=batch.num_rows), count]
            yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(5)), *(pa.array(x.astype(np.int64)) for x in sums)], names=[*batch.schema.names[:5], "n_links", "n_best", "count_sum"])

    kind = aligned.schema["id"].dataType.simpleString()
    out = aligned.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long")
    return out.withColumnRenamed("id", id_col)
