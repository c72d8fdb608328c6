"""Collocations: phrases whose words stand together more often than their parts would, from merged count tries."""

from __future__ import annotations

import heapq
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BASE, materialize, mix, slices, utf8

STOP = b"."
#: A-Z lower-cased; `.,;:!?` and the bytes 0A to 0D end a piece; a tab is a blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else STOP[0] if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
#: Languages whose totals are sent to all tasks, at most; beyond, they are joined by a shuffle.
MOST_TOTALS = 10_000


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, with STOP wherever a piece ends."""
    return text.translate(TABLE).replace(STOP, b" . ").split()


class _Numbers(dict):
    """Word -> its number, in the order of appearance."""

    def __missing__(self, w: bytes) -> int:
        self[w] = n = len(self)
        return n


class _Block:
    """Words of some documents in a row: their numbers (0 ends a piece), the language of each, and 64-bit hashes of the trie's nodes of depth 1 and 2 that begin at each word."""

    def __init__(self, langs: list[str], words: list[bytes], ids: np.ndarray, lang: np.ndarray):
        self.langs, self.words, self.ids, self.lang = langs, words, ids, lang
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        with np.errstate(over="ignore"):
            self.root = np.fromiter((xxhash.xxh64_intdigest(x.encode()) for x in langs), np.uint64, len(langs))
            self.one = mix(self.root[lang] * BASE + hashes[ids])
            self.two = mix(self.one[:-1] * BASE + hashes[ids[1:]])
        self.real = ids != 0
        self.pair = self.real[:-1] & self.real[1:]


def _blocks(batches, size: int):
    """Blocks of about `size` words of rows (lang, text)."""

    def block():
        return _Block(list(langs), list(numbers), np.concatenate(ids), np.repeat(np.array(lang, np.int32), [len(x) for x in ids]))

    numbers, langs, ids, lang, held = _Numbers({STOP: 0}), _Numbers(), [], [], 0
    for batch in slices(batches, 1):
        for name, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            words = tokens(text or b"")
            if words.count(STOP) < len(words):
                words.append(STOP)  # no phrase crosses documents
                ids.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                lang.append(langs[name])
                held += len(words)
        if held >= size:
            yield block()
            numbers, langs, ids, lang, held = _Numbers({STOP: 0}), _Numbers(), [], [], 0
    if held:
        yield block()


def _pack(x: np.ndarray) -> bytes:
    """Numbers by byte planes, whose upper ones then compress well in the shuffle."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unpack(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _shallow(size: int, range_bits: int):
    """The nodes of depth 1 and 2 of each shard's trie as hashes with counts, a row for each range of hashes."""

    def run(batches):
        for b in _blocks(batches, size):
            keys, counts = np.unique(np.concatenate([b.one[b.real], b.two[b.pair]]), return_counts=True)
            at, first = np.unique(keys >> np.uint64(64 - range_bits), return_index=True)
            ends = [*first[1:], len(keys)]
            rows = [(_pack(keys[i:j]), _pack(counts[i:j].astype(np.uint32))) for i, j in zip(first, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), *(pa.array(x, pa.binary()) for x in zip(*rows))], names=["range", "keys", "counts"])

    return run


def _marks(range_bits: int, bits: int, least: int):
    """Of a range of hashes: its part of the bit map, with a bit for each node that counts `least` or more over all shards."""

    def run(table):
        keys = np.concatenate([_unpack(x, np.uint64) for x in table["keys"].to_pylist()])
        counts = np.concatenate([_unpack(x, np.uint32) for x in table["counts"].to_pylist()]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        often = keys[first][np.add.reduceat(counts[order], first) >= least]
        map_ = np.zeros(1 << (bits - range_bits), bool)
        map_[((often >> np.uint64(64 - bits)) & np.uint64(len(map_) - 1)).astype(np.int64)] = True
        return pa.table({"range": table["range"][:1], "map": pa.array([np.packbits(map_).tobytes()], pa.binary())})

    return run


def _bit_map(shallow: DataFrame, range_bits: int, bits: int, least: int) -> np.ndarray:
    """The bit map of all nodes of depth 1 and 2 that may count `least` or more: 2**bits bits, whatever the corpus. It has no false negative; false positives cost work and change nothing."""
    parts = shallow.groupBy("range").applyInArrow(_marks(range_bits, bits, least), "range long, map binary").toArrow()
    out = np.zeros((1 << range_bits, 1 << (bits - range_bits - 3)), np.uint8)
    for at, part in zip(parts["range"].to_pylist(), parts["map"].to_pylist()):
        out[at] = np.frombuffer(part, np.uint8)
    return out.ravel()


def _trie(b: _Block, marked: np.ndarray, bits: int, longest: int, range_bits: int):
    """Nodes of a block's trie whose depth 1 and 2 are marked, sorted: rows (range, lang, depth, word, count), words of a level by UTF-8 bytes.

    A node of depth k at a word is its node of depth k - 1 there and the k-th word, so each level is one `unique`. A
    phrase can count `least` only if all its pairs do, so a deeper node needs a mark of every pair in it.
    """

    def often(h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - bits)
        return (marked[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1

    single, pair = b.real & often(b.one), b.pair & often(b.two)
    used = np.unique(np.concatenate([b.ids[single], b.ids[:-1][pair], b.ids[1:][pair]]))
    used = np.array(sorted(used.tolist(), key=b.words.__getitem__), np.int64)
    rank = np.zeros(len(b.words), np.int64)
    rank[used] = np.arange(1, len(used) + 1)
    r, width = rank[b.ids], len(used) + 1
    place = lambda h: (h >> np.uint64(64 - range_bits)).astype(np.int64)

    langs, n_words = np.unique(b.lang[b.real], return_counts=True)
    levels = [(place(b.root[langs]), langs, np.zeros((len(langs), longest), np.int64), n_words, 0)]
    at = np.flatnonzero(single)
    _, first, count = np.unique(b.lang[at] * np.int64(width) + r[at], return_index=True, return_counts=True)
    path = np.zeros((len(first), longest), np.int64)
    path[:, 0] = r[at[first]]
    levels.append((place(b.one[at[first]]), b.lang[at[first]], path, count, 1))
    at, node, above = np.flatnonzero(pair), None, None
    for depth in range(2, longest + 1):
        if depth == 2:
            key = (b.lang[at] * np.int64(width) + r[at]) * np.int64(width) + r[at + 1]
        else:
            on = at + depth - 2 < len(pair)
            on[on] = pair[at[on] + depth - 2]
            at, node = at[on], node[on]
            key = node * np.int64(width) + r[at + depth - 1]
        if not len(at):
            break
        _, first, node, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        path = np.stack([r[at[first] + j] if j < depth else np.zeros(len(first), np.int64) for j in range(longest)], 1)
        where = place(b.two[at[first]])
        levels.append((where, b.lang[at[first]], path, count, depth))
        if depth == 2:  # the way to them from the root, counted elsewhere
            over = np.unique(np.stack([where, b.lang[at[first]], path[:, 0]], 1), axis=0)
            way = np.zeros((len(over), longest), np.int64)
            way[:, 0] = over[:, 2]
            levels.append((over[:, 0], over[:, 1], way, np.zeros(len(over), np.int64), 1))
    where, lang, path, count, depth = (np.concatenate(x) for x in zip(*((w, g, p, c, np.full(len(w), d)) for w, g, p, c, d in levels)))
    order = np.lexsort([*path.T[::-1], lang, where])
    last = path[np.arange(len(path)), np.maximum(depth - 1, 0)]
    names = [b"", *(b.words[i] for i in used.tolist())]
    return where[order], lang[order], depth[order], [names[i] for i in last[order].tolist()], count[order]


def _serialised(size: int, range_bits: int, bits: int, longest: int, marked):
    """Each shard's trie as rows (lang, range, trie). A trie is lines in preorder: the depth, the last word of the path, its count."""

    def run(batches):
        for b in _blocks(batches, size):
            where, lang, depth, words, count = _trie(b, marked.value, bits, longest, range_bits)
            lines = [b"%d%b\t%d" % x for x in zip(depth.tolist(), words, count.tolist())]
            first = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (lang[1:] != lang[:-1])])) if len(where) else np.zeros(0, np.int64)
            ends = [*first[1:].tolist(), len(lines)]
            blobs = [b"\n".join(lines[i:j]) for i, j in zip(first.tolist(), ends)]
            yield pa.RecordBatch.from_arrays([pa.array([b.langs[i] for i in lang[first].tolist()], pa.string()), pa.array(where[first], pa.int64()), pa.array(blobs, pa.binary())], names=["lang", "range", "trie"])

    return run


def _walk(trie: bytes):
    """(path, count) of the nodes of a serialised trie, ascending."""
    path: tuple[bytes, ...] = ()
    for line in trie.split(b"\n"):
        word, _, count = line.partition(b"\t")
        depth = word[0] - 48
        path = (*path[: depth - 1], word[1:]) if depth else ()
        yield path, int(count)


def _merged(least: int, longest: int):
    """The tries of all shards in a range, merged by a heap: nodes that count `least` or more (the root always) with their left parts of two words and more, the nodes that the walk came by."""

    def run(key, table):
        rows, over = [], [0] * (longest + 1)
        for path, same in groupby(heapq.merge(*map(_walk, table["trie"].to_pylist())), itemgetter(0)):
            over[len(path)] = n = sum(c for _, c in same)
            if n >= least or n and not path:
                rows.append((b" ".join(path), len(path), n, over[2 : len(path)]))
        phrase, m, n, lefts = zip(*rows) if rows else ([], [], [], [])
        return pa.table({"lang": pa.array([key[0].as_py()] * len(rows), pa.string()), "phrase": pa.array(phrase, pa.binary()).cast(pa.string()), "m": pa.array(m, pa.int32()), "f": pa.array(n, pa.int64()), "lefts": pa.array(lefts, pa.list_(pa.int64()))})

    return run


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = 5, lang_col: str = "lang", text_col: str = "text", block_words: int = 1_000_000, bits: int = 26) -> DataFrame:
    """(lang, phrase, m, f, lefts): all phrases of 1 to `longest` words that occur `least` times or more in a language, and for each language the root (phrase '', m 0, f all its words). lefts: counts of the first 2 to m - 1 words.

    1. A scan counts the nodes of depth 1 and 2 of each shard's trie by hash (a shard is a block of about `block_words`
       words). Ranges of hashes are merged, and those that may count `least` make a bit map of 2**bits bits (8 MB at 26).
    2. A second scan makes each shard's trie down to `longest` words, by the words themselves, of marked nodes only. It
       is serialised sorted and cut by ranges of its two-word prefixes (a hot first word is spread over all ranges).
    3. All shards' tries of a range meet in one task and are merged by a heap. Ranges follow the size of the corpus.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    blocks = (rows.agg(F.sum(F.length("text"))).first()[0] or 0) // (block_words * 4) + 1
    parts = max(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")), 16)
    range_bits = min((2 * parts - 1).bit_length(), bits - 3)
    shallow = rows.mapInArrow(_shallow(block_words, range_bits), "range long, keys binary, counts binary")
    marked = spark.sparkContext.broadcast(_bit_map(shallow, range_bits, bits, least))
    tries = rows.mapInArrow(_serialised(block_words, range_bits, bits, longest, marked), "lang string, range long, trie binary")
    return tries.groupBy("lang", "range").applyInArrow(_merged(least, longest), "lang string, phrase string, m int, f long, lefts array<long>")


def collocations(docs: DataFrame, top: int | None = 2000, least: int = 100, longest: int = 5, lang_col: str = "lang", text_col: str = "text", **options) -> DataFrame:
    """The first `top` phrases of each language (all, if None): lang, rank, phrase, m, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut at `.,;:!?` and line ends into pieces and at blanks and tabs into words. A
    candidate is a phrase of 2 to `longest` words with a = f(phrase) >= `least`; for a cut after k words l is the count
    of the first part, r that of the rest, and the score floor(1000 * a * n / (l * r)), in decimals of 38 digits. The
    lowest cut counts, the first of equals. Candidates within a longer candidate of the same count are dropped.
    Order: score and a downwards, phrase by UTF-8 bytes.

    Left parts of two words and more come from the walk through the merged trie; the first word and all right parts are
    suffix links, joins with the nodes themselves. Null languages are `und`; null, empty and blank texts have no words;
    repeated rows count each. Other columns are not read; an empty table gives none.
    """
    nodes = materialize(phrase_counts(docs, least, longest, lang_col, text_col, **options))
    w = F.split("phrase", " ")
    links = F.concat(
        F.array(F.struct(F.lit(0).alias("k"), w[0].alias("part"))),
        F.transform(F.sequence(F.lit(1), F.col("m") - 1), lambda k: F.struct(k.alias("k"), F.array_join(F.slice(w, k + 1, F.col("m") - k), " ").alias("part"))),
    )
    asked = nodes.where("m > 1").withColumn("x", F.explode(links)).select("lang", "phrase", "m", F.col("f").alias("a"), "lefts", "x.k", "x.part")
    found = asked.join(nodes.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    # A candidate: its right parts by the cut, and before them (k = 0) its first word.
    cand = materialize(found.groupBy("lang", "phrase").agg(F.first("m").alias("m"), F.first("a").alias("a"), F.first("lefts").alias("lefts"), F.transform(F.array_sort(F.collect_list(F.struct("k", "f"))), lambda x: x["f"]).alias("rights")))
    longer = cand.where("m > 2")
    within = [
        longer.where(F.element_at("lefts", -1) == F.col("a")).select("lang", F.array_join(F.slice(w, F.lit(1), F.col("m") - 1), " ").alias("phrase")),
        longer.where(F.col("rights")[1] == F.col("a")).select("lang", F.array_join(F.slice(w, F.lit(2), F.col("m") - 1), " ").alias("phrase")),
    ]
    kept = cand.join(within[0].unionByName(within[1]), ["lang", "phrase"], "left_anti")
    totals = nodes.where("m = 0").select("lang", F.col("f").alias("n"))
    kept = kept.join(F.broadcast(totals) if totals.count() <= MOST_TOTALS else totals, "lang")
    big = lambda c: c.cast("decimal(18,0)")
    scored = kept.withColumn("cuts", F.expr("transform(sequence(1, m - 1), k -> named_struct('k', k, 'l', if(k = 1, rights[0], lefts[k - 2]), 'r', rights[k]))"))
    scored = scored.withColumn("over", (big(F.col("a")) * big(F.col("n"))).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"))
    scored = scored.withColumn("cut", F.expr("array_min(transform(cuts, x -> named_struct('score', over div (cast(x.l as decimal(18,0)) * cast(x.r as decimal(18,0))), 'k', x.k, 'l', x.l, 'r', x.r)))"))
    scored = materialize(scored.select("lang", "phrase", "m", "a", "cut.l", "cut.r", "n", "cut.score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    if top:  # first within many parts of a language, then among the best of all parts
        parts = max(1, int((scored.count() / top) ** 0.5))
        deal = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        scored = scored.withColumn("part", deal).withColumn("in_part", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("in_part") <= top)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "m", "a", "l", "r", "n", "score")
