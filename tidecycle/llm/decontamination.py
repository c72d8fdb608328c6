"""Benchmark decontamination with suffix arrays over the training shards."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE, materialize, mix, packed, slices, utf8, word_hashes, words

OPENING = 4  # words by which suffixes are looked up before they are sorted, fewer for shorter items


def opening_codes(h: np.ndarray, k: int) -> np.ndarray:
    """32-bit codes of the k words from each place on; places with fewer words left have none."""
    n = max(0, len(h) - k + 1)
    code = np.full(n, k, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            code = code * BASE + h[j : n + j]
        return (mix(code) >> np.uint64(32)).astype(np.uint32)


def bits_for(codes: np.ndarray, most: int) -> int:
    """Bits of a set of so many codes with a sixteenth of them taken."""
    return min(most, max(16, (16 * len(codes)).bit_length()))


class Bits:
    """A set of 32-bit codes, folded to `bits` bits: may hold more, never less."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.mask = np.uint32((1 << bits) - 1)
        flags = np.zeros(1 << bits, bool)
        flags[codes & self.mask] = True
        self.packed = np.packbits(flags, bitorder="little")

    def has(self, codes: np.ndarray) -> np.ndarray:
        at = codes & self.mask
        return (self.packed[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & np.uint8(1) == 1


@dataclass
class Openings:
    """Suffixes of test items that open with the same number of words: places in the block, their codes and all codes as a set."""

    words: int
    at: np.ndarray
    codes: np.ndarray
    known: Bits


class Benchmark:
    """A block of test items as word hashes, 0 after each item.

    A window is `window` consecutive words of an item, or the whole item when it is shorter; an item without words has none.
    """

    def __init__(self, names: list[str], hashes: list[np.ndarray], window: int):
        order = sorted(range(len(names)), key=lambda i: (names[i], hashes[i].tobytes()))
        self.names = [names[i] for i in order]
        sizes = np.array([len(hashes[i]) for i in order], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.words = np.concatenate([np.zeros(0, np.uint64), *(np.append(hashes[i], np.uint64(0)) for i in order)])
        self.window = window
        item = np.repeat(np.arange(len(order)), sizes + 1)
        left = self.starts[item] + sizes[item] - np.arange(len(self.words))  # words of the item from here on
        size = np.minimum(sizes[item], window)
        #: Words of the window that begins at each place, 0 where none does.
        self.size = np.where((left >= size) & (left > 0), size, 0).astype(np.int32)
        self.openings: list[Openings] = []
        short = np.minimum(size, OPENING)
        for k in range(1, OPENING + 1):
            at = np.flatnonzero((short == k) & (left >= k)).astype(np.int32)
            if len(at):
                codes = opening_codes(self.words, k)[at]
                self.openings.append(Openings(k, at, codes, Bits(codes, bits_for(at, 30))))

    def item_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def search(self, texts: list[bytes | None]) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]], list[list[tuple[int, int, str, int]]]]:
        """Words of each text, its merged spans of hit words (start, end), the items found in it, and its longest verbatim matches (start, words, item, start in the item) of which none is part of another."""
        flat: list[bytes] = []
        sizes = []
        for text in texts:
            ws = words(text)
            sizes.append(len(ws))
            flat += ws
            flat.append(b"")
        h = word_hashes(flat)
        del flat
        starts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
        h[starts[1:] - 1] = 0  # no word: nothing matches across the end of a text
        change = np.zeros(len(h) + 1, np.int32)
        best, source = np.zeros(len(h), np.int32), np.zeros(len(h), np.int64)
        held: list[np.ndarray] = []
        for o in self.openings:
            found = self._shard(h, o)
            if found is None:
                continue
            places, reach, classes, class_of, test_at, length, partner = found
            np.add.at(change, places, 1)
            np.add.at(change, places + reach, -1)
            up = np.argsort(length, kind="stable")  # of a place's matches the longest is set last
            up = up[length[up] > best[places[up]]]
            best[places[up]], source[places[up]] = length[up], partner[up]
            held.append(self._holders(np.searchsorted(starts, places, "right") - 1, classes, class_of, self.item_of(test_at)))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[list[str]] = [[] for _ in texts]
        matches: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
        if not held:
            return sizes, spans, items, matches
        edges = np.diff(np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]]))
        for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            d = int(np.searchsorted(starts, s, "right")) - 1
            spans[d].append((s - int(starts[d]), e - int(starts[d])))
        for d, i in np.unique(np.concatenate(held), axis=0).tolist():
            items[d].append(self.names[i])
        before = np.concatenate([[0], best[:-1]])
        top = np.flatnonzero((best > 0) & (best >= before))  # else the match one place before holds this one
        for p, n, t in zip(top.tolist(), best[top].tolist(), source[top].tolist()):
            d, i = int(np.searchsorted(starts, p, "right")) - 1, int(np.searchsorted(self.starts, t, "right")) - 1
            matches[d].append((p - int(starts[d]), n, self.names[i], t - int(self.starts[i])))
        return sizes, spans, [sorted(set(x)) for x in items], [outermost(x) for x in matches]

    def _shard(self, h: np.ndarray, o: Openings):
        """Searches all test suffixes of `o` in the suffix array of the shard `h`.

        Suffixes that open like none of the other side match nowhere and are left out; the stretches of the others,
        of both sides, are ranked together by prefix doubling, to whatever depth it takes. Returns the places of the
        shard where a window begins, the words it reaches, its class, the class of each test window with its place,
        and for each place the length of the longest match and its place among the tests.
        """
        codes = opening_codes(h, o.words)
        at = np.flatnonzero(o.known.has(codes))
        at = at[h[at] > 0]
        if not len(at):
            return None
        tests = o.at[Bits(codes[at], bits_for(at, 24)).has(o.codes)]
        if not len(tests):
            return None
        x, here, there = _stretches(h, at, self.words, tests, o.words)
        ranks = _ranks(x)
        deepest = ranks[-1]
        array = here[np.argsort(deepest[here])]  # the shard's suffix array
        lo = np.searchsorted(deepest[array], deepest[there])  # every test suffix in it
        size = self.size[tests]
        reach = np.maximum(*(_common(ranks, there, array[np.clip(lo + k, 0, len(array) - 1)]) for k in (-1, 0)))
        ok = (size > 0) & (reach >= size)  # the window of this test suffix stands in the shard
        if not ok.any():
            return None
        tests, there, size = tests[ok], there[ok], size[ok]
        # Places of each window: the classes of equal prefixes of its size.
        place, words_, classes, class_of, test_at, first = [], [], [], [], [], 0
        for m in np.unique(size).tolist():
            mine = there[size == m]
            key = _prefix_class(ranks, np.concatenate([mine, here]), m)
            known, number = np.unique(key[: len(mine)], return_inverse=True)
            near = np.minimum(np.searchsorted(known, key[len(mine) :]), len(known) - 1)
            hit = known[near] == key[len(mine) :]
            place.append(np.flatnonzero(hit))
            words_.append(np.full(int(hit.sum()), m, np.int64))
            classes.append(near[hit] + first)
            class_of.append(number + first)
            test_at.append(tests[size == m])
            first += len(known)
        k, reach, classes = np.concatenate(place), np.concatenate(words_), np.concatenate(classes)
        class_of, test_at = np.concatenate(class_of), np.concatenate(test_at)
        # Longest match of each place: the neighbours among the test suffixes; one shorter than a window counts as the short item that it holds.
        sorted_tests = np.argsort(deepest[there])
        order = there[sorted_tests]
        lo = np.searchsorted(deepest[order], deepest[here[k]])
        both = [np.clip(lo + d, 0, len(order) - 1) for d in (-1, 0)]
        common = np.stack([_common(ranks, here[k], order[b]) for b in both])
        which = common.argmax(0)
        length, partner = common.max(0), tests[sorted_tests][np.where(which == 0, both[0], both[1])]
        one_of = np.zeros(first, np.int64)
        one_of[class_of[::-1]] = test_at[::-1]
        short = length < self.window
        return at[k], reach, classes, class_of, test_at, np.where(short, reach, length), np.where(short, one_of[classes], partner)

    @staticmethod
    def _holders(doc: np.ndarray, classes: np.ndarray, class_of: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Pairs (text, item) from places with a class and tests with a class. Windows of the same items are one, so a shared passage costs a pair for each text and item, not for each of its windows."""
        pairs = np.unique(np.stack([class_of, item], 1), axis=0)
        bounds = np.searchsorted(pairs[:, 0], np.arange(int(pairs[-1, 0]) + 2))
        groups: dict[bytes, int] = {}
        number = np.array([groups.setdefault(pairs[a:b, 1].tobytes(), len(groups)) for a, b in zip(bounds, bounds[1:])])
        sets = [np.frombuffer(g, np.int64) for g in groups]
        out = [np.zeros((0, 2), np.int64)]
        for d, g in np.unique(np.stack([doc, number[classes]], 1), axis=0).tolist():
            out.append(np.stack([np.full(len(sets[g]), d), sets[g]], 1))
        return np.concatenate(out)


def _stretches(h: np.ndarray, at: np.ndarray, tests: np.ndarray, there: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of places, each with the k - 1 words after its last, of both sides in one array, every run closed by an end of its own; and where the places are in it."""
    parts, places, total = [], [], 0
    for words_, p in ((h, at), (tests, there)):
        cut = np.flatnonzero(np.diff(p) > k) + 1  # places nearer than the words they need share a run
        first, last = p[np.concatenate([[0], cut])], p[np.concatenate([cut - 1, [len(p) - 1]])] + k
        sizes = last - first + 1
        offset = np.cumsum(sizes) - sizes
        index = np.arange(int(sizes.sum())) - np.repeat(offset - first, sizes)
        values = words_[np.minimum(index, len(words_) - 1)].copy()
        closing = offset + sizes - 1
        run = np.searchsorted(first, p, "right") - 1
        places.append(total + offset[run] + p - first[run])
        parts.append((values, closing + total))
        total += int(sizes.sum())
    values = np.concatenate([v for v, _ in parts])
    closing = np.concatenate([c for _, c in parts])
    _, x = np.unique(values, return_inverse=True)
    x = x + len(closing) + int((values == 0).sum()) + 1
    none = np.union1d(closing, np.flatnonzero(values == 0))  # ends of runs, of texts and of items: each differs from all others
    x[none] = np.arange(len(none))
    return x, places[0], places[1]


def _ranks(x: np.ndarray) -> list[np.ndarray]:
    """ranks[j][i]: order of the 2**j words from i on; the last tells all suffixes apart."""
    _, r = np.unique(x, return_inverse=True)
    out, step, n = [r], 1, len(x)
    while int(r.max()) + 1 < n and step < n:
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = r[step:] + 1
        _, r = np.unique(r.astype(np.int64) * (n + 1) + ahead, return_inverse=True)
        out.append(r)
        step *= 2
    return out


def _common(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at a and b have in common."""
    a, b, out, n = a.copy(), b.copy(), np.zeros(len(a), np.int64), len(ranks[0])
    for j in range(len(ranks) - 1, -1, -1):
        same = (a < n) & (b < n)
        same[same] = ranks[j][a[same]] == ranks[j][b[same]]
        for y in (a, b, out):
            y[same] += 1 << j
    return out


def _prefix_class(ranks: list[np.ndarray], at: np.ndarray, m: int) -> np.ndarray:
    """A number for each place, equal where the m words from there on are."""
    n = len(ranks[0])
    j = min(m.bit_length() - 1, len(ranks) - 1)
    key = ranks[j][at].astype(np.int64)
    done = 1 << j
    while done < m:
        step = min(1 << j, m - done)
        nxt = at + done + step - (1 << j)
        _, key = np.unique(key * (n + 1) + np.where(nxt < n, ranks[j][np.minimum(nxt, n - 1)], n), return_inverse=True)
        done += step
    return key


def outermost(matches: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Matches (start, words, item, start in the item) that are not part of another; of equal ones the first item."""
    out: list[tuple[int, int, str, int]] = []
    for m in sorted(matches, key=lambda x: (x[0], -x[1], x[2], x[3])):
        if not out or m[0] + m[1] > out[-1][0] + out[-1][1]:
            out.append(m)
    return out


SPAN = T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())])
MATCH = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("words", T.IntegerType()), T.StructField("item", T.StringType()), T.StructField("item_start", T.IntegerType())])
SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
MATCHES = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("item", pa.string()), ("item_start", pa.int32())]))
NEW = ("__n_words", "__spans", "__items", "__matches")


def _hashed(batches):
    for batch in slices(batches, 1):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([word_hashes(words(t)).tobytes() for t in utf8(batch.column(1))], pa.binary())], names=["id", "words"])


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int):
    """The benchmark in blocks of about `block_bytes` of word hashes and names. The hashes are made on executors; the number of blocks grows with the benchmark."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    hashed = materialize(items.mapInArrow(_hashed, "id string, words binary"))
    total = hashed.agg(F.sum(F.octet_length("words") + F.octet_length("id") + 64)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        part = hashed.where(F.pmod(F.xxhash64("id", "words"), F.lit(n)) == b) if n > 1 else hashed
        rows = part.collect()
        yield Benchmark([r[0] for r in rows], [np.frombuffer(r[1], np.uint64) for r in rows], window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = 32 << 20) -> DataFrame:
    """`docs` with columns __n_words, __spans (merged hit words, start and end), __items (ids of found items, sorted as strings) and __matches (longest verbatim matches: start, words, item, item_start; none is part of another).

    A slice of documents of some MB is a shard: the suffixes that open like a test suffix make its suffix array, and
    every test suffix that could match is searched in it by bisection. Its neighbours there give the longest match; a
    match counts from `window` words on, or when it is all of a shorter item. Suffixes are ordered to any depth, so
    `window` may be of any size. Documents stay where they are: nothing is shuffled.

    The benchmark goes to the tasks in blocks of about `block_bytes` of 64-bit word hashes (some 4 million words; an
    item is never cut), with an index of twice that size; the findings of one block are carried in the row to the next.
    Null or empty texts have no words. Null item ids count as the empty string, repeated item ids as one item; of
    several items that hold a match any one is named. All columns of `docs` pass through, but for those named as the new
    ones, which are replaced. An empty benchmark, or one without words, hits nothing; an empty table gives none.
    """
    docs = docs.drop(*NEW)
    out, names = docs, docs.columns
    kinds = (T.LongType(), T.ArrayType(SPAN), T.ArrayType(T.StringType()), T.ArrayType(MATCH))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, k) for c, k in zip(NEW, kinds))])
    text_at, spark = names.index(text_col), docs.sparkSession
    for b, block in enumerate(benchmark_blocks(benchmark, item_id, item_text, window, block_bytes)):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared, first=b == 0):
            bench = shared.value
            for batch in slices(batches, text_at):
                sizes, spans, items, matches = bench.search(utf8(batch.column(text_at)))
                if not first:
                    old = [batch.column(len(names) + k).to_pylist() for k in (1, 2, 3)]
                    spans = [_merged([(x["s"], x["e"]) for x in was] + new) for was, new in zip(old[0], spans)]
                    items = [sorted({*was, *new}) for was, new in zip(old[1], items)]
                    matches = [outermost([tuple(x.values()) for x in was] + new) for was, new in zip(old[2], matches)]
                found = [
                    pa.array(sizes, pa.int64()),
                    pa.array([[{"s": s, "e": e} for s, e in x] for x in spans], SPANS),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array([[dict(zip(("start", "words", "item", "item_start"), m)) for m in x] for x in matches], MATCHES),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + found, names=[*names, *NEW])

        if b:
            out = materialize(out)
        out = out.mapInArrow(run, schema)
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def hit_words() -> F.Column:
    return F.aggregate("__spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])


def longest_match() -> F.Column:
    """Words of the longest verbatim match, 0 without one."""
    return F.coalesce(F.array_max(F.transform("__matches", lambda m: m["words"])), F.lit(0)).cast("long")


def contaminated() -> F.Column:
    """Some word is hit, and hit words are a twentieth of all words at least."""
    return (hit_words() > 0) & (20 * hit_words() >= F.col("__n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Documents that are not contaminated, with all their own columns; see `find_contamination`."""
    rows, back = packed(docs, text_col)
    return find_contamination(rows, benchmark, text_col=text_col, **options).where(~contaminated()).select(*back)
