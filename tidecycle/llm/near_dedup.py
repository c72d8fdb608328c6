"""Jaccard similarity join of documents on word n-grams, by MinHash banding with exact verification."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BASE, materialize, materialize_with, mix, packed, slices, utf8, word_hashes, words

BLOCK, WIDTH = 256, 16_384  # members and n-grams that are compared at a time: dense blocks of 16 MB


def choose_bands(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows a band, so the fewest false candidates, with which a pair at `threshold` meets in some band with probability `recall` under `hashes` hashes in all."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= hashes:
            return bands, rows
    raise ValueError("too few hashes for this recall")


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of words; a text of fewer words, but some, is one n-gram; none gives none."""
    ws = words(text)
    if not ws:
        return np.zeros(0, np.uint64)
    h = word_hashes(ws)
    m = min(n, len(h))
    code = np.zeros(len(h) - m + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(m):
            code = code * BASE + h[j : len(h) - m + 1 + j]
        return np.unique(mix(code + np.uint64(m)))


def _signatures(n: int, bands: int, rows: int):
    rng = np.random.default_rng(20240229)
    factors = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for batch in slices(batches, 2):
            sets = [shingles(t, n) for t in utf8(batch.column(2))]
            prints, keys = [], [None] * len(sets)
            for s in sets:
                prints.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
            # Equal sets of a batch are hashed once.
            first = {p: i for i, p in reversed(list(enumerate(prints))) if p is not None}
            full = sorted(first.values())
            for lo in range(0, len(full), 512):
                part = full[lo : lo + 512]
                flat = np.concatenate([sets[i] for i in part])
                starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in part])[:-1]])
                with np.errstate(over="ignore"):
                    least = np.stack([np.minimum.reduceat(flat * f, starts) for f in factors], 1).reshape(len(part), bands, rows)
                    code = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(part), bands)).copy()
                    for r in range(rows):
                        code = mix(code * BASE + least[:, :, r])
                for i, c in zip(part, code.view(np.int64).tolist()):
                    keys[i] = c
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array([keys[first[p]] if p is not None else None for p in prints], pa.list_(pa.int64()))],
                names=["id", "th", "set", "n", "bands"],
            )

    return run


def _components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the least node of the connected component of each node of the edges.

    Every round each node takes the least label among its neighbours and itself, then the label of that label; rounds
    are written to the shared folder, and only the number of changes goes to the driver. Rounds grow with the logarithm
    of a component's width. The joins are between plain shuffles, so that AQE may split nodes of many edges and labels
    of many nodes.
    """
    ways = F.array(F.struct(F.col(a).alias("u"), F.col(b).alias("v")), F.struct(F.col(b).alias("u"), F.col(a).alias("v")))
    both = materialize(edges.where(F.col(a) != F.col(b)).select(F.explode(ways).alias("e")).select("e.u", "e.v").distinct())
    labels = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root")).withColumnRenamed("u", "node"))
    while True:
        seen = both.join(labels.select(F.col("node").alias("v"), "root"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(seen, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        step, changes = materialize_with(step.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("far", "root")).alias("root")), F.count_if(F.col("old") != F.col("root")))
        if not changes:
            return step.select("node", "root")
        labels = step.select("node", "root")


def _stars(keys: DataFrame, node: str, bucket: str) -> DataFrame:
    """Edges (a, b) that connect the nodes of each bucket: as many as (node, bucket) pairs at most, whatever the size of a bucket.

    A node hangs on one head per bucket at most; its other heads are hung on the least of them, so that a group has
    about one edge per member once repeated edges are dropped.
    """
    heads = keys.groupBy(bucket).agg(F.min(node).alias("head"), F.count("*").alias("k")).where("k > 1").select(bucket, "head")
    hung = keys.join(heads, bucket).where(F.col(node) != F.col("head")).groupBy(F.col(node).alias("a")).agg(F.collect_set("head").alias("heads"))
    hung = hung.select("a", "heads", F.array_min("heads").alias("b"))
    return hung.select(F.explode(F.array_append("heads", F.col("a"))).alias("a"), "b").where("a <> b")


def _grams(sized: DataFrame) -> DataFrame:
    """(root, grams): n-grams of the members of each component."""
    return sized.groupBy("root").agg(F.sum("n").alias("grams"))


def _frequent(n: int, bits: int):
    """(place, count) in a table of 2**bits hashed counts of the n-grams that two or more members of a component in this task have."""

    def run(batches):
        counts = np.zeros(1 << bits, np.int32)
        for batch in slices(batches, 2):
            for root, t in zip(batch.column(0).to_pylist(), utf8(batch.column(2))):
                np.add.at(counts, _place(shingles(t, n), root, bits), 1)
        at = np.flatnonzero(counts > 1)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at].astype(np.int64))], names=["place", "count"])

    return run


def _place(grams: np.ndarray, root: bytes, bits: int) -> np.ndarray:
    """Place of the n-grams of a component in the table."""
    with np.errstate(over="ignore"):
        return (mix(grams ^ np.frombuffer(root[:8], np.uint64)[0]) >> np.uint64(64 - bits)).astype(np.int64)


def prefix_length(n: int, threshold: float) -> int:
    """So many of the first n-grams, in an order that all sets share, that two sets of a Jaccard similarity of `threshold` have one of them in common."""
    return n - math.ceil(threshold * n - 1e-9) + 1


def _prefixes(n: int, bits: int, threshold: float, shared):
    """(cell, node): the rarest n-grams of each member, by the shared table, as many as `prefix_length` says."""

    def run(batches):
        counts = np.zeros(1 << bits, np.int32)
        at, many = (np.frombuffer(x, np.int64) for x in shared.value)
        counts[at] = np.minimum(many, 2**31 - 1)
        for batch in slices(batches, 2):
            cells, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for k, (root, t) in enumerate(zip(batch.column(0).to_pylist(), utf8(batch.column(2)))):
                g = shingles(t, n)
                first = g[np.lexsort([g, counts[_place(g, root, bits)]])[: prefix_length(len(g), threshold)]]
                with np.errstate(over="ignore"):
                    cells.append(mix(first * BASE ^ np.frombuffer(root[:8], np.uint64)[0]))
                owner.append(np.full(len(first), k))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells).view(np.int64)), batch.column(1).take(pa.array(np.concatenate(owner)))], names=["cell", "node"])

    return run


def _parted(texts: DataFrame, n: int, threshold: float, bits: int) -> DataFrame:
    """(node, root): candidate components (root, node, text) parted without loss.

    Two sets of similarity `threshold` have one of their first n-grams in common, in any order of the n-grams that both
    share (`prefix_length`). The order here is by how many members of the component have an n-gram, rarest first, as far as a
    table of 2**bits counts knows (16 MB at 22 bits, sent to every task; what it lumps together changes the order, never
    the result). So members that share only what all pages of a template have part at a cost in proportion to their number.
    """
    spark = texts.sparkSession
    table = texts.select("root", "node", "text").mapInArrow(_frequent(n, bits), "place long, count long").groupBy("place").agg(F.sum("count").alias("count"))
    rows = table.toArrow()  # 2**bits rows at most
    shared = spark.sparkContext.broadcast(tuple(rows.column(c).to_numpy().astype(np.int64).tobytes() for c in ("place", "count")))
    cells = materialize(texts.select("root", "node", "text").mapInArrow(_prefixes(n, bits, threshold, shared), "cell long, node binary"))
    return _components(_stars(cells, "node", "cell"))


def _verify(n: int, threshold: float):
    """Links of all pairs of a group: (i, i) chunks hold one side, (i, j) two. One row per member, with its linked weight here and an edge of a spanning forest of the links found."""

    def run(pdf):
        import pandas as pd

        pdf = pdf.drop_duplicates("set").reset_index(drop=True)
        sets = [shingles(t.encode() if t is not None else None, n) for t in pdf["text"]]
        sizes = np.array([len(s) for s in sets])
        weight, side = pdf["size"].to_numpy(), (pdf["part"] == pdf["i"]).to_numpy()
        same = bool((pdf["i"] == pdf["j"]).all())
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        df = np.diff(np.concatenate([starts, [len(flat)]]))
        shared = np.repeat(df > 1, df)  # grams that one member has alone can't be common
        rows, cols = owner[shared], np.repeat(np.cumsum(df > 1) - 1, df)[shared]
        by_row = np.lexsort([cols, rows])
        rows, cols = rows[by_row], cols[by_row]
        bounds = np.searchsorted(rows, np.arange(len(sets) + 1))
        links, root = np.zeros(len(sets), np.int64), np.arange(len(sets))
        left = np.arange(len(sets)) if same else np.flatnonzero(side)
        right = left if same else np.flatnonzero(~side)
        for lo in range(0, len(left), BLOCK):
            a = left[lo : lo + BLOCK]
            own = np.unique(np.concatenate([cols[bounds[m] : bounds[m + 1]] for m in a]))  # only these can be in common
            for ro in range(lo if same else 0, len(right), BLOCK):
                b = right[ro : ro + BLOCK]
                both = np.zeros((len(a), len(b)), np.float32)
                for c in range(0, len(own), WIDTH):
                    part = own[c : c + WIDTH]
                    both += _dense(a, cols, bounds, part) @ _dense(b, cols, bounds, part).T
                union = sizes[a][:, None] + sizes[b][None, :] - both
                x, y = np.nonzero(both >= threshold * union - 1e-9)
                x, y = a[x], b[y]
                if same and ro == lo:
                    x, y = x[x < y], y[x < y]
                np.add.at(links, x, weight[y])
                np.add.at(links, y, weight[x])
                _unite(root, x, y)
        return pd.DataFrame({"set": pdf["set"], "links": links, "other": pdf["set"].to_numpy()[_tops(root)]})

    return run


def _dense(members: np.ndarray, cols: np.ndarray, bounds: np.ndarray, part: np.ndarray) -> np.ndarray:
    """0/1 rows of the members over the columns `part`."""
    out = np.zeros((len(members), len(part)), np.float32)
    for k, m in enumerate(members.tolist()):
        c = cols[bounds[m] : bounds[m + 1]]
        at = np.minimum(np.searchsorted(part, c), len(part) - 1)
        out[k, at[part[at] == c]] = 1
    return out


def _tops(root: np.ndarray) -> np.ndarray:
    while True:
        up = root[root]
        if (up == root).all():
            return root
        root = up


def _unite(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Union-find over many edges: each turn the first open edge of each node; those inside a component go."""
    while True:
        top = _tops(root)
        root[:] = top
        px, py = top[x], top[y]
        open_ = px != py
        if not open_.any():
            return
        x, y = x[open_], y[open_]
        hi, lo = np.maximum(px, py)[open_], np.minimum(px, py)[open_]
        hi, first = np.unique(hi, return_index=True)
        root[hi] = lo[first]  # from greater to less: no cycle


#: Bits of a sieve: a table of 2**18 words of 64 bits at most, which is sent to every task.
SIEVE_BITS = 24


def _sieved(rows: DataFrame, row_id: Column, row_th: Column, keys: DataFrame, key_id: str, key_th: str) -> DataFrame:
    """`rows` with a boolean `__in`: false only for rows that are none of `keys`, by a map of one bit per hash of (id, th). It tells before a join which rows need not be shuffled; its size is bounded, and false positives only are shuffled in vain."""
    place = lambda a, b: F.xxhash64(a, b).bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    found = keys.select(place(F.col(key_id), F.col(key_th)).alias("__place"))
    words = found.groupBy(F.shiftright("__place", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(__place & 63 AS int))")).alias("__bits"))
    at = rows.withColumn("__place", place(row_id, row_th)).withColumn("__word", F.shiftright("__place", 6))
    hit = F.coalesce(F.expr("shiftrightunsigned(__bits, cast(__place & 63 AS int)) & 1 = 1"), F.lit(False))
    return at.join(F.broadcast(words), "__word", "left").withColumn("__in", hit).drop("__word", "__bits", "__place")


def similarity_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, hashes: int = 128, id_col: str = "doc_id", text_col: str = "text", chunk_grams: int = 1 << 18, sketch_bits: int = 22) -> DataFrame:
    """One row per input row: id, th (hash of the text), set_id, n_grams, class_id, copies, links.

    Two documents are linked when the Jaccard similarity of their sets of word n-grams is `threshold` or more.
    `links` is the number of other documents linked to this one, `copies` how many of those have the same set, and
    `class_id` the least id of all documents that links connect with it. Texts of fewer than n words are one n-gram;
    texts without words (null and empty ones too) have no links and are a class each, with their own id. Null ids
    come last; where all ids of a class are null, so is its class_id. Repeated rows count as documents each. Other
    columns are not read; an empty table gives none.

    1. Signatures: a scan gives each row a 128-bit print of its set and its band hashes (`choose_bands`). Rows of equal
       sets are one class member from here on (partial aggregation before the shuffle).
    2. Shuffle on band hashes; members that share a bucket are joined to the least member of it - a star, as many
       rows as members - and stars are merged into candidate components.
    3. Components of over `chunk_grams` n-grams are parted by the n-grams that similar sets must share (`_parted`).
    4. Verification on the full sets: the text of one row per member goes to its component. What is still over
       `chunk_grams` n-grams, a group of texts that are truly close, is cut into chunks, and pairs of chunks are tasks of their own. Pairs are counted
       inside, never written: a task returns one row per member with its links and an edge of a spanning forest.
    5. Components of the forests are the classes.
    """
    bands, per_band = choose_bands(threshold, recall, hashes)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    signed = materialize(rows.mapInArrow(_signatures(n, bands, per_band), f"id {id_type}, th long, set binary, n long, bands array<long>"))
    members = signed.where("set IS NOT NULL").groupBy("set").agg(F.count("*").alias("size"), F.min("id").alias("least_id"), F.max("n").alias("n"), F.min(F.struct("id", "th")).alias("row"), F.first("bands").alias("bands"))
    members = materialize(members)
    comps = _components(_stars(members.select("set", F.explode("bands").alias("band")), "set", "band"))
    sized = comps.join(members.select(F.col("set").alias("node"), "size", "n", "row.id", "row.th"), "node")
    picked = materialize(sized.join(_grams(sized), "root"))
    # Only the texts of candidates are shuffled.
    near = _sieved(rows, F.col("id"), F.col("th"), picked, "id", "th").where("__in").select("id", "th", "text")
    texts = near.join(picked, (near["id"].eqNullSafe(picked["id"])) & (near["th"] == picked["th"])).select("node", "root", "grams", "size", "n", "text")
    texts, most = materialize_with(texts, F.max("grams"))
    if (most or 0) > chunk_grams:
        large = texts.where(F.col("grams") > chunk_grams)
        parts = materialize(_parted(large, n, threshold, sketch_bits).join(large.select("node", "n"), "node"))
        moved = large.drop("root", "grams", "n").join(parts.join(_grams(parts), "root"), "node")
        texts = texts.where(F.col("grams") <= chunk_grams).unionByName(moved)
    # Chunks: a member of a component of c chunks goes to the c pairs that hold its chunk.
    placed = texts.withColumn("chunks", F.ceil(F.col("grams") / chunk_grams).cast("int")).withColumn("part", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.struct(F.least(k, F.col("part")).alias("i"), F.greatest(k, F.col("part")).alias("j")))
    tasks = placed.withColumn("p", F.explode(pairs)).select("root", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "part", F.col("node").alias("set"), "size", "text")
    checked = materialize(tasks.groupBy("root", "i", "j").applyInPandas(_verify(n, threshold), "set binary, links long, other binary"))
    linked = checked.groupBy("set").agg(F.sum("links").alias("links"))
    classes = _components(checked.where("set <> other").select(F.col("set").alias("a"), F.col("other").alias("b")))
    final = members.select("set", "size", "least_id").join(classes.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    tops = final.groupBy("root").agg(F.min("least_id").alias("class_id"))
    # Written, so that the join with the rows is between two plain shuffles, whose hot sets AQE may split.
    final = materialize(final.join(tops, "root").join(linked, "set", "left").select("set", "size", "class_id", F.coalesce("links", F.lit(0)).alias("links")))
    some = signed.where("set IS NOT NULL").join(final, "set").select("id", "th", F.hex("set").alias("set_id"), F.col("n").alias("n_grams"), "class_id", (F.col("size") - 1).alias("copies"), (F.col("links") + F.col("size") - 1).alias("links"))
    none = signed.where("set IS NULL").select("id", "th", F.lit(None).cast("string").alias("set_id"), F.lit(0).cast("long").alias("n_grams"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("links"))
    return some.unionByName(none).withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with one row of each class that holds more than one document: that of the least id (null ids last; of equal ids the least text hash, of identical rows any one)."""
    found = similarity_classes(docs, id_col=id_col, text_col=text_col, **options).where("links > 0")
    found = found.groupBy("class_id", F.col(id_col).alias("__id"), F.col("th").alias("__th")).agg(F.count("*").alias("__times"))
    first = found.groupBy("class_id").agg(F.min(F.struct(F.col("__id").isNull(), "__id", "__th")).alias("k")).select(F.col("class_id").alias("c"), F.col("k.__id").alias("kid"), F.col("k.__th").alias("kth"))
    same = found["class_id"].eqNullSafe(first["c"])
    keeps = found["__id"].eqNullSafe(first["kid"]) & (found["__th"] == first["kth"])
    marks = materialize(found.join(first, same).select("__id", "__th", "__times", keeps.alias("__keep")))

    def key(x: DataFrame):
        return x["__row_id"].eqNullSafe(F.col("__id")) & (x["__row_th"] == F.col("__th"))

    rows, back = packed(docs, id_col, text_col)
    rows = rows.withColumn("__row_id", F.col(id_col)).withColumn("__row_th", F.xxhash64(text_col))
    # Only rows that may go are shuffled.
    sieved = _sieved(rows, F.col("__row_id"), F.col("__row_th"), marks.where("NOT __keep"), "__id", "__th")
    unsure = sieved.where("__in").drop("__in")
    out = sieved.where("NOT __in").drop("__in").unionByName(unsure.join(marks.where("NOT __keep"), key(unsure), "left_anti"))
    repeated = marks.where("__keep AND __times > 1")
    if repeated.limit(1).count():
        several = out.join(repeated, key(out), "left_semi").dropDuplicates(["__row_id", "__row_th"])
        out = out.join(repeated, key(out), "left_anti").unionByName(several)
    return out.select(*back)
