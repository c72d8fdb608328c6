import random

import numpy as np
import pytest
import xxhash

from tidecycle.llm import simhash as sh


def print_of(text):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(prints, reach=2):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= reach:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def close_prints(rng, n):
    """Random fingerprints, chains of them and tight clusters."""
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 30])):
            out.add(x)
            for _ in range(rng.randrange(1, 5)):
                x ^= 1 << rng.randrange(64)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("text", ["", None, " \t\n", "one", "One two", "a b c", "a b c a b c a b c", "é　x y\x1cz w", "word " * 50_000])
def test_fingerprint(text):
    assert sh.fingerprint(text.encode() if text is not None else None) == print_of(text)


def test_spark_hashes_alike(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.xxhash64(F.lit("the sea was")).alias("h")).first().h % 2**64 == xxhash.xxh64_intdigest(b"the sea was", 42)


@pytest.mark.parametrize("dense", [sh.DENSE, 2])
@pytest.mark.parametrize("leaf", [256, 4])
def test_forest_finds_every_link(monkeypatch, leaf, dense):
    monkeypatch.setattr(sh, "LEAF", leaf)
    prints = close_prints(random.Random(leaf), 900)
    found = sh.forest(prints, np.ones(len(prints), bool), 2, dense)
    want = roots(prints.tolist())
    assert len(set(zip(found.tolist(), want))) == len(set(want)) == len(set(found.tolist()))


def test_dealt_shards_hold_every_pair():
    prints = close_prints(random.Random(5), 1500)
    tree = sh.Tree(prints[::3], 12, 2)
    row, shard, home = tree.deal(prints)
    assert tree.leaves > 4 and (np.bincount(row[home]) == 1).all()
    at = {(r, s) for r, s in zip(row.tolist(), shard.tolist())}
    own = dict(zip(row[home].tolist(), shard[home].tolist()))
    for i in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2)
        assert all((j, own[i]) in at for j in near.tolist())


def test_query_against_brute_force(docs):
    rng = random.Random(2)
    texts = []
    for _ in range(60):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([1, 2, 5, 120]))]
        for _ in range(rng.choice([1, 2, 4])):
            w = list(base)
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    rows = [(1000 - i, t) for i, t in enumerate([*texts, None, "", " ", "Same Text of four", "same text OF four"])] + [(None, "same text of four"), (None, "nobody knows me at all"), (7, "w"), (7, "w")]
    prints = [print_of(t) for _, t in rows]
    root = roots(prints)
    want = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[k] and rows[j][0] is not None]
        want.append((i, prints[k], min(ids, default=None)))
    found = [(r.doc_id, r.fp % 2**64, r.component_id) for r in sh.near_fingerprints(docs(rows), per_shard=20).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_odd_rows_and_an_empty_table(odd, docs):
    assert sh.near_fingerprints(odd).count() == odd.count()
    assert sh.near_fingerprints(docs([])).collect() == []
