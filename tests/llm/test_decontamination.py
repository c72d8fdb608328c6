import hashlib
import random

import pytest
import regex
from pyspark.sql import functions as F

from tidecycle.llm import decontamination as dc
from tidecycle.llm.common import WORD_PATTERN

WORD = regex.compile(WORD_PATTERN)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items, window=13):
    wins = {}
    for name, t in items:
        w = words(t)
        m = min(window, len(w))
        for s in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[s : s + m]), set()).add("" if name is None else str(name))
    sizes = {len(k) for k in wins}
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for m in sizes:
            for s in range(len(w) - m + 1):
                g = tuple(w[s : s + m])
                if g in wins:
                    hit |= set(range(s, s + m))
                    found |= wins[g]
        out.append((i, len(w), len(hit), ",".join(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def found(df, bench, **o):
    x = dc.find_contamination(df, bench, **o)
    return sorted(map(tuple, x.select("doc_id", "__n_words", dc.hit_words().alias("h"), F.array_join("__items", ",").alias("i"), dc.contaminated().alias("c")).collect()), key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_against_brute_force(spark, sample, block_bytes):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    assert found(sample.limit(60) if block_bytes < 1000 else sample, bench, block_bytes=block_bytes) == brute(rows[:60] if block_bytes < 1000 else rows, items)


def test_small_items_boundaries_and_nulls(spark, odd, docs):
    bench = spark.createDataFrame([(1, "Same TEXT here"), (10, "all"), (2, None), (None, "漢字"), (3, "..."), (1, "us"), (4, " ".join(f"w{i}" for i in range(40)))], "item_id int, text string")
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(odd, bench) == brute(rows, [(r.item_id, r.text) for r in bench.collect()])
    split = docs(["a b c d e f", "g h i j k l m n"])
    whole = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id int, text string")
    assert all(r[2] == 0 for r in found(split, whole))  # never across two documents
    assert dc.decontaminate(docs([]), bench).count() == 0
    assert found(odd, bench.limit(0)) == brute(rows, [])


def test_removal_keeps_columns(spark, odd):
    bench = spark.createDataFrame([(1, "same text here for all of us")], "item_id int, text string")
    out = dc.decontaminate(odd, bench)
    assert out.columns == odd.columns and out.count() == odd.count() - 3


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def brute_matches(text, items, window):
    """All pairs of places: (start, words, item, start in the item) of verbatim matches that count, and those spans that are not part of another."""
    w, out = words(text), []
    for name, t in items:
        v = words(t)
        m = min(window, len(v))
        for p in range(len(w)):
            for s in range(len(v)):
                n = 0
                while p + n < len(w) and s + n < len(v) and w[p + n] == v[s + n]:
                    n += 1
                if n >= m:
                    out.append((p, n, name, s))
    spans = {(p, n) for p, n, _, _ in out}
    return out, {(p, n) for p, n in spans if not any(q <= p and q + k >= p + n and (q, k) != (p, n) for q, k in spans)}


@pytest.mark.parametrize("window", [1, 3, 4, 13, 70, 200])
def test_longest_matches_against_brute_force(spark, docs, window):
    rng = random.Random(window)
    items, texts = [], []
    for k in range(12):
        n = rng.choice([1, 2, 3, 5, 12, 30, 90, 230])
        items.append((f"i{k}", " ".join(f"w{rng.randrange(rng.choice([3, 40]))}" for _ in range(n))))
    for _ in range(25):
        w = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(60))]
        v = rng.choice(items)[1].split()
        a = rng.randrange(len(v))
        w[rng.randrange(len(w) + 1) : 0] = v[a : a + rng.randrange(1, 240)]
        texts.append(" ".join(w))
    texts += [items[3][1], "", None]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for block_bytes in (32 << 20, 2000):
        out = {r.doc_id: r for r in dc.find_contamination(docs(texts), bench, window=window, block_bytes=block_bytes).withColumn("top", dc.longest_match()).collect()}
        for i, t in enumerate(texts):
            every, outer = brute_matches(t, items, window)
            got = [(m.start, m.words, m.item, m.item_start) for m in out[i]["__matches"]]
            assert {(s, n) for s, n, _, _ in got} == outer and set(got) <= set(every) and len(got) == len(outer)
            assert out[i].top == max((n for _, n in outer), default=0)
            assert sum(x.e - x.s for x in out[i]["__spans"]) == len({p for s, n, _, _ in every for p in range(s, s + n)})


def test_a_passage_in_many_items_and_documents(spark, docs):
    passage = " ".join(f"p{i}" for i in range(120))
    bench = spark.createDataFrame([(i, f"own{i} {passage} end{i}") for i in range(300)], "item_id int, text string")
    out = dc.find_contamination(docs([f"d{i} {passage}" for i in range(300)] + ["clean text"]), bench).select("doc_id", F.size("__items").alias("n"), dc.longest_match().alias("m"), dc.hit_words().alias("h")).collect()
    assert {(r.n, r.m, r.h) for r in out if r.doc_id < 300} == {(300, 120, 120)} and [(r.n, r.m) for r in out if r.doc_id == 300] == [(0, 0)]
