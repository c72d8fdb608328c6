import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecycle.llm import exact_dedup, sharding

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = keep(known) if known else None
        seen = False
        for i in ids:
            out.append((i, best, len(ids), i == best and not seen, hashlib.sha256(t.encode()).hexdigest()))
            seen |= i == best
    return sorted(out, key=str)


@pytest.mark.parametrize("hash_bytes", [16, 0])
def test_dedup_against_brute_force(odd, hash_bytes):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = exact_dedup.exact_dedup(odd, keep="max", hash_bytes=hash_bytes).collect()  # 0 bytes: all texts collide
    assert sorted(map(tuple, found), key=str) == brute(rows, max)
    assert sorted(map(tuple, exact_dedup.exact_dedup(odd).collect()), key=str) == brute(rows, min)


def test_dedup_of_the_sample_and_of_nothing(sample, docs):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert sorted(map(tuple, exact_dedup.exact_dedup(sample, keep="max").collect()), key=str) == brute(rows, max)
    assert exact_dedup.exact_dedup(docs([])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 100, 1000, 65537])
def test_feistel_is_a_permutation(n):
    f = sharding.Feistel(n, 5)
    y = f.forward(np.arange(n))
    assert sorted(y.tolist()) == list(range(n))
    assert f.inverse(y).tolist() == list(range(n))


def test_shards_are_even_gapless_and_computable(odd, sample):
    for df in (odd, sample):
        x = sharding.shard_rows(df, 7, seed=3)
        rows = x.collect()
        n = df.count()
        assert len(rows) == n and sorted(r.row_number for r in rows) == list(range(n))
        counts = [sum(r.shard == s for r in rows) for s in range(7)]
        assert max(counts) - min(counts) <= 1
        for s in range(7):
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
        f = sharding.Feistel(n, 3)
        assert all(int(f.forward(np.array([r.row_number]))[0]) == r.position == r.slot * 7 + r.shard for r in rows)


def test_shards_do_not_depend_on_partitions(sample):
    a = sharding.shard_rows(sample.repartition(1)).select("doc_id", "shard", "slot").collect()
    b = sharding.shard_rows(sample.repartition(9, F.rand(1))).select("doc_id", "shard", "slot").collect()
    assert sorted(a) == sorted(b)


def test_shard_sizes_and_checksums(odd):
    for r in sharding.shard_rows(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), 3).join(odd.dropDuplicates(["doc_id"]).select("doc_id", "text"), "doc_id").collect():
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))


def test_no_rows_no_shards(docs):
    assert sharding.shard_rows(docs([])).count() == 0


def feistel_plain(x, n, seed, rounds=6):
    """The permutation in plain integers, written apart from the operator."""
    m = 2**64 - 1

    def mix(v):
        v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 & m
        v = (v ^ v >> 27) * 0x94D049BB133111EB & m
        return v ^ v >> 31

    half = max(1, -(-max(n - 1, 1).bit_length() // 2))
    keys = [mix(k * 0x9E3779B97F4A7C15 + seed & m) for k in range(1, rounds + 1)]
    while True:
        a, b = divmod(x, 1 << half)
        for k in keys:
            a, b = b, a ^ mix(b + k & m) % (1 << half)
        x = b << half | a
        if x < n:
            return x


def test_query_of_shards_against_plain_integers(spark):
    from tidecycle.llm import queries

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op3_feistel_sharding(spark, sf).collect()
    n = len(out)
    assert sorted(r.doc_id for r in out) == sorted(texts) and sorted(r.row_number for r in out) == list(range(n))
    assert [r.doc_id for r in sorted(out, key=lambda r: r.row_number)] == sorted(texts)
    for r in out:
        place = feistel_plain(r.row_number, n, 17)
        assert (r.position, r.shard, r.slot) == (place, place % 40, place // 40)
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]), "rows", None)
