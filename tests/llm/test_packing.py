import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidecycle.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_and_bound(lengths):
    lengths.sort(reverse=True)
    bins, offsets, free = packing.best_fit(lengths, 64)
    used = defaultdict(list)
    for b, o, n in zip(bins, offsets, lengths):
        used[b].append((o, n))
    for b, xs in used.items():
        at = 0
        for o, n in sorted(xs):
            assert o == at
            at += n
        assert at <= 64 and free[b] == 64 - at
    assert packing.lower_bound(np.array(lengths, int), 64) <= len(free)


def test_bound_knows_halves():
    assert packing.lower_bound(np.array([33] * 10), 64) == 10
    assert packing.lower_bound(np.array([22] * 9), 64) == 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"ab'st .,!\n\t\r\x0b\u00a0\u2003\u3000\u200b\ufeff é漢1٣½Ⅷ-_€\U0001f600\u0301  ", "<|endoftext|>"]), max_size=40).map("".join))
def test_ids_equal_the_library(text):
    ids = packing._ids(PATH)
    assert np.frombuffer(ids.encode(text), "<u4").tolist() == ids.whole.encode(text, add_special_tokens=False).ids


def test_white_space_around_a_blank():
    ids = packing._ids(PATH)
    for text in ("\u00a0 \u00a0", "a \u3000 \u3000b", "x\n \ny", " \u00a0", "a\u00a0 b", "a \u00a0b"):
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == ids.whole.encode(text, add_special_tokens=False).ids


def verify(df, out, capacity=1024):
    whole = Tokenizer.from_file(PATH)
    texts = defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        texts[r.doc_id].append(whole.encode(r.text or "", add_special_tokens=False).ids + [2])
    pieces = defaultdict(list)
    for r in out.collect():
        pieces[r.doc_id].append(r)
    assert pieces.keys() == texts.keys()
    for i, ps in pieces.items():
        for ids in texts[i]:
            mine = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in ps})
            assert [s for _, s, _, _ in mine] == np.cumsum([0, *[n for _, _, n, _ in mine]])[:-1].tolist()
            assert sum(n for _, _, n, _ in mine) == len(ids) and all(n == capacity for k, _, n, _ in mine if k)
            assert all(zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) == c for _, s, n, c in mine)
        assert len(ps) == len(mine) * len(texts[i])
    bins = defaultdict(list)
    for r in out.collect():
        bins[r.sequence_id].append((r.offset, r.length))
    for xs in bins.values():
        at = 0
        for o, n in sorted(xs):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins), sum(n for xs in bins.values() for _, n in xs)


def test_round_trip_of_the_sample(sample):
    bins, tokens = verify(sample, packing.pack_documents(sample, PATH).cache())
    assert bins <= 1.02 * tokens / 1024 + 2


def test_many_partitions_exchange_documents(sample):
    one, tokens = verify(sample, packing.pack_documents(sample, PATH).cache())
    many, _ = verify(sample, packing.pack_documents(sample, PATH, per_partition=10).cache())
    # Each partition of the first deal may need one bin more than its share.
    assert many <= one + -(-sample.count() // 10)


def test_odd_rows(odd, docs):
    verify(odd, packing.pack_documents(odd, PATH).cache())
    assert packing.pack_documents(docs([]), PATH).count() == 0
    assert packing.pack_documents(docs([None]), PATH).select(F.sum("length")).first()[0] == 1


def test_every_partition_is_certified_or_gains_nothing(spark):
    """Lengths for which one deal leaves gaps: the rounds go on, and the query says how good each partition is."""
    rng = np.random.default_rng(2)
    items = spark.createDataFrame([(i, int(x)) for i, x in enumerate(rng.integers(200, 500, 4000))], "uid long, length long")
    out = packing.pack_lengths(items, 1024, per_partition=100).toPandas()
    assert sorted(out.uid) == list(range(4000)) and (out.bins >= out.bound).all()
    one = packing.pack_lengths(items, 1024, per_partition=10**6).toPandas()
    assert one.sequence_id.nunique() == one.bins[0] and out.sequence_id.nunique() <= 1.02 * one.sequence_id.nunique()


def test_query_reports_its_certificate(spark):
    out = queries.op2_best_fit_packing(spark, "/root/testdata/sf0.001").toPandas()
    placed = out[out.length < 1024]
    assert (placed.bins >= placed.bound).all() and placed.sequence_id.nunique() == placed.bins.iloc[0]
