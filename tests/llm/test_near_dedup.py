import random

import pytest

from tidecycle.llm import near_dedup as nd
from tidecycle.llm.common import words


def sets_of(texts, n=5):
    out = []
    for t in texts:
        w = words((t or "").encode())
        m = min(n, len(w))
        out.append({tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if w else set())
    return out


def brute(rows, threshold=0.8):
    sets = sets_of([t for _, t in rows])
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[x][0] for x in range(n) if find(x) == find(k)]
        known = [x for x in ids if x is not None]
        out.append((i, links[k], (min(known) if known else None) if sets[k] else i))
    return sorted(out, key=str)


def near(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
    return " ".join(w)


def result(df, **o):
    return sorted(((r.doc_id, r.links, r.class_id) for r in nd.similarity_classes(df, **o).collect()), key=str)


def test_bands_reach_the_recall():
    b, r = nd.choose_bands(0.8, 0.9999, 128)
    assert b * r <= 128 and 1 - (1 - 0.8**r) ** b >= 0.9999


@pytest.mark.parametrize("chunk_grams", [1 << 18, 400])
def test_against_brute_force(docs, chunk_grams):
    rng = random.Random(4)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([30, 60, 200]))]
        texts += [near(rng, base, rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(12)]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) for _ in range(10)]
    rows = list(enumerate(texts))
    assert result(docs(rows), chunk_grams=chunk_grams) == brute(rows)


def test_odd_rows(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert result(odd) == brute(rows)
    assert result(docs([])) == [] and nd.keep_one(docs([])).count() == 0


def test_one_of_each_group_stays(odd, sample):
    for df in (odd, sample):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        found = brute(rows)
        grouped = {c for _, k, c in found if k}
        want = sorted([i for i, k, _ in found if not k] + list(grouped), key=str)
        out = nd.keep_one(df)
        assert out.columns == df.columns
        assert sorted([r.doc_id for r in out.collect()], key=str) == want


def test_many_copies_and_near_copies(docs):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)] * 300 + [near(rng, base, 1) for _ in range(500)] + ["alone in the world, quite alone"]
    out = result(docs(texts), chunk_grams=20_000)
    assert out == brute(list(enumerate(texts)))


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95, 1.0])
def test_first_grams_of_similar_sets_meet(threshold):
    rng = random.Random(7)
    for _ in range(3000):
        a = set(rng.sample(range(60), rng.randrange(1, 40)))
        b = {x for x in a if rng.random() > 0.15} | set(rng.sample(range(60), rng.randrange(0, 4)))
        order = {x: rng.random() for x in range(60)}
        if b and len(a & b) >= threshold * len(a | b) - 1e-9:
            first = [set(sorted(s, key=order.get)[: nd.prefix_length(len(s), threshold)]) for s in (a, b)]
            assert first[0] & first[1]


@pytest.mark.parametrize("bits", [22, 4])
def test_pages_of_a_template_part(docs, bits):
    rng = random.Random(3)
    menu = [f"menu{i}" for i in range(65)]
    texts = [" ".join(menu + [f"w{rng.randrange(10**6)}" for _ in range(42)]) for _ in range(150)]
    texts += [near(rng, texts[k % 5].split(), 1) for k in range(40)]
    rows = list(enumerate(texts))
    assert result(docs(rows), chunk_grams=2000, sketch_bits=bits) == brute(rows)


def test_components_of_stars_and_chains(spark):
    edges = [(0, i) for i in range(1, 1500)] + [(2000 + i, 2001 + i) for i in range(9)] + [(1499, 3000)]
    got = {r.node: r.root for r in nd._components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1500)}, 3000: 0, **{2000 + i: 2000 for i in range(10)}}
