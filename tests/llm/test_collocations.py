import random
import re
from collections import Counter

import pytest

from tidecycle.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top, least, longest=5):
    f, n, out = {}, Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[i : i + m])] += 1
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inner = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= 100 * c[p[i:j]]}
        rows = []
        for p, a in cand.items():
            if p not in inner:
                s, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((" ".join(p), a, c[p[:k]], c[p[k:]], n[lang], s))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows[:top], 1)]
    return sorted(out)


def texts(seed, n=300):
    rng = random.Random(seed)
    words = ["a", "b", "c", "D", "é", "x\x01", "\x01", "漢", "don't", "b\x02"]
    out = []
    for _ in range(n):
        w = [rng.choice(words[: rng.choice([2, 4, 10])]) for _ in range(rng.randrange(30))]
        out.append((rng.choice(["en", "de", "", None, "und", "a\tb\n"]), "".join(x + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b"]) for x in w)))
    return out


@pytest.mark.parametrize("block_words,bits,top", [(2_000_000, 26, 2000), (200, 9, 7)])
def test_against_brute_force(spark, block_words, bits, top):
    rows = texts(1) + [("en", "hot pair " * 400), (None, None), ("en", ""), ("fr", "only a few words")]
    df = spark.createDataFrame([(*r, 1, "m") for r in rows], "lang string, text string, f int, phrase string").repartition(5)
    found = co.collocations(df, top=top, least=5, block_words=block_words, bits=bits)
    assert sorted(tuple(r) for r in found.drop("m").collect()) == brute(rows, top, 5)


def test_one_text_of_many_words(spark):
    text = " ".join(f"w{i % 7} w{i % 11}" for i in range(30_000))
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    assert sorted(tuple(r) for r in co.collocations(df, top=50, block_words=1000).drop("m").collect()) == brute([("en", text)], 50, 100)


def test_odd_rows_and_an_empty_table(odd, docs):
    assert co.collocations(odd, least=2).count() > 0
    assert co.collocations(docs([])).collect() == []
    assert co.collocations(docs([(1, None), (2, " \t\n")])).collect() == []


def test_counts_past_64_bits(spark):
    """The score's products in decimals."""
    from pyspark.sql import functions as F

    n = spark.range(1).select(F.expr("cast(30000000000000 as decimal(18,0)) * cast(90000000000000 as decimal(18,0)) * cast(1000 as decimal(4,0)) div (cast(40000000000000 as decimal(18,0)) * cast(50000000000000 as decimal(18,0)))").alias("x")).first().x
    assert n == 1000 * 30000000000000 * 90000000000000 // (40000000000000 * 50000000000000)
