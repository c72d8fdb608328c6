import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from tidecycle.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens():
    """Ids and their bytes of whole texts, by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    chars = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    names = {chr(c): c for c in chars}
    for c in range(256):
        if c not in chars:
            names[chr(256 + sum(x not in chars for x in range(c)))] = c
    assert decoders is not None

    def run(text):
        if not text:
            return [], []
        a = [(i, bytes(names[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()) for i in sp.encode(text) for p in [sp.id_to_piece(i)]]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    return run


def brute(rows, tokens):
    per = []
    for i, text in rows:
        a, b = tokens(text)
        ends = []
        for side in (a, b):
            at, out = 0, []
            for name, x in side:
                at += len(x)
                out.append((at, name))
            ends.append(out)
        links = [(x, y) for e, x in ends[0] for f, y in ends[1] if e == f] if len(a) < 60 else [(x, other[e]) for other in [dict(ends[1])] for e, x in ends[0] if e in other]
        cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        said, lo = [], 0
        for c in cuts:
            said.append("|".join(",".join(str(x) for e, x in side if lo < e <= c) for side in ends))
            lo = c
        per.append((i, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(said).encode()).hexdigest() if a else ""))
    count = Counter(x for p in per for x in p[4])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted([(i, na, nb, g, len(k), sum(count[x] == most[x[1]] for x in k), sum(count[x] for x in k), sha) for i, na, nb, g, k, sha in per], key=str)


def found(df):
    out = al.align_tokenizers(df, A, B)
    return sorted([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out.collect()], key=str)


def test_tables(sample, tokens):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert found(sample.repartition(3)) == brute(rows, tokens)


def test_odd_texts(docs, tokens):
    rng = random.Random(8)
    alphabet = ["a", "b", "the", " ", " ", "  ", "\n", "\t", "\r\n", "　", "\xa0", "\x1c", "\x85", "▁", "é", "é", "漢字", "\U0001f600", "'s", "<s>", "<0x0A>", "<|endoftext|>", "\x00", "1234", "...", "ﬁ", "​"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 25))) for _ in range(600)]
    rows = list(enumerate([*texts, None, "", " ", "   ", "▁", "a ▁ b", "x" * 5000, "ab" * 3000 + "  end", " lead", "trail "])) + [(None, "the same"), (3, "the same"), (3, "the same")]
    assert found(docs(rows)) == brute(rows, tokens)


def test_pieces_are_taken_alone(tokens):
    """With all white space and many other characters of Unicode, tokens of the pieces are those of the whole."""
    for c in [c for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000 and (chr(c).isspace() or c < 0x180 or c % 97 == 0)]:
        x = chr(c)
        for text in (f"x {x}", f"{x} y", f"{x} {x}", f"a {x} b", f"a{x} {x}b", f" {x}  z {x}1"):
            parts, whole = al.pieces(text), tokens(text)
            if any(map(al.odd, parts)):
                parts = al.careful_pieces(text)
            if whole[0]:
                got = [tokens(p[1:]) for p in parts]
                assert [y for a, _ in got for y in a] == whole[0] and [y for _, b in got for y in b] == whole[1], (hex(c), text)


def test_a_worker_forgets(docs, tokens, monkeypatch):
    a = al.Aligner(A, B)
    monkeypatch.setattr(al, "KNOWN", 5)
    for k in range(4):
        n, said, links = a.align([f"word{k} other thing{k}", None, "x▁ y"])
        want = tokens(f"word{k} other thing{k}")
        assert n[0].tolist()[:2] == [len(want[0]), len(want[1])] and n[1:].sum() == 0 and said[1:] == ["", ""] and len(links[0]) == n[0][2]


def test_pairs_are_bounded_by_the_vocabularies():
    assert 100_000 < al.most_pairs(al._aligner(A, B)) < 3_000_000


def test_empty_table(docs):
    assert found(docs([])) == []
    assert found(docs([(1, None)])) == [(1, 0, 0, 0, 0, 0, 0, "")]
