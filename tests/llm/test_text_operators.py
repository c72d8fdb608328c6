"""Line dedup, LM scoring, toxicity, PII, URL filters and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from tidecycle.llm import line_dedup, lm_scoring, pii, queries, toxicity, url_filters
from tidecycle.llm.common import materialize, words

SF = "/root/testdata/sf0.001"


def test_sql_of_the_queries_agrees(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        a = queries.QUERIES[name](spark, SF).toPandas()
        b = con.execute(sql).df()
        cols = sorted(a.columns)
        assert cols == sorted(b.columns), name
        key = lambda df: sorted(str(tuple(None if x != x or x is None else x for x in r)) for r in df[cols].astype(object).itertuples(index=False))
        assert key(a) == key(b), name


def test_lines_of_a_host(docs):
    texts = ["menu\nfoo bar", " menu \nbaz", "menu\nqux\nmenu", "other", None, "", "menu"]
    x = line_dedup.drop_boilerplate(docs(texts), ratio=0.5, min_pages=3, certain=4)
    got = {r.doc_id: (r.text, r["__n_lines"], r["__n_dropped"]) for r in x.collect()}
    # The last page is nothing but boilerplate and stays.
    assert got == {0: ("foo bar", 2, 1), 1: ("baz", 2, 1), 2: ("qux", 3, 2), 3: ("other", 1, 0), 4: (None, 0, 0), 5: ("", 1, 0), 6: ("menu", 1, 0)}
    few = line_dedup.drop_boilerplate(docs(texts[:4]), ratio=0.5, min_pages=3)
    assert sorted(r["__n_dropped"] for r in few.collect())[:2] == [0, 0] and "\n".join(r.text for r in few.collect()).count("menu") in (1, 2)  # one page keeps it
    assert x.columns == [*docs(texts).columns, "__n_lines", "__n_dropped"]
    assert line_dedup.drop_boilerplate(docs([])).count() == 0


def test_lines_are_relative_to_their_host(docs):
    a, b = docs([f"x y\n{i}" for i in range(3)], "a"), docs([(i, f"x y\n{i}" if i < 13 else f"t{i}") for i in range(10, 60)], "b")
    out = line_dedup.drop_boilerplate(a.union(b).union(docs([(99, "x y")]).withColumn("source", F.lit(None).cast("string"))), ratio=0.5, min_pages=3, certain=3)
    assert {r.doc_id: r["__n_dropped"] for r in out.collect() if r.doc_id < 13} == {0: 1, 1: 1, 2: 1, 10: 0, 11: 0, 12: 0}


@pytest.mark.parametrize("pages", [1, 2, 5, 19, 20, 60])
def test_no_text_loses_its_last_copy(docs, pages):
    """Copies, near copies and pages of boilerplate alone, on hosts of all sizes: every line of every text is still on its host."""
    menu = [f"menu\nfoot\nown {i}" for i in range(pages)]
    copies = ["a b c\nd e f"] * pages
    near = [f"shared one\nshared two\nnumber {i % 2}" for i in range(pages)]
    for texts in (menu, copies, near, menu + copies + near, [*menu, "menu\nfoot", "menu"], ["T", "T", "U"][:pages]):
        out = line_dedup.drop_boilerplate(docs(list(enumerate(texts)))).select("doc_id", "text").collect()
        left = {line for r in out for line in r.text.split("\n")}
        assert all(r.text.strip() for r in out)
        own = {line for t in texts for line in t.split("\n")} - {"menu", "foot"}
        assert own <= left, (pages, own - left)
        if texts is menu and pages >= 20:
            assert not left & {"menu", "foot"}


def lm_brute(rows, order, backoff=0.4):
    toks = [(i, words((t or "").encode())) for i, t in rows]
    grams = lambda ws, n: Counter(tuple(ws[k : k + n]) for k in range(len(ws) - n + 1))
    every = {n: sum((grams(ws, n) for _, ws in toks), Counter()) for n in range(1, order + 1)}
    total, out = sum(every[1].values()), []
    for i, ws in toks:
        c = {n: every[n] - grams(ws, n) for n in every}
        rest, s = max(total - len(ws), 1), 0.0
        for k, w in enumerate(ws):
            back = 0
            for n in range(min(order, k + 1), 1, -1):
                g = tuple(ws[k - n + 1 : k + 1])
                if c[n][g] > 0:
                    s += math.log10(c[n][g] / c[n - 1][g[:-1]]) + back * math.log10(backoff)
                    break
                back += 1
            else:
                s += math.log10(max(c[1][w,], 1) / rest) + (back + (c[1][w,] == 0)) * math.log10(backoff)
        out.append((i, len(ws), round(s / len(ws), 6) if ws else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes,order", [(8 << 20, 2), (3000, 2), (3000, 1), (3000, 4)])
def test_scores_against_brute_force(odd, docs, block_bytes, order):
    df = odd.union(docs([(20, "the same text here for all of us and more"), (21, "text here for all"), (22, "for all of us and more")]))
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_words, None if r.score is None else round(r.score, 6)) for r in lm_scoring.stupid_backoff(df, order, block_bytes=block_bytes).collect()), key=str)
    assert got == lm_brute(rows, order)


def test_scores_of_nothing(docs):
    assert lm_scoring.stupid_backoff(docs([])).count() == 0


def test_toxicity_is_learnt(spark):
    rng = random.Random(0)
    plain = [f"{a}{b}" for a in ("ta", "ri", "mo", "ke", "su") for b in ("na", "lo", "ri", "ta", "mi", "du", "pe")]
    bad = ["scoundrel", "nitwitted", "blockhead", "dunderhead"]
    docs, labels = [], []
    for i in range(1600):
        ws = [rng.choice(plain) for _ in range(rng.randrange(30, 120))]
        if i % 4 == 0:
            for _ in range(4):
                ws[rng.randrange(len(ws))] = rng.choice(bad)
        docs.append((i, " ".join(ws)))
        labels.append((i, int(i % 4 == 0)))
    d, y = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(d, queries.learnable(y))
    out = {r.doc_id: r["__score"] for r in toxicity.score(d, model).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((out[i] >= 0.5) == (i % 4 == 0) for i in held) / len(held)
    assert right >= 0.95


def test_score_from_the_dictionaries_by_hand(odd):
    """Score of each text: windows of whole words, compressed with either dictionary content in front of the ordinary one, and the two logistic curves."""
    model = toxicity.Model([b" scoundrel  nitwitted ", b" blockhead  scoundrel "], b" the quick brown fox  same text here ", [[-2.0, 1.5, -0.3], [-1.0, 0.7, 0.1]])

    def length(window, content):
        p = zstandard.ZstdCompressionParameters.from_level(7, min_match=6, write_checksum=0, write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        return len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=p).compress(window))

    def by_hand(text):
        out, cur = [], b""
        for w in (text or "").lower().encode().split():
            cur += b" " + w
            if len(cur) >= 64:
                out.append(cur)
                cur = b""
        out += [cur] * bool(cur)
        z = 0
        for content, (c, a, b) in zip(model.toxic, model.weights):
            saved = sum(max(0, length(w, model.ordinary) - length(w, content + model.ordinary)) for w in out)
            z += (c + a * math.log1p(saved) + b * math.log1p(len(out))) / 2
        return 1 / (1 + math.exp(-z))

    texts = ["you scoundrel and blockhead", "Same text here", "SCOUNDREL " * 40, None, ""]
    assert model.score(texts) == pytest.approx([by_hand(t) for t in texts])
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(r["__score"] == pytest.approx(by_hand(r.text)) for r in rows)


def test_query_of_toxicity_learns_from_the_other_rows_alone(spark):
    out = queries.op9_toxicity(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in out)
    kept = {r.doc_id for r in queries.learnable(spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert kept and not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in kept)


def test_toxicity_without_labels_and_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(odd, none)
    out = toxicity.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r["__score"] < 0.5 for r in out)


def test_copies_do_not_fill_the_sample(spark):
    texts = [f"word{i} some text of number {i}" for i in range(80)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").orderBy(F.xxhash64("t")).collect()
    first, others = rows[0].t, [r.t for r in rows[1:]]
    docs = [(k, first) for k in range(50)] + [(100 + k, t) for k, t in enumerate(others[:40])] + [(200 + k, t) for k, t in enumerate(others[40:])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame([(i, int(i < 200)) for i, _ in docs], "doc_id long, toxic int")
    assert toxicity.train(d, y, per_class=30).weights  # 50 copies of the text of least hash


def test_windows_are_spread_over_all_texts():
    texts = [" ".join(f"{a}{i:03d}" for i in range(400)) for a in "abcd"]
    got = toxicity._spread(texts, 40)
    assert len(got) == 40 and [sum(w[1:2] == a for w in got) for a in (b"a", b"b", b"c", b"d")] == [10] * 4
    assert toxicity._spread(texts, 10**6) == [w for t in texts for w in toxicity.windows(t)]


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(s):
    d = [int(c) for c in s][::-1]
    return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0


def base_brute(text):
    out = []
    for kind, p in BASE.items():
        for m in p.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))) or (kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)) or (kind == "phone" and 9 <= len(digits) <= 15)
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


ODD_TEXTS = ["a@b.c", "a@b@c.d", "x..y%@q-.z.w. é@b.c é a@b", "@@a@b.c.d@e.f", "1.2.3.4.5.6.7.8", "256.1.1.1 001.02.255.0000255", "4111 1111 1111 1111 x 4111-1111-1111-1112", "+1 (017) 555-7713 +1234", "4111111111111111" * 2, "", None, "+49 30 1234567. a.b+c@d-e.f.g-h", "a" * 5000 + "@" + "b" * 50]


def test_base_spans(docs):
    out = {r.doc_id: r for r in pii.find_pii(docs(ODD_TEXTS)).select("doc_id", pii.span_text(F.col("base")).alias("b"), pii.span_text(F.concat("base", "added")).alias("a")).collect()}
    for i, t in enumerate(ODD_TEXTS):
        assert out[i].b == base_brute(t or "")
        assert set(filter(None, out[i].b.split(","))) <= set(filter(None, out[i].a.split(",")))


@pytest.mark.parametrize("text", ["7" * 1_000_000, "1." * 500_000, "1.2.3." * 200_000 + "4", "+" * 300_000 + "1" * 9, "+1 " * 300_000, "4111 " * 200_000, "a@" * 300_000, "+1" + "(" * 300_000, "0-" * 500_000, "9.9.9.999 " * 100_000])
def test_long_runs_take_linear_time(text):
    import time

    began = time.process_time()
    pii.base_spans(text)
    assert time.process_time() - began < 3


def test_addresses_as_the_plain_pattern_finds_them():
    import random

    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices("0123.. a+-", k=rng.randrange(40)))
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in BASE["ip"].finditer(text)]


def test_query_of_pii(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op10_pii(spark, SF).collect():
        want = base_brute(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(f"{k}:") for k in BASE]


def test_contexts_find_unseen_identifiers(docs):
    texts = [f"please ring me at +49 30 12345{k:02d} today" for k in range(10)] + ["please ring me at 030 5551234 today", "room 030 5551234 is free", "count 1234567 apples"]
    out = {r.doc_id: r.added for r in pii.find_pii(docs(texts)).collect()}
    assert [x.k for x in out[10]] == [3] and texts[10][out[10][0].s : out[10][0].e] == "030 5551234"
    assert [x.k for x in out[11]] == [3]  # the identifier is known by now
    assert not out[12] and not any(out[k] for k in range(10))
    assert pii.find_pii(docs([])).count() == 0


def test_others_do_not_count_against_a_kind(docs):
    texts = [f"please ring me at +49 30 12345{k:02d} today" for k in range(10)] + [f"please ring me at user{k}@host today" for k in range(6)] + ["please ring me at 030 5551234 today"]
    out = {r.doc_id: r.added for r in pii.find_pii(docs(texts)).collect()}
    assert [x.k for x in out[16]] == [3] and not any(out[k] for k in range(16))


def test_chains_are_followed_to_their_end(docs):
    texts, sizes, value = [], [320, 80, 20, 5, 1], lambda j, i: f"+49 30 {1000000 + i}" if j == 0 else f"030 {j}{100000 + i}"
    for j, n in enumerate(sizes):
        a = chr(97 + j)
        texts += [f"{a}one {a}two {value(j, i)} {a}three" for i in range(n)]
        if j:
            b = chr(96 + j)
            texts += [f"{b}one {b}two {value(j, i)} {b}three" for i in range(n)]
    last = [i for i, t in enumerate(texts) if value(4, 0) in t]
    out = {r.doc_id: r.added for r in pii.find_pii(docs(texts)).collect()}
    assert len(last) == 2 and all([x.k for x in out[i]] == [3] for i in last)  # found in the fourth round
    short = {r.doc_id: r.added for r in pii.find_pii(docs(texts), rounds=3).collect()}
    assert not any(short[i] for i in last)


def test_url_rules_and_templates(spark):
    urls = ["http://www.Example.ORG/es/1", "https://a.org/x?y", "http://example.org/en/12", "http://example.org/en/2", "http://xorg/en", "x://a.com/fr/", "x://a.com/de/9#z", "x://a.com", "no url", None, "", "ftp://h/a://b.org/", "x://a.com/de"]
    df = spark.createDataFrame([(i, u, "mine", 5) for i, u in enumerate(urls)], "page_id int, url string, host string, __shape int")
    got = {r.page_id: r for r in url_filters.judge_urls(df, queries.RULES).collect()}
    want = ["example.org/es/", "org/", "example.org/en/1", "org/", None, "com/fr/", "com/de/", None, None, None, None, None, None]
    assert [got[i].rule for i in range(len(urls))] == want
    assert (got[0].host, got[0].path, got[8].host, got[8].path, got[11].host) == ("www.example.org", "/es/1", "", "", "h")
    assert all(got[i].verdict in ("allow", "block") for i in got)
    assert got[0].asDict()["__shape"] == 5
    assert url_filters.judge_urls(df.limit(0), queries.RULES).count() == 0


def test_url_templates_are_learnt(spark):
    urls = [f"http://h.net/bad/{i}.html" for i in range(40)] + [f"http://h.net/good/{i}" for i in range(40)] + ["http://h.net/bad/new7.html", "http://h.net/good/77"]
    known = spark.createDataFrame([(u, "/bad/" in u) for u in urls[:80]], "url string, blocked boolean")
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: r.verdict for r in url_filters.judge_urls(df, [], known).collect()}
    assert got[80] == "block" and got[81] == "allow"


def tree_brute(urls, known, variable_children=12, smoothing=4.0, alpha=0.05):
    """(host, shape) -> (template, purity); urls and known labels as (host, path[, blocked])."""

    def shape(path):
        return tuple("*" + (re.search(r"\.[A-Za-z]+$", x) or [""])[0] if re.search("[0-9]", x) else x for x in path.split("/") if x)

    n, l, b = Counter(), Counter(), Counter()
    for h, p in urls:
        n[h, shape(p)] += 1
    for h, p, bad in known:
        n[h, shape(p)] += 1
        l[h, shape(p)] += 1
        b[h, shape(p)] += bad
    prior = sum(b.values()) / sum(l.values()) if l else 0.5
    out = {}

    def walk(shapes, level, template, above):
        purity = (sum(b[s] for s in shapes) + smoothing * above) / (sum(l[s] for s in shapes) + smoothing)
        kids = defaultdict(list)
        for s in shapes:
            if len(s[1]) == level:
                out[s] = (template or "/", purity)
            else:
                kids[s[1][level]].append(s)
        if len(kids) > variable_children:
            kids = {"*": [s for v in kids.values() for s in v]}

        def shares(v):
            c = Counter()
            for s in v:
                c[s[1][level + 1] if len(s[1]) > level + 1 else ""] += n[s]
            if sum(k != "" for k in c) > variable_children:
                c = Counter({"*": sum(x for k, x in c.items() if k), **({"": c[""]} if c[""] else {})})
            total = sum(c.values())
            return total, {k: x / total for k, x in c.items()}

        groups = []
        for total, seg, d in sorted(((*shares(v)[:1], k, shares(v)[1]) for k, v in kids.items()), key=lambda x: (-x[0], x[1])):
            for lead, many, members in groups:
                bound = math.sqrt(math.log(2 / alpha) / 2) * (1 / math.sqrt(many) + 1 / math.sqrt(total)) + 1e-9
                if all(abs(lead.get(k, 0) - d.get(k, 0)) <= bound for k in {*lead, *d}):
                    members.append(seg)
                    break
            else:
                groups.append((d, total, [seg]))
        for _, _, members in groups:
            name = "{" + "|".join(sorted(members)) + "}" if len(members) > 1 else members[0]
            walk([s for m in members for s in kids[m]], level + 1, f"{template}/{name}", purity)

    for host in {h for h, _ in n}:
        walk([s for s in n if s[0] == host], 0, "", prior)
    return out, shape


def split_url(u):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_brute(host, path):
    fits = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_query_of_urls_against_brute_force(spark):
    """Every verdict, template and purity of the table."""
    rows = [(r.page_id, *split_url(r.url)) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    ruled = {i: rule_brute(h, p) for i, h, p in rows}
    want, shape = tree_brute([(h, p) for i, h, p in rows if not ruled[i]], [(h, p, ruled[i].verdict == "block") for i, h, p in rows if ruled[i]])
    got = queries.op5_url_filters(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    for r, (i, h, p) in zip(sorted(got, key=lambda r: r.page_id), sorted(rows)):
        template, purity = want[h, shape(p)]
        rule = ruled[i]
        assert (r.page_id, r.host, r.path, r.rule) == (i, h, p, rule.name if rule else None)
        assert r.template == template and r.purity == pytest.approx(purity, abs=1e-8)
        assert r.verdict == (rule.verdict if rule else "block" if purity >= 0.8 else "allow")


def test_tree_of_random_urls_against_brute_force(spark):
    rng = random.Random(5)
    urls = []
    for _ in range(900):
        segs = [rng.choice(["a", "b", "c", "d", f"n{rng.randrange(9)}", f"{rng.randrange(50)}.html", rng.choice("efghijklmnopqrstuv")]) for _ in range(rng.randrange(7))]
        urls.append((f"h{rng.randrange(3)}.net", "/" + "/".join(segs)))
    known = [(h, p, int("/b" in p)) for h, p in urls[:300]]
    urls += [("long.net", "/" + "/".join(["seg"] * 40) + "x" * 9000)] * 2 + [("", "")]
    df = spark.createDataFrame([(i, f"http://{h}{p}" if h else None, "clash") for i, (h, p) in enumerate(urls)], "page_id int, url string, template string")
    labels = spark.createDataFrame([(f"http://{h}{p}", bool(b)) for h, p, b in known], "url string, blocked boolean")
    want, shape = tree_brute(urls, known)
    got = sorted(url_filters.judge_urls(df, [], labels).collect(), key=lambda r: r.page_id)
    assert len(got) == len(urls)
    for r, (h, p) in zip(got, urls):
        template, purity = want[h, shape(p)]
        assert r.template == template and r.purity == pytest.approx(purity, abs=1e-9)


def test_long_paths_cost_their_branches(spark, monkeypatch):
    """Traps: a path of 5000 segments, one that grows by a segment at a time, and a branch deep down."""
    rounds = []
    plain = url_filters._down_chains
    monkeypatch.setattr(url_filters, "_down_chains", lambda *a: rounds.append(1) or plain(*a))
    deep = "/" + "/".join(["loop"] * 300)
    urls = [("t.net", "/" + "/".join(["s"] * 5000))] * 2 + [("g.net", "/x" * k) for k in range(60)] + [("b.net", deep + x) for x in ("/a/end", "/b/other", "/b/other/more")]
    known = [("g.net", "/x" * k, k % 3 == 0) for k in range(0, 60, 2)] + [("t.net", "/" + "/".join(["s"] * 70), True), ("b.net", deep, True)]
    df = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate(urls)], "page_id int, url string")
    labels = spark.createDataFrame([(f"http://{h}{p}", bool(b)) for h, p, b in known], "url string, blocked boolean")
    got = sorted(url_filters.judge_urls(df, [], labels).collect(), key=lambda r: r.page_id)
    assert len(rounds) <= 3
    import sys

    sys.setrecursionlimit(20_000)
    want, shape = tree_brute(urls, [(h, p, int(b)) for h, p, b in known])
    for r, (h, p) in zip(got, urls):
        template, purity = want[h, shape(p)]
        assert r.template == template and r.purity == pytest.approx(purity, abs=1e-9)


def test_labels_reach_siblings_and_children(spark):
    known = [(f"http://h.net/a/b/c/spam/{i}.html", True) for i in range(30)] + [(f"http://h.net/a/b/c/news/{i}", False) for i in range(30)]
    known += [(f"http://h.net/x/p/go/{i}/", True) for i in range(60)]
    urls = ["http://h.net/a/b/c/spam/77.html", "http://h.net/a/b/c/news/77"] + [f"http://h.net/x/q/go/{i}" for i in range(9)] + [f"http://h.net/x/r/stay/{w}" for w in "abc"] + ["http://h.net/", "http://h.net", None]
    df = spark.createDataFrame(list(enumerate(u for u in [*urls, *(k for k, _ in known)])), "page_id int, url string")
    got = {r.page_id: r for r in url_filters.judge_urls(df, [], spark.createDataFrame(known, "url string, blocked boolean")).collect()}
    assert (got[0].verdict, got[1].verdict) == ("block", "allow")  # parted at the fourth level
    assert got[2].template.startswith("/x/{p|q") and got[2].verdict == "block"  # the sibling's labels reach it
    assert got[14].template == got[15].template == got[16].template == "/" and len(got) == len(urls) + len(known)
    assert url_filters.judge_urls(df.limit(0), []).count() == 0


def words_of(text):
    return words((text or "").encode())


def stages_by_hand(rows, model, bench):
    """The first four stages over (doc_id, text, source) rows with ids that differ: what each keeps."""
    out = []
    rows = [r for r in rows if model.score([r[1]])[0] < 0.5]
    out.append(sorted(rows, key=str))
    pages, on = defaultdict(set), defaultdict(lambda: defaultdict(set))
    for _, t, host in rows:
        page = int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16)
        pages[host or ""].add(page)
        for x in {x.strip(" ") for x in (t or "").split("\n")} - {""}:
            on[host or ""][x].add(page)
    bad = {h: {x: min(s) if len(s) < 20 else None for x, s in c.items() if len(s) >= 2 and len(s) > 0.1 * len(pages[h])} for h, c in on.items()}

    def cut(t, host):
        page = int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
        left = [x for x in t.split("\n") if bad.get(host, {}).get(x.strip(" "), page) == page]
        return "\n".join(left) if any(x.strip(" ") for x in left) else t

    rows = [(i, None if t is None else cut(t, h or ""), h) for i, t, h in rows]
    out.append(sorted(rows, key=str))
    sets = [{tuple(w[k : k + min(5, len(w))]) for k in range(len(w) - min(5, len(w)) + 1)} if (w := words_of(t)) else set() for _, t, _ in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                old, new = root[a], root[b]
                root = [new if x == old else x for x in root]
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[root[k]] = min(least.get(root[k], i), i)
    rows = [r for k, r in enumerate(rows) if r[0] == least[root[k]]]
    out.append(sorted(rows, key=str))
    windows = {tuple(w[k : k + min(13, len(w))]) for t in bench if (w := words_of(t)) for k in range(len(w) - min(13, len(w)) + 1)}
    sizes = {len(x) for x in windows}

    def hit(t):
        w = words_of(t)
        found = {p for m in sizes for k in range(len(w) - m + 1) if tuple(w[k : k + m]) in windows for p in range(k, k + m)}
        return found and 20 * len(found) >= len(w)

    out.append(sorted([r for r in rows if not hit(r[1])], key=str))
    return out


def pipeline_case(spark, cp, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.train(docs, queries.learnable(spark.read.parquet(f"{sf}/labels.parquet")))
    want = stages_by_hand([(r.doc_id, r.text, r.source) for r in docs.collect()], model, [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    step = docs
    for (name, stage), rows in zip(cp.STAGES, want):
        step = materialize(stage(spark, step, sf))
        assert step.columns == docs.columns, name
        assert sorted([(r.doc_id, r.text, r.source) for r in step.collect()], key=str) == rows, name
        assert all(r.n_chars == len(r.text) for r in step.collect() if r.text is not None), name
    packed = cp.STAGES[-1][1](spark, step, sf).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in want[-1]}
    assert sorted(map(tuple, cp.run(spark, sf).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    return want


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "best_fit_packing"]
    pipeline_case(spark, cp, SF)


def test_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    import corpus_pipeline as cp

    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark")}
    odd_rows = [(10**6, None, None, "s"), (10**6 + 1, "", "en", None), (10**6 + 2, " \n\n ", None, None), (10**6 + 3, "same five words stand here", "en", "s"), (10**6 + 4, "same five words stand here", "en", "s"), (10**6 + 5, " ".join(f"w{i}" for i in range(30_000)), "en", "s")]
    more = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in odd_rows], "doc_id long, text string, lang string, source string, n_chars long")
    tables["documents"].limit(60).select(more.columns).unionByName(more).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    tables["labels"].unionByName(spark.createDataFrame([(None, 1, None), (10**6, None, 1)], tables["labels"].schema)).write.parquet(str(tmp_path / "a" / "labels.parquet"))
    tables["benchmark"].unionByName(spark.createDataFrame([(None, None)], tables["benchmark"].schema)).write.parquet(str(tmp_path / "a" / "benchmark.parquet"))
    pipeline_case(spark, cp, str(tmp_path / "a"))
    for t, df in tables.items():
        df.limit(0).write.parquet(str(tmp_path / "b" / f"{t}.parquet"))
    assert cp.run(spark, str(tmp_path / "b")).count() == 0


def test_long_and_repeated_rows(spark, docs):
    """Line dedup and personal data: very long texts and lines, repeated rows, null ids."""
    long = "menu\n" + "x" * 300_000 + "\n" + "\n".join(f"line {i}" for i in range(20_000))
    rows = [(1, long), (1, long), (2, "menu"), (None, "a@b.c"), (None, "a@b.c"), (3, "a" * 200_000 + " 4111 1111 1111 1111 " + "b" * 200_000)]
    out = line_dedup.drop_boilerplate(docs(rows), ratio=0.4).collect()
    assert len(out) == 6 and [r["__n_dropped"] for r in out if r.doc_id == 2] == [0] and [r["__n_lines"] for r in out if r.doc_id == 1] == [20_002] * 2
    found = pii.find_pii(docs(rows)).select("doc_id", pii.span_text(F.col("base")).alias("b")).collect()
    assert sorted((str(r.doc_id), r.b) for r in found) == sorted([("1", ""), ("1", ""), ("2", ""), ("None", "email:0:5"), ("None", "email:0:5"), ("3", "card:200001:200020")])
