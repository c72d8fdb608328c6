"""The registered queries of the training-data operators, one per operator, over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, collocations, decontamination, exact_dedup, line_dedup, lm_scoring, near_dedup, packing, pii, sharding, simhash, toxicity, url_filters
from .common import table

#: SQL that several texts share: A-Z lower-cased; the words of a text.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="max")


OP1_SQL = f"""
WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_rows(table(spark, sf_dir, "documents"), shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number", "position")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        decontamination.hit_words().alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
        decontamination.longest_match().alias("longest"),
    )


OP4_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS rid, CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
places AS (
  SELECT rid, item, s, least(len(w), 13) AS m, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT rid, item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0)),
win AS (SELECT DISTINCT item, m, g FROM places),
sizes AS (SELECT DISTINCT m FROM win),
heads AS (SELECT DISTINCT m, g FROM win),
spots AS (
  SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT doc_id, m, s, g FROM spots JOIN heads USING (m, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits JOIN win USING (m, g)) GROUP BY doc_id),
diagonals AS (SELECT doc_id, rid, h.m, h.s - p.s AS d, h.s - row_number() OVER (PARTITION BY doc_id, rid, h.s - p.s ORDER BY h.s) AS run FROM hits h JOIN places p ON h.m = p.m AND h.g = p.g),
longest AS (SELECT doc_id, max(k) AS longest FROM (SELECT doc_id, m + count(*) - 1 AS k FROM diagonals GROUP BY doc_id, rid, m, d, run) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(longest, 0) AS longest
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
"""

#: The rules that the query applies before the method.
RULES = [
    url_filters.Rule("allow", "org/"),
    url_filters.Rule("block", "example.org/es/"),
    url_filters.Rule("block", "example.org/en/1"),
    url_filters.Rule("allow", "com/fr/"),
    url_filters.Rule("block", "com/de/"),
]


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 9).alias("purity"))


def _level_sql(k: int) -> str:
    """One level of the template tree: l<k> (host, shape, n, l, b, template, purity) to l<k + 1>."""
    return rf"""
a{k} AS (SELECT *, shape[{k + 1}] AS g, count(DISTINCT shape[{k + 1}]) OVER (PARTITION BY host, template) AS k FROM l{k}),
b{k} AS (SELECT * EXCLUDE (g, k), CASE WHEN g IS NULL THEN NULL WHEN k > 12 THEN '*' ELSE g END AS seg FROM a{k}),
c{k} AS (SELECT host, template, seg, coalesce(shape[{k + 2}], '') AS kid, sum(n) AS n FROM b{k} WHERE seg IS NOT NULL GROUP BY ALL),
e{k} AS (SELECT *, sum(n) OVER (PARTITION BY host, template, seg) AS total, count(nullif(kid, '')) OVER (PARTITION BY host, template, seg) AS many FROM c{k}),
d{k} AS (SELECT host, template, seg, CASE WHEN many > 12 AND kid <> '' THEN '*' ELSE kid END AS kid, sum(n) / any_value(total) AS p, any_value(total) AS total FROM e{k} GROUP BY 1, 2, 3, 4),
s{k} AS (SELECT *, row_number() OVER (PARTITION BY host, template ORDER BY total DESC, seg) AS r FROM (SELECT DISTINCT host, template, seg, total FROM d{k})),
w{k} AS (SELECT x.host, x.template, x.r AS ra, y.r AS rb, x.seg AS sa, y.seg AS sb, x.total AS ta, y.total AS tb FROM s{k} x JOIN s{k} y ON x.host = y.host AND x.template = y.template AND x.r < y.r),
u{k} AS (
  SELECT host, template, ra, rb, ta, tb, kid, sum(pa) - sum(pb) AS gap FROM (
    SELECT w.host, w.template, ra, rb, ta, tb, kid, p AS pa, 0 AS pb FROM w{k} w JOIN d{k} d ON d.host = w.host AND d.template = w.template AND d.seg = w.sa
    UNION ALL SELECT w.host, w.template, ra, rb, ta, tb, kid, 0, p FROM w{k} w JOIN d{k} d ON d.host = w.host AND d.template = w.template AND d.seg = w.sb) GROUP BY ALL),
v{k} AS (
  SELECT host, template, rb AS r, list(ra) AS alike FROM (
    SELECT host, template, ra, rb FROM u{k} GROUP BY host, template, ra, rb, ta, tb HAVING max(abs(gap)) <= sqrt(ln(2 / 0.05) / 2) * (1 / sqrt(ta) + 1 / sqrt(tb)) + 1e-9) GROUP BY 1, 2, 3),
g{k} AS (
  SELECT host, template, r, [r] AS leads, r AS lead FROM s{k} WHERE r = 1
  UNION ALL
  SELECT host, template, r, CASE WHEN m IS NULL THEN list_append(leads, r) ELSE leads END, coalesce(m, r) FROM (
    SELECT s.host, s.template, s.r, leads, list_min(list_intersect(leads, coalesce(alike, CAST([] AS BIGINT[])))) AS m
    FROM g{k} g JOIN s{k} s ON s.host = g.host AND s.template = g.template AND s.r = g.r + 1 LEFT JOIN v{k} v ON v.host = s.host AND v.template = s.template AND v.r = s.r)),
m{k} AS (SELECT host, template, seg, CASE WHEN count(*) OVER w > 1 THEN '{{' || string_agg(seg, '|') OVER (PARTITION BY host, template, lead ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) || '}}' ELSE seg END AS name
  FROM g{k} JOIN s{k} USING (host, template, r) WINDOW w AS (PARTITION BY host, template, lead)),
n{k} AS (SELECT b.host, shape, n, l, b, b.template || coalesce('/' || name, '') AS template, name IS NOT NULL AS new, purity FROM b{k} b LEFT JOIN m{k} m ON m.host = b.host AND m.template = b.template AND m.seg = b.seg),
l{k + 1} AS (SELECT host, shape, n, l, b, template, CASE WHEN new THEN (sum(b) OVER w + 4.0 * purity) / (sum(l) OVER w + 4.0) ELSE purity END AS purity FROM n{k} WINDOW w AS (PARTITION BY host, template, new))"""


#: Levels that the SQL unrolls; paths of the tables have two segments. The operator has no such bound.
LEVELS = 3
OP5_SQL = rf"""
WITH RECURSIVE p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, name, rhost, rpath) AS (VALUES
  ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
  ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
fit AS (
  SELECT page_id, arg_max(name, length(name)) AS rule, arg_max(verdict, length(name)) AS by_rule FROM p, rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
r AS (
  SELECT p.page_id, host, path, rule, by_rule,
         list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
           lambda s: CASE WHEN regexp_matches(s, '[0-9]') THEN '*' || regexp_extract(s, '(\.[A-Za-z]+)$', 1) ELSE s END) AS shape
  FROM p LEFT JOIN fit USING (page_id)),
sh AS (SELECT host, shape, count(*) AS n, count(by_rule) AS l, count(*) FILTER (WHERE by_rule = 'block') AS b FROM r GROUP BY 1, 2),
prior AS (SELECT CASE WHEN sum(l) > 0 THEN sum(b) / sum(l) ELSE 0.5 END AS q FROM sh),
l0 AS (SELECT sh.*, '' AS template, (sum(b) OVER w + 4.0 * q) / (sum(l) OVER w + 4.0) AS purity FROM sh, prior WINDOW w AS (PARTITION BY host)),
{",".join(map(_level_sql, range(LEVELS)))}
SELECT page_id, r.host, path, rule, coalesce(by_rule, CASE WHEN purity >= 0.8 THEN 'block' ELSE 'allow' END) AS verdict, CASE WHEN t.template = '' THEN '/' ELSE t.template END AS template, round(purity, 9) AS purity
FROM r JOIN l{LEVELS} t ON r.host = t.host AND r.shape = t.shape
"""


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.similarity_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "links", "copies", "n_grams")


OP7_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda s: array_to_string(w[s:s + least(len(w), 5) - 1], ' ')))) AS g FROM d WHERE len(w) > 0),
e AS (SELECT doc_id, unnest(g) AS x FROM g),
n AS (SELECT doc_id, len(g) AS n, count(*) OVER (PARTITION BY g) - 1 AS copies FROM g),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
p AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE k >= 0.8 * (x.n + y.n - k)),
r AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a),
l AS (SELECT a AS doc_id, count(*) AS links FROM p GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(c.least, d.doc_id)) AS class_id, coalesce(links, 0) AS links, coalesce(copies, 0) AS copies, coalesce(n, 0) AS n_grams
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("text_sha256"))


OP8_SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, text, ('0x' || md5(coalesce(text, ''))[1:15])::BIGINT AS page, string_split(text, chr(10)) AS ls FROM documents),
n AS (SELECT host, count(DISTINCT page) AS host_pages FROM d GROUP BY host),
c AS (SELECT host, line, count(DISTINCT page) AS pages, min(page) AS keeper FROM (SELECT page, host, trim(x, ' ') AS line FROM (SELECT page, host, unnest(ls) AS x FROM d)) WHERE line <> '' GROUP BY host, line),
b AS (SELECT host, line, CASE WHEN pages < 20 THEN keeper END AS keeper FROM c JOIN n USING (host) WHERE pages >= 2 AND pages > 0.1 * host_pages),
bad AS (SELECT d.doc_id, d.page, list(line) AS bad FROM (SELECT DISTINCT doc_id, host, page FROM d) d JOIN b ON b.host = d.host AND coalesce(b.keeper <> d.page, true) GROUP BY d.doc_id, d.page),
k AS (SELECT d.doc_id, text, ls, CASE WHEN bad IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(bad, trim(x, ' '))) END AS left_ FROM d LEFT JOIN bad USING (doc_id, page)),
w AS (SELECT *, CASE WHEN len(list_filter(left_, lambda x: trim(x, ' ') <> '')) > 0 THEN left_ ELSE ls END AS kept FROM k)
SELECT doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(len(ls) - len(kept), 0) AS n_dropped, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS text_sha256 FROM w
"""

def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.stupid_backoff(table(spark, sf_dir, "documents")).select("doc_id", "n_words", F.round("score", 6).alias("score"))


OP6_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i FROM d),
g AS (SELECT doc_id, i, x, lag(x) OVER (PARTITION BY doc_id ORDER BY i) AS v FROM t),
c AS (
  SELECT doc_id, i, v, count(*) OVER (PARTITION BY x) - count(*) OVER (PARTITION BY doc_id, x) AS cw,
         count(*) OVER (PARTITION BY v, x) - count(*) OVER (PARTITION BY doc_id, v, x) AS cvw FROM g),
p AS (SELECT *, lag(cw) OVER (PARTITION BY doc_id ORDER BY i) AS cv, count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS n FROM c),
s AS (
  SELECT doc_id, CASE WHEN v IS NOT NULL AND cvw > 0 THEN log10(cvw) - log10(cv)
    ELSE log10(greatest(cw, 1)) - log10(greatest(n, 1)) + CASE WHEN v IS NULL THEN 0 ELSE log10(0.4) END + CASE WHEN cw > 0 THEN 0 ELSE log10(0.4) END END AS s FROM p),
m AS (SELECT doc_id, avg(s) AS score FROM s GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(score, 6) AS score FROM d LEFT JOIN m USING (doc_id)
"""


def learnable(labels: DataFrame) -> DataFrame:
    """Labels that may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return labels.where(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 != 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, learnable(table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 5 == 0  # a null id counts as empty text
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return found.select(
        "doc_id",
        *[pii.count_kind(base, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.concat("base", "added")).alias("spans"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, m, array_to_string(w[s:s + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM w, range(1, 6) x(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 100),
cuts AS (SELECT *, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:m], ' ') AS q FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
s AS (
  SELECT c.lang, c.m, c.phrase, a, k, x.f AS l, y.f AS r, CAST(n AS BIGINT) AS n, CAST(1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = p JOIN f y ON y.lang = c.lang AND y.phrase = q JOIN n ON n.lang = c.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT lang, m AS long_m, a AS long_a, array_to_string(w[i:i + j - 1], ' ') AS part FROM (SELECT *, unnest(range(1, m - j + 2)) AS i FROM c, range(2, 5) y(j) WHERE j < m)) x
    WHERE x.lang = b.lang AND x.part = b.phrase AND 100 * long_a >= 100 * b.a)),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_feistel_sharding": op3_feistel_sharding,
    "op4_decontamination": op4_decontamination,
    "op5_url_filters": op5_url_filters,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_collocations": op11_collocations,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_simhash": op13_simhash,
}
ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op4_decontamination": OP4_SQL,
    "op5_url_filters": OP5_SQL,
    "op6_lm_scoring": OP6_SQL,
    "op7_ngram_jaccard_join": OP7_SQL,
    "op8_line_dedup": OP8_SQL,
    "op11_collocations": OP11_SQL,
}
