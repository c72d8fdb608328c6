"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import materialize, slices

WINDOW_BYTES = 64
LEVEL = 7
MIN_MATCH = 6
ORDINARY_BYTES, TOXIC_BYTES = 8192, 1024  # content of the two dictionaries
GRAMS = (6, 8)  # bytes of the grams by which toxic windows are told from ordinary ones
TABLE_BITS = 21  # of the hashed counts of grams: 8 MB a table, whatever the sample
#: Fixed value: the repeat offsets after which the content of a dictionary of the trainer begins.
CONTENT_AFTER = bytes.fromhex("010000000400000008000000")


def windows(text: str) -> list[bytes]:
    """Lower-cased text in windows of whole words, of WINDOW_BYTES at least but for the last; every word is in one."""
    out, cur, n = [], [], 0
    for w in text.lower().encode().split():
        cur.append(w)
        n += len(w) + 1
        if n >= WINDOW_BYTES:
            out.append(b" " + b" ".join(cur))
            cur, n = [], 0
    if cur:
        out.append(b" " + b" ".join(cur))
    return out


@dataclass
class Model:
    """`toxic`: contents of the dictionaries trained on either half of the toxic texts; `ordinary`: that of ordinary text; `weights`: for each toxic one a constant, those of the log of saved bytes and of the log of windows."""

    toxic: list[bytes] = field(default_factory=list)
    ordinary: bytes = b""
    weights: list[list[float]] = field(default_factory=list)

    def saved(self, text: str | None) -> tuple[list[int], int]:
        """(bytes saved by each toxic dictionary, windows): over all windows of the text, by how much each is shorter when compressed with the toxic dictionary added to the ordinary one."""
        plain, with_toxic = _compressor(self.ordinary), [_compressor(t + self.ordinary) for t in self.toxic]
        ws = windows(text) if text else []
        alone = [len(plain(w)) for w in ws]
        return [sum(max(0, n - len(both(w))) for w, n in zip(ws, alone)) for both in with_toxic], len(ws)

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Shape (toxic dictionaries, texts, 3): a constant, log of saved bytes, log of windows."""
        rows = [self.saved(t) for t in texts]
        return np.array([[(1.0, math.log1p(s[k]), math.log1p(n)) for s, n in rows] for k in range(len(self.toxic))]).reshape(len(self.toxic), len(texts), 3)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of the mean log odds of the dictionaries."""
        if not self.weights:
            return np.full(len(texts), 1 / (1 + math.exp(20)))
        z = np.mean([x @ np.array(w) for x, w in zip(self.features(texts), self.weights)], 0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@lru_cache(16)
def _compressor(content: bytes):
    p = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=MIN_MATCH, write_checksum=0, write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress


def _without_copies(texts: list[str]) -> list[str]:
    """Texts that share none of three minhashes of word 5-grams with an earlier one: copies would count their words again and again."""
    seen, out = set(), []
    for t in texts:
        ws = t.lower().encode().split()
        h = np.array([zlib.crc32(b" ".join(ws[i : i + 5])) for i in range(max(1, len(ws) - 4))], np.uint64)
        keys = {(k, int((h * np.uint64(m) & np.uint64(0xFFFFFFFF)).min())) for k, m in enumerate((1, 2654435761, 40503))}
        if not keys & seen:
            out.append(t)
        seen |= keys
    return out


def _flat(text: str) -> bytes:
    return b"".join(windows(text)) + b" "


def _grams(data: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k bytes from each place on, and whether they stay inside a word and its blanks."""
    b = np.frombuffer(data, np.uint8)
    n = max(0, len(b) - k + 1)
    code, inside = np.full(n, k, np.uint64), np.ones(n, bool)
    for j in range(k):
        code = code * np.uint64(0x9E3779B97F4A7C15) + b[j : n + j]
        code ^= code >> np.uint64(29)
        if 0 < j < k - 1:
            inside &= b[j : n + j] != 32
    return (code * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - TABLE_BITS)).astype(np.int64), inside


def _counts(texts: list[str]) -> list[np.ndarray]:
    """For each size of GRAMS, how many of the texts hold each hash."""
    out = [np.zeros(1 << TABLE_BITS, np.int32) for _ in GRAMS]
    for t in texts:
        data = _flat(t)
        for c, k in zip(out, GRAMS):
            g, inside = _grams(data, k)
            c[np.unique(g[inside])] += 1
    return out


def _contrast(toxic: list[np.ndarray], ordinary: list[np.ndarray], n: int, m: int, sigmas: float, odds: float) -> list[np.ndarray]:
    """For each size of GRAMS the hashes that n toxic texts hold significantly more often than m ordinary ones: by the likelihood ratio, `sigmas` standard deviations, and `odds`-fold."""
    out = []
    for a, b in zip(toxic, ordinary):
        at = np.flatnonzero(a)
        x, y = a[at].astype(float), b[at].astype(float)
        p = (x + y) / (n + m)
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = [np.where(o > 0, o * np.log(o / e), 0.0) for o, e in ((x, n * p), (y, m * p), (n - x, n * (1 - p)), (m - y, m * (1 - p)))]
        ok = (2 * sum(parts) >= sigmas**2) & ((x + 0.5) / (n + 1) >= odds * (y + 0.5) / (m + 1))
        telling = np.zeros(len(a), bool)
        telling[at[ok]] = True
        out.append(telling)
    return out


def _contrastive_windows(text: str, telling: list[np.ndarray]) -> list[bytes]:
    """The stretches of a text that telling grams cover, each once."""
    data = _flat(text)
    cover = np.zeros(len(data) + 1, np.int32)
    for k, ok in zip(GRAMS, telling):
        g, inside = _grams(data, k)
        at = np.flatnonzero(ok[g] & inside)
        cover[at] += 1
        cover[at + k] -= 1
    edges = np.diff(np.concatenate([[0], (np.cumsum(cover)[:-1] > 0).astype(np.int8), [0]]))
    return list(dict.fromkeys(data[s:e] for s, e in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))))


def _train_dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of the dictionary that zstandard trains on the samples; of too few to train on, the samples themselves."""
    try:
        trained = zstandard.train_dictionary(size + 512, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]
    return trained[trained.index(CONTENT_AFTER) + len(CONTENT_AFTER) :][-size:]


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton steps on the ridge-penalised log-likelihood, in standardised columns; the first is the constant."""
    mean, sd = x.mean(0), x.std(0)
    mean[0], sd[0] = 0, 1
    sd[sd == 0] = 1
    z = (x - mean) / sd
    w = np.zeros(z.shape[1])
    pen = np.full(z.shape[1], ridge)
    pen[0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(pen), z.T @ (y - p) - pen * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    w = w / sd
    w[0] -= float((w[1:] * mean[1:]).sum())
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 4000, max_chars: int = 20_000, max_windows: int = 40_000) -> Model:
    """A model from the documents that `labels` (id, 0/1 label) names.

    Fitted on the driver from a bounded sample: of each label the `per_class` texts of least hash among those of
    1 to `max_chars` characters; copies of a text are one. The ordinary dictionary is trained on `max_windows` windows
    spread evenly over the ordinary texts, the toxic one on contrastive windows, the stretches of toxic texts that are
    significantly more frequent there than in ordinary texts. There are two toxic dictionaries, each
    trained on one half of the texts (by text hash) and calibrated on the other: a text's bytes saved by the toxic
    dictionary, against its number of windows, give log odds, whose mean is taken. The probability
    is for the class shares of all labelled texts, not of the sample. Null ids, texts and labels are left out; of an id
    with several labels the greatest counts. With one class alone, or none, every score is near 0. Only ids and hashes
    meet the labels in a join; texts are fetched for the sample alone.
    """
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1)").groupBy("i").agg(F.max("y").alias("y"))
    slim = docs.select(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("h"), F.length(text_col).alias("n")).where(F.col("n").between(1, max_chars)).select("i", "h")
    joined = materialize(slim.join(known, "i").groupBy("y", "h").agg(F.min("i").alias("i")))
    total = {r["y"]: r["count"] for r in joined.groupBy("y").count().collect()}
    top = [tuple(r) for y in (0, 1) for r in joined.where(F.col("y") == y).orderBy("h").limit(per_class).collect()]
    picked = docs.sparkSession.createDataFrame(top, joined.schema)  # 2 * per_class rows at most
    texts = docs.select(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t")).join(F.broadcast(picked), ["i", "h"]).collect()
    sample = {y: sorted({(r["h"], r["t"]) for r in texts if r["y"] == y}) for y in (0, 1)}
    return _fit(sample, max_windows, total)


def _spread(texts: list[str], most: int) -> list[bytes]:
    """`most` windows of all texts, or all if there are no more: each text gives its share. The texts are cut twice, so that only what is taken is held."""
    total = sum(len(windows(t)) for t in texts)
    out, at = [], 0
    for t in texts:
        for w in windows(t):
            if total <= most or (at + 1) * most // total > at * most // total:
                out.append(w)
            at += 1
    return out


def _fit(sample: dict[int, list[tuple[int, str]]], max_windows: int, total: dict[int, int] | None = None, sigmas: float = 6.0, odds: float = 4.0) -> Model:
    """From (hash, text) of each label; `total` holds the number of labelled texts of each."""
    if not all(len(v) >= 8 for v in sample.values()):
        return Model()
    half = {y: [_without_copies([t for h, t in v if h % 2 == k]) for k in (0, 1)] for y, v in sample.items()}
    if not all(x for v in half.values() for x in v):
        return Model()
    model = Model(ordinary=_train_dictionary(_spread(half[0][0] + half[0][1], max_windows), ORDINARY_BYTES))
    for k in (0, 1):
        telling = _contrast(_counts(half[1][k]), _counts(half[0][k]), len(half[1][k]), len(half[0][k]), sigmas, odds)
        model.toxic.append(_train_dictionary([b"".join(found) for t in half[1][k] if (found := _contrastive_windows(t, telling))], TOXIC_BYTES))
    toxic, ordinary = ([model.features(half[y][k])[1 - k] for k in (0, 1)] for y in (1, 0))
    for k in (0, 1):  # of the half that the dictionary was not trained on
        x, y = toxic[1 - k], ordinary[1 - k]
        weights = _fit_logistic(np.concatenate([x, y]), np.array([1.0] * len(x) + [0.0] * len(y)))
        if total:  # from the odds in the sample to those of all labelled texts
            weights[0] += math.log(total[1] / total[0]) - math.log(len(x) / len(y))
        model.weights.append(weights.tolist())
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "__score") -> DataFrame:
    """`docs` with the score of the whole text, 0 to 1. A null text counts as empty; all columns and rows pass through, but for one named `out_col`, which is replaced."""
    docs = docs.drop(out_col)
    names = docs.columns
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast((model.toxic, model.ordinary, model.weights))  # three dictionaries, 10 KB at most

    def run(batches):
        m = Model(*shared.value)
        for batch in slices(batches, at):
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(m.score(batch.column(at).to_pylist()), pa.float64())], names=[*names, out_col])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out_col, DoubleType())]))
