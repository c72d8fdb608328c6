"""Shared pieces of the training-data operators."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bytes of words: 0-9, a-z and everything above ASCII; A-Z lower-cased, the rest blank.
WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: bytes | None) -> list[bytes]:
    """The lower-cased words of a UTF-8 text; a null or empty text has none."""
    return text.translate(WORD_TABLE).split() if text else []


#: An odd multiplier for sequences of hashes and those of the splitmix64 finaliser.
BASE, MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
CACHE_WORDS = 150_000


class _WordHash(dict):
    """Word -> 64-bit hash, never 0; forgets all when it is full."""

    def __missing__(self, w: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[w] = h = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") or 1
        return h


_HASHES = _WordHash()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    """64-bit hashes of words. Operators compare words by them: two different words are taken for equal with a chance of 2**-64."""
    return np.fromiter(map(_HASHES.__getitem__, ws), np.uint64, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tidecycle-")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share: `spark.checkpoint.dir`, or that of `SparkContext.setCheckpointDir`. A folder of our own is taken only where neither is set and driver and executors are one machine, as in tests; on a cluster that is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return shared or _local_scratch()


def materialize(df: DataFrame, **options) -> DataFrame:
    """Cut the lineage: write `df` as Parquet to the shared folder (with these options of the writer) and read it again, so that a lost executor loses nothing."""
    path = f"{scratch_dir(df.sparkSession)}/tidecycle/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_with(df: DataFrame, measure: Column):
    """`materialize`, and the value of an aggregate over the rows, observed while they are written: no pass of its own."""
    seen = Observation()
    out = materialize(df.observe(seen, measure.alias("m")))
    return out, seen.get["m"]


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches, column: int, max_bytes: int = 4 << 20):
    """Arrow batches cut so that the texts of one have about `max_bytes`: what a Python worker holds does not follow the batch size. A longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(size // max_bytes)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, *plain: str, drop: tuple[str, ...] = ()) -> tuple[DataFrame, list[Column]]:
    """`df` with the columns `plain` and all others in one struct, whose names then can't clash with an operator's own; and the columns that restore it. Columns in `drop` stay behind."""
    rest = [c for c in df.columns if c not in plain and c not in drop]
    out = df.select(*[F.col(f"`{c}`") for c in plain], (F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("string")).alias("__rest"))
    back = [F.col(f"`{c}`") if c in plain else F.col("__rest").getField(c).alias(c) for c in df.columns if c not in drop]
    return out, back
