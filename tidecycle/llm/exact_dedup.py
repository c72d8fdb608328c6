"""Exact deduplication by 128-bit content hash with byte comparison."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices


def _hashed(hash_bytes: int):
    def run(batches):
        for batch in slices(batches, 1):
            norm = pc.ascii_lower(pc.fill_null(batch.column(1), ""))
            raw = norm.cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([hashlib.md5(x).digest()[:hash_bytes] for x in raw], pa.binary()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                    norm,
                ],
                names=["id", "h128", "text_sha256", "norm"],
            )

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", hash_bytes: int = 16) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Rows are grouped by a 128-bit hash of
    that text and, inside a hash group, by the bytes themselves, so that colliding texts stay apart whatever
    `hash_bytes` is. Of equal texts the row with the smallest id stays (`keep="max"`: the largest); null ids come last.
    Of rows that repeat both id and text exactly one stays. Columns beyond the two named are not read, an empty
    table gives an empty result.

    The texts are shuffled once, after map-side combination, so a hot group arrives as one row per task; the groups
    are written without their texts. A hash that stands for one text, as found there, is enough for the rows to meet
    their group, in a join of short columns whose hot keys AQE splits; rows of other hashes meet it by their bytes.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    rows = rows.mapInArrow(_hashed(hash_bytes), f"id {id_type}, h128 binary, text_sha256 string, norm string")
    best = (F.min if keep == "min" else F.max)("id")

    def groups(x: DataFrame) -> DataFrame:
        return x.groupBy("h128", "norm").agg(best.alias("keep_id"), F.count("*").alias("group_size"), F.first("text_sha256").alias("text_sha256"))

    known = materialize(groups(rows).drop("norm"))
    collided = known.groupBy("h128").count().where("count > 1").select("h128")
    found = rows.select("id", "h128")
    if collided.limit(1).count():
        collided = materialize(collided)
        apart = rows.drop("text_sha256").join(collided, "h128", "left_semi")
        apart = apart.join(groups(rows.join(collided, "h128", "left_semi")), ["h128", "norm"]).drop("norm")
        found = found.join(known.join(collided, "h128", "left_anti"), "h128").unionByName(apart)
    else:
        found = found.join(known, "h128")
    nth = F.row_number().over(Window.partitionBy("id", "text_sha256").orderBy("keep_id"))  # not the key of the join, so that AQE may split that
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (nth == 1)).alias("kept"),
        "text_sha256",
    )
