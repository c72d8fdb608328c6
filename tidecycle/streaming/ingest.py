"""New recordings as a stream: each batch rewrites the nights that it touches, and only once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import temporal
from ..schema import COARSE, KEYS


def recordings(spark: SparkSession, root: str, per_batch: int = 1000) -> DataFrame:
    """Feature files that appear below `root`, as a stream with source_file, wall_time and night; the checkpoint keeps which were read. Names give the times; a file without one has neither."""
    x = spark.readStream.schema(COARSE).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", per_batch).parquet(root)
    x = x.withColumn("source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    x = x.withColumn("wall_time", temporal.plus_seconds(temporal.start_of_name(F.col("source_file")), F.col("timestamp_sec")))
    return x.withColumn("night", temporal.night_label(F.col("wall_time")))


def merge_nights(batch: DataFrame, out: str, keys: tuple[str, ...] = KEYS) -> None:
    """Adds a batch to the table at `out`, a folder per night: nights that it touches are written anew with what they held, one row per key; others stay.

    A batch that runs again, wholly or after it was killed half-way, changes nothing more: its rows are there already,
    and dynamic overwriting replaces a night by its whole new content.
    """
    spark = batch.sparkSession
    both = batch
    try:
        there = spark.read.schema(batch.schema).parquet(out)
    except Exception as e:  # the first batch finds no table
        if "PATH_NOT_FOUND" not in str(e):
            raise
        there = None
    if there is not None:
        touched = batch.select("night").distinct()
        both = batch.unionByName(there.join(touched, "night", "left_semi"))
    rows = both.dropDuplicates([*keys, "night"])
    rows.hint("rebalance", "night").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("night").parquet(out)


def ingest(spark: SparkSession, root: str, out: str, checkpoint: str, per_batch: int = 1000) -> StreamingQuery:
    """Takes in all recordings that are there and ends; run again, those that came since."""
    writer = recordings(spark, root, per_batch).writeStream.foreachBatch(lambda batch, _: merge_nights(batch, out))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
