"""Writers of feature tables, summaries, labels and manifests."""

from __future__ import annotations

import uuid
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import stats
from ..schema import COARSE, conform
from .cbf import store


def features(df: DataFrame, path: str, mode: str = "append") -> None:
    """Coarse features as Parquet, 32-bit. Rows are dealt by recording and sorted by recording and frame: files number tasks, however many recordings there are, AQE splits a large one, and a reader of one recording skips row groups by their least and greatest video_id."""
    conform(df, COARSE).hint("rebalance", "video_id").sortWithinPartitions("video_id", "frame_idx").write.mode(mode).parquet(path)


def features_once(df: DataFrame, path: str, done: DataFrame | None) -> None:
    """As `features`, for recordings that `done` (video_id) does not hold yet."""
    features(stats.missing(df, done, ["video_id"]) if done is not None else df, path)


#: Annotations of a file at most. The reader takes a file as a whole, so this bounds what a task reads: about 60 MB with four boxes each.
ANNOTATIONS = 50_000


def annotations(df: DataFrame, path: str, per_file: int = ANNOTATIONS) -> None:
    """Annotations (filename, size, object: an array of boxes) as XML, `per_file` at most to a file."""
    df.write.format("xml").option("rootTag", "annotations").option("rowTag", "annotation").option("maxRecordsPerFile", per_file).save(path)


def csv(df: DataFrame, path: str, mode: str = "overwrite", mark: bool = False) -> None:
    """CSV with a header; key columns are kept. With `mark` each file begins with a byte-order mark, as spreadsheets like it."""
    names = [f"\ufeff{c}" if mark and i == 0 else c for i, c in enumerate(df.columns)]
    df.toDF(*names).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def flat(df: DataFrame, separator: str = "; ") -> DataFrame:
    """Arrays of strings joined, other nested columns as JSON: what a CSV file can hold."""
    out = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        out.append(F.array_join(f.name, separator).alias(f.name) if kind == "array<string>" else F.to_json(f.name).alias(f.name) if kind.startswith(("array", "struct", "map")) else F.col(f.name))
    return df.select(*out)


def night_summary(df: DataFrame, path: str) -> None:
    """Summary as CSV and as JSON, by night."""
    csv(flat(df).orderBy("night").coalesce(1), f"{path}/csv")  # one row per night
    df.write.mode("overwrite").json(f"{path}/json")


def by_date(df: DataFrame, path: str, date: str = "date") -> None:
    """Replaces the dates that `df` holds and leaves others."""
    df.hint("rebalance", date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def feature_csv(df: DataFrame, path: str, floats: list[str]) -> None:
    """CSV with six decimals, strings in quotes."""
    x = df.select(*[scalars.six_decimals(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])
    x.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def log_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def label_files(df: DataFrame, path: str) -> None:
    """Label lines (class, centre, size relative to the frame), a folder per picture: columns image, cls, cx, cy, w, h."""
    line = scalars.label_line(*[F.col(c) for c in ("cls", "cx", "cy", "w", "h")])
    df.select("image", line.alias("value")).hint("rebalance", "image").write.mode("overwrite").partitionBy("image").text(path)


def dataset_manifest(df: DataFrame, label: str, name: str, share: float = 0.2, seed: str = "", rare=None, times: int = 1) -> DataFrame:
    """What goes where in a training set: split, class and replica of each file."""
    x = stats.stratified_split(df, label, name, share, seed)
    return stats.oversample(x, (rare if rare is not None else F.lit(False)) & (F.col("split") == "train"), times, name).withColumn("target", F.concat_ws("/", "split", label, name))


def review_lines(core: DataFrame) -> DataFrame:
    """Markdown report of reviewed core windows as rows (part, cycle_id, line): a head of six lines, then one per cycle."""
    classes = ("HIGH", "MEDIUM", "LOW")
    n = core.agg(F.count("*").alias("n"), F.coalesce(F.avg("duration_core_window_min"), F.lit(0.0)).alias("m"), *[F.count_if(F.col("confidence") == c).alias(c) for c in classes])
    counts = F.format_string(f"%d cycles, core window %.1f min on average; {', '.join(f'%d {c.lower()}' for c in classes)}", "n", F.col("m").cast("double"), *classes)
    head = [F.lit("# Core windows for review"), F.lit(""), counts, F.lit(""), F.lit("| cycle | from | to | minutes | confidence | issues |"), F.lit("|-|-|-|-|-|-|")]
    first = n.select(F.posexplode(F.array(*head)).alias("part", "line"))
    clock = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    row = F.format_string("| %s | %s | %s | %.1f | %s | %s |", F.col("cycle_id").cast("string"), clock("net_on_deck_time"), clock("fish_end_time"), F.col("duration_core_window_min").cast("double"), "confidence", F.array_join("issues", "; "))
    rows = core.select(F.lit(len(head)).alias("part"), "cycle_id", row.alias("line"))
    return rows.unionByName(first, allowMissingColumns=True)


def review_report(core: DataFrame) -> str:
    """The report of a night's worth of cycles as one text."""
    return "\n".join(r["line"] for r in review_lines(core).orderBy("part", "cycle_id").toLocalIterator()) + "\n"


def write_review(core: DataFrame, path: str) -> None:
    """`review_lines` in order as text files, whose names follow the order."""
    review_lines(core).orderBy("part", "cycle_id").select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def recording_files(df: DataFrame, path: str, order: str = "frame_idx") -> int:
    """A Parquet file per recording, named <video_id>.<8 hex digits>.parquet, rows by `order`; AQE may deal a large recording over several. Returns their number.

    Tasks stream their sorted rows into files below `_temporary`, one open at a time; the driver moves those of tasks
    that succeeded into the folder, so that a task that ran twice leaves nothing.
    """
    job = f"_temporary-{uuid.uuid4().hex[:8]}"

    def run(batches):
        system, folder = store(path)
        name = out = None
        for batch in batches:
            video = batch.column("video_id")
            cuts = [0, *(i for i in range(1, batch.num_rows) if video[i] != video[i - 1]), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if out is None or video[a].as_py() != name:
                    if out:
                        out.close()
                    name = video[a].as_py()
                    file = f"{quote(name or 'video', safe='')}.{uuid.uuid4().hex[:8]}.parquet"
                    system.create_dir(f"{folder}/{job}")
                    out = pq.ParquetWriter(f"{folder}/{job}/{file}", batch.schema, filesystem=system)
                    yield pa.RecordBatch.from_pydict({"file": [file]})
                out.write_batch(batch.slice(a, b - a))
        if out:
            out.close()

    files = [r["file"] for r in df.hint("rebalance", "video_id").sortWithinPartitions("video_id", order).mapInArrow(run, "file string").collect()]
    system, folder = store(path)
    for f in files:
        system.move(f"{folder}/{job}/{f}", f"{folder}/{f}")
    if files:
        system.delete_dir(f"{folder}/{job}")
    return len(files)


def blobs(df: DataFrame, path: str) -> int:
    """A file for each row (name, data), written by tasks and moved into the folder when all are there. Returns their number."""
    job = f"_temporary-{uuid.uuid4().hex[:8]}"

    def run(batches):
        system, folder = store(path)
        for batch in batches:
            made = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = f"{job}/{uuid.uuid4().hex}"
                system.create_dir(f"{folder}/{at}")
                with system.open_output_stream(f"{folder}/{at}/{name}") as f:
                    f.write(data)
                made.append((at, name))
            yield pa.RecordBatch.from_pydict({"at": pa.array([a for a, _ in made], pa.string()), "name": pa.array([n for _, n in made], pa.string())})

    files = df.select("name", "data").mapInArrow(run, "at string, name string").collect()
    system, folder = store(path)
    for f in files:
        system.move(f"{folder}/{f['at']}/{f['name']}", f"{folder}/{f['name']}")
    if files:
        system.delete_dir(f"{folder}/{job}")
    return len(files)
