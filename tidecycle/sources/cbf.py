"""The columnar binary feature format: a Python data source named `cbf`, reading and writing.

    spark.dataSource.register(CbfSource)
    spark.read.format("cbf").option("path", folder).load()
    spark.read.format("cbf").schema("video_id string, entropy float").option("path", folder).load()
    df.write.format("cbf").option("path", folder).mode("append").save()

A file: magic `CBF` and a version byte, number of rows and of columns, offsets of the columns and of the end, four
reserved floats, then each column as little-endian u32 or f32. Version 2 has roi_code, version 1 has not. The folder
is a path or URI of a store that all executors see (file, hdfs, s3, gs). A partition holds files of `PART_BYTES`
together, small ones counted as `OPEN_BYTES`, so tasks follow the size of the folder and not its recordings. A reader with a schema
reads the bytes of its columns alone; with `scan`, a list of recordings or filters on video_id choose files by their names, before any is opened.
"""

from __future__ import annotations

import io
import json
import posixpath
import re
import struct
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_type

from ..schema import ROI_CODES

#: Column names in the order of the file.
COLUMNS = ["frame_idx", "roi_code", "timestamp_sec", "mean_brightness", "brightness_std", "mean_b", "mean_g", "mean_r", "motion_intensity", "edge_density", "laplacian_variance", "entropy"]
UNSIGNED = {"frame_idx", "roi_code"}
#: Files of a task of the reader: so many bytes together, each file counted as `OPEN_BYTES` at least; rows of small files go on in batches of `BATCH`.
PART_BYTES, OPEN_BYTES, BATCH = 64 << 20, 256 << 10, 1 << 16
#: Files that the commit moves or deletes at a time.
THREADS = 16


def columns_of(version: int) -> list[str]:
    return [c for c in COLUMNS if version == 2 or c != "roi_code"]


def read_columns(f, wanted: list[str]) -> tuple[int, dict[str, np.ndarray]]:
    """Rows of an open file and those of the columns `wanted` that it has; only the head and their bytes are read. Longer buffers are cut to the number of rows."""
    head = f.read(12)
    if head[:3] != b"CBF" or head[3:4] not in (b"\x01", b"\x02"):
        raise ValueError("not a CBF file of version 1 or 2")
    names = columns_of(head[3])
    rows, cols = struct.unpack_from("<II", head, 4)
    if cols != len(names):
        raise ValueError(f"{len(names)} columns expected, {cols} found")
    at = struct.unpack(f"<{cols + 1}I", f.read(4 * (cols + 1)))
    out = {}
    for n, a, b in zip(names, at, at[1:]):
        if n in wanted:
            f.seek(a)
            out[n] = np.frombuffer(f.read(min(b - a, 4 * rows)), "<u4" if n in UNSIGNED else "<f4")
    return rows, out


def decode(data: bytes) -> dict[str, np.ndarray]:
    """All columns of one file."""
    return read_columns(io.BytesIO(data), COLUMNS)[1]


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), posixpath.abspath(path))


def recording(path: str) -> str:
    """The recording that a file is of, by its name."""
    return unquote(re.sub(r"(\.[0-9a-f]{8})?\.cbf$", "", posixpath.basename(path)))


def encode(columns: dict[str, np.ndarray], version: int = 2) -> bytes:
    names = columns_of(version)
    bodies = [np.asarray(columns[n], "<u4" if n in UNSIGNED else "<f4").tobytes() for n in names]
    head = 4 + 8 + 4 * (len(names) + 1) + 16
    at = head + np.concatenate([[0], np.cumsum([len(b) for b in bodies])])
    return b"CBF" + bytes([version]) + struct.pack(f"<II{len(at)}I4f", len(columns["frame_idx"]), len(names), *at.tolist(), 0, 0, 0, 0) + b"".join(bodies)


def each(apply, items: list) -> None:
    """`apply` to all items, many at a time: a store answers each call after a while."""
    with ThreadPoolExecutor(THREADS) as pool:
        for _ in pool.map(apply, items):
            pass


@dataclass
class FilePartition(InputPartition):
    paths: list


class CbfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cbf"

    def schema(self) -> str:
        kinds = ", ".join(f"{c} {'long' if c in UNSIGNED else 'float'}" for c in COLUMNS)
        return f"video_id string, {kinds}, roi_name string"

    def reader(self, schema) -> CbfReader:
        return (PushingReader if self.options.get("pushdown") == "true" else CbfReader)(self.options, schema)

    def writer(self, schema, overwrite: bool) -> CbfWriter:
        return CbfWriter(self.options, overwrite)


class CbfReader(DataSourceReader):
    """Options: path (file or folder), roi (codes and names, as 0=left_deck,1=right_deck)."""

    def __init__(self, options, schema=None):
        self.path, self.schema = options["path"], schema
        self.roi = {int(k): v for k, v in (x.split("=") for x in options["roi"].split(","))} if options.get("roi") else ROI_CODES
        self.videos: set | None = set(json.loads(options["videos"])) if options.get("videos") else None

    def infos(self) -> list[fs.FileInfo]:
        system, path = store(self.path)
        found = system.get_file_info(path)
        if found.type == fs.FileType.File:
            infos = [found]
        else:
            below = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
            infos = sorted((f for f in below if f.type == fs.FileType.File and f.path.endswith(".cbf") and "_temporary" not in f.path[len(path) :]), key=lambda f: f.path)
        return [f for f in infos if self.videos is None or recording(f.path) in self.videos]

    def files(self) -> list[str]:
        return [f.path for f in self.infos()]

    def partitions(self):
        parts, left = [FilePartition([])], PART_BYTES
        for f in self.infos():
            size = max(f.size or 0, OPEN_BYTES)
            if size > left and parts[-1].paths:
                parts.append(FilePartition([]))
                left = PART_BYTES
            parts[-1].paths.append(f.path)
            left -= size
        return parts

    def read(self, partition):
        names = self.schema.names if self.schema else ["video_id", *COLUMNS, "roi_name"]
        wanted = {"roi_code" if n == "roi_name" else n for n in names}
        system = store(self.path)[0]
        held, rows = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as f:
                n, found = read_columns(f, wanted)
            if held and rows + n > BATCH:
                yield self._batch(names, held)
                held, rows = [], 0
            held.append((path, n, found))
            rows += n
        if held:
            yield self._batch(names, held)

    def _batch(self, names: list[str], files: list[tuple[str, int, dict]]) -> pa.RecordBatch:
        """The rows of some files; columns that a file lacks are null."""

        def column(c: str) -> pa.Array:
            if c == "video_id":
                return pa.array([recording(p) for p, _, _ in files], pa.string()).take(pa.array(np.repeat(np.arange(len(files)), [n for _, n, _ in files])))
            if c == "roi_name":
                codes, at = np.unique(np.concatenate([f.get("roi_code", np.zeros(n)).astype("i8") for _, n, f in files]), return_inverse=True)
                known = np.concatenate([np.full(n, "roi_code" in f) for _, n, f in files])
                return pa.array([self.roi.get(int(v)) for v in codes], pa.string()).take(pa.array(at, mask=~known))
            kind = pa.int64() if c in UNSIGNED else pa.float32()
            return pa.concat_arrays([pa.array(f[c].astype("i8") if c in UNSIGNED else f[c]) if c in f else pa.nulls(n, kind) for _, n, f in files])

        cols = [column(c) if c in ("video_id", "roi_name", *COLUMNS) else pa.nulls(sum(n for _, n, _ in files), pa.int64()) for c in names]
        if self.schema:
            cols = [c.cast(to_arrow_type(x.dataType)) for c, x in zip(cols, self.schema)]
        return pa.RecordBatch.from_arrays(cols, names=names)


class PushingReader(CbfReader):
    """With option pushdown=true; Spark takes it only where spark.sql.python.filterPushdown.enabled is set."""

    def pushFilters(self, filters):
        """Filters on the recording are settled here; the others go back to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("video_id",):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.videos = names if self.videos is None else self.videos & names
            else:
                yield f


@dataclass
class Written(WriterCommitMessage):
    files: list


class CbfWriter(DataSourceArrowWriter):
    """Writes files of a recording each, as <video>.<8 hex digits>.cbf. A task holds `part_rows` rows (an option) of all
    its recordings together and a batch at most: beyond, recordings with the most rows are written until half is left. Input that is dealt
    by recording (`dealt`) gives a file per recording and `part_rows` rows.

    Tasks write below `_temporary`, which readers pass over; the commit moves their files into the folder, and with mode
    overwrite first takes away those that were there. A task that fails or runs twice leaves nothing. Nulls become NaN,
    or 0 in columns of whole numbers; columns that are missing are null.
    """

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.part_rows = int(options.get("part_rows", 1 << 20))
        self.job = f"_temporary-{uuid.uuid4().hex[:8]}"

    def write(self, iterator):
        system, path = store(self.path)
        system.create_dir(f"{path}/{self.job}")
        held: dict[str, list[pa.Table]] = {}
        rows: Counter = Counter()
        total, files = 0, []
        for batch in iterator:
            table = pa.Table.from_batches([batch])
            names = table.column("video_id") if "video_id" in table.column_names else pa.chunked_array([pa.nulls(len(table), pa.string())])
            codes = pc.fill_null(names, "video").combine_chunks().dictionary_encode()
            at = codes.indices.to_numpy()
            order = np.argsort(at, kind="stable")
            table, ends = table.take(pa.array(order)), np.cumsum(np.bincount(at, minlength=len(codes.dictionary))).tolist()
            for video, a, b in zip(codes.dictionary.to_pylist(), [0, *ends], ends):
                held.setdefault(video, []).append(table.slice(a, b - a))
                rows[video] += b - a
            total += len(table)
            if total >= self.part_rows:  # down to half, so that the recordings are ranked once for many of them
                out = {}
                for video, n in rows.most_common():
                    if total < self.part_rows / 2:
                        break
                    out[video] = held.pop(video)
                    del rows[video]
                    total -= n
                files += self._put(out)
        return Written(files + self._put(held))

    def _put(self, held: dict[str, list[pa.Table]]) -> list[str]:
        """A file for each of these recordings; their names."""
        if not held:
            return []
        table = pa.concat_tables([p for parts in held.values() for p in parts])
        columns = {}
        for c in COLUMNS:
            x = table.column(c) if c in table.column_names else pa.chunked_array([pa.nulls(len(table), pa.float64())])
            columns[c] = pc.fill_null(x.cast(pa.int64()), 0).to_numpy().astype("<u4") if c in UNSIGNED else x.cast(pa.float64()).to_numpy().astype("<f4")
        system, path = store(self.path)
        files, at = [], 0
        for video, parts in held.items():
            n = sum(map(len, parts))
            files.append(f"{quote(video, safe='')}.{uuid.uuid4().hex[:8]}.cbf")
            with system.open_output_stream(f"{path}/{self.job}/{files[-1]}") as f:
                f.write(encode({c: x[at : at + n] for c, x in columns.items()}))
            at += n
        return files

    def commit(self, messages):
        new = [f for m in messages if m for f in m.files]
        system, path = store(self.path)
        if self.overwrite:
            each(system.delete_file, CbfReader({"path": self.path}).files())
        system.create_dir(path)
        each(lambda f: system.move(f"{path}/{self.job}/{f}", f"{path}/{f}"), new)
        self._clear()

    def abort(self, messages):
        self._clear()

    def _clear(self):
        system, path = store(self.path)
        if system.get_file_info(f"{path}/{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{path}/{self.job}")


def dealt(df: DataFrame) -> DataFrame:
    """Rows of a recording together, large recordings split and small ones joined by AQE: as many files as recordings and tasks, not their product. A task gets its recordings one after the other."""
    return df.hint("rebalance", "video_id").sortWithinPartitions("video_id")


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, videos: list[str] | None = None) -> DataFrame:
    """The column files of a folder, reading `columns` (all, if None) of `videos` (all, if None). In a session with spark.sql.python.filterPushdown.enabled filters on video_id choose files, too."""
    spark.dataSource.register(CbfSource)
    kinds = {"video_id": "string", "roi_name": "string"} | {c: "long" if c in UNSIGNED else "float" for c in COLUMNS}
    pushes = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format("cbf").option("path", path).option("pushdown", pushes)
    if videos is not None:
        reader = reader.option("videos", json.dumps(videos))
    return (reader.schema(", ".join(f"{c} {kinds[c]}" for c in columns)) if columns else reader).load()
