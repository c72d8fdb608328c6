"""Recordings without a decoder: what their containers say (`probe`), and frames of uncompressed ones as a data source named `frames`.

    spark.dataSource.register(FrameSource)
    spark.read.format("frames").option("path", folder).option("sample_fps", "1").load()

Containers are read in ranges - heads and tables, never the pictures - through the file system that the path names.
"""

from __future__ import annotations

import io
import struct
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .cbf import recording, store

#: Bytes of frames in a partition and in an Arrow batch.
PART, BATCH = 64 << 20, 8 << 20


@dataclass
class Facts:
    """Of the first picture track: codec, frames a second, frames, size in pixels, seconds; of uncompressed ones also where frames lie: kind, first byte, bytes from frame to frame, bytes of a frame."""

    codec: str | None = None
    fps: Fraction | None = None
    frames: int | None = None
    width: int | None = None
    height: int | None = None
    seconds: float | None = None
    layout: tuple[str, int, int, int] | None = None


def facts(f, size: int) -> Facts | None:
    """What the container of an open file says; None if it is none of MP4, AVI, Matroska, YUV4MPEG2, or broken before a picture track is described."""
    f.seek(0)
    head = f.read(64)
    try:
        if head[4:8] in (b"ftyp", b"moov", b"mdat", b"free", b"wide"):
            out = _mp4(f, size)
        elif head[:4] == b"RIFF" and head[8:12] == b"AVI ":
            out = _avi(f, size)
        elif head[:4] == b"\x1a\x45\xdf\xa3":
            out = _matroska(f, size)
        elif head[:9] == b"YUV4MPEG2":
            out = _y4m(f, size)
        else:
            return None
    except (struct.error, LookupError, ValueError, ArithmeticError, OSError):
        return None
    return out if out and out.width and out.height else None


def _at(f, offset: int, n: int) -> bytes:
    f.seek(offset)
    out = f.read(n)
    if len(out) < n:
        raise ValueError("the file ends early")
    return out


def _boxes(f, a: int, b: int):
    """(kind, first byte, end) of the boxes in a range; sizes of 64 bits and to the end of the range are known."""
    while a + 8 <= b:
        n, kind = struct.unpack(">I4s", _at(f, a, 8))
        first = a + 8
        if n == 1:
            n, first = struct.unpack(">Q", _at(f, first, 8))[0], first + 8
        n = n or b - a
        if n < first - a or a + n > b:
            raise ValueError("a box leaves its parent")
        yield kind, first, a + n
        a += n


def _mp4(f, size: int) -> Facts | None:
    top = {k: (a, b) for k, a, b in _whole_boxes(f, size)}
    if b"moov" not in top:
        return None
    for kind, a, b in _boxes(f, *top[b"moov"]):
        if kind == b"trak" and (out := _track(f, a, b)):
            return out
    return None


def _whole_boxes(f, size: int):
    """Boxes of the top level; the last may be cut (a recording that broke off), unless it is the one that is asked for."""
    try:
        yield from _boxes(f, 0, size)
    except ValueError:
        return


def _track(f, a: int, b: int) -> Facts | None:
    parts = {k: (x, y) for k, x, y in _boxes(f, a, b)}
    media = {k: (x, y) for k, x, y in _boxes(f, *parts[b"mdia"])}
    if _at(f, media[b"hdlr"][0] + 8, 4) != b"vide":
        return None
    head = _at(f, media[b"mdhd"][0], 32)
    scale, ticks = struct.unpack(">IQ", head[20:32]) if head[0] else struct.unpack(">II", head[12:20])
    table = {k: (x, y) for k, x, y in _boxes(f, *{k: (x, y) for k, x, y in _boxes(f, *media[b"minf"])}[b"stbl"])}
    entry = _at(f, table[b"stsd"][0] + 8, 36)
    width, height = struct.unpack(">HH", entry[32:36])
    x, y = table[b"stts"]
    many = struct.unpack(">I", _at(f, x + 4, 4))[0]
    if x + 8 + 8 * many > y:
        raise ValueError("the table of times is cut")
    times = np.frombuffer(_at(f, x + 8, 8 * many), ">u4").reshape(-1, 2).astype(np.int64)
    frames, whole = int(times[:, 0].sum()), int((times[:, 0] * times[:, 1]).sum())
    return Facts(entry[4:8].decode("latin-1").strip(), Fraction(scale * frames, whole) if whole else None, frames, width, height, (ticks or whole) / scale)


def _chunks(f, a: int, b: int):
    """(kind, first byte, end) of RIFF chunks in a range; a list's kind is LIST and its name."""
    while a + 8 <= b:
        kind, n = struct.unpack("<4sI", _at(f, a, 8))
        if kind == b"LIST":
            yield kind + _at(f, a + 8, 4), a + 12, min(a + 8 + n, b)
        else:
            yield kind, a + 8, min(a + 8 + n, b)
        a += 8 + n + n % 2


def _avi(f, size: int) -> Facts | None:
    out, movie = Facts(), None
    for kind, a, b in _chunks(f, 12, size):
        if kind == b"LISThdrl":
            for inner, x, y in _chunks(f, a, b):
                if inner == b"LISTstrl" and out.width is None:
                    _avi_stream(f, {k: (i, j) for k, i, j in _chunks(f, x, y)}, out)
        elif kind == b"LISTmovi":
            movie = a
            break
    if movie and out.codec == "RAW":
        row = (3 * out.width + 3) // 4 * 4
        bytes_ = row * out.height
        if _at(f, movie, 8) == struct.pack("<4sI", b"00db", bytes_):
            out.layout = ("avi", movie + 8, bytes_ + 8 + bytes_ % 2, bytes_)
    return out


def _avi_stream(f, parts: dict, out: Facts) -> None:
    head = _at(f, parts[b"strh"][0], 36)
    if head[:4] != b"vids":
        return
    scale, rate, _, length = struct.unpack("<IIII", head[20:36])
    _, width, height, _, bits, coding = struct.unpack("<IiiHHI", _at(f, parts[b"strf"][0], 20))
    out.width, out.height, out.frames, out.fps = width, abs(height), length, Fraction(rate, scale)
    out.seconds = float(length / out.fps)
    out.codec = "RAW" if coding == 0 and bits == 24 and height > 0 else struct.pack("<I", coding).decode("latin-1").strip("\0 ") or "RAW?"


def _number(f, a: int, keep_mark: bool) -> tuple[int, int]:
    """(value, next byte) of an EBML number of 1 to 8 bytes."""
    first = _at(f, a, 1)[0]
    n = 9 - first.bit_length() if first else 9
    if n > 8:
        raise ValueError("not an EBML number")
    raw = _at(f, a, n)
    value = int.from_bytes(raw, "big")
    return (value if keep_mark else value & ((1 << 7 * n) - 1)), a + n


def _elements(f, a: int, b: int):
    while a < b:
        kind, x = _number(f, a, True)
        start = x
        n, x = _number(f, x, False)
        end = b if n == (1 << 7 * (x - start)) - 1 else x + n  # all ones: to the end of the parent
        yield kind, x, min(end, b)
        a = end


def _matroska(f, size: int) -> Facts | None:
    #: Element ids.
    segment, info, tracks, cluster, scale, length, entry, kind, codec, step, video, width, height = 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x2AD7B1, 0x4489, 0xAE, 0x83, 0x86, 0x23E383, 0xE0, 0xB0, 0xBA

    def short(a: int, b: int, most: int = 8) -> bytes:
        if b - a > most:
            raise ValueError("too long a value")
        return _at(f, a, b - a)

    whole = lambda a, b: int.from_bytes(short(a, b), "big")
    for top, a, b in _elements(f, 0, size):
        if top != segment:
            continue
        unit, ticks, out = 1_000_000, None, None
        for k, x, y in _elements(f, a, b):
            if k == cluster:
                break
            if k == info:
                for c, i, j in _elements(f, x, y):
                    if c == scale:
                        unit = whole(i, j)
                    elif c == length:
                        ticks = struct.unpack(">f" if j - i == 4 else ">d", short(i, j))[0]
            elif k == tracks:
                for c, i, j in _elements(f, x, y):
                    held = {e: (p, q) for e, p, q in _elements(f, i, j)} if c == entry else {}
                    if out is None and kind in held and whole(*held[kind]) == 1:
                        inner = {e: whole(p, q) for e, p, q in _elements(f, *held[video]) if e in (width, height)}
                        name = short(*held[codec], 256).decode("latin-1").strip("\0")
                        out = Facts(name, Fraction(1_000_000_000, whole(*held[step])) if step in held else None, None, inner.get(width), inner.get(height))
        if out:
            out.fps = out.fps and out.fps.limit_denominator(1001)
            out.seconds = None if ticks is None else ticks * unit / 1e9
            out.frames = round(out.seconds * out.fps) if out.seconds is not None and out.fps else None
        return out
    return None


def _y4m(f, size: int) -> Facts | None:
    f.seek(0)
    line = f.read(256).split(b"\n")[0]
    given = {x[:1]: x[1:].decode("ascii") for x in line.split()[1:]}
    w, h = int(given[b"W"]), int(given[b"H"])
    fps = Fraction(*map(int, given.get(b"F", "25:1").split(":")))
    chroma = given.get(b"C", "420")
    extra = 0 if chroma.startswith("mono") else 2 * w * h if chroma.startswith("444") else 2 * ((w + 1) // 2) * ((h + 1) // 2) if chroma.startswith("420") else None
    if extra is None:
        return Facts("Y4M", fps, None, w, h)
    step = 6 + w * h + extra
    frames = (size - len(line) - 1) // step
    return Facts("Y4M", fps, frames, w, h, float(frames / fps), (f"y4m-{chroma[:4]}", len(line) + 1 + 6, step, step - 6))


SCHEMA = "path string, codec string, fps double, fps_num long, fps_den long, frame_count long, width int, height int, duration_sec double"


def probe(spark: SparkSession, root: str) -> DataFrame:
    """Recordings below a folder with what their containers say: path, codec, fps (also as a fraction), frame_count, width, height, duration_sec; nulls for files that say nothing. Only heads and tables are read."""
    from .readers import VIDEO_EXTENSIONS

    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    x = x.where(" OR ".join(f"lower(path) LIKE '%{e}'" for e in (*VIDEO_EXTENSIONS, ".y4m", ".webm")))

    def run(batches):
        for b in batches:
            rows = []
            for path in b.column(0).to_pylist():
                got = facts_of(path) or Facts()
                fps = got.fps
                rows.append((path, got.codec, float(fps) if fps else None, fps.numerator if fps else None, fps.denominator if fps else None, got.frames, got.width, got.height, got.seconds))
            kinds = [pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return x.mapInArrow(run, SCHEMA)


def facts_of(path: str) -> Facts | None:
    system, at = store(path)
    with system.open_input_file(at) as f:
        return facts(f, f.size())


@dataclass
class Frames(InputPartition):
    path: str
    first: int
    last: int


class FrameSource(DataSource):
    """Options: path (file or folder of raw AVI or YUV4MPEG2 recordings); sample_fps (so many frames a second at most, at a fixed step) or every (each n-th frame). Partitions are runs of frames of about 64 MB."""

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return "video_id string, frame_idx int, timestamp_sec double, h int, w int, data binary"

    def reader(self, schema) -> FrameReader:
        return FrameReader(self.options)


class FrameReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.every, self.sample_fps = int(options.get("every", "1")), float(options.get("sample_fps", "0"))

    def partitions(self):
        system, path = store(self.path)
        found = system.get_file_info(path)
        below = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        out = []
        for name in sorted(x.path for x in below if x.type == fs.FileType.File and x.path.lower().endswith((".avi", ".y4m"))):
            with system.open_input_file(name) as f:
                got = facts(f, f.size())
            if got and got.layout and got.frames:
                run = max(1, PART // got.layout[3])
                out += [Frames(name, a, min(a + run, got.frames)) for a in range(0, got.frames, run)]
        return out or [Frames("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        system, _ = store(self.path)
        video = recording(partition.path).rpartition(".")[0]
        with system.open_input_file(partition.path) as f:
            got = facts(f, f.size())
            kind, first, step, size = got.layout
            n = max(1, round(got.fps / Fraction(self.sample_fps))) if self.sample_fps else self.every
            rows: list[tuple] = []
            for k in range(-(-partition.first // n) * n, partition.last, n):
                rows.append((video, k, float(k / got.fps), got.height, got.width, to_bgr(_at(f, first + k * step, size), kind, got.height, got.width)))
                if len(rows) * size >= BATCH:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["video_id", "frame_idx", "timestamp_sec", "h", "w", "data"])


def to_bgr(data: bytes, kind: str, h: int, w: int) -> bytes:
    """A stored frame as BGR bytes, rows from the top."""
    raw = np.frombuffer(data, np.uint8)
    if kind == "avi":
        return raw.reshape(h, -1)[::-1, : 3 * w].tobytes()
    y = raw[: h * w].reshape(h, w).astype(np.float64)
    if kind.startswith("y4m-mono"):
        return np.repeat(y.astype(np.uint8)[..., None], 3, 2).tobytes()
    full = kind.startswith("y4m-444")
    ch, cw = (h, w) if full else ((h + 1) // 2, (w + 1) // 2)
    u, v = (raw[h * w + i * ch * cw : h * w + (i + 1) * ch * cw].reshape(ch, cw).astype(np.float64) - 128 for i in (0, 1))
    if not full:
        u, v = (np.repeat(np.repeat(c, 2, 0), 2, 1)[:h, :w] for c in (u, v))
    y = 1.164383 * (y - 16)
    bgr = np.stack([y + 2.017232 * u, y - 0.391762 * u - 0.812968 * v, y + 1.596027 * v], 2)
    return np.clip(np.rint(bgr), 0, 255).astype(np.uint8).tobytes()


def encode_avi(frames: list[bytes], h: int, w: int, fps: Fraction) -> bytes:
    """An uncompressed AVI file of BGR frames: a clip that fits in memory."""
    row = (3 * w + 3) // 4 * 4
    size = row * h
    chunk = lambda kind, body: struct.pack("<4sI", kind, len(body)) + body + b"\0" * (len(body) % 2)
    group = lambda name, *parts: chunk(b"LIST", name + b"".join(parts))
    avih = struct.pack("<14I", round(1e6 / fps), 0, 0, 0, len(frames), 0, 1, size, w, h, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"DIB ", 0, 0, 0, 0, fps.denominator, fps.numerator, 0, len(frames), size, 0, 0, 0, 0, w, h)
    strf = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, size, 0, 0, 0, 0)
    movie = io.BytesIO()
    for data in frames:
        img = np.zeros((h, row), np.uint8)
        img[:, : 3 * w] = np.frombuffer(data, np.uint8).reshape(h, 3 * w)[::-1]
        movie.write(chunk(b"00db", img.tobytes()))
    body = b"AVI " + group(b"hdrl", chunk(b"avih", avih), group(b"strl", chunk(b"strh", strh), chunk(b"strf", strf))) + group(b"movi", movie.getvalue())
    return struct.pack("<4sI", b"RIFF", len(body)) + body
