import struct
from fractions import Fraction

import numpy as np
import pytest

from tidecycle.functions import pixels
from tidecycle.sources import video


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def mp4(times, scale=30000, size=(1920, 1080), codec=b"avc1", first=b"vide", wide=False, moov_last=True):
    frames, ticks = sum(n for n, _ in times), sum(n * d for n, d in times)
    mdhd = box(b"mdhd", struct.pack(">B3xQQIQI", 1, 0, 0, scale, ticks, 0) if wide else struct.pack(">IIIIII", 0, 0, 0, scale, ticks, 0))
    stsd = box(b"stsd", struct.pack(">II", 0, 1), struct.pack(">I4s", 86, codec), bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HH", *size), bytes(50))
    stts = box(b"stts", struct.pack(">II", 0, len(times)), *(struct.pack(">II", n, d) for n, d in times))
    hdlr = lambda k: box(b"hdlr", bytes(8), k, bytes(12))
    trak = lambda k: box(b"trak", box(b"tkhd", bytes(84)), box(b"mdia", mdhd, hdlr(k), box(b"minf", box(b"stbl", stsd, stts))))
    moov = box(b"moov", box(b"mvhd", bytes(100)), *([trak(b"soun")] if first == b"soun" else []), trak(b"vide"))
    mdat = box(b"mdat", bytes(1000))
    return box(b"ftyp", b"isom", bytes(4)) + (mdat + moov if moov_last else moov + mdat), frames, ticks


def ebml(kind, body):
    return bytes.fromhex(kind) + (0x10000000 | len(body)).to_bytes(4, "big") + body


def mkv(step=33366667, unknown=False):
    info = ebml("1549a966", ebml("2ad7b1", (1_000_000).to_bytes(3, "big")) + ebml("4489", struct.pack(">d", 10_010.0)))
    sound = ebml("ae", ebml("83", b"\x02") + ebml("86", b"A_AAC"))
    track = ebml("ae", ebml("83", b"\x01") + ebml("86", b"V_MPEGH/ISO/HEVC") + ebml("23e383", step.to_bytes(4, "big")) + ebml("e0", ebml("b0", (640).to_bytes(2, "big")) + ebml("ba", (480).to_bytes(2, "big"))))
    body = info + ebml("1654ae6b", sound + track) + ebml("1f43b675", bytes(50))
    return ebml("1a45dfa3", ebml("4282", b"matroska")) + (bytes.fromhex("18538067") + b"\x01" + b"\xff" * 7 + body if unknown else ebml("18538067", body))


def y4m(frames, h, w, chroma="444"):
    return f"YUV4MPEG2 W{w} H{h} F30000:1001 Ip C{chroma}\n".encode() + b"".join(b"FRAME\n" + f for f in frames)


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(2)
    files = {
        "a.mp4": mp4([(300, 1001)])[0], "b.mov": mp4([(10, 1000), (5, 2000)], 15000, (64, 48), b"hvc1", b"soun", True, False)[0],
        "c.mkv": mkv(), "d.mkv": mkv(unknown=True), "e.y4m": y4m([bytes(3 * 35)] * 4, 5, 7), "f.avi": video.encode_avi([rng.integers(0, 256, 3 * 15, np.uint8).tobytes() for _ in range(6)], 3, 5, Fraction(25)),
        "broken.mp4": mp4([(300, 1001)])[0][:1300], "empty.mp4": b"x", "text.avi": b"no recording at all, but long enough for a head of sixty-four bytes",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    return tmp_path


def test_probe(spark, folder):
    got = {r.path.rsplit("/", 1)[1]: r for r in video.probe(spark, str(folder)).collect()}
    say = lambda n: (got[n].codec, got[n].fps_num, got[n].fps_den, got[n].frame_count, got[n].width, got[n].height)
    assert say("a.mp4") == ("avc1", 30000, 1001, 300, 1920, 1080) and got["a.mp4"].duration_sec == pytest.approx(10.01)
    assert say("b.mov") == ("hvc1", 45, 4, 15, 64, 48) and got["b.mov"].duration_sec == pytest.approx(20000 / 15000)
    assert say("c.mkv") == say("d.mkv") == ("V_MPEGH/ISO/HEVC", 30000, 1001, 300, 640, 480)
    assert say("e.y4m") == ("Y4M", 30000, 1001, 4, 7, 5) and say("f.avi") == ("RAW", 25, 1, 6, 5, 3)
    for n in ("broken.mp4", "empty.mp4", "text.avi"):
        assert tuple(got[n])[1:] == (None,) * 8, n


def test_any_cut_of_a_file_is_survived():
    import io

    for data in (mp4([(300, 1001)], moov_last=False)[0], mkv(), y4m([bytes(105)] * 2, 5, 7), video.encode_avi([bytes(45)] * 2, 3, 5, Fraction(25))):
        for n in range(0, min(len(data), 700), 3):
            got = video.facts(io.BytesIO(data[:n]), n)
            assert got is None or got.width
    rng = np.random.default_rng(0)
    whole = mp4([(300, 1001)], moov_last=False)[0]
    for _ in range(500):
        data = bytearray(whole)
        for i in rng.integers(0, 700, 4):
            data[i] = rng.integers(0, 256)
        video.facts(io.BytesIO(bytes(data)), len(data))


def test_frames_of_uncompressed_recordings(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(4)
    h, w, n = 6, 5, 23
    frames = [rng.integers(0, 256, (h, w, 3)).astype(np.uint8) for _ in range(n)]
    (tmp_path / "clip.avi").write_bytes(video.encode_avi([f.tobytes() for f in frames], h, w, Fraction(10)))
    grey = [rng.integers(0, 256, (h, w)).astype(np.uint8) for _ in range(n)]
    (tmp_path / "grey.y4m").write_bytes(y4m([g.tobytes() for g in grey], h, w, "mono"))
    spark.dataSource.register(video.FrameSource)
    x = spark.read.format("frames").option("path", str(tmp_path)).load()
    got = {(r.video_id, r.frame_idx): r for r in x.collect()}
    assert len(got) == 2 * n and got["clip", 7].timestamp_sec == pytest.approx(0.7)
    for k in range(n):
        assert got["clip", k].data == frames[k].tobytes()
        assert got["grey", k].data == np.repeat(grey[k][..., None], 3, 2).tobytes()
    every = spark.read.format("frames").option("path", str(tmp_path / "clip.avi")).option("sample_fps", "2").load()
    assert sorted(r.frame_idx for r in every.collect()) == [0, 5, 10, 15, 20]
    monkeypatch.setattr(video, "PART", 4 * 16 * h)
    parts = video.FrameReader({"path": str(tmp_path), "every": "3"}).partitions()
    assert len(parts) >= 8 and sorted(k for p in parts if p.path.endswith("avi") for b in video.FrameReader({"path": str(tmp_path), "every": "3"}).read(p) for k in b.column(1).to_pylist()) == list(range(0, n, 3))
    out = {r.frame_idx: r for r in pixels.extract(x.where("video_id = 'clip'").drop("timestamp_sec")).collect()}
    assert out[3].motion_intensity == pytest.approx(np.abs(pixels.luma(frames[3]).astype(int) - pixels.luma(frames[2])).mean(), abs=1e-3)


@pytest.mark.parametrize("chroma", ["444", "420jpeg"])
def test_colours(chroma):
    h, w = 4, 6
    size = h * w if chroma == "444" else (h // 2) * (w // 2)
    for (y, u, v), bgr in {(16, 128, 128): (0, 0, 0), (235, 128, 128): (255, 255, 255), (81, 90, 240): (0, 0, 255), (145, 54, 34): (0, 255, 0), (41, 240, 110): (255, 0, 0)}.items():
        data = bytes([y]) * (h * w) + bytes([u]) * size + bytes([v]) * size
        out = np.frombuffer(video.to_bgr(data, f"y4m-{chroma[:4]}", h, w), np.uint8).reshape(h, w, 3)
        assert np.abs(out.astype(int) - bgr).max() <= 2
