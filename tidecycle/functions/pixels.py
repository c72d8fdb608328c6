"""Features of raw frames: columns video_id, frame_idx, h, w, data (BGR bytes), one row per frame.

The decoder is outside the engine; frames come as bytes. Kernels are NumPy over Arrow batches, one call per frame.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import motion as motions

#: Regions of the frame of a quarter of its size, as shares (x0, y0, x1, y1).
FULL = {"full": (0.0, 0.0, 1.0, 1.0)}


def frame(data: bytes, h: int, w: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(h, w, 3)


def crop(img: np.ndarray, roi: tuple[float, float, float, float], rounded: bool = False) -> np.ndarray:
    """Region of a frame; its edges are cut to whole pixels, or rounded half to even."""
    h, w = img.shape[:2]
    cut = (lambda v: int(round(v))) if rounded else int
    x0, y0, x1, y1 = roi
    return img[cut(y0 * h) : cut(y1 * h), cut(x0 * w) : cut(x1 * w)]


def luma(img: np.ndarray) -> np.ndarray:
    b, g, r = (img[..., k].astype(np.int32) for k in range(3))
    return ((77 * r + 150 * g + 29 * b) >> 8).astype(np.uint8)


def entropy(gray: np.ndarray) -> float:
    """Bits of the 256-bin histogram."""
    p = np.bincount(gray.ravel(), minlength=256) / max(gray.size, 1)
    p = p[p > 0]
    return float(-(p * np.log2(p)).sum()) + 0.0


def sobel_density(gray: np.ndarray) -> float:
    """Mean gradient magnitude of inner pixels over 255."""
    g = gray.astype(np.float64)
    if min(g.shape) < 3:
        return 0.0
    row = g[:-2] + 2 * g[1:-1] + g[2:]
    col = g[:, :-2] + 2 * g[:, 1:-1] + g[:, 2:]
    return float(np.hypot(row[:, 2:] - row[:, :-2], col[2:] - col[:-2]).mean() / 255)


def laplacian(gray: np.ndarray) -> np.ndarray:
    g = gray.astype(np.float64)
    return g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]


def laplacian_variance(gray: np.ndarray) -> float:
    x = laplacian(gray)
    return float(x.var()) if x.size >= 2 else 0.0


def laplacian_deviation(gray: np.ndarray) -> float:
    """Root of the variance: the other definition in use under the same column name."""
    return float(np.sqrt(laplacian_variance(gray)))


def dark_ratio(img: np.ndarray, limit: int = 35) -> float:
    return float((img < limit).all(-1).mean()) if img.size else 0.0


def motion(gray: np.ndarray, before: np.ndarray | None) -> float:
    """Mean absolute difference from the frame before; 0 for the first."""
    return 0.0 if before is None or before.shape != gray.shape else float(np.abs(gray.astype(np.int16) - before).mean())


def histogram_correlation(a: np.ndarray, b: np.ndarray) -> float:
    """Correlation of the two histograms; 1 if either is flat."""
    x, y = (np.bincount(v.ravel(), minlength=256).astype(float) for v in (a, b))
    return float(np.corrcoef(x, y)[0, 1]) if x.std() and y.std() else 1.0


def mask_box(mask: np.ndarray) -> tuple[int, int, int, int, int]:
    """(area, x, y, w, h) of the set pixels of a bitmap; zeros if there are none."""
    ys, xs = np.nonzero(mask)
    return (len(xs), int(xs.min()), int(ys.min()), int(np.ptp(xs)) + 1, int(np.ptp(ys)) + 1) if len(xs) else (0, 0, 0, 0, 0)


def mask_boxes(masks: DataFrame, key: str) -> DataFrame:
    """(key, area, x, y, w, h) of bitmaps: columns key, h, w, data (a byte per pixel, set if not 0)."""

    def run(batches):
        for b in batches:
            boxes = [mask_box(np.frombuffer(d, np.uint8).reshape(h, w)) for h, w, d in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
            cols = list(zip(*boxes)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int32()) for c in cols)], names=[key, "area", "x", "y", "w", "h"])

    rows = masks.select(key, "h", "w", "data")
    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, area int, x int, y int, w int, h int")


FEATURES = "roi_name string, mean_brightness float, brightness_std float, mean_r float, mean_g float, mean_b float, motion_intensity float, edge_density float, laplacian_variance float, entropy float, dark_ratio float, scene_correlation float"
#: With `stabilize`: shift of the whole frame before, the motion that is left when it is undone, and edges by hysteresis.
MOTION = "global_motion_x float, global_motion_y float, global_motion_mag float, local_motion_intensity float, canny_density float"


def _rows(r, rois: dict, before: dict | None, stabilize: bool) -> tuple[list[tuple], dict]:
    """Features of a frame's regions; and its grey regions, which the next frame needs (with "" for the whole)."""
    img, rows, held = frame(r.data, r.h, r.w), [], {}
    shift, still = (0.0, 0.0), None
    if stabilize:
        held[""] = luma(img)
        if before and before[""].shape == held[""].shape:
            shift = motions.phase_shift(held[""], before[""])
            still = motions.stabilized(held[""], shift)
    for name, roi in rois.items():
        part = crop(img, roi)
        held[name] = g = luma(part)
        last = before and before[name]
        b, gr, rd = part.reshape(-1, 3).mean(0)
        row = (r.video_id, r.frame_idx, name, g.mean(), g.std(), rd, gr, b, motion(g, last), sobel_density(g), laplacian_variance(g), entropy(g), dark_ratio(part), 1.0 if last is None else histogram_correlation(g, last))
        if stabilize:
            row += (*shift, float(np.hypot(*shift)), 0.0 if still is None else motion(crop(still[..., None], roi)[..., 0], last), motions.hysteresis_density(g))
        rows.append(row)
    return rows, held


def extract(frames: DataFrame, rois: dict[str, tuple[float, float, float, float]] | None = None, stabilize: bool = False, block: int = 1000) -> DataFrame:
    """One row per frame and region with its features (FEATURES; with `stabilize` also MOTION).

    A frame needs the one before it alone. So a recording is cut into blocks of `block` frame numbers, tasks of their
    own, and the last frame of a block also goes to the next one that has frames: a recording of any length is spread
    over all tasks, and a frame is sent once, or twice at a seam.
    """
    rois = rois or FULL
    columns = f"{FEATURES}, {MOTION}" if stabilize else FEATURES
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches):
        at, before = None, None
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if at != (r.video_id, r.block):
                    at, before = (r.video_id, r.block), None
                found, before = _rows(r, rois, before, stabilize)
                rows += found if r.own else []
            yield pd.DataFrame(rows, columns=["video_id", "frame_idx", *names])

    x = frames.select("video_id", "frame_idx", "h", "w", "data").withColumn("block", F.floor(F.col("frame_idx") / block))
    seams = x.groupBy("video_id", "block").agg(F.max("frame_idx").alias("frame_idx"))
    seams = seams.withColumn("next", F.lead("block").over(Window.partitionBy("video_id").orderBy("block"))).where("next IS NOT NULL").select("video_id", "frame_idx", "next")
    places = F.array_compact(F.array(F.struct(F.col("block"), F.lit(True).alias("own")), F.when(F.col("next").isNotNull(), F.struct(F.col("next").alias("block"), F.lit(False).alias("own")))))
    dealt = x.join(seams, ["video_id", "frame_idx"], "left").withColumn("place", F.explode(places)).select("video_id", "frame_idx", "h", "w", "data", "place.*")
    dealt = dealt.repartition("video_id", "block").sortWithinPartitions("video_id", "block", "frame_idx")
    return dealt.mapInPandas(run, f"video_id string, frame_idx int, {columns}")
