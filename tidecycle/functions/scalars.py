"""Scalar expressions: guarded arithmetic, classification rules, scores, arrays and formats."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def guarded(a: Column, b: Column, least: float = 1e-6) -> Column:
    """a / b with the divisor floored, so that it is never 0."""
    return a / F.greatest(b, F.lit(least))


def argmax(p: Column) -> Column:
    """Index from 0 of the greatest element; the first of equal ones; null for null or empty arrays."""
    return F.when(F.size(p) > 0, F.array_position(p, F.array_max(p)) - 1)


def histogram_entropy(counts: Column) -> Column:
    """Shannon entropy in bits of an array of counts; 0 when all are in one bin or there are none."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(counts, F.lit(0.0), lambda a, x: a - F.when(x > 0, x / total * F.log2(x / total)).otherwise(0.0))


@F.pandas_udf(DoubleType())
def byte_entropy(texts: pd.Series) -> pd.Series:
    """Shannon entropy in bits of the 256 bins of a text's UTF-8 bytes; 0 for empty and null texts."""

    def one(text: str | None) -> float:
        n = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256) if text else np.zeros(1)
        p = n[n > 0] / max(n.sum(), 1)
        return float(-(p * np.log2(p)).sum()) + 0.0

    return texts.map(one, na_action=None).astype(float)


def gray(r: Column, g: Column, b: Column) -> Column:
    """Integer luma: (77 r + 150 g + 29 b) >> 8."""
    return F.shiftright((77 * r + 150 * g + 29 * b).cast("int"), 8)


def roi_pixels(share: Column, size: Column, rounded: bool = False) -> Column:
    """Pixel of a share of the frame: cut, or rounded half to even."""
    return F.bround(share * size).cast("int") if rounded else (share * size).cast("int")


def roi_quarter(pixel: Column) -> Column:
    """Pixel of the full frame on the frame of a quarter of its width."""
    return F.floor(pixel / 4).cast("int")


def activity_score(density: Column, active: Column, variation: Column) -> Column:
    """0.5 density + 0.3 active share + 0.2 variation, each capped at 1."""
    one = F.lit(1.0)
    return 0.5 * F.least(density, one) + 0.3 * F.least(active, one) + 0.2 * F.least(variation, one)


def is_operating(cycles: Column, active: Column, snr: Column) -> Column:
    """Three cycles and a share of 0.18 active minutes, or two cycles and a clear period (signal to noise 5)."""
    return ((cycles >= 3) & (active >= 0.18)) | ((cycles >= 2) & (F.coalesce(snr, F.lit(0.0)) >= 5))


def window_issues(core_min: Column, increase: Column, cycle_min: Column) -> Column:
    """What casts doubt on a core window, as texts."""
    # Limits and their wording.
    return F.array_compact(F.array(
        F.when(core_min < 15, "core window too short"),
        F.when(core_min > 30, "core window too long"),
        F.when(increase < 1.05, "weak right-deck signal"),
        F.when(cycle_min > 60, "abnormally long cycle"),
    ))


def confidence(issues: Column) -> Column:
    return F.when(F.size(issues) == 0, "HIGH").when(F.size(issues) == 1, "MEDIUM").otherwise("LOW")


def box_geometry(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> dict[str, Column]:
    """Area, centre, aspect and the centre-size form relative to the frame."""
    w, h = x1 - x0, y1 - y0
    return {"area": w * h, "cx": (x0 + x1) / 2, "cy": (y0 + y1) / 2, "aspect": w / F.nullif(h, F.lit(0)), "rel_cx": (x0 + x1) / 2 / width, "rel_cy": (y0 + y1) / 2 / height, "rel_w": w / width, "rel_h": h / height}


def label_line(cls: Column, cx: Column, cy: Column, w: Column, h: Column) -> Column:
    return F.format_string("%d %.6f %.6f %.6f %.6f", cls, cx, cy, w, h)


def mask_score(area: Column, w: Column, h: Column, roi_w: Column, roi_h: Column) -> Column:
    """How much a mask looks like a hanging net: share of the height, height to width, narrow against the region, compact."""
    one = F.lit(1.0)
    return (h / roi_h) * (h / F.greatest(w, one)) * F.greatest(F.lit(0.0), 1 - w / roi_w) * (area / F.greatest(w * h, one))


def mask_ok(area: Column, x: Column, w: Column, h: Column, roi_w: Column, roi_h: Column) -> Column:
    """Four tests of a mask: slender, tall enough, its centre right of the middle, compact."""
    one = F.lit(1.0)
    centre = (x + w / 2) / roi_w
    return (h / F.greatest(w, one) >= 1.5) & (h / roi_h >= 0.25) & centre.between(0.4, 0.9) & (area / F.greatest(w * h, one) >= 0.3)


def rate(text: Column) -> Column:
    """A rational text such as 30000/1001 as a number."""
    return F.split_part(text, F.lit("/"), F.lit(1)).cast("double") / F.nullif(F.coalesce(F.nullif(F.split_part(text, F.lit("/"), F.lit(2)), F.lit("")), F.lit("1")).cast("double"), F.lit(0.0))


def stem(path: Column) -> Column:
    """File name without folders and extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def zero_padded(n: Column, width: int) -> Column:
    """A number of at least `width` digits."""
    return F.format_string(f"%0{width}d", n)


def has_extension(path: Column, *extensions: str) -> Column:
    out = F.lit(False)
    for e in extensions:
        out = out | F.endswith(F.lower(path), F.lit(e))
    return out


def six_decimals(x: Column) -> Column:
    return F.format_string("%.6f", x.cast("double"))
