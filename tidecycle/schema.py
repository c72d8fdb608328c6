"""Column types of the engine's tables, and checks of tables and parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns of the frozen feature table, in order; numeric features are 32-bit floats.
FEATURE_COLUMNS = [
    "video_id", "frame_idx", "timestamp_sec", "roi_name", "sample_fps", "mean_brightness", "brightness_std", "mean_r", "mean_g", "mean_b",
    "motion_intensity", "edge_density", "laplacian_variance", "entropy", "scene_transition", "global_motion_x", "global_motion_y",
    "global_motion_mag", "local_motion_intensity", "brightness_rolling_mean_30s", "brightness_rolling_std_30s", "motion_rolling_mean_30s",
    "motion_rolling_std_30s",
]
#: Features of the coarse table and of the column file.
COARSE_FEATURES = ["mean_brightness", "brightness_std", "mean_r", "mean_g", "mean_b", "motion_intensity", "edge_density", "laplacian_variance", "entropy"]
#: Regions by their code.
ROI_CODES = {0: "left_deck", 1: "transfer", 2: "right_deck"}


def _kind(name: str) -> T.DataType:
    return T.StringType() if name in ("video_id", "roi_name") else T.IntegerType() if name == "frame_idx" else T.FloatType()


FEATURES = T.StructType([T.StructField(n, _kind(n)) for n in FEATURE_COLUMNS])
COARSE = T.StructType([T.StructField(n, _kind(n)) for n in ["video_id", "frame_idx", "timestamp_sec", "roi_name", *COARSE_FEATURES]])
KEYS = ("video_id", "frame_idx", "roi_name")


def conform(df: DataFrame, schema: T.StructType, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """`df` with the columns of `schema`, cast; missing ones are null, but keys must be there. Further columns stay behind. NaN becomes null."""
    missing = [k for k in keys if k in schema.names and k not in df.columns]
    if missing:
        raise ValueError(f"key columns are missing: {missing}")
    return nan_to_null(df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark's aggregates skip null but not NaN, so NaN becomes null once, on the way in."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def check_config(config: dict) -> list[str]:
    """What is wrong with sampling and region parameters; an empty list if nothing is.

    Regions: {name: (x0, y0, x1, y1)} as shares of the frame. Sampling: normal_fps, burst_fps, threshold, workers.
    """
    wrong = []
    for name, (x0, y0, x1, y1) in config.get("roi", {}).items():
        if not all(0 <= v <= 1 for v in (x0, y0, x1, y1)):
            wrong.append(f"roi {name}: outside 0..1")
        if x0 >= x1 or y0 >= y1:
            wrong.append(f"roi {name}: empty")
    if not 0 < config.get("threshold", 0.5) < 1:
        wrong.append("threshold: not between 0 and 1")
    if config.get("burst_fps", 2) <= config.get("normal_fps", 1):
        wrong.append("burst_fps: not above normal_fps")
    if config.get("workers", 1) < 1:
        wrong.append("workers: below 1")
    return wrong
