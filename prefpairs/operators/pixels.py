"""De-normalise [0, canvas] coordinates to device pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.functions.actions import to_pixels


def with_pixels(
    parsed: DataFrame,
    device_width: Column | float,
    device_height: Column | float,
    canvas: tuple[int, int] = K.DEFAULT_CANVAS,
) -> DataFrame:
    """Adds ``px = x / W * device_width`` and ``py = y / H * device_height`` (doubles,
    no rounding; NULL where the action has no coordinates)."""
    w, h = canvas
    return parsed.withColumn("px", to_pixels(F.col("x"), device_width, w)).withColumn(
        "py", to_pixels(F.col("y"), device_height, h)
    )
