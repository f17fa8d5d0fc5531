"""Schemas and the job configuration.

Every read in this package uses one of these explicit schemas; nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from prefpairs import constants as K

MESSAGE = T.StructType(
    [
        T.StructField("from", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
    ]
)

# One instruction -> action record. ``entry_id`` is the row position (or any unique,
# stable key); it orders prefixes and seeds the per-row noise.
ENTRY = T.StructType(
    [
        T.StructField("entry_id", T.LongType(), True),
        T.StructField("conversations", T.ArrayType(MESSAGE, True), True),
    ]
)

PARSED = T.StructType(
    [
        T.StructField("entry_id", T.LongType(), True),
        T.StructField("instruction", T.StringType(), True),
        T.StructField("action_type", T.StringType(), True),
        T.StructField("x", T.LongType(), True),
        T.StructField("y", T.LongType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("raw_action", T.StringType(), True),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("action_type", T.StringType(), True),
        T.StructField("rejection_strategy", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
    ]
)

# What goes to disk as JSON lines and what the training readers expect.
PAIR = T.StructType(
    [
        T.StructField("prompt", T.StringType(), True),
        T.StructField("chosen", T.StringType(), True),
        T.StructField("rejected", T.StringType(), True),
    ]
)

AUDIT_COUNTERS = (
    "valid_pairs",
    "invalid_pairs",
    "json_errors",
    "valid_coords",
    "invalid_coords",
    "action_click",
    "action_type",
    "action_long_press",
    "action_scroll",
)


@dataclass(frozen=True)
class PairConfig:
    """Data-side settings of the pair job.

    ``canvas`` bounds the perturbed coordinates and the audit's range check.
    ``unwrap_prompt`` strips one existing ``<image>\\nUser: ...\\nModel:`` wrapper
    before wrapping (the faithful default wraps twice, as the original output does).
    ``drop_degenerate`` removes pairs whose rejected equals chosen (off by default).
    ``noise_shape`` is the shape of the spatial shift (``gauss``, ``disc``, ``laplace``,
    ``truncated``), with deviation ``noise_std`` before it is cut.
    """

    seed: int = K.DEFAULT_SEED
    noise_std: float = K.DEFAULT_NOISE_STD
    canvas: tuple[int, int] = K.DEFAULT_CANVAS
    source: str = K.DEFAULT_SOURCE
    strategies: tuple[str, ...] = (K.SPATIAL, K.LOGICAL)
    unwrap_prompt: bool = False
    drop_degenerate: bool = False
    noise_shape: str = "gauss"
