"""Keyed, reproducible randomness.

A row's random numbers are a pure function of ``(seed, key, tags)``: an md5 digest cut
to 48 bits and mapped into (0, 1). The result does not depend on partitioning, task
retries, executor loss or streaming micro-batch boundaries, unlike ``rand``/``randn``.
The same digest is available in most SQL engines, which gives the noise a value oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TWO_48 = float(2**48)
_TWO_PI = 2.0 * math.pi


def keyed_bits48(seed: int, key: Column, *tags: str) -> Column:
    """First 48 bits of md5("seed|key|tag|..."), as BIGINT in [0, 2^48)."""
    msg = F.concat_ws("|", F.lit(str(seed)), key.cast("string"), *[F.lit(t) for t in tags])
    return F.conv(F.substring(F.md5(msg), 1, 12), 16, 10).cast("bigint")


def keyed_uniform(seed: int, key: Column, *tags: str) -> Column:
    """Uniform double in the open interval (0, 1)."""
    return (keyed_bits48(seed, key, *tags).cast("double") + F.lit(0.5)) / F.lit(_TWO_48)


def keyed_gauss(seed: int, key: Column, axis: str) -> Column:
    """Standard normal draw by Box-Muller over two keyed uniforms."""
    u1 = keyed_uniform(seed, key, axis, "1")
    u2 = keyed_uniform(seed, key, axis, "2")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(_TWO_PI) * u2)


def _gauss(seed: int, key: Column, std: float) -> tuple[Column, Column]:
    """Independent normal shifts of both axes."""
    return F.lit(std) * keyed_gauss(seed, key, "x"), F.lit(std) * keyed_gauss(seed, key, "y")


def _polar(seed: int, key: Column, radius: Column) -> tuple[Column, Column]:
    """A shift of the given length in a keyed direction."""
    angle = F.lit(_TWO_PI) * keyed_uniform(seed, key, "angle")
    return radius * F.cos(angle), radius * F.sin(angle)


def _disc(seed: int, key: Column, std: float) -> tuple[Column, Column]:
    """Uniform over a disc of radius 2 std, which has deviation std on each axis: within the
    fraction u of its area lies the radius 2 std sqrt(u)."""
    return _polar(seed, key, F.lit(2.0 * std) * F.sqrt(keyed_uniform(seed, key, "radius")))


def _truncated(seed: int, key: Column, std: float, cut: float = 2.0) -> tuple[Column, Column]:
    """Normal on both axes, but never further than ``cut`` deviations from the point: the
    radius by the inverse of its distribution function below the cut."""
    mass = 1.0 - math.exp(-cut * cut / 2.0)
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - F.lit(mass) * keyed_uniform(seed, key, "radius")))
    return _polar(seed, key, F.lit(std) * radius)


def _laplace(seed: int, key: Column, std: float) -> tuple[Column, Column]:
    """Double exponential on each axis with deviation std: mostly small shifts, some large."""
    scale = F.lit(std / math.sqrt(2.0))

    def axis(name: str) -> Column:
        u = keyed_uniform(seed, key, name) - F.lit(0.5)
        return -scale * F.signum(u) * F.log(F.lit(1.0) - F.lit(2.0) * F.abs(u))

    return axis("x"), axis("y")


#: Shapes of the shift, by name: (seed, key, standard deviation) -> (x shift, y shift).
SHAPES = {"gauss": _gauss, "disc": _disc, "laplace": _laplace, "truncated": _truncated}


def with_perturbed(
    df: DataFrame,
    x: str,
    y: str,
    key: str,
    seed: int,
    noise_std: float,
    width: float,
    height: float,
    out_x: str,
    out_y: str,
    where: Column | None = None,
    shape: str = "gauss",
) -> DataFrame:
    """Adds ``out_x, out_y``: a shift of the given shape (``SHAPES``), clip to the canvas, round half-to-even,
    and move x by +10 (mod width) when the result landed back on the original point.

    Rows failing ``where`` get NULLs and no digest is computed for them. Three small
    projections, so the digests and the rounded values are each computed once.
    """
    keep = [F.col(c) for c in df.columns]
    cx, cy = F.col(x), F.col(y)
    gate = where if where is not None else F.lit(True)
    if shape not in SHAPES:
        raise ValueError(f"unknown noise shape {shape!r}; known: {sorted(SHAPES)}")
    dx, dy = SHAPES[shape](seed, F.col(key), float(noise_std))
    s = df.select(*keep, F.when(gate, cx.cast("double") + dx).alias("_n_x"), F.when(gate, cy.cast("double") + dy).alias("_n_y"))
    s = s.select(
        *keep,
        F.rint(F.greatest(F.lit(0.0), F.least(F.lit(float(width)), F.col("_n_x")))).cast("bigint").alias("_n_x"),
        F.rint(F.greatest(F.lit(0.0), F.least(F.lit(float(height)), F.col("_n_y")))).cast("bigint").alias("_n_y"),
    )
    nx, ny = F.col("_n_x"), F.col("_n_y")
    landed_back = (nx == cx) & (ny == cy)
    return s.select(
        *keep,
        F.when(landed_back, F.pmod(cx + F.lit(10), F.lit(int(width)))).otherwise(nx).alias(out_x),
        ny.alias(out_y),
    )


def hash_fraction(seed: int, key: Column, salt: str) -> Column:
    """Keyed uniform in [0, 1) used for repeatable splits (``bits / 2^48``)."""
    return keyed_bits48(seed, key, salt).cast("double") / F.lit(_TWO_48)
