"""Rejection strategies: from a parsed entry to a rejected action string.

A strategy has an optional ``prepare(df, cfg) -> df`` step that adds helper columns and
a ``rejected(cfg) -> Column`` builder over the parsed columns (entry_id, action_type, x,
y, text) plus ``chosen``. Strategies are registered by name; each selected strategy is
one branch of the per-row ``rejected`` expression after the pair expansion, so one scan
and one parse feed all of them (no union of branches).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.functions.actions import format_action, format_coords
from prefpairs.functions.noise import with_perturbed
from prefpairs.schema import PairConfig


@dataclass(frozen=True)
class Strategy:
    rejected: Callable[[PairConfig], Column]
    prepare: Callable[[DataFrame, PairConfig], DataFrame] | None = None


_REGISTRY: dict[str, Strategy] = {}


def register_strategy(
    name: str,
    rejected: Callable[[PairConfig], Column],
    prepare: Callable[[DataFrame, PairConfig], DataFrame] | None = None,
) -> Strategy:
    """Register (or replace) a rejection strategy under ``name``."""
    _REGISTRY[name] = Strategy(rejected, prepare)
    return _REGISTRY[name]


def get_strategy(name: str) -> Strategy:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"unknown rejection strategy {name!r}; known: {sorted(_REGISTRY)}") from None


def strategy_names() -> list[str]:
    return list(_REGISTRY)


def chosen_action() -> Column:
    return format_action(F.col("action_type"), F.col("x"), F.col("y"), F.col("text"))


def _movable() -> Column:
    return F.col("action_type").isin(*K.PERTURBED_ACTIONS) & F.col("x").isNotNull() & F.col("y").isNotNull()


def _spatial_prepare(df: DataFrame, cfg: PairConfig) -> DataFrame:
    w, h = cfg.canvas
    return with_perturbed(
        df, "x", "y", "entry_id", cfg.seed, cfg.noise_std, w, h, "_spatial_x", "_spatial_y", where=_movable(), shape=cfg.noise_shape
    )


def _spatial_rejected(cfg: PairConfig) -> Column:
    """"Fat finger": CLICK and LONG_PRESS with coordinates get a keyed shift;
    every other action is returned unchanged (rejected == chosen)."""
    moved = format_coords(F.col("action_type"), F.col("_spatial_x"), F.col("_spatial_y"))
    return F.when(_movable(), moved).otherwise(F.col("chosen"))


def _logical_rejected(cfg: PairConfig) -> Column:
    """"Hallucination": a fixed wrong action per type; coordinates and text ignored."""
    t = F.col("action_type")
    return (
        F.when(t == K.CLICK, F.lit(K.LOGICAL_FOR_CLICK))
        .when(t == K.TYPE, F.lit(K.LOGICAL_FOR_TYPE))
        .otherwise(F.lit(K.LOGICAL_DEFAULT))
    )


register_strategy(K.SPATIAL, _spatial_rejected, _spatial_prepare)
register_strategy(K.LOGICAL, _logical_rejected)
