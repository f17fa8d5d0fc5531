"""Audit of pair JSON lines: one pass, nine counters (a single partial+final aggregate).

Every line counts, blank ones included (they are JSON errors). A line is a valid pair
when it is one JSON object holding the keys prompt, chosen and rejected (a ``null``
value still counts as present). For both chosen and rejected:
- coordinates are checked only in strings that contain ``CLICK:`` or ``LONG_PRESS:``;
  an unreadable coordinate text counts in neither bucket;
- the action family is counted by substring with precedence CLICK, TYPE, LONG_PRESS,
  SCROLL (COMPLETE, INCOMPLETE and STOP are not counted).

Divergences from the original (which crashes on them): valid JSON that is not an object
is an invalid pair; a non-string chosen/rejected adds no coordinate or family count.
"""

from __future__ import annotations

import functools
import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.functions.jsonline import (
    action_family,
    has_key,
    is_object,
    is_strict_json,
    plain_numbers,
    string_field,
    with_coord_check,
    wrapped_variant,
)

FAMILIES = ("action_click", "action_type", "action_long_press", "action_scroll")


def _python_verdicts(lines: pd.Series) -> pd.DataFrame:
    """json.loads verdicts for the lines the JVM check rejected (NULL for the others)."""
    kinds, chosen, rejected = [], [], []
    for line in lines:
        k = c = r = None
        if line is not None:
            try:
                obj = json.loads(line)
            except json.JSONDecodeError:
                k = "json_error"
            else:
                ok = isinstance(obj, dict) and all(key in obj for key in ("prompt", "chosen", "rejected"))
                k = "valid" if ok else "invalid"
                if ok:
                    c = obj["chosen"] if isinstance(obj["chosen"], str) else None
                    r = obj["rejected"] if isinstance(obj["rejected"], str) else None
        kinds.append(k)
        chosen.append(c)
        rejected.append(r)
    return pd.DataFrame({"kind": kinds, "chosen": chosen, "rejected": rejected})


@functools.cache
def _python_lane():
    # Built on first use: a pandas UDF needs an active session to be created.
    return F.pandas_udf(_python_verdicts, "kind string, chosen string, rejected string")


def classify_lines(
    lines: DataFrame,
    line_col: str = "value",
    canvas: tuple[int, int] = K.DEFAULT_CANVAS,
    python_lane: bool = False,
    bare_numbers: bool = False,
) -> DataFrame:
    """Per line: kind in {valid, invalid, json_error}, and for valid pairs the coordinate
    verdict and family of chosen and rejected. Each stage is its own projection so the
    JSON is parsed once per line.

    ``bare_numbers`` takes NaN, Infinity and -Infinity for numbers, as ``json.loads`` does.
    ``python_lane`` re-checks the lines the JVM rejects with ``json.loads`` (such literals,
    duplicate keys in any session). Accepted lines reach it as NULL,
    so on well-formed data almost nothing crosses to Python.
    """
    w_, h_ = canvas
    line = F.col(line_col)
    plain = lines.select(line.alias("line"), (plain_numbers(line) if bare_numbers else line).alias("plain"))
    parsed = plain.select("line", "plain", wrapped_variant(F.col("plain")).alias("w"))
    checked = parsed.select(
        "line",
        "w",
        is_strict_json(F.col("plain"), F.col("w")).alias("ok"),
    )
    fast_kind = (
        F.when(~F.col("ok"), F.lit("json_error"))
        .when(
            is_object(F.col("w"))
            & has_key(F.col("w"), "prompt")
            & has_key(F.col("w"), "chosen")
            & has_key(F.col("w"), "rejected"),
            F.lit("valid"),
        )
        .otherwise(F.lit("invalid"))
    )
    fast_chosen = F.when(F.col("ok"), string_field(F.col("w"), "chosen"))
    fast_rejected = F.when(F.col("ok"), string_field(F.col("w"), "rejected"))
    if python_lane:
        slow = checked.select(
            "ok",
            fast_kind.alias("_k"),
            fast_chosen.alias("_c"),
            fast_rejected.alias("_r"),
            _python_lane()(F.when(~F.col("ok"), F.col("line"))).alias("_py"),
        )
        kinds = slow.select(
            F.when(F.col("ok"), F.col("_k")).otherwise(F.col("_py.kind")).alias("kind"),
            F.when(F.col("ok"), F.col("_c")).otherwise(F.col("_py.chosen")).alias("chosen"),
            F.when(F.col("ok"), F.col("_r")).otherwise(F.col("_py.rejected")).alias("rejected"),
        )
    else:
        kinds = checked.select(fast_kind.alias("kind"), fast_chosen.alias("chosen"), fast_rejected.alias("rejected"))
    valid = F.col("kind") == "valid"
    checked = with_coord_check(kinds, "chosen", "chosen_coords_ok", w_, h_)
    checked = with_coord_check(checked, "rejected", "rejected_coords_ok", w_, h_)
    return checked.select(
        "kind",
        F.when(valid, F.col("chosen_coords_ok")).alias("chosen_coords_ok"),
        F.when(valid, F.col("rejected_coords_ok")).alias("rejected_coords_ok"),
        F.when(valid, action_family(F.col("chosen"))).alias("chosen_family"),
        F.when(valid, action_family(F.col("rejected"))).alias("rejected_family"),
    )


def audit_lines(
    lines: DataFrame,
    line_col: str = "value",
    canvas: tuple[int, int] = K.DEFAULT_CANVAS,
    python_lane: bool = False,
    bare_numbers: bool = False,
) -> DataFrame:
    """One row with valid_pairs, invalid_pairs, json_errors, valid_coords,
    invalid_coords, action_click, action_type, action_long_press, action_scroll
    (all BIGINT, 0 on empty input). See ``classify_lines`` for ``python_lane``
    and ``bare_numbers``."""
    c = classify_lines(lines, line_col, canvas, python_lane, bare_numbers)
    kind = F.col("kind")
    cc, rc = F.col("chosen_coords_ok"), F.col("rejected_coords_ok")
    cf, rf = F.col("chosen_family"), F.col("rejected_family")
    return c.agg(
        F.count_if(kind == "valid").alias("valid_pairs"),
        F.count_if(kind == "invalid").alias("invalid_pairs"),
        F.count_if(kind == "json_error").alias("json_errors"),
        (F.count_if(cc) + F.count_if(rc)).alias("valid_coords"),
        (F.count_if(~cc) + F.count_if(~rc)).alias("invalid_coords"),
        *[(F.count_if(cf == f) + F.count_if(rf == f)).alias(f) for f in FAMILIES],
    )


def audit_file(spark, path: str, canvas: tuple[int, int] = K.DEFAULT_CANVAS, python_lane: bool = False) -> DataFrame:
    """Audit a written JSONL file or folder (read back as raw lines). NaN and Infinity are
    numbers, as they are for the original's reader."""
    return audit_lines(spark.read.text(path), "value", canvas, python_lane, bare_numbers=True)


def summary(spark, path: str, canvas: tuple[int, int] = K.DEFAULT_CANVAS, python_lane: bool = False) -> DataFrame:
    """The end-of-run report as one row: output path plus all nine counters
    (``invalid_pairs`` included, which the original counted but never printed)."""
    return audit_file(spark, path, canvas, python_lane).select(F.lit(path).alias("output_path"), "*")


def pair_actions(pairs: DataFrame) -> DataFrame:
    """Unpivot chosen and rejected: one row per (pair, side)."""
    return pairs.select(
        "entry_id",
        "strategy_ord",
        F.inline(
            F.array(
                F.struct(F.lit("chosen").alias("side"), F.col("chosen").alias("action")),
                F.struct(F.lit("rejected").alias("side"), F.col("rejected").alias("action")),
            )
        ),
    )


def action_distribution(pairs: DataFrame) -> DataFrame:
    """Counts per action family over chosen + rejected. Four keys only; partial
    aggregation on the map side keeps the hot keys cheap."""
    fam = action_family(F.col("action"))
    return (
        pair_actions(pairs)
        .select(fam.alias("family"))
        .filter(F.col("family").isNotNull())
        .groupBy("family")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def coords_out_of_range(pairs: DataFrame, canvas: tuple[int, int] = K.DEFAULT_CANVAS) -> DataFrame:
    """Pair sides whose coordinates the audit counts as out of range."""
    w_, h_ = canvas
    checked = with_coord_check(pair_actions(pairs), "action", "_coords_ok", w_, h_)
    return checked.filter(F.col("_coords_ok") == F.lit(False)).drop("_coords_ok")
