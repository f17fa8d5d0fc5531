"""Parsing and formatting of action strings.

``parse_actions`` reproduces the generator's rules (prefix dispatch, remove every tag
occurrence, strip, split on ``,`` into exactly two numbers through ``int(float())``).
It is a chain of small projections: each intermediate (tag, body, parts) is computed
once per row and referenced by name, which keeps the generated code small.
``format_action`` is the canonical writer: ``TAG: (x, y)``, ``TYPE: "text"`` or a bare tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefpairs import constants as K
from prefpairs.functions.text import py_float_to_int, py_strip, strip_chars

# Prefix tested -> tag returned, in the order the generator tests them.
_DISPATCH = (
    (K.CLICK + ":", K.CLICK),
    (K.LONG_PRESS + ":", K.LONG_PRESS),
    (K.TYPE + ":", K.TYPE),
    (K.SCROLL + ":", K.SCROLL),
    (K.COMPLETE, K.COMPLETE),
    (K.INCOMPLETE, K.INCOMPLETE),
)

def action_tag(action: Column) -> Column:
    """The tag whose prefix the (stripped) action string starts with, else NULL."""
    expr = None
    for prefix, tag in _DISPATCH:
        cond = action.startswith(prefix)
        expr = F.when(cond, F.lit(tag)) if expr is None else expr.when(cond, F.lit(tag))
    return expr


def parse_actions(df: DataFrame, action_col: str, prefix: str = "", stripped: bool = False) -> DataFrame:
    """Adds ``action_type, x, y, text`` (named with ``prefix``) parsed from ``action_col``.

    ``action_type`` is NULL when the string cannot be parsed (the entry is then skipped).
    x/y are set for CLICK, LONG_PRESS and SCROLL; text for TYPE (may be empty).
    ``stripped`` skips the leading ``str.strip()`` when the column already had it.
    """
    keep = [F.col(c) for c in df.columns]
    s = df.select(*keep, (F.col(action_col) if stripped else py_strip(F.col(action_col))).alias("_a_s"))
    s = s.select(*keep, "_a_s", action_tag(F.col("_a_s")).alias("_a_tag"))
    body = py_strip(F.replace(F.col("_a_s"), F.concat(F.col("_a_tag"), F.lit(":")), F.lit("")))
    s = s.select(*keep, "_a_tag", body.alias("_a_body"))
    s = s.select(*keep, "_a_tag", "_a_body", F.split(strip_chars(F.col("_a_body"), "()"), ",", -1).alias("_a_parts"))
    two = F.size("_a_parts") == 2
    s = s.select(
        *keep,
        "_a_tag",
        "_a_body",
        F.when(two, py_float_to_int(F.get(F.col("_a_parts"), 0))).alias("_a_x"),
        F.when(two, py_float_to_int(F.get(F.col("_a_parts"), 1))).alias("_a_y"),
    )
    tag, px, py = F.col("_a_tag"), F.col("_a_x"), F.col("_a_y")
    coord_ok = tag.isin(*K.COORD_ACTIONS) & px.isNotNull() & py.isNotNull()
    action_type = (
        F.when(coord_ok, tag)
        .when(tag == K.TYPE, tag)
        .when(tag.isin(K.COMPLETE, K.INCOMPLETE), tag)
    )
    result = F.struct(
        action_type.alias(prefix + "action_type"),
        F.when(coord_ok, px).alias(prefix + "x"),
        F.when(coord_ok, py).alias(prefix + "y"),
        F.when(tag == K.TYPE, strip_chars(F.col("_a_body"), "\"'")).alias(prefix + "text"),
    )
    # The one-element inline is a pushdown barrier: a later filter on the parsed fields
    # stays above it instead of being rewritten into the stages below (which would
    # inline every stage into the predicate). Filters on input columns still go down.
    return s.select(*keep, F.inline(F.array(result)))


def format_coords(tag: Column | str, x: Column, y: Column) -> Column:
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return F.concat(tag, F.lit(": ("), x.cast("string"), F.lit(", "), y.cast("string"), F.lit(")"))


def format_action(action_type: Column, x: Column, y: Column, text: Column) -> Column:
    """Canonical action string. Missing coordinates print as ``(0, 0)``; an empty or
    missing TYPE text prints as ``TYPE: ""``; inner quotes are not escaped."""
    has_xy = x.isNotNull() & y.isNotNull()
    return (
        F.when(
            action_type.isin(*K.COORD_ACTIONS),
            F.when(has_xy, format_coords(action_type, x, y)).otherwise(
                F.concat(action_type, F.lit(": (0, 0)"))
            ),
        )
        .when(
            action_type == K.TYPE,
            F.when(
                text.isNotNull() & (text != ""),
                F.concat(F.lit(K.TYPE + ': "'), text, F.lit('"')),
            ).otherwise(F.lit(K.TYPE + ': ""')),
        )
        .when(action_type.isin(K.COMPLETE, K.INCOMPLETE), action_type)
        .otherwise(F.lit(K.STOP))
    )


def to_pixels(coord: Column, device_size: Column | float, canvas: float = 1000.0) -> Column:
    """De-normalise a [0, canvas] coordinate to device pixels (float, no rounding)."""
    size = device_size if isinstance(device_size, Column) else F.lit(float(device_size))
    return coord.cast("double") / F.lit(float(canvas)) * size.cast("double")
