"""Strict JSON-line checks (what ``json.loads`` accepts) as column expressions.

``try_parse_json`` alone accepts trailing garbage (``{"a":1} x``). Wrapping the line
twice closes that gap: ``[line]`` is valid only for a comma list of values and
``{"v": line}`` only for one value followed by optional members, so both together hold
exactly for a single JSON value. Blank lines fail both, as ``json.loads`` fails them.

``json.loads`` also takes ``NaN``, ``Infinity`` and ``-Infinity`` for numbers. ``plain_numbers``
writes a number in their place, outside strings only, before the line is parsed.

Known difference from Python: duplicate object keys keep the last value, as in Python, when ``spark.sql.variant.allowDuplicateKeys`` is on (``build_session`` sets it);
otherwise they are JSON errors too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefpairs.constants import CLICK, LONG_PRESS
from prefpairs.functions.text import INT_LITERAL, ascii_digits, py_strip


# A bare literal stands where a number could: nothing that would make it part of one is beside it.
_BARE = r"(?<![0-9A-Za-z_.+\-])(?:NaN|-?Infinity)(?![0-9A-Za-z_.+\-])"
# Stand-ins for an escaped backslash and an escaped quote. As bare characters both make a line
# invalid JSON, so a line that holds one is left as it is.
_SLASH, _QUOTE = "\x01", "\x02"


def plain_numbers(line: Column) -> Column:
    """``line`` with ``0`` for each bare NaN, Infinity and -Infinity outside strings.

    Escapes are set aside, so that every quote left opens or closes a string; of the parts
    between quotes, the first, third and so on are outside. Lines without such a word are
    passed on untouched.
    """
    hidden = F.replace(F.replace(line, F.lit("\\\\"), F.lit(_SLASH)), F.lit('\\"'), F.lit(_QUOTE))
    parts = F.transform(F.split(hidden, '"'), lambda p, i: F.when(i % 2 == 0, F.regexp_replace(p, _BARE, "0")).otherwise(p))
    shown = F.replace(F.replace(F.array_join(parts, '"'), F.lit(_QUOTE), F.lit('\\"')), F.lit(_SLASH), F.lit("\\\\"))
    named = line.contains("NaN") | line.contains("Infinity")
    return F.when(named & ~line.contains(_SLASH) & ~line.contains(_QUOTE), shown).otherwise(line)


def wrapped_variant(line: Column) -> Column:
    """``{"v": <line>}`` parsed as VARIANT, NULL when not valid JSON."""
    return F.try_parse_json(F.concat(F.lit('{"v":'), line, F.lit("}")))


def is_strict_json(line: Column, wrapped: Column | None = None) -> Column:
    wrapped = wrapped_variant(line) if wrapped is None else wrapped
    as_list = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    return F.coalesce(as_list.isNotNull() & wrapped.isNotNull(), F.lit(False))


def is_object(wrapped: Column) -> Column:
    return F.try_variant_get(wrapped, "$.v", "map<string,variant>").isNotNull()


def has_key(wrapped: Column, key: str) -> Column:
    """Key presence; a JSON ``null`` value still counts as present."""
    return F.variant_get(wrapped, f"$.v.{key}", "variant").isNotNull()


def string_field(wrapped: Column, key: str) -> Column:
    """The field's value when it is a JSON string, else NULL."""
    v = F.variant_get(wrapped, f"$.v.{key}", "variant")
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(wrapped, f"$.v.{key}", "string"))


def with_coord_check(df: DataFrame, action_col: str, out_col: str, width: int, height: int) -> DataFrame:
    """Adds ``out_col``: the audit's coordinate verdict for one action string column.

    TRUE (valid), FALSE (out of range) or NULL (not counted). Only strings that contain
    ``CLICK:`` or ``LONG_PRESS:`` are looked at; the text between the first ``(`` and
    the next ``(``/``)`` must split on ``,`` into exactly two ``int()`` literals (so
    ``250.5`` is not counted, unlike the generator's own parser). Staged so the split
    and strip run once per row.
    """
    keep = [F.col(c) for c in df.columns]
    a = F.col(action_col)
    looked_at = (a.contains(CLICK + ":") | a.contains(LONG_PRESS + ":")) & (F.instr(a, "(") > 0)
    inner = F.split_part(F.split_part(a, F.lit("("), F.lit(2)), F.lit(")"), F.lit(1))
    s = df.select(*keep, F.when(looked_at, F.split(inner, ",", -1)).alias("_c_parts"))
    two = F.size("_c_parts") == 2
    s = s.select(
        *keep,
        F.when(two, ascii_digits(py_strip(F.get(F.col("_c_parts"), 0)))).alias("_c_x"),
        F.when(two, ascii_digits(py_strip(F.get(F.col("_c_parts"), 1)))).alias("_c_y"),
    )
    tx, ty = F.col("_c_x"), F.col("_c_y")
    countable = tx.rlike(INT_LITERAL) & ty.rlike(INT_LITERAL)
    # A literal that int() takes but BIGINT cannot hold is far outside any canvas.
    x = F.replace(tx, F.lit("_"), F.lit("")).try_cast("bigint")
    y = F.replace(ty, F.lit("_"), F.lit("")).try_cast("bigint")
    in_range = F.coalesce(x.between(0, width) & y.between(0, height), F.lit(False))
    return s.select(*keep, F.when(countable, in_range).alias(out_col))


def action_family(action: Column) -> Column:
    """Audit distribution bucket by substring, precedence CLICK, TYPE, LONG_PRESS, SCROLL."""
    return (
        F.when(action.contains("CLICK:"), F.lit("action_click"))
        .when(action.contains("TYPE:"), F.lit("action_type"))
        .when(action.contains("LONG_PRESS:"), F.lit("action_long_press"))
        .when(action.contains("SCROLL:"), F.lit("action_scroll"))
    )
