"""String helpers with Python ``str`` semantics, as Spark column expressions."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefpairs.constants import PY_WHITESPACE

# Python float() literal grammar, finite values only: digits may be grouped by single
# underscores, optional fraction, optional exponent. nan/inf are excluded on purpose
# because int(float('nan')) raises.
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_LITERAL = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
INT_LITERAL = rf"^[+-]?{_DIGITS}$"


def py_strip(col: Column) -> Column:
    """``str.strip()``: remove every ``str.isspace()`` character at both ends.

    Spark's ``trim`` only removes U+0020, so it is not used.
    """
    return F.btrim(col, F.lit(PY_WHITESPACE))


def strip_chars(col: Column, chars: str) -> Column:
    """``str.strip(chars)``: remove any run of ``chars`` at both ends."""
    return F.btrim(col, F.lit(chars))


@functools.cache
def _decimal_digits() -> tuple[str, str]:
    """Every non-ASCII Unicode decimal digit (``str.isdecimal()``) and its ASCII value,
    built from the Unicode database rather than listed."""
    src = "".join(ch for ch in map(chr, range(0x110000)) if ch.isdecimal() and not "0" <= ch <= "9")
    return src, "".join(str(unicodedata.decimal(ch)) for ch in src)


def ascii_digits(col: Column) -> Column:
    """Map Unicode decimal digits to ASCII, as Python's ``float()``/``int()`` do before
    parsing (``'١٢'`` and ``'１２'`` both read as 12)."""
    src, dst = _decimal_digits()
    return F.translate(col, src, dst)


def py_float_to_int(part: Column) -> Column:
    """``int(float(part))`` as BIGINT; NULL where Python would raise.

    Truncates toward zero. Values beyond the 64-bit range also give NULL.
    """
    s = ascii_digits(py_strip(part))
    digits = F.replace(s, F.lit("_"), F.lit(""))
    return F.when(s.rlike(FLOAT_LITERAL), digits.try_cast("double").try_cast("bigint"))
