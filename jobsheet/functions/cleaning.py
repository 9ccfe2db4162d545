"""Column expressions for input coercion (the cleaning contract).

All numeric input goes through ``try_cast`` - ANSI mode is on in Spark 4, a
plain cast of ``"abc"`` would fail the whole job instead of nulling one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python's str.strip() removes every Unicode white-space character; Java's
# \s only does so under UNICODE_CHARACTER_CLASS, hence (?U).
_EDGE_WS = r"(?U)^\s+|\s+$"
# The characters that pattern matches.
_WS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_WS, "")


def clean_text(c: Column) -> Column:
    """``(text or "").strip()``"""
    return strip(F.coalesce(c.cast("string"), F.lit("")))


def trimmed_text(c: Column) -> Column:
    """:func:`clean_text` of the flat positions as a trim, which looks at the ends of a text only, not at every place of it."""
    return F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(_WS))


def is_double(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.DoubleType)


def to_double(c: Column, double: bool = False) -> Column:
    """Numeric or numeric string -> double; anything else -> null, also the
    JVM's own suffixes and hexadecimal forms (``90d``, ``1.5f``, ``0x1p3``).
    ``double``: the column is of that type, so its text would read back as itself."""
    if double:
        return c
    s = c.cast("string")
    return F.when(~s.rlike(r"(?i)0x|[0-9.][df]\s*$"), s.try_cast("double"))


def _clamped(v: Column) -> Column:
    """``max(0.0, v)``, which is 0 for NaN (Spark's ``greatest`` would keep it)."""
    return F.greatest(F.lit(0.0), F.nanvl(F.coalesce(v, F.lit(0.0)), F.lit(0.0)))


def clean_price(c: Column, double: bool = False) -> Column:
    """``max(0.0, float(x or 0))``"""
    return _clamped(to_double(c, double))


def clean_time(c: Column, clamp: bool = False, double: bool = False) -> Column:
    """``float(x or 0)``; batch mode keeps negatives, API mode clamps them."""
    v = to_double(c, double)
    return _clamped(v) if clamp else F.coalesce(v, F.lit(0.0))


def clean_cost_center(c: Column, unknown: str = "unknown_cc", blank_is_null: bool = False) -> Column:
    """``cc or "unknown_cc"``; API mode also treats white-space-only as missing."""
    s = c.cast("string")
    probe = strip(s) if blank_is_null else s
    return F.when(s.isNull() | (probe == ""), F.lit(unknown)).otherwise(s)


def clean_make(c: Column) -> Column:
    """null / blank make -> UNKNOWN, else stripped upper case."""
    s = strip(c.cast("string"))
    return F.upper(F.when(s.isNull() | (s == ""), F.lit("unknown")).otherwise(s))


def is_bad_number(c: Column) -> Column:
    """True when a value is present but not numeric (quarantine reason)."""
    return c.isNotNull() & (strip(c.cast("string")) != "") & to_double(c).isNull()
