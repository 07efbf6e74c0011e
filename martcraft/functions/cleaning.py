"""Cleaning of raw transaction strings as native column expressions.

Each function maps a STRING column to a typed column and yields NULL for text
it cannot read. Guards (regular expressions) run before every ``try_cast`` so
that Spark's own lenient parsing (``1.0d``, ``inf``) does not leak through.

Text in its plain form (digits only, ``yyyy-MM-dd``, no white space around) is read
by one guard and one cast; all other text goes through the full rules, which give
the same value for plain text but evaluate the trimmed text several times.
"""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens read as NULL (the default NA words of pandas.read_csv).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Spelled-out amounts accepted per column (compared case-insensitively after trimming).
PRICE_WORDS = {"two hundred": 200.0}
TAX_WORDS = {"fifteen": 15.0}

# The characters Python's str.strip() removes (str.isspace() is true for exactly these).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Guards.
_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_YMD = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_DMY = r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"

# Plain forms (whole numbers that a DOUBLE holds exactly; years that every reader of dates takes).
# They end with \\z: $ would take a last line break too.
_PLAIN_ID = r"^[0-9]{1,15}\z"
_PLAIN_INT = r"^[0-9]{1,9}\z"
_PLAIN_DATE = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z"
_PLAIN_MONEY = r"^[0-9]{1,8}(?:\.[0-9]{1,2})?\z"
_PLAIN_TEXT = r"^[!-~](?:.*[!-~])?\z"


def na_to_null(c: Column) -> Column:
    """NA words become NULL; matching is exact, as in the CSV reader being modelled."""
    return F.when(~c.isin(*NA_TOKENS), c)


def py_strip(c: Column) -> Column:
    """Strip leading/trailing whitespace as Python does (tabs, no-break spaces too); no regex."""
    return F.trim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """``py_strip``, which text without white space around doesn't need."""
    return F.when(c.rlike(_PLAIN_TEXT), c).otherwise(py_strip(c))


def _number(s: Column) -> Column:
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def clean_prefixed_id(c: Column, prefix: str) -> Column:
    """Trim, drop ONE leading case-sensitive ``prefix``, read an integer; else NULL."""
    s = py_strip(c)
    if prefix:
        s = F.when(s.startswith(prefix), s.substr(F.lit(len(prefix) + 1), F.lit(1 << 30))).otherwise(s)
    full = F.when(s.rlike(_INTEGER), s.try_cast("bigint"))
    if prefix[:1].isdigit():
        return full
    return F.when(c.rlike(_PLAIN_ID), c.try_cast("bigint")).otherwise(full)


def clean_float_id(c: Column) -> Column:
    """Integer id written as a float (``501.0``): truncate toward zero; else NULL."""
    return F.when(c.rlike(_PLAIN_ID), c.try_cast("bigint")).otherwise(_number(py_strip(c)).try_cast("bigint"))


def clean_date(c: Column) -> Column:
    """``y-M-d`` or ``d-M-y`` (day first when the first part has one or two digits)."""
    s = py_strip(c)
    return F.when(c.rlike(_PLAIN_DATE), c.try_cast("date")).when(
        s.rlike(_YMD), F.try_to_date(s, "y-M-d")).when(
        s.rlike(_DMY), F.try_to_date(s, "d-M-y")
    )


def _is_word(s: Column, word: str) -> Column:
    """``lower(s)`` is ``word`` in lower case; for ASCII words without building ``lower(s)``, which costs more than all other rules.

    The one other character with an ASCII letter as its lower case is the Kelvin sign.
    """
    low = word.lower()
    if not (word.isascii() and low):
        return F.lower(s) == F.lit(low)
    either = {c: f"[{c}{c.upper()}{chr(0x212A) if c == 'k' else ''}]" for c in "abcdefghijklmnopqrstuvwxyz"}
    return s.rlike("^" + "".join(either.get(c) or re.escape(c) for c in low) + r"\z")


def clean_amount(c: Column, words: dict[str, float] | None = None) -> Column:
    """Decimal text or one of ``words`` (case-insensitive) to DOUBLE; else NULL."""
    s = py_strip(c)
    out = None
    for word, value in (words or {}).items():
        cond = _is_word(s, word)
        out = F.when(cond, F.lit(float(value))) if out is None else out.when(cond, F.lit(float(value)))
    num = s.rlike(_NUMBER)
    parsed = s.try_cast("double")
    return F.when(num, parsed) if out is None else out.when(num, parsed)


def clean_whole_number(c: Column) -> Column:
    """Numeric text that is a whole number (``3``, ``3.0``, ``3e0``) to INT; ``1.5`` gives NULL."""
    d = _number(py_strip(c))
    return F.when(c.rlike(_PLAIN_INT), c.try_cast("int")).when(d == F.floor(d), d.try_cast("int"))


def to_money(c: Column, precision: int = 10, scale: int = 2) -> Column:
    """DOUBLE to DECIMAL(p,s), half-up; out-of-range gives NULL."""
    return c.try_cast(f"decimal({precision},{scale})")


def clean_money(c: Column, words: dict[str, float] | None = None) -> Column:
    """``to_money`` of ``clean_amount``."""
    full = to_money(clean_amount(c, words))
    if any(re.match(_PLAIN_MONEY.replace(r"\z", r"\Z"), w) for w in words or {}):
        return full
    return F.when(c.rlike(_PLAIN_MONEY), c.try_cast("decimal(10,2)")).otherwise(full)
