"""Numbers out of dirty text columns.

Under ANSI a failing cast throws, and ``try_cast`` pays for a caught exception on
every bad value (about 25 us per row for integers). Dirty columns are the normal
case here, so text is checked with a pattern first and only well-formed values
reach the cast. A short pattern settles the common plain values; the long one runs
on the rest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLAIN_WHOLE = r"^[+-]?\d{1,9}$"
# Digits with an optional fraction that is cut off; more than ten digits overflow.
WHOLE_TEXT = r"^[\x00-\x20\x7F]*([+-]?0*\d{1,10})(?:\.\d*)?[\x00-\x20\x7F]*$"
# A fraction without digits in front counts as 0.
BARE_FRACTION = r"^[\x00-\x20\x7F]*[+-]?\.\d*[\x00-\x20\x7F]*$"

PLAIN_REAL = r"^[+-]?\d+(?:\.\d+)?$"
# Everything the float parser accepts: decimals, exponents, hex and the special names.
REAL_TEXT = (
    r"^[\x00-\x20]*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?[fFdD]?"
    r"|0[xX].*|(?i:nan|inf|infinity))[\x00-\x20]*$"
)


def found(name: str, pattern: str, group: int = 0) -> str:
    """SQL for what the pattern finds first in a column, null if nothing."""
    return f"get(regexp_extract_all(`{name}`, r'{pattern}', {group}), 0)"


def whole_number(name: str) -> Column:
    """Int of a text column: ``12.7`` is 12, ``28_`` is null, ``.5`` is 0."""
    return F.expr(
        f"""CASE
        WHEN `{name}` RLIKE r'{PLAIN_WHOLE}' THEN CAST(`{name}` AS INT)
        WHEN `{name}` RLIKE r'{BARE_FRACTION}' THEN 0
        ELSE try_cast({found(name, WHOLE_TEXT, 1)} AS INT) END"""
    )


def real_number(name: str, target: str = "float") -> Column:
    """Float or double of a text column; null when malformed (``1.2.3``, ``-12--3``)."""
    return F.expr(
        f"""CASE
        WHEN `{name}` RLIKE r'{PLAIN_REAL}' THEN CAST(`{name}` AS {target})
        ELSE try_cast({found(name, REAL_TEXT)} AS {target}) END"""
    )


def zero_outside(value: Column, low: int, high: int, *, fill_null: bool = False) -> Column:
    """0 for values outside ``low..high``. Nulls stay null unless ``fill_null``."""
    inside = value.between(low, high)
    return F.when(inside if fill_null else inside | value.isNull(), value).otherwise(F.lit(0))


def outside(value: Column, low: int, high: int) -> Column:
    """True for a non-null value outside ``low..high``."""
    return (value < low) | (value > high)


def has_fraction(name: str) -> Column:
    """True when a text column holds a number that is not whole."""
    value = real_number(name, "double")
    return F.when(F.col(name).rlike(PLAIN_WHOLE), False).otherwise(value != F.floor(value))
