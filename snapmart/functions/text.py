"""Cleaning rules for text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keep_only(text: Column, characters: str) -> Column:
    """Remove every character outside the given character class."""
    return F.regexp_replace(text, f"[^{characters}]", "")


def null_unless(text: Column, pattern: str) -> Column:
    """The value when it matches the pattern, else null."""
    return F.when(text.rlike(pattern), text)
