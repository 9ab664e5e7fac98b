"""Column types of text tables, from one aggregate over all rows.

Types form a lattice: int below bigint below double, date below timestamp, and boolean, all of
them below string. A column keeps a type while every value fits it; whether all do is a logical
and, so the answers of partitions merge in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How values of a type are written. Casts get only text of these forms.
FORMS = {
    "boolean": r"^(?i:true|false)$",
    "int": r"^[+-]?[0-9]{1,10}$",
    "bigint": r"^[+-]?[0-9]{1,19}$",
    "double": r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$",
}


def _fits(column: str, kind: str) -> Column:
    text = F.trim(F.col(column))
    cast = F.expr(f"try_cast(trim(`{column}`) AS {kind})")
    return F.when(text.rlike(FORMS[kind]), cast.isNotNull()).otherwise(False)


def inferred_types(rows: DataFrame) -> dict[str, str]:
    """The narrowest type of each text column; columns without any value are text. One row comes to the driver."""
    if not rows.columns:
        return {}
    cells = [
        F.bool_and(F.when(F.col(f"`{c}`").isNotNull(), _fits(c, kind))).alias(f"{kind}_{i}")
        for i, c in enumerate(rows.columns)
        for kind in FORMS
    ]
    found = rows.agg(*cells).first()
    return {c: next((k for k in FORMS if found[f"{k}_{i}"]), "string") for i, c in enumerate(rows.columns)}


def typed(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as the given types."""
    return rows.select(
        *[(F.trim(F.col(f"`{c}`")).cast(types[c]) if types[c] != "string" else F.col(f"`{c}`")).alias(c) for c in rows.columns]
    )
