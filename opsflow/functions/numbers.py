"""Number functions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def money(col: Column) -> Column:
    return col.cast("decimal(18,2)")


def whole(col: Column) -> Column:
    """Whole part, cut not rounded."""
    return F.when(col >= 0, F.floor(col)).otherwise(F.ceil(col)).cast("int")


def text_to_int(col: Column) -> Column:
    """``'3.0000'`` as 3; null for text that is no number."""
    return whole(col.try_cast("double"))


def lenient(col: Column, type_name: str, default, digits: int | None = None) -> Column:
    """Cast, with ``default`` for nulls and for what cannot be cast."""
    value = F.coalesce(F.trim(col.cast("string")).try_cast(type_name), F.lit(default).cast(type_name))
    return value if digits is None else F.round(value, digits)
