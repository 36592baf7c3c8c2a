"""JSON, array, map and wrapper functions, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def json_value(col: Column, path: str) -> Column:
    """Scalar at a JSON path, null where the text is no JSON."""
    return F.get_json_object(col, path)


def parse_or_empty(col: Column, ddl: str) -> Column:
    """JSON array text as an array; bad or missing text as an empty one."""
    empty = F.from_json(F.lit("[]"), ddl)
    return F.coalesce(F.from_json(col, ddl), empty)


def one_or_nth(array: Column, position: Column) -> Column:
    """The only element if there is one, else the one at ``position`` (from 0)."""
    return F.when(F.size(array) == 1, F.get(array, F.lit(0))).otherwise(
        F.get(array, position)
    )


def sorted_tags(*cols: Column) -> Column:
    """Distinct non-null texts in ascending order."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*cols))))


def lookup(col: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Value of a small fixed map, ``default`` for keys it lacks."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    found = F.try_element_at(F.create_map(*pairs), col)
    return found if default is None else F.coalesce(found, F.lit(default))


def property_or(bag: Column, name: str, default: str | None = None) -> Column:
    """Entry of a ``map<string,string>`` property bag."""
    found = F.try_element_at(bag, F.lit(name))
    return found if default is None else F.coalesce(found, F.lit(default))


def wrap(**cols: Column) -> Column:
    """Struct whose fields are ``{"value": x}`` wrappers."""
    return F.struct(*[F.struct(c.alias("value")).alias(name) for name, c in cols.items()])


def wrapped(col: Column) -> Column:
    return F.struct(col.alias("value"))


def unwrap(col: Column) -> Column:
    return col["value"]
