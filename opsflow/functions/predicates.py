"""Row predicates and choices, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F


def decode(col: Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Replace codes by values; a code not listed gives ``default``."""
    result = reduce(
        lambda chain, pair: chain.when(col == pair[0], F.lit(pair[1])),
        mapping.items(),
        F.when(F.lit(False), None),
    )
    return result.otherwise(F.lit(default))


def first_match(rules: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Value of the first rule that holds. Values may be columns."""
    chain = F.when(F.lit(False), None)
    for condition, value in rules:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def bucketize(col: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for values below ``bounds[i]``; the last label for the rest,
    nulls included."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("bucketize needs one label more than bounds")
    return first_match(
        [(col < bound, label) for bound, label in zip(bounds, labels)], labels[-1]
    )


def is_blank(col: Column) -> Column:
    """Null, empty or only blanks."""
    return col.isNull() | (F.trim(col) == "")


def null_or(col: Column, condition: Column) -> Column:
    """Null passes, other values are tested."""
    return col.isNull() | condition


def contains_any(col: Column, words: Sequence[str]) -> Column:
    """Any of the words occurs, whatever its case."""
    return reduce(lambda a, b: a | b, [col.ilike(f"%{word}%") for word in words])


def changed_since(ts: Column, as_of: datetime, interval: str) -> Column:
    """``ts`` is at most ``interval`` (such as ``'2 HOURS'``) before ``as_of``."""
    return ts >= F.lit(as_of) - F.expr(f"INTERVAL {interval}")


def any_changed_since(stamps: Sequence[Column], as_of: datetime, interval: str) -> Column:
    """One of several times is recent enough; null times do not count."""
    latest = F.greatest(*stamps) if len(stamps) > 1 else stamps[0]
    return changed_since(latest, as_of, interval)


def filter_groups(groups: Sequence[Sequence[Mapping[str, Any]]]) -> Column:
    """OR of groups, each an AND of ``{"column", "operator", "value(s)"}``.

    Operators: EQ, GTE, IN and NOT_IN.
    """

    def test(item: Mapping[str, Any]) -> Column:
        col = F.col(item["column"])
        operator = item["operator"]
        if operator == "EQ":
            return col == item["value"]
        if operator == "GTE":
            return col >= item["value"]
        if operator == "IN":
            return col.isin(*item["values"])
        if operator == "NOT_IN":
            return ~col.isin(*item["values"])
        raise ValueError(f"unknown filter operator {operator!r}")

    every = [reduce(lambda a, b: a & b, [test(item) for item in group]) for group in groups]
    return reduce(lambda a, b: a | b, every)


def all_equal(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """1 where every pair is equal, else 0; a null makes a pair unequal."""
    same = reduce(lambda a, b: a & b, [left == right for left, right in pairs])
    return F.when(same, 1).otherwise(0)


def prefer(*cols: Column) -> Column:
    """First value that is not null."""
    return F.coalesce(*cols)


def prefer_filled(first: Column, second: Column) -> Column:
    """``first`` unless it is null or empty."""
    return F.when(first != "", first).otherwise(second)


def contact_name(full: Column, attention: Column, account: Column) -> Column:
    """Contact's full name, else the attention line, else the account name.

    Only the account name keeps leading blanks.
    """
    return F.coalesce(F.ltrim(full), F.ltrim(attention), account)
