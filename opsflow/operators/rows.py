"""Row filters, row identity, order and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.operators.skew import Order, sort_columns
from opsflow.operators.windows import top1


def distinct_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[Order]) -> DataFrame:
    """One row per key: the first along ``order_by``."""
    return top1(df, keys, order_by)


def fill_key(df: DataFrame, col: str, sentinel: Any) -> DataFrame:
    """Give missing key values a sentinel, so that keyed writes can match them."""
    return df.fillna(sentinel, subset=[col])


def with_constants(df: DataFrame, constants: Mapping[str, tuple[Any, str]]) -> DataFrame:
    """Add constant columns ``{name: (value, type)}``; a null needs its type too."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in constants.items()})


def newest(df: DataFrame, n: int, order_by: Sequence[Order]) -> DataFrame:
    """Top ``n`` rows; each task keeps only its own ``n`` before the merge."""
    return df.orderBy(*sort_columns(order_by)).limit(n)


def union_tagged(branches: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Distinct union in which every branch carries its name."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in branches.items()]
    return reduce(DataFrame.unionByName, tagged).distinct()


def union_keys(columns: Sequence[tuple[DataFrame, str]], out: str) -> DataFrame:
    """Distinct union of key lists. Each list is reduced before the shuffle."""
    lists = [df.select(F.col(name).alias(out)) for df, name in columns]
    return reduce(DataFrame.unionByName, lists).distinct()


def concat_rows(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def route(df: DataFrame, conditions: Mapping[str, Column]) -> dict[str, DataFrame]:
    """One frame per branch, each with the rows that meet its condition."""
    return {name: df.where(condition) for name, condition in conditions.items()}


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values in ascending order, as rows (range sorted)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
