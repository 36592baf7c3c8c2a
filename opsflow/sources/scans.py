"""Reading relations: files, tables, named queries, reports, landed records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from opsflow.functions import numbers


def scan(
    spark: SparkSession,
    source: str | Mapping[str, str],
    columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """A parquet path, a table name, or JDBC options, cut to rows and columns.

    Filter and column list reach the scan. Give JDBC sources ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` to read in parallel.
    """
    if isinstance(source, Mapping):
        df = spark.read.format("jdbc").options(**source).load()
    elif "/" in source or source.endswith(".parquet"):
        df = spark.read.parquet(source)
    else:
        df = spark.table(source)
    if where is not None:
        df = df.where(where)
    return df if columns is None else df.select(*columns)


class NamedQueries:
    """A catalogue of query texts with ``:name`` parameters and ``{view}`` inputs."""

    def __init__(self, texts: Mapping[str, str]):
        self.texts = dict(texts)

    def run(
        self,
        spark: SparkSession,
        name: str,
        views: Mapping[str, DataFrame],
        args: Mapping[str, Any] | None = None,
    ) -> DataFrame:
        """Run a query by name; an unknown name is an error."""
        if name not in self.texts:
            raise KeyError(f"no query named {name!r}; known: {sorted(self.texts)}")
        return spark.sql(self.texts[name], args=dict(args or {}), **views)


def scan_report(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Delimited report with a header line, all columns as text. A byte-order
    mark before the first header is dropped."""
    df = spark.read.option("sep", sep).option("header", True).csv(path)
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})


def scan_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Landed nested records, one JSON object per line, read with a given schema."""
    return spark.read.schema(schema).json(path)


def join_sources(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner"
) -> DataFrame:
    """Join relations of two systems on keys with different names."""
    condition = F.lit(True)
    for a, b in on.items():
        condition = condition & (left[a] == right[b])
    return left.join(right, condition, how)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


# -- report cleaning -------------------------------------------------------


def canonicalize(
    df: DataFrame, aliases: Mapping[str, Sequence[str]], required: Sequence[str]
) -> DataFrame:
    """Rename columns from any of their known spellings; missing ones are listed
    in the error."""
    renames = {}
    for name, spellings in aliases.items():
        found = [c for c in df.columns if c in spellings or c == name]
        if found:
            renames[found[0]] = name
    result = df.withColumnsRenamed(renames)
    missing = [name for name in required if name not in result.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")
    return result


def drop_rollups(df: DataFrame, key: str) -> DataFrame:
    """Drop total rows, whose key is null or blank."""
    return df.where(F.trim(F.col(key).cast("string")) != "")


def safe_cast(
    df: DataFrame, targets: Mapping[str, tuple[str, Any, int | None]]
) -> DataFrame:
    """Lenient casts ``{column: (type, default, digits)}``."""
    return df.withColumns(
        {name: numbers.lenient(F.col(name), t, default, digits)
         for name, (t, default, digits) in targets.items()}
    )
