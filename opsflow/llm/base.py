"""Registry of the corpus queries, table access and helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from opsflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# White space of the text contracts: blank, tab, line feed, vertical tab, form feed, return.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``build(spark, folder)`` under ``name``."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def group_key(col: str | Column) -> Column:
    """A text key that is never null: ``n`` for null, else ``s`` and the value."""
    value = F.col(col) if isinstance(col, str) else col
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), value.cast("string")))


def hex_unit(digest: Column) -> Column:
    """The first eight hex digits as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def running_sums(
    df: DataFrame,
    unit: Column,
    order_by: Sequence[str],
    weights: Sequence[str],
    within: Sequence[str] = (),
    chunk_rows: int = 5000,
) -> DataFrame:
    """``df`` with ``<weight>_before``: the sum of the rows before it, per group.

    Exact for groups of any size, without ever sorting a group in one task. The
    order is cut into chunks of about ``chunk_rows`` rows along ``unit``, a number
    in [0, 1) that rises with ``order_by`` and is spread evenly. Sums per chunk are
    added up first (one row per chunk), rows then only within their chunk. The
    number of chunks follows the row count; it never changes a result. ``df`` is
    read three times, so it should be a written table. ``within`` must not be null;
    ``order_by`` may tie only on rows that are interchangeable.
    """
    chunks = max(1, df.count() // chunk_rows)
    cut = df.withColumn("_chunk", F.least(F.floor(unit * chunks), F.lit(chunks - 1)).cast("long"))
    keys = [*within, "_chunk"]
    sums = cut.groupBy(*keys).agg(*[F.sum(w).alias(f"_{w}") for w in weights])
    before = Window.partitionBy(*within).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, *[F.coalesce(F.sum(f"_{w}").over(before), F.lit(0)).alias(f"_{w}") for w in weights])
    inner = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    out = cut.join(starts, keys)
    for w in weights:
        out = out.withColumn(f"{w}_before", F.col(f"_{w}") + F.coalesce(F.sum(w).over(inner), F.lit(0)))
    return out.drop("_chunk", *[f"_{w}" for w in weights])
