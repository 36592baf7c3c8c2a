"""Registry of the queries over the driver tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


class Tables:
    """The tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def day_text(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def time_text(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def cents(col: Column) -> Column:
    """Amount as decimal, so that sums do not depend on the order of rows."""
    return col.cast("decimal(18,2)")


def flag(col: Column) -> Column:
    return F.coalesce(col, F.lit(False)).cast("int")
