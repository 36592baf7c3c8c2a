"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked there. A row's
fractional rank ``(rank + 1/2) / rows of its source`` places every source evenly
along one line; the line, sorted, is cut into shards of equal row count, so each
shard holds every source in the proportion of the whole corpus (to within a row or
so). Ranks are exact for sources of any size: they come from ``running_sums``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsflow.llm.base import group_key, hex_unit, query, running_sums, table
from opsflow.session import settle


def interleave(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, source, shard, slot``.

    ``size`` is the text's UTF-8 bytes plus 16; null text has no bytes. Row counts
    of shards differ by one at most; ``slot`` counts from 0 in each shard. A null
    source is a source of its own. The place of a row depends on ``seed``, doc_id and
    text alone; rows that agree in both are interchangeable. An empty table gives an
    empty result.
    """
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.col("source").cast("string").alias("source"),
        group_key("source").alias("_source"),
    ).withColumn(
        "_digest", F.md5(F.concat_ws("|", F.lit(str(seed)), group_key("doc_id"), F.col("text_crc32").cast("string")))
    ).withColumn("_one", F.lit(1).cast("long"))
    narrow = settle(narrow, "shard-rows")
    ranked = running_sums(narrow, hex_unit(F.col("_digest")), ["_digest", "size"], ["_one"], ["_source"])
    counts = narrow.groupBy("_source").agg(F.sum("_one").alias("_rows"))
    line = settle(
        ranked.join(counts, "_source")
        .withColumn("_at", (F.col("_one_before") + 0.5) / F.col("_rows"))
        .drop("_one_before", "_rows"),
        "shard-line",
    )
    total = max(1, line.count())
    placed = running_sums(line, F.col("_at"), ["_at", "_source", "_digest", "size"], ["_one"])
    return (
        placed.withColumn("shard", F.expr(f"_one_before * {shards} div {total}"))
        .withColumn("slot", F.expr(f"_one_before - (shard * {total} + {shards - 1}) div {shards}"))
        .select("doc_id", "size", "text_crc32", "source", F.col("shard").cast("int"), F.col("slot").cast("long"))
    )


@query("op5_sharding")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return interleave(table(spark, folder, "documents"), shards=40, seed=7).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )
