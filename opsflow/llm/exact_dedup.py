"""Exact deduplication with a two-pass Bloom filter.

Pass one reads the text once and writes one narrow row per document: the hash of
its normalised text. From these rows a filter of possibly repeated hashes is made.
Pass two tests each row against it: rows whose hash cannot repeat pass straight
through, only the others are shuffled and compared by their full hash. False
positives of the filter cost a shuffled row, never a wrong result.

The filter has ``bits_per_row`` bits per document up to ``max_bits`` in all. That
bound (32 MB at the default) is what allows it to be broadcast. Above it the filter
fills up and lets more rows through to the exact comparison; give a larger bound
where executors have the memory.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from opsflow.llm.base import SPACE, query, table
from opsflow.session import settle

SEGMENT_BITS = 1 << 18
DROP = SPACE.encode()

HASHED = "doc_id long, text_sha256 string, n_points long, hash long, text_hash long"
KEY = ["_id", "_null", "_text"]


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        points = pc.fill_null(pc.utf8_length(texts), 0).cast(pa.int64())
        digests = [
            hashlib.sha256((t.as_py() or "").encode().translate(None, DROP)).digest() for t in texts
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([d.hex() for d in digests], pa.string()),
                points,
                pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                batch.column(2),
            ],
            names=["doc_id", "text_sha256", "n_points", "hash", "text_hash"],
        )


def hashed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_sha256, n_points, hash, text_hash`` per row; null text counts as empty."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text)).mapInArrow(_hash_batches, HASHED)


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes.view(np.uint64) % np.uint64(bits)


#: Positions that a task gathers before it sends them on.
GATHER = 4_000_000


def _segments(bits: int):
    """Each task's filter positions, packed per segment of the filter."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        at = np.sort(np.concatenate(held))
        segments, first = np.unique(at // SEGMENT_BITS, return_index=True)
        within = (at % SEGMENT_BITS).astype(np.uint32)
        parts = [p.tobytes() for p in np.split(within, first[1:])] if len(at) else []
        return pa.RecordBatch.from_arrays([pa.array(segments.astype(np.int64)), pa.array(parts, pa.binary())], names=["segment", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(_positions(batch.column(0).to_numpy(), bits))
            size += len(held[-1])
            if size > GATHER:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return run


def _bitmap(times: int):
    def run(group: pa.Table) -> pa.Table:
        """The bitmap of positions set by ``times`` rows (1 or 2) or more, for one segment."""
        count = np.zeros(SEGMENT_BITS, np.uint8)
        for packed in group.column("bits"):
            at, n = np.unique(np.frombuffer(packed.as_buffer(), np.uint32), return_counts=True)
            count[at] = np.minimum(2, count[at] + np.minimum(n, 2))
        bitmap = zlib.compress(np.packbits(count >= times).tobytes(), 1)
        return pa.table({"segment": group.column("segment").slice(0, 1), "bitmap": pa.array([bitmap], pa.binary())})

    return run


def hash_filter(
    hashes: DataFrame, rows: int, times: int = 2, bits_per_row: int = 32, max_bits: int = 1 << 28
) -> np.ndarray:
    """Bitmap of the positions that ``times`` or more rows of ``hashes`` (one long column) set."""
    segments = max(1, -(-min(max_bits, rows * bits_per_row) // SEGMENT_BITS))
    bits = segments * SEGMENT_BITS
    found = (
        hashes.mapInArrow(_segments(bits), "segment long, bits binary")
        .groupBy("segment")
        .applyInArrow(_bitmap(times), "segment long, bitmap binary")
    )
    bitmap = np.zeros(bits // 8, np.uint8)
    width = SEGMENT_BITS // 8
    for row in found.toLocalIterator():
        bitmap[row["segment"] * width : (row["segment"] + 1) * width] = np.frombuffer(
            zlib.decompress(bytes(row["bitmap"])), np.uint8
        )
    return bitmap


def passes(df: DataFrame, bitmap: np.ndarray, column: str, out: str) -> DataFrame:
    """``df`` and whether the filter has the hash in ``column`` (a long)."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def test(hashes):
        import pandas as pd

        bits = shared.value
        at = _positions(hashes.to_numpy(np.int64), len(bits) * 8)
        return pd.Series((bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1)

    return df.withColumn(out, test(column))


def with_key(df: DataFrame, text_hash=None) -> DataFrame:
    """``df`` with the key of a row: its id, whether that is null, and its text's hash."""
    known = F.xxhash64(F.col("text").cast("string")) if text_hash is None else F.col(text_hash)
    number = F.col("doc_id").cast("long")
    return df.withColumns({"_id": F.coalesce(number, F.lit(0)), "_null": number.isNull(), "_text": known})


def split_by_keys(keyed: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``keyed`` whose ``KEY`` may be among ``keys``, and all others.

    A filter of bounded size tells them apart, so the others need no shuffle.
    """
    hashes = keys.select(F.xxhash64(*KEY).alias("hash"))
    bitmap = hash_filter(hashes, hashes.count(), times=1, bits_per_row=16)
    tested = passes(keyed.withColumn("_hash", F.xxhash64(*KEY)), bitmap, "_hash", "_maybe").drop("_hash")
    return tested.where("_maybe").drop("_maybe"), tested.where(~F.col("_maybe")).drop("_maybe")


def keep_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` (``doc_id, text_hash, kept`` per row) keeps.

    Of rows that agree in id and text as many stay as verdicts say. Rows that nothing
    speaks against pass straight through.
    """
    counted = with_key(verdicts, "text_hash").groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("_all"), F.sum(F.col("kept").cast("int")).alias("_stay")
    )
    fewer = settle(counted.where("_stay < _all").drop("_all"), "fewer")
    # the row travels as one value, so its columns may have any names
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")
    touched, free = split_by_keys(with_key(nested).drop("doc_id", "text"), fewer)
    turn = F.row_number().over(Window.partitionBy(*KEY).orderBy("_text"))
    stay = touched.withColumn("_turn", turn).join(fewer, KEY, "left").where("_stay IS NULL OR _turn <= _stay")
    return stay.select("_row.*").unionByName(free.select("_row.*"))


def exact_duplicates(docs: DataFrame, bits_per_row: int = 32, max_bits: int = 1 << 28) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256, text_hash``.

    Texts are equal when they agree after all white space is deleted; null counts as
    empty. Of equal texts the row with the most code points stays, then the smallest
    ``doc_id`` (null last). Rows repeated in every column: one of them stays, and
    exactly one. An empty table gives an empty result; other columns are ignored.
    """
    rows = settle(hashed(docs).withColumn("row", F.monotonically_increasing_id()), "hashed")
    total = rows.count()
    marked = settle(passes(rows, hash_filter(rows.select("hash"), total, 2, bits_per_row, max_bits), "hash", "maybe"), "marked")
    single = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", "text_hash",
    )
    several = marked.where("maybe")
    best = several.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(-F.col("n_points"), F.col("doc_id").isNull(), "doc_id", "row")).alias("best"),
    )
    grouped = several.join(best, "text_sha256").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "text_hash",
    )
    return single.unionByName(grouped)


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""


@query("op4_exact_dedup", SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents")).drop("text_hash")
