"""Near-duplicate detection by MinHash with tensored banding.

A document's words make one set of shingles. Two small collections of ``side`` band
keys each, A and B, of ``rows`` minhashes a key are taken of the set. Every pair (A_i,
B_j) is the key of one table, so ``2 * side * rows`` minhashes stand for ``side ** 2``
tables of ``2 * rows`` minhashes: the square root of what separate tables would cost.

1. *Classes.* Equal sets form a class; all that follows is between classes.
2. *Keys.* A keys that one class alone has are dropped by a plain count. Only classes
   with a shared A key get their table keys.
3. *Candidates.* Every member of a table's bucket is tied to the bucket's least class,
   so a bucket of n gives n - 1 rows, never its pairs. Linked sets lie in one
   component of these ties, but for the misses of the tables (below).
4. *Verification.* The full sets of one component meet in one task, small components
   many to a task. Members of one linked group need no comparison; others are pruned by size and
   by a parity sketch, which bounds the symmetric difference from below and so loses
   nothing, and are then compared set by set.
5. *Large components* are cut into blocks. First every block meets the component's
   leader, the class with most shared A keys, and itself. What is then outside the
   largest linked group meets all blocks, piece by piece.

At a similarity of 0.85 one side's key agrees with probability 0.61, so the tables miss
a pair with ``2 * (1 - 0.61) ** 13``, about 1 in 100,000, at 0.9 1 in 10 million. Sets
are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from opsflow.llm.base import query, table
from opsflow.llm.components import components
from opsflow.llm.exact_dedup import KEY, split_by_keys, with_key
from opsflow.llm.linking import BLOCK, SET_WEIGHT, links_within
from opsflow.llm.ngram_join import class_of
from opsflow.llm.textbytes import U, factors, mix64, shingle_sets
from opsflow.session import settle

SIDE = 13
ROWS = 3

SIGNED = "doc_id long, n_shingles long, class long, text_hash long, a array<long>, b array<int>"


def minhashes(counts: np.ndarray, hashes: np.ndarray, lanes: int) -> np.ndarray:
    """``lanes`` minhashes (rows x lanes) of consecutive non-empty sets."""
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    shift, scale = factors(4096 + lanes)[4096:], factors(8192 + lanes)[8192:]
    out = np.empty((len(counts), lanes), np.uint64)
    for lane in range(lanes):
        out[:, lane] = np.minimum.reduceat((hashes ^ shift[lane]) * scale[lane], starts)
    return out


def band_keys(mins: np.ndarray, side: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys (sets x side) of both collections; the place of a key is part of it."""
    scale = factors(512 + rows)[512:]
    keys = np.zeros((len(mins), 2 * side), np.uint64)
    for k in range(rows):
        keys += mins[:, k :: rows] * scale[k]
    keys = mix64(keys + factors(1024 + 2 * side)[1024:])
    return keys[:, :side], keys[:, side:]


def _signed(width: int, side: int, rows: int):
    lanes = 2 * side * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, counts, hashes in shingle_sets(batch.column(1), width):
                full = np.flatnonzero(counts)
                a, b = band_keys(minhashes(counts[full], hashes, lanes), side, rows) if len(full) else ((), ())
                ends = np.concatenate(([0], np.cumsum(np.where(counts > 0, side, 0)))).astype(np.int32)
                flat_a = np.ascontiguousarray(a).reshape(-1).view(np.int64) if len(full) else np.zeros(0, np.int64)
                flat_b = (np.ascontiguousarray(b).reshape(-1) >> U(32)).astype(np.uint32).view(np.int32) if len(full) else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[at.start : at.stop], pa.array(counts.astype(np.int64)),
                        pa.array(class_of(counts, hashes).view(np.int64)), batch.column(2)[at.start : at.stop],
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat_a)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat_b)),
                    ],
                    names=["doc_id", "n_shingles", "class", "text_hash", "a", "b"],
                )

    return run


def _whole_sets(width: int):
    """The row's key and its full set, as packed 64-bit numbers in ascending order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, counts, hashes in shingle_sets(batch.column(3), width):
                ends = np.concatenate(([0], np.cumsum(counts)))
                sets = [hashes[x:y].tobytes() for x, y in zip(ends, ends[1:])]
                keys = [batch.column(k)[at.start : at.stop] for k in range(3)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(sets, pa.binary())], names=[*KEY, "hashes"])

    return run


def _candidates(one: DataFrame) -> DataFrame:
    """``class, component, score``: classes tied to another by a table; ``score``: shared A keys."""
    keys = one.select("class", F.explode("a").alias("key"))
    shared = keys.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("n"))
    shared = shared.where("low <> high").select("key", "n")
    mine = keys.join(shared, "key").groupBy("class").agg(F.collect_list("key").alias("keys"), F.sum("n").alias("score"))
    mine = settle(mine, "shared-keys")
    tables = (
        mine.join(one.select("class", "b"), "class")
        .select("class", "keys", F.posexplode("b").alias("j", "b"))
        .select("class", F.explode("keys").alias("a"), "j", "b")
        .select("class", F.xxhash64("a", "j", "b").alias("key"))
    )
    least = tables.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    ties = tables.join(least.select("key", "low"), "key").where("class <> low").select("class", "low").distinct()
    known = components(ties).withColumnRenamed("node", "class")
    return known.join(mine.select("class", "score"), "class")


def similar_documents(
    docs: DataFrame, width: int = 5, percent: int = 85, side: int = SIDE, rows: int = ROWS, block: int = BLOCK
) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, kept`` per row of ``docs``.

    Words are runs of non-space characters, A-Z lowered. Documents link when the distinct
    ``width``-word shingles they share are ``percent`` % or more of those that either has,
    as confirmed on whole sets. A text of fewer words is one shingle; a null or empty one,
    or one without words, has none and links with nothing. ``component_id`` is the least
    doc_id reachable by links, itself included (null only if there is no other);
    ``class_id`` tells equal sets. ``kept``: the id is the component's; rows that repeat
    it are kept alike, and a row without an id only if its component has none. An empty
    table gives an empty result; other columns are ignored.
    """
    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text))
    signed = settle(narrow.mapInArrow(_signed(width, side, rows), SIGNED), "signed")
    some = signed.where("n_shingles > 0")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    one = some.groupBy("class").agg(
        F.max("n_shingles").alias("n"), F.first("a").alias("a"), F.first("b").alias("b"), F.min(first).alias("first")
    )
    one = settle(one, "classes")
    near = _candidates(one).join(one.select("class", "n", "first"), "class")
    near = settle(near.withColumn("weight", F.col("n") + SET_WEIGHT), "candidates")
    weights = near.groupBy("component").agg(F.sum("weight").alias("total"))
    near = near.join(weights, "component")

    key = {"_id": F.coalesce("first.doc_id", F.lit(0)), "_null": F.col("first.none"), "_text": F.col("first.text_hash")}
    wanted = settle(near.withColumns(key).drop("first"), "wanted")
    chosen = split_by_keys(with_key(narrow), wanted.select(*KEY))[0].select(*KEY, "text")
    whole = chosen.mapInArrow(_whole_sets(width), "_id long, _null boolean, _text long, hashes binary")
    whole = settle(whole.join(wanted, KEY).drop(*KEY), "whole-sets")

    found = links_within(whole, percent, block)
    named = found.withColumnRenamed("root", "group").join(one.select("class", F.col("first.doc_id").alias("least")), "class")
    least = named.groupBy("group").agg(F.min("least").alias("reached"))
    reached = named.join(least, "group").select("class", "reached")
    own = some.groupBy("class").agg(F.min("doc_id").alias("own"))
    ids = own.join(reached, "class", "left").select("class", F.coalesce("reached", "own").alias("component_id"))
    out = ["doc_id", "n_shingles", "component_id", "class_id"]
    linked = some.join(ids, "class").withColumnRenamed("class", "class_id").select(*out)
    empty = signed.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("class_id")
    )
    return linked.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
                               ELSE array_to_string(words[i:i + 4], ' ') END AS sh
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= 85 * (nx.n + ny.n - o)),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.d)
SELECT r.d AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id, r.d = min(r.c) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.d GROUP BY r.d
"""


@query("op13_minhash_near_dedup", SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = similar_documents(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
