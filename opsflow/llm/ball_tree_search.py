"""Exact ranked lexical search: sparse inner products over ball trees.

A document's score for a query is the inner product of two sparse vectors: the saturated
term counts of the document and the weights of the query's terms. Only dimensions of
terms that some query has can matter, so the documents are kept in these.

1. *Vectors.* One pass over the whole texts finds every term, counts all of them (N, L)
   and writes, per document, the counts of the terms that queries have. Document
   frequencies are summed from these vectors.
2. *Trees.* Every task builds a ball tree over each chunk of its documents: a node is cut
   in two halves, first along the line between two far members, then between the halves' means. Of a node it keeps the radius
   around the centroid and the inner product of the centroid with every query. Vectors
   are scaled by the root of the term weights, queries too, so rare terms set the shape.
3. *Search.* ``q.c + |q| r`` bounds the score of any document in a ball, rounded upwards by
   more than the arithmetic can lose. ``r`` is the ball's radius, or its radius in the
   dimensions of the query, bounded by the members' reach in each, if less. Subtrees are taken best bound first; what is below
   the query's k-th best score so far is pruned. Leaves are scored in 64-bit integers.
4. The k best of every task are ranked once more.

Queries are taken in blocks of a bounded number of terms; only one block is broadcast.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from opsflow.llm.base import query, table
from opsflow.llm.textbytes import byte_slices, word_hashes
from opsflow.session import settle

#: Bytes that are no part of a term become blanks.
FOLD = np.arange(256, dtype=np.uint8)
for _first, _last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    FOLD[_first : _last + 1] = 32
#: Vector entries of one tree, documents of a leaf, terms (with their queries) of one block.
ENTRIES = 1_000_000
LEAF = 32
#: Times a node's cut is made, each time along the line between the last halves' means.
HALVINGS = 4
BLOCK_TERMS = 200_000

VECTOR = "doc_id long, n long, terms binary, counts binary"
QUERY_TERM = "row long, term long, times long"
FOUND = "row long, doc_id long, score long"


def terms_of(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """``rows, hashes, row`` of the terms of whole texts: 64-bit hash and row of each."""
    for rows, data, offsets in byte_slices(column):
        yield rows, *word_hashes(FOLD[data], offsets)


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, hashes, row in terms_of(batch.column(1)):
            number = batch.column(0)[rows.start : rows.stop].to_numpy()
            pairs, times = np.unique(np.stack((number[row].astype(np.int64), hashes.view(np.int64))), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[0]), pa.array(pairs[1]), pa.array(times.astype(np.int64))], names=["row", "term", "times"]
            )


def _vectors(vocabulary: np.ndarray):
    """``vocabulary``: ascending hashes; terms are given by their place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, hashes, row in terms_of(batch.column(1)):
                size = rows.stop - rows.start
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = vocabulary[at] == hashes
                pairs, times = np.unique(row[known] * len(vocabulary) + at[known], return_counts=True)
                ends = np.searchsorted(pairs, np.arange(size + 1) * len(vocabulary))
                terms, times = (pairs % len(vocabulary)).astype(np.uint32), times.astype(np.uint32)
                cut = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[rows.start : rows.stop], pa.array(np.bincount(row, minlength=size)), cut(terms), cut(times)],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's documents per term."""
    held = np.zeros(0, np.int64)
    for batch in batches:
        more = np.bincount(np.frombuffer(b"".join(t.as_py() for t in batch.column(0)), np.uint32))
        if len(more) > len(held):
            held, more = more, held
        held[: len(more)] += more
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["term", "df"])


@dataclass
class Queries:
    """A block of queries in compressed rows: ``terms`` and ``times`` from ``ends[i]`` to ``ends[i + 1]``."""

    rows: np.ndarray
    ends: np.ndarray
    terms: np.ndarray
    times: np.ndarray
    weights: np.ndarray  # per term

    def __post_init__(self):
        self.scaled = self.times * np.sqrt(self.weights[self.terms])
        self.norms = np.sqrt(_sums(self.scaled**2, self.ends))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, exact in the type of ``values``; empty runs give 0."""
    full = np.flatnonzero(ends[1:] > ends[:-1])
    out = np.zeros(len(ends) - 1, values.dtype)
    if len(full):
        out[full] = np.add.reduceat(values, ends[full])
    return out


class BallTree:
    """Balls over sparse documents, with an upper bound of every query's scores in each.

    ``ends, terms, values``: the documents in compressed rows; ``values`` are whole numbers.
    """

    def __init__(self, ends: np.ndarray, terms: np.ndarray, values: np.ndarray, queries: Queries, leaf: int = LEAF):
        self.scaled = values * np.sqrt(queries.weights[terms])
        self.ends, self.terms, self.values, self.queries, self.leaf = ends, terms, values, queries, leaf
        self.squares = _sums(self.scaled**2, ends)
        self.bounds: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.leaves: list[tuple | None] = []
        if len(ends) > 1:
            self._node(np.arange(len(ends) - 1))

    def _entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of ``docs`` and the ends of their runs."""
        sizes = self.ends[docs + 1] - self.ends[docs]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return np.arange(ends[-1]) + np.repeat(self.ends[docs] - ends[:-1], sizes), ends

    def _node(self, docs: np.ndarray) -> int:
        number = len(self.bounds)
        self.bounds.append(None)
        self.children.append(None)
        self.leaves.append(None)
        places, ends = self._entries(docs)
        terms, scaled = self.terms[places], self.scaled[places]
        q = self.queries
        center = np.bincount(terms, scaled, minlength=len(q.weights)) / len(docs)
        far = self.squares[docs] - 2 * _sums(scaled * center[terms], ends) + center @ center
        # squares cancel: what the differences may have lost is added before the root
        slack = 1e-9 * (self.squares[docs].max() + center @ center) + 1e-9
        radius = math.sqrt(max(0.0, far.max()) + slack)
        near = _sums(q.scaled * center[q.terms], q.ends)
        within = np.sqrt(_sums(self._reach(docs, terms, scaled, center)[q.terms] ** 2, q.ends)) + math.sqrt(slack)
        self.bounds[number] = (near + q.norms * np.minimum(radius, within)) * (1 + 1e-9) + 1e-6
        if len(docs) <= self.leaf or radius * radius <= 4 * slack:
            self.leaves[number] = (docs, terms, self.values[places], ends)
            return number
        one = self._dense(docs[int(np.argmax(far))])
        apart = self.squares[docs] - 2 * _sums(scaled * one[terms], ends)
        line = self._dense(docs[int(np.argmax(apart))]) - one
        side = np.repeat(np.arange(len(docs)), np.diff(ends))
        for _ in range(HALVINGS):
            order = np.argsort(_sums(scaled * line[terms], ends), kind="stable")
            upper = np.zeros(len(docs), bool)
            upper[order[len(docs) // 2 :]] = True
            signed = np.where(upper[side], scaled, -scaled)
            line = np.bincount(terms, signed, minlength=len(center))
        half = len(docs) // 2
        self.children[number] = (self._node(docs[order[:half]]), self._node(docs[order[half:]]))
        return number

    @staticmethod
    def _reach(docs: np.ndarray, terms: np.ndarray, scaled: np.ndarray, center: np.ndarray) -> np.ndarray:
        """Per dimension, how far a member can be from the centroid."""
        high, low = np.zeros(len(center)), np.full(len(center), np.inf)
        np.maximum.at(high, terms, scaled)
        np.minimum.at(low, terms, scaled)
        low[np.bincount(terms, minlength=len(center)) < len(docs)] = 0
        return np.maximum(high - center, center - low)

    def _dense(self, doc: int) -> np.ndarray:
        out = np.zeros(len(self.queries.weights))
        at = slice(self.ends[doc], self.ends[doc + 1])
        out[self.terms[at]] = self.scaled[at]
        return out

    def search(self, best: list[list], ids: list, k: int) -> int:
        """Puts documents into ``best`` (``(-score, id is None, id)`` per query, k at most, ascending); leaves scored."""
        if not self.bounds:
            return 0
        q, seen = self.queries, 0
        weight = np.zeros(len(q.weights), np.int64)
        for i, top in enumerate(best):
            at = q.terms[q.ends[i] : q.ends[i + 1]]
            if not len(at):
                continue
            weight[at] = q.times[q.ends[i] : q.ends[i + 1]] * q.weights[at]
            bound = lambda node: float(self.bounds[node][i])  # noqa: E731, B023
            least = -top[-1][0] if len(top) == k else 1
            heap = [(-bound(0), 0)]
            while heap and -heap[0][0] >= least:
                above, node = heapq.heappop(heap)
                if self.children[node] is not None:
                    for child in self.children[node]:
                        heapq.heappush(heap, (max(above, -bound(child)), child))
                    continue
                seen += 1
                docs, terms, values, ends = self.leaves[node]
                scores = _sums(values * weight[terms], ends)
                for d in np.flatnonzero(scores >= least):
                    top.append((-int(scores[d]), ids[docs[d]] is None, ids[docs[d]]))
                top.sort(key=lambda x: (x[0], x[1], x[2] or 0))
                del top[k:]
                least = -top[-1][0] if len(top) == k else 1
            weight[at] = 0
        return seen


def saturated(counts: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """A document's part of the score per term, in 64-bit integers: it rises with the term's count
    and falls with the document's terms ``n`` against the mean ``terms / docs``."""
    length = 100 - 25 + (25 * n * docs) // terms
    return (1_000_000_000 * counts) // (1000 * counts + 12 * length)


def _search(shared, k: int, docs: int, total: int, entries: int, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best: list[list] = [[] for _ in queries.rows]
        held, size = [], 0

        def grow() -> None:
            ids = [i for batch in held for i in batch.column(0).to_pylist()]
            n = np.concatenate([batch.column(1).to_numpy() for batch in held])
            flat = [np.frombuffer(b"".join(x.as_py() for batch in held for x in batch.column(c)), np.uint32) for c in (2, 3)]
            sizes = np.concatenate([[len(x.as_py()) // 4 for x in batch.column(2)] for batch in held]).astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            values = saturated(flat[1].astype(np.int64), np.repeat(n, sizes), docs, total)
            BallTree(ends, flat[0].astype(np.int64), values, queries, leaf).search(best, ids, k)

        for batch in batches:
            held.append(batch)
            size += sum(len(x.as_py()) for x in batch.column(2)) // 4
            if size >= entries:
                grow()
                held, size = [], 0
        if held:
            grow()
        rows = [(row, doc, -score) for row, top in zip(queries.rows.tolist(), best) for score, _, doc in top]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "doc_id", "score"])

    return run


def lexical_search(
    docs: DataFrame, items: DataFrame, k: int = 20, block_terms: int = BLOCK_TERMS, entries: int = ENTRIES, leaf: int = LEAF
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best rows of ``docs`` for each row of ``items``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lowered,
    over whole texts; a null text has none. A score sums, over the item's terms with
    repeats, the term's weight ``floor(1000 ln((2 N + 2) / (2 df + 1)))`` times
    ``saturated``. Only scores above 0 count; equal ones go by ascending doc_id (null
    last). An item without a term, or none of whose terms any document has, gives no
    rows; repeated items and documents count each. An empty table on either side gives
    an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    asked = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    asked = settle(asked.withColumn("row", F.monotonically_increasing_id()), "items")
    terms = asked.select("row", "text").mapInArrow(_query_terms, QUERY_TERM)
    terms = settle(terms.groupBy("row", "term").agg(F.sum("times").alias("times")), "item-terms")
    blocks = -(-terms.count() // block_terms)
    found = spark.createDataFrame([], FOUND)
    for block in range(blocks):
        mine = terms.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
        part = mine.orderBy("row", "term").toArrow()
        if not part.num_rows:
            continue
        vocabulary = np.unique(part.column("term").to_numpy().view(np.uint64))
        vectors = settle(narrow.mapInArrow(_vectors(vocabulary), VECTOR), "vectors")
        sums = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        if not sums[0]:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        counted = vectors.select("terms").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        for row in counted.collect():  # one row per term of the block at most
            df[row["term"]] = row["df"]
        weights = np.array([math.floor(1000 * math.log((2 * sums[0] + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        rows, first = np.unique(part.column("row").to_numpy(), return_index=True)
        queries = Queries(
            rows, np.append(first, part.num_rows), np.searchsorted(vocabulary, part.column("term").to_numpy().view(np.uint64)),
            part.column("times").to_numpy(), weights,
        )
        shared = spark.sparkContext.broadcast(queries)
        top = vectors.where("length(terms) > 0").mapInArrow(_search(shared, k, sums[0], sums[1], entries, leaf), FOUND)
        found = found.unionByName(settle(top, "best"))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").isNull(), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
df AS (SELECT term, floor(1000 * ln((2.0 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, docs),
v AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // terms))) AS v
  FROM tf JOIN n USING (doc_id), s),
r AS (
  SELECT item_id, doc_id, sum(times * w * v)::BIGINT AS score
  FROM (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL) JOIN df USING (term) JOIN v USING (term)
  GROUP BY ALL HAVING sum(times * w * v) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM r QUALIFY rank <= 20
"""


@query("op12_ranked_lexical_search", SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
