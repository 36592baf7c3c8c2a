"""Hard-negative mining by threshold joins over an inverted index with suffix-norm bounds.

Anchors are joined with all rows in blocks: a bounded block of anchors is indexed and
sent out, and every task scores its rows against it.

* *Index.* Dimensions are ordered by the block's energy. Of an anchor only the leading
  ones are indexed; the others are left out where the norm of that suffix times the
  largest norm of any row stays below the anchor's threshold.
* *Join.* Partial scores are accumulated over a few dimensions at a time. Pairs whose
  partial score plus the product of both remaining norms is below the threshold are
  pruned; those left get the dimensions that the index omits. Norms are rounded upwards.
* *Thresholds.* A join starts with what the best rows of the block itself reach, and rises
  within a task as its windows fill. Anchors whose windows do not fill are joined again
  with a lower threshold: first positives (the best of the same label), then negatives
  (the best of other labels in a window relative to each positive's score).

Scores are exact integers: products are formed in 32- or 64-bit floats only where every
sum fits their whole numbers, else in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from opsflow.llm.base import query, table
from opsflow.session import settle

#: Dimensions added up between two prunings; anchors of one block.
STEP = 8
ANCHORS = 4096
LAST = np.iinfo(np.int64).max

ROWS = "id long, label string, anchor boolean, x binary, norm double"


def _whole(scale: int):
    """Rows that take part, components as whole numbers of 16, 32 or 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, label, anchor, vector in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if label is None or vector is None or any(v is None for v in vector):
                    continue
                real = np.array(vector, np.float64)
                if not np.isfinite(real).all():
                    continue
                real = np.floor(scale * real)
                size = float(np.abs(real).max(initial=0))
                kind = np.int16 if size < 1 << 15 else np.int32 if size < 1 << 31 else np.int64
                packed = real.astype(kind) if size < 1 << 62 else np.zeros(0, kind)  # told by the norm
                out.append((id_, label, bool(anchor), bytes([kind().itemsize]) + packed.tobytes(), float(np.sqrt(real @ real))))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.bool_(), pa.binary(), pa.float64())
            names = [c.split()[0] for c in ROWS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _matrix(packed: pa.Array, dims: int, kind: np.dtype) -> np.ndarray:
    """Rows x dims; shorter vectors end in zeros."""
    out = np.zeros((len(packed), dims), kind)
    for i, x in enumerate(packed):
        body = x.as_py()
        row = np.frombuffer(body, f"i{body[0]}", offset=1)
        out[i, : len(row)] = row
    return out


class Index:
    """The leading dimensions of a block of vectors, and for the rest a bound."""

    def __init__(self, vectors: np.ndarray, floors: np.ndarray, reach: float, step: int = STEP):
        dims = vectors.shape[1]
        self.step, self.vectors = step, vectors
        self.slack = 1e-14 * reach * reach  # of whole numbers beyond 2**53, compared as floats
        self.order = np.argsort(-(vectors.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        ordered = vectors[:, self.order]
        self.tails = self._tails(ordered)
        # whole steps are indexed, up to where the suffix cannot reach the floor alone
        self.steps = (self.tails * reach >= floors[:, None] - self.slack).sum(axis=1).clip(0, self.tails.shape[1] - 1)
        mask = np.arange(dims) < (self.steps * step)[:, None]
        self.indexed, self.omitted = np.where(mask, ordered, 0), np.where(mask, 0, ordered)

    def _tails(self, ordered: np.ndarray) -> np.ndarray:
        """Norms of the suffixes that begin at each step, rounded upwards; the last is 0."""
        squares = ordered.astype(np.float64) ** 2
        ends = np.append(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1], np.zeros((len(ordered), 1)), axis=1)
        return np.append(np.sqrt(ends[:, : ordered.shape[1] : self.step]), np.zeros((len(ordered), 1)), axis=1) * (1 + 1e-9)

    def pairs(self, rows: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``vector, row, score`` of all pairs that reach the vector's floor."""
        rows = rows[:, self.order]
        tails = self._tails(rows)
        a, r = np.arange(len(self.vectors)), np.arange(len(rows))
        partial = np.zeros((len(a), len(r)), self.vectors.dtype)
        alive = np.ones(partial.shape, bool)
        for k in range(int(self.steps.max(initial=0))):
            at = slice(k * self.step, (k + 1) * self.step)
            partial += self.indexed[a, at] @ rows[r, at].T
            left = np.minimum(k + 1, self.steps[a])
            alive = partial + self.tails[a, left][:, None] * tails[r][:, left].T >= floors[a][:, None] - self.slack
            keep_a, keep_r = alive.any(axis=1), alive.any(axis=0)
            if keep_a.sum() * keep_r.sum() < 0.7 * alive.size:
                partial, alive = partial[np.ix_(keep_a, keep_r)], alive[np.ix_(keep_a, keep_r)]
                a, r = a[keep_a], r[keep_r]
        i, j = np.nonzero(alive)
        score = partial[i, j]
        if self.omitted.any():
            score = score + np.einsum("pd,pd->p", self.omitted[a[i]], rows[r[j]])
        score = score.astype(np.int64)
        reached = score >= floors[a[i]]
        return a[i][reached], r[j][reached], score[reached]


class Best:
    """The first ``k`` of every group: higher scores, then smaller ids, null ids last."""

    NAMES = ("group", "score", "id", "row")

    def __init__(self, groups: int, k: int):
        self.groups, self.k = groups, k
        self.held = [np.zeros(0, np.int64) for _ in self.NAMES]

    def add(self, *columns: np.ndarray) -> None:
        if not len(columns[0]):
            return
        group, score, id_, row = (np.concatenate(c) for c in zip(self.held, columns))
        order = np.lexsort((row, id_, -score, group))
        group = group[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        first = order[place < self.k]
        self.held = [group[place < self.k], score[first], id_[first], row[first]]

    def least(self, otherwise: np.ndarray) -> np.ndarray:
        """The k-th score of full groups, ``otherwise`` for the rest."""
        out = otherwise.copy()
        group, score = self.held[:2]
        ends = np.searchsorted(group, np.arange(self.groups), "right")
        full = ends - np.searchsorted(group, np.arange(self.groups)) >= self.k
        out[full] = np.maximum(out[full], score[ends[full] - 1])
        return out


@dataclass
class Block:
    """Anchors of one block with their thresholds; ``positives`` (anchors x k scores, with ``has``) if negatives are asked."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    floors: np.ndarray
    reach: float
    positives: np.ndarray | None = None
    has: np.ndarray | None = None
    indices: dict = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "indices": {}}

    def index(self, label: str | None) -> tuple[np.ndarray, Index]:
        """Places and index of the anchors of ``label`` (all, for None)."""
        if label not in self.indices:
            at = np.arange(len(self.rows)) if label is None else np.flatnonzero(self.labels == label)
            self.indices[label] = (at, Index(self.vectors[at], self.floors[at], self.reach))
        return self.indices[label]


def _windows(positives: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest negative score of each positive: ``low * p <= 100 * n <= high * p``."""
    return -(-low * positives // 100), high * positives // 100


def _candidates(shared, k: int, window: tuple[int, int], dims: int, kind: str):
    """A task's first ``k`` per anchor, or per anchor and positive: ``anchor, place, score, id, row``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        anchors, floors = len(block.rows), block.floors.copy()
        mining = block.positives is not None
        places = block.positives.shape[1] if mining else 1
        best = Best(anchors * places, k)
        if mining:
            low, high = _windows(block.positives, *window)
            group_floors = np.where(block.has, np.maximum(low, floors[:, None]), LAST)
        for batch in batches:
            row, label = batch.column(0).to_numpy(), np.array(batch.column(2).to_pylist(), object)
            id_ = batch.column(1).fill_null(LAST).to_numpy()
            x = _matrix(batch.column(3), dims, np.dtype(kind))
            for name in [None] if mining else np.unique(label):
                mine = np.arange(len(x)) if name is None else np.flatnonzero(label == name)
                at, index = block.index(name)
                if not len(at):
                    continue
                a, r, score = index.pairs(x[mine], floors[at])
                a, r = at[a], mine[r]
                if not mining:
                    other = block.rows[a] != row[r]
                    best.add(a[other], score[other], id_[r[other]], row[r[other]])
                    continue
                other = block.labels[a] != label[r]
                a, r, score = a[other], r[other], score[other]
                for p in range(places):
                    fits = block.has[a, p] & (low[a, p] <= score) & (score <= high[a, p]) & (score >= floors[a])
                    best.add(a[fits] * places + p, score[fits], id_[r[fits]], row[r[fits]])
            floors = best.least(group_floors.ravel()).reshape(anchors, places).min(axis=1) if mining else best.least(floors)
        group, score, id_, row = best.held
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.rows[group // places]), pa.array(group % places), pa.array(score),
             pa.array(id_, mask=id_ == LAST), pa.array(row)],
            names=["anchor", "place", "score", "id", "row"],
        )

    return run


FOUND = "anchor long, place long, score long, id long, row long"


def _join(rows: DataFrame, block: Block, k: int, window: tuple[int, int], dims: int, kind: str) -> DataFrame:
    """The first ``k`` of all tasks per anchor and place, with their ``rank``."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    found = rows.select("row", "id", "label", "x").mapInArrow(_candidates(shared, k, window, dims, kind), FOUND)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.col("id").isNull(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of every line; the least number where there are fewer columns."""
    if scores.shape[1] < k:
        return np.full(len(scores), -LAST)
    return -np.partition(-scores, k - 1, axis=1)[:, k - 1]


def _first_floors(block: Block, k: int, window: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """A hopeful threshold per anchor and one to fall back on, from scores within the block."""
    hopeful, sure = np.full(len(block.rows), -LAST), np.full(len(block.rows), -LAST)
    for start in range(0, len(block.rows), 256):
        part = slice(start, start + 256)
        scores = (block.vectors[part] @ block.vectors.T).astype(np.int64)
        same = block.labels[part, None] == block.labels[None]
        if block.positives is None:
            scores[~same | (block.rows[part, None] == block.rows[None])] = -LAST
            hopeful[part], sure[part] = _kth(scores, 1), _kth(scores, k)
            continue
        low, high = _windows(block.positives[part], *window)
        has = block.has[part]
        sure[part] = np.where(has, low, LAST).min(axis=1)
        hopeful[part] = LAST
        for p in range(has.shape[1]):
            fits = ~same & (scores >= low[:, p, None]) & (scores <= high[:, p, None])
            top = np.where(fits, scores, -LAST).max(axis=1)
            top = np.where(has[:, p], np.maximum(top, low[:, p]), LAST)
            hopeful[part] = np.minimum(hopeful[part], top)
    return np.maximum(hopeful, sure), sure


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, anchors: int = ANCHORS
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors``: ``vec_id``, ``label``, ``embedding`` (array of numbers), ``anchor`` (boolean).
    Rows with a null label, a null vector or a null or non-finite component take no part.
    Components become ``floor(scale * x)``; shorter vectors end in zeros, an empty one has
    only zeros. An anchor's positives are its first ``positives`` other rows of the same label
    by inner product, ties by vec_id (null last), then by row. For each positive the first
    ``negatives`` rows of another label with ``low * positive <= 100 * negative <= high * positive``
    are ranked, so a negative positive score gives none. Repeated rows count each, as
    anchors too. An empty table gives an empty result; other columns are ignored. Scores
    beyond 64 bits, taken a hundred times, raise an error.
    """
    spark = vectors.sparkSession
    narrow = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"), F.coalesce("anchor", F.lit(False)), F.col("embedding").cast("array<double>")
    )
    rows = narrow.mapInArrow(_whole(scale), ROWS).withColumn("row", F.monotonically_increasing_id())
    rows = settle(rows, "vectors")
    width = F.max((F.length("x") - 1) / F.conv(F.hex(F.substring("x", 1, 1)), 16, 10).cast("int"))
    total, reach, dims = rows.agg(F.sum(F.col("anchor").cast("int")), F.max("norm"), width).first()
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not total:
        return out
    if max(100, abs(low), abs(high)) * reach**2 >= 1 << 62:
        raise ValueError("inner products of these vectors do not fit 64 bits")
    kind, dims = "f4" if reach**2 < 1 << 23 else "f8" if reach**2 < 1 << 52 else "i8", max(1, int(dims))
    blocks = -(-total // anchors)
    chosen = settle(rows.where("anchor").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))), "anchors")
    for number in range(blocks):
        part = chosen.where(F.col("block") == number).orderBy("row").toArrow()  # about ``anchors`` rows
        if part.num_rows:
            packed = part.column("x").combine_chunks()
            block = Block(
                part.column("row").to_numpy(), np.array(part.column("label").to_pylist(), object), _matrix(packed, dims, np.dtype(kind)),
                np.full(part.num_rows, -LAST), reach,
            )
            names = dict(zip(part.column("row").to_pylist(), part.column("id").to_pylist()))
            out = out.unionByName(_mined(rows, block, names, positives, negatives, (low, high), dims, kind))
    return out


def _mined(rows: DataFrame, block: Block, names: dict, positives: int, negatives: int, window: tuple[int, int], dims: int, kind: str) -> DataFrame:
    spark = rows.sparkSession
    held: dict[int, list] = {}
    hopeful, sure = _first_floors(block, positives, window)
    open_ = np.arange(len(block.rows))
    for floors in (hopeful, sure):
        asked = Block(block.rows[open_], block.labels[open_], block.vectors[open_], floors[open_], block.reach)
        found = _join(rows, asked, positives, window, dims, kind).orderBy("anchor", "rank").collect()  # positives per anchor at most
        for row in block.rows[open_].tolist():
            held[row] = []
        for f in found:
            held[f["anchor"]].append((f["score"], f["id"]))
        open_ = np.array([i for i in open_ if len(held[int(block.rows[i])]) < positives and floors[i] > -LAST], np.int64)
        if not len(open_):
            break
    block.positives = np.zeros((len(block.rows), positives), np.int64)
    block.has = np.zeros(block.positives.shape, bool)
    pairs = []
    for i, row in enumerate(block.rows.tolist()):
        for place, (score, id_) in enumerate(held[row]):
            block.positives[i, place], block.has[i, place] = score, True
            pairs.append((row, place, names[row], id_, score))
    pairs = spark.createDataFrame(pairs, "anchor long, place long, anchor_id long, positive_id long, positive_score long")

    some = block.has.any(axis=1)
    mined = None
    hopeful, sure = _first_floors(block, negatives, window)
    open_ = np.flatnonzero(some)
    for floors in (hopeful, sure):
        asked = Block(block.rows[open_], block.labels[open_], block.vectors[open_], floors[open_], block.reach, block.positives[open_], block.has[open_])
        found = settle(_join(rows, asked, negatives, window, dims, kind), "negatives")
        full = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
        counts = {r["anchor"]: r["n"] for r in full.collect()}  # one row per anchor of the block
        # an anchor is done when all its windows are full or nothing lower can be in them
        short = [i for i in open_ if counts.get(int(block.rows[i]), 0) < negatives * block.has[i].sum() and floors[i] > sure[i]]
        done = set(block.rows[open_].tolist()) - {int(block.rows[i]) for i in short}
        final = spark.createDataFrame([(r,) for r in done], "anchor long")
        some_found = found.join(final, "anchor", "left_semi")
        mined = some_found if mined is None else mined.unionByName(some_found)
        open_ = np.array(short, np.int64)
        if not len(open_):
            break
    return mined.join(pairs, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


SQL = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op11_hard_negative_mining", SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumns({"label": turned, "anchor": F.col("vec_id") % 100 == 0}))
