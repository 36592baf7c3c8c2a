"""Mixing sources to target weights.

Each source is one long stream of words (its documents in a seeded order), cut into
blocks of ``block_words``. The output has ``shards`` shards; each draws how many
blocks it takes from each source. The draws are multinomial, conditioned on the
totals that meet the targets (what one shard has drawn is no longer there for the
next), so no source misses its target by chance. A source's slots run through its
blocks in epochs; each epoch maps its slots to block numbers by a pseudorandom
permutation of its own, computed per index. Slots and blocks are joined by
(source, block), which no hot source can skew, as blocks are all of one size.

The driver holds three numbers per source and one count per shard and source,
nothing per document or block.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType

from opsflow.llm.base import SPACE_CLASS, WORD, group_key, hex_unit, query, running_sums, table
from opsflow.session import settle

SLOT_RUN = 1 << 14


def targets(sizes: np.ndarray, weights: np.ndarray, most: float) -> np.ndarray:
    """Shares of the total by weight, none above ``most`` times its source's size.

    What is cut off at a limit is shared by weight among the others, until none is
    above its limit.
    """
    sizes, weights = sizes.astype(float), weights.astype(float)
    out, open_ = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    left = sizes.sum()
    while open_.any():
        share = np.where(open_, left * weights / max(weights[open_].sum(), 1e-300), 0)
        above = open_ & (share > most * sizes)
        if not above.any():
            return np.where(open_, share, out)
        out[above] = most * sizes[above]
        open_ &= ~above
        left = sizes.sum() - out.sum()
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of ``[0, n)``: a four-round Feistel network, walked back into range."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    x, key, limit = index.astype(np.uint64), key.astype(np.uint64), n.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for round_ in range(4):
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(round_ + 1)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(31)) & m)
        x[todo] = (left << h) | right
        todo = x >= limit
    return x.astype(np.int64)


@F.pandas_udf(LongType())
def block_of(slot: pd.Series, blocks: pd.Series, seed: pd.Series) -> pd.Series:
    """The block that a source's slot takes; each run through the blocks has its own order."""
    if not len(slot):
        return pd.Series([], dtype="int64")
    epoch, index = slot // blocks, slot % blocks
    key = seed.to_numpy(np.int64).view(np.uint64) + epoch.to_numpy(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return pd.Series(permuted(index.to_numpy(), blocks.to_numpy(), key))


class Mix:
    """``documents`` (a row each, with place in its source), ``pieces`` and ``slots``."""

    def __init__(self, documents: DataFrame, pieces: DataFrame, slots: DataFrame):
        self.documents, self.pieces, self.slots = documents, pieces, slots

    def taken(self) -> DataFrame:
        """``documents`` with ``taken``: the words the mix takes from each, repeats counted."""
        uses = self.slots.groupBy("_source", "block").agg(F.count(F.lit(1)).alias("times"))
        words = (
            self.pieces.join(uses, ["_source", "block"])
            .groupBy("_source", "start")
            .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        )
        none = F.lit(0).cast("long")
        joined = self.documents.withColumn("_start", F.when(F.col("size") > 0, F.col("start"))).join(
            words.withColumnRenamed("start", "_start"), ["_source", "_start"], "left"
        )
        return joined.withColumn("taken", F.coalesce("taken", none)).drop("_start")


def mix(
    docs: DataFrame,
    shards: int = 64,
    block_words: int = 128,
    most: float = 3.0,
    weights: tuple[int, ...] = (1, 2, 3),
    seed: int = 0,
) -> Mix:
    """Blocks of every source in the proportion of its weight.

    Sources in code point order (null last) weigh ``weights``, repeating. The mix is
    as long as the corpus; a source gives ``most`` times its size at most, and so
    does a document. Null text has no words; documents without words are never
    taken. Sources without words get no target. Rows that agree in id, size and
    text are interchangeable. An empty table gives an empty mix. Reruns agree.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col("source").cast("string").alias("source"),
        group_key("source").alias("_source"),
        F.xxhash64(text).alias("_text"),
    )
    rows = rows.withColumn("_digest", F.md5(F.concat_ws("|", F.lit(str(seed)), group_key("doc_id"), F.col("_text").cast("string"))))
    rows = settle(rows, "mix-rows")
    totals = sorted(
        ((r["source"], r["_source"], r["size"]) for r in rows.groupBy("source", "_source").agg(F.sum("size").alias("size")).collect()),
        key=lambda r: (r[0] is None, r[0] or ""),
    )
    sizes = np.array([r[2] for r in totals], np.int64)
    weight = np.array([weights[i % len(weights)] for i in range(len(totals))])
    target = targets(sizes, weight, most)
    blocks = -(-sizes // block_words)
    quota = np.rint(np.divide(target * blocks, sizes, out=np.zeros(len(sizes)), where=sizes > 0)).astype(np.int64)

    rng = np.random.default_rng(seed)
    left, drawn = quota.copy(), []
    for shard in range(shards):
        take = int(left.sum()) // (shards - shard)
        counts = draw(rng, left, take)
        first = quota - left
        drawn += [
            (shard, totals[i][1], int(first[i]), int(counts[i]), int(blocks[i]), int(rng_key(seed, i)))
            for i in np.flatnonzero(counts)
        ]
        left = left - counts
    draws = spark.createDataFrame(drawn, "shard int, _source string, first long, n long, blocks long, seed long")
    runs = draws.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {SLOT_RUN}"))).alias("_run"))
    slots = (
        runs.withColumn("_from", F.col("_run") * SLOT_RUN)
        .withColumn("_to", F.least(F.col("n"), F.col("_from") + SLOT_RUN) - 1)
        .select("shard", "_source", "first", "blocks", "seed", F.explode(F.sequence("_from", "_to")).alias("_i"))
        .withColumn("slot", F.col("first") + F.col("_i"))
        .select(
            "shard", "_source", "slot", F.expr("slot div blocks").alias("epoch"),
            block_of("slot", "blocks", "seed").alias("block"),
        )
    )
    per_source = spark.createDataFrame(
        [(r[1], int(s), float(t)) for r, s, t in zip(totals, sizes, target)],
        "_source string, source_size long, target double",
    )
    placed = running_sums(rows, hex_unit(F.col("_digest")), ["_digest", "doc_id", "size"], ["size"], ["_source"])
    documents = settle(placed.withColumnRenamed("size_before", "start").join(per_source, "_source"), "mix-documents")
    end = F.col("start") + F.col("size")
    pieces = (
        documents.where("size > 0")
        .select(
            "_source", "start", "size",
            F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")).alias("block"),
        )
        .withColumn("from_word", F.greatest(F.col("block") * block_words, F.col("start")) - F.col("start"))
        .withColumn("to_word", F.least((F.col("block") + 1) * block_words, end) - F.col("start"))
        .withColumn("words", F.col("to_word") - F.col("from_word"))
        .drop("size")
    )
    return Mix(documents, pieces, slots)


#: Blocks that one hypergeometric draw can be made from.
LARGEST = 900_000_000


def draw(rng: np.random.Generator, left: np.ndarray, take: int, largest: int = LARGEST) -> np.ndarray:
    """``take`` blocks of ``left``, drawn at random without putting back, counted per source.

    Beyond ``largest`` blocks in all, whole units of so many blocks are drawn that the
    units are few enough; what is missing of ``take`` comes from the sources that have most left.
    """
    unit = max(1, -(-int(left.sum()) // largest))
    units = left // unit
    counts = unit * rng.multivariate_hypergeometric(units, min(take // unit, int(units.sum())), method="marginals")
    missing = take - int(counts.sum())
    for i in np.argsort(counts - left, kind="stable"):
        more = min(missing, int(left[i] - counts[i]))
        counts[i] += more
        missing -= more
    return counts


def rng_key(seed: int, source: int) -> np.int64:
    """A permutation key per source."""
    return np.random.default_rng([seed, source]).integers(1 << 62)


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``docs``: every stretch of a document that the mix takes.

    Neighbouring blocks that one epoch takes from a document form one stretch, from
    the start of its first word to the start of the word after it, so a whole epoch
    gives the document as it is. Other columns are those of the document; ``n_chars``
    is counted anew where there is such a column.
    """
    made = mix(docs, **options)
    uses = made.slots.select("_source", "block", "epoch").join(made.pieces, ["_source", "block"])
    gap = F.lag("to_word").over(_along()) != F.col("from_word")
    runs = (
        uses.withColumn("_new", F.coalesce(gap, F.lit(True)).cast("int"))
        .withColumn("_run", F.sum("_new").over(_along()))
        .groupBy("_source", "start", "epoch", "_run")
        .agg(F.min("from_word").alias("from_word"), F.max("to_word").alias("to_word"))
        .groupBy("_source", "start")
        .agg(F.array_sort(F.collect_list(F.struct("epoch", "from_word", "to_word"))).alias("_runs"))
    )
    same = Window.partitionBy("_id", "_text")
    keyed = made.documents.where("size > 0").join(runs, ["_source", "start"], "left").select(
        group_key("doc_id").alias("_id"), "_text", "_source", "start", F.struct("size", "_runs").alias("_take")
    )
    # rows that agree in id and text are dealt to one another by their number
    copies = keyed.withColumn("_copy", F.row_number().over(same.orderBy("_source", "start"))).where("_take._runs IS NOT NULL")
    text = F.col("text").cast("string")
    # the row travels as one value, so its columns may have any names
    known = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), group_key("doc_id").alias("_id"),
        F.xxhash64(text).alias("_text"), group_key("source").alias("_source"),
    ).withColumn("_copy", F.row_number().over(same.orderBy("_source")))
    whole_text = F.col("_row.text")
    tokens = F.regexp_extract_all(whole_text, F.lit(f"({WORD}{SPACE_CLASS}*)"), F.lit(1))

    def stretch(parts, run):
        part = F.slice(parts, run["from_word"].cast("int") + 1, (run["to_word"] - run["from_word"]).cast("int"))
        whole = (run["from_word"] == 0) & (run["to_word"] == F.col("_take.size"))
        return F.when(whole, whole_text).otherwise(F.array_join(part, ""))

    # words are found once per document, however many stretches it gives
    stretches = F.transform(F.array(tokens), lambda parts: F.transform("_take._runs", lambda run: stretch(parts, run)))[0]
    taken = known.join(copies.select("_id", "_text", "_copy", "_take"), ["_id", "_text", "_copy"])
    out = taken.select("_row", F.explode(stretches).alias("_stretch"))
    made_anew = {"text": F.col("_stretch").alias("text")}
    if "n_chars" in docs.columns:
        made_anew["n_chars"] = F.char_length("_stretch").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[made_anew.get(c, F.col(f"_row.`{c}`").alias(c)) for c in docs.columns])


def _along():
    return Window.partitionBy("_source", "start", "epoch").orderBy("from_word")


@query("op10_mixing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"), seed=11).taken().select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )
