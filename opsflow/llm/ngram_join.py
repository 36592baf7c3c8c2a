"""Set-similarity self join on word shingles by vertical partitioning.

All shingles have one global order: rarest first. The order is cut into fragments;
a document's set is cut into segments along them. Overlaps are counted fragment by
fragment and summed per pair.

1. *Classes.* Documents with equal sets form a class; all that follows is between
   classes, so copies cost nothing.
2. *Hopeful classes.* Of every set only a first part of an order by hash is dealt, a
   little over a quarter. Linked sets share a tenth of the smaller set's size there, so
   a class with fewer repeated shingles in it can have no link. Only one document of
   each other class goes on.
3. *Order.* Shingles of these are dealt by hash range and counted over all classes. They
   travel as packed numbers (about 8 bytes each), not as rows. A shingle that occurs
   often within one task's buffer is known to be frequent; it is announced to its
   range once and its occurrences are spread, so no range grows with it.
4. *Survivors.* A linked class shares 75 % of its shingles, so a class with fewer
   repeated ones is out. Only the survivors' repeated shingles are kept, as segments,
   one per fragment.
5. *Candidates.* Two linked sets share a shingle among the first of the global order
   (prefix filter). For components, every class of such a shingle is tied to the least
   one, so a group of n gives n - 1 ties; linked classes lie in one component of ties.
   ``all_class_links`` forms the pairs that size and place filters let through instead.
6. *Count.* Partial overlaps are counted fragment by fragment and summed per pair:
   within the tasks that hold the components of ties (``linking``), where pairs already
   connected need no count, or, for all links, where pairs meet their segments.

Sets are compared by 56-bit hashes of their shingles and classes by 64-bit sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from opsflow.llm.base import query, table
from opsflow.llm.components import components
from opsflow.llm.exact_dedup import KEY, hash_filter, passes, split_by_keys, with_key
from opsflow.llm.linking import BLOCK, links_within, overlaps_by_fragment
from opsflow.llm.textbytes import U, mix64, pack_ascending, shingle_sets, sums_by_run, unpack_ascending
from opsflow.session import settle

HASH_BITS = 56
BUFFER = 500_000
#: Times in one buffer from which a shingle is spread over all ranges.
OFTEN = 32
FREQUENT = 63
RANGE_SHINGLES = 600_000
#: Work of a class's segment besides its shingles.
SEGMENT_WEIGHT = 60


def class_of(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A number per set that is equal for equal sets."""
    return mix64(sums_by_run(mix64(hashes ^ U(0x2545F4914F6CDD1D)), counts) + counts.astype(np.uint64))


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, counts, hashes in shingle_sets(batch.column(1), width):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[rows.start : rows.stop],
                        pa.array(counts.astype(np.int64)),
                        pa.array(class_of(counts, hashes).view(np.int64)),
                        batch.column(2)[rows.start : rows.stop],
                    ],
                    names=["doc_id", "n_shingles", "class", "text_hash"],
                )

    return run


PACKET = "part long, often boolean, hashes binary, at binary, class binary, n binary, told binary"
PACKET_SCHEMA = pa.schema(
    [("part", pa.int64()), ("often", pa.bool_())] + [(c, pa.binary()) for c in ("hashes", "at", "class", "n", "told")]
)


def _packet(part: int, often: bool, hashes, at, classes, sizes, told) -> dict:
    """Shingles in ascending order, each with the place of its class in a list; ``told``: frequent ones."""
    used, local = np.unique(at, return_inverse=True)
    local = local.astype(np.uint16 if len(used) < 1 << 16 else np.uint32)
    return {
        "part": part, "often": often, "hashes": pack_ascending(hashes), "at": local.tobytes(),
        "class": classes[used].tobytes(), "n": sizes[used].astype(np.uint32).tobytes(),
        "told": pack_ascending(np.unique(told)),
    }


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hashes, class, n`` per shingle of a packet."""
    classes = np.frombuffer(row["class"], np.uint64)
    at = np.frombuffer(row["at"], np.uint16 if len(classes) < 1 << 16 else np.uint32)
    return unpack_ascending(row["hashes"]), classes[at], np.frombuffer(row["n"], np.uint32)[at]


def hopeful_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles of a set of ``n`` that are dealt in the first place, see ``hopeful_repeats``."""
    return n - -(-percent * n // 100) + np.maximum(1, n // 10)


def hopeful_repeats(n: np.ndarray, percent: int) -> np.ndarray:
    """Shared ones among them that a set of ``n`` with a link has at least.

    Linked sets of sizes x <= y share o >= percent y / 100 shingles. The first x - o + k of
    the one and y - o + k of the other, in any common order, share k. With k a tenth of x
    both lie within the lengths above, and x is no less than percent y / 100.
    """
    return np.maximum(1, -(-percent * n // 100) // 10)


def _deal(width: int, bits: int, buffer: int, times_often: int, percent: int | None = None):
    """Every task's shingles, packed per range of the hash; with ``percent``, the hopeful length of each set."""

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        own, count, taken, value = (np.concatenate(x) for x in zip(*held))
        held.clear()
        classes, first = np.unique(own, return_index=True)
        keep = np.zeros(len(own), bool)
        keep[first] = True  # one of each class
        at = np.repeat(np.arange(len(own), dtype=np.uint32), taken)
        kept = keep[at]
        value, at = value[kept], at[kept]
        value >>= U(64 - HASH_BITS)
        order = np.argsort(value, kind="stable")
        value, at = value[order], at[order]
        del kept, order
        runs = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, int)
        times = np.diff(np.append(runs, len(value)))
        often = np.repeat(times >= times_often, times)
        # a frequent shingle is announced to its range by one occurrence
        told = np.zeros(len(value), bool)
        told[runs[times >= times_often]] = True
        del runs, times
        edges = np.searchsorted(value, np.arange(1 << bits, dtype=np.uint64) << U(HASH_BITS - bits))
        for p, (low, high) in enumerate(zip(edges, np.append(edges[1:], len(value)))):
            here = np.flatnonzero(~often[low:high] | told[low:high]) + low
            if len(here):
                yield sent(_packet(p, False, value[here], at[here], own, count, value[here][told[here]]))
        spread = np.flatnonzero(often & ~told)
        if len(spread):
            yield sent(_packet(int(own[0] % U(1 << bits)), True, value[spread], at[spread], own, count, value[:0]))

    def sent(packet: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([packet], PACKET_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, count, value in shingle_sets(batch.column(0), width):
                own, taken = class_of(count, value), count
                if percent is not None:
                    taken = np.minimum(count, hopeful_length(count, percent))
                    place = np.arange(len(value)) - np.repeat(np.cumsum(count) - count, count)
                    value = value[place < np.repeat(taken, count)]
                held.append((own, count, taken, value))
                size += len(value)
                if size > buffer:
                    yield from flush(held)
                    size = 0
        if held:
            yield from flush(held)

    return run


REPEATED = "bucket long, class binary, n binary, times binary, hashes binary, frequency binary"
REPEATED_SCHEMA = pa.schema(
    [("bucket", pa.int64())] + [(c, pa.binary()) for c in ("class", "n", "times", "hashes", "frequency")]
)


def _repeated_here(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``hash, class, n, level`` of the shingles of one range that two classes or more have."""
    plain, spread, announced = [], [], [np.zeros(0, np.uint64)]
    for i in range(len(group)):
        r = group.slice(i, 1).to_pylist()[0]
        (spread if r["often"] else plain).append(_open(r))
        announced.append(unpack_ascending(r["told"]))
    value, own, size = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (zip(*plain) if plain else ((), (), ())))
    plain.clear()
    size = size.astype(np.uint32, copy=False)
    order = np.lexsort((own, value))
    value, own, size = value[order], own[order], size[order]
    del order
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
    value, own, size = value[new], own[new], size[new]
    runs = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, int)
    times = np.diff(np.append(runs, len(value)))
    told = np.unique(np.concatenate(announced))
    frequent = np.isin(value[runs], told)
    kept = np.repeat((times >= 2) | frequent, times)
    level = np.floor(np.log2(np.maximum(times, 1))).astype(np.uint8)
    level = np.repeat(np.where(frequent, np.uint8(FREQUENT), level), times)
    parts = [(value[kept], own[kept], size[kept], level[kept])]
    parts += [(v, o, n, np.full(len(v), FREQUENT, np.uint8)) for v, o, n in spread]
    return tuple(np.concatenate(x) for x in zip(*parts))


REPEATS = "bucket long, class binary, n binary, times binary"
REPEATS_SCHEMA = pa.schema([("bucket", pa.int64())] + [(c, pa.binary()) for c in ("class", "n", "times")])


def _repeats(bits: int):
    """How many shingles of one hash range each class repeats, packed per class bucket."""

    def run(group: pa.Table) -> pa.Table:
        _, own, size, _ = _repeated_here(group)
        classes, first, times = np.unique(own, return_index=True, return_counts=True)
        size, times = size[first], times.astype(np.uint32)
        bucket = (classes >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(classes), np.int64)
        out = []
        for b in np.unique(bucket):
            low, high = np.searchsorted(bucket, [b, b + 1])
            out.append({"bucket": int(b), "class": classes[low:high].tobytes(), "n": size[low:high].tobytes(), "times": times[low:high].tobytes()})
        return pa.Table.from_pylist(out, REPEATS_SCHEMA)

    return run


def _hopeful_classes(percent: int):
    """Of one bucket, the classes that repeat enough of their first shingles."""

    def run(group: pa.Table) -> pa.Table:
        own, size, times = (
            np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(name)])
            for name, kind in (("class", np.uint64), ("n", np.uint32), ("times", np.uint32))
        )
        classes, first, where = np.unique(own, return_index=True, return_inverse=True)
        size, times = size[first].astype(np.int64), np.bincount(where, times, len(classes))
        some = times >= hopeful_repeats(size, percent)
        return pa.table({"class": pa.array(classes[some].view(np.int64)), "n": pa.array(size[some])})

    return run


def _repeated(bits: int):
    """The shingles of one hash range that two classes or more have, packed per class bucket."""

    def run(group: pa.Table) -> pa.Table:
        value, own, size, level = _repeated_here(group)
        order = np.argsort(own, kind="stable")
        value, own, size, level = value[order], own[order], size[order], level[order]
        bucket = (own >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(own), np.int64)
        out = []
        for b in np.unique(bucket):
            low, high = np.searchsorted(bucket, [b, b + 1])
            classes, first, count = np.unique(own[low:high], return_index=True, return_counts=True)
            out.append(
                {
                    "bucket": int(b), "class": classes.tobytes(), "n": size[low:high][first].tobytes(),
                    "times": count.astype(np.uint32).tobytes(),
                    "hashes": value[low:high].view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8].tobytes(),
                    "frequency": level[low:high].tobytes(),
                }
            )
        return pa.Table.from_pylist(out, REPEATED_SCHEMA)

    return run


#: ``before``: the class's shingles in earlier fragments.
SEGMENT = "class long, n long, repeated long, before long, fragment int, hashes array<long>"
SEGMENT_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("class", "n", "repeated", "before")] + [("fragment", pa.int32()), ("hashes", pa.list_(pa.int64()))]
)


def _segments(percent: int):
    """Segments, in the global order, of the classes of a bucket that can have a link."""

    def run(group: pa.Table) -> pa.Table:
        parts = []
        for r in group.to_pylist():
            times = np.frombuffer(r["times"], np.uint32)
            body = np.frombuffer(r["hashes"], np.uint8).reshape(-1, HASH_BITS // 8)
            wide = np.zeros((len(body), 8), np.uint8)
            wide[:, : HASH_BITS // 8] = body
            parts.append(
                (
                    np.repeat(np.frombuffer(r["class"], np.uint64), times), np.repeat(np.frombuffer(r["n"], np.uint32), times),
                    np.frombuffer(r["frequency"], np.uint8), wide.view(np.uint64).ravel(),
                )
            )
        own, size, level, value = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((value, own))
        own, size, level, value = own[order], size[order], level[order], value[order]
        new = np.ones(len(own), bool)
        new[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
        own, size, level, value = own[new], size[new], level[new], value[new]
        _, where, count = np.unique(own, return_inverse=True, return_counts=True)
        repeated = count[where]
        kept = 100 * repeated >= percent * size.astype(np.int64)
        own, size, level, value, repeated = own[kept], size[kept], level[kept], value[kept], repeated[kept]
        fragment = level.astype(np.int32)  # hashes order a fragment, fragments the whole
        order = np.lexsort((value, fragment, own))
        own, size, value, repeated, fragment = own[order], size[order], value[order], repeated[order], fragment[order]
        first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (fragment[1:] != fragment[:-1])))) if len(own) else np.zeros(0, int)
        opens = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, int)
        before = first - opens[np.searchsorted(opens, first, "right") - 1] if len(own) else first
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(own)).astype(np.int32)), pa.array(value.view(np.int64)))
        return pa.Table.from_arrays(
            [
                pa.array(own[first].view(np.int64)), pa.array(size[first].astype(np.int64)), pa.array(repeated[first].astype(np.int64)),
                pa.array(before.astype(np.int64)), pa.array(fragment[first]), lists,
            ],
            schema=SEGMENT_SCHEMA,
        )

    return run


def _only(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` whose class may be in ``classes`` (one column).

    A filter of bounded size keeps most others out of the shuffles that follow; those
    that it lets through find no partner in the joins.
    """
    bitmap = hash_filter(classes, classes.count(), times=1, bits_per_row=16)
    return passes(rows, bitmap, "class", "_maybe").where("_maybe").drop("_maybe")


def _overlaps(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Links ``x, y, both`` among candidate ``pairs`` (x, y): overlaps per fragment, summed per pair."""
    segments = _only(segments, pairs.select(F.explode(F.array("x", "y"))))
    left = segments.select(F.col("class").alias("x"), "fragment", F.col("n").alias("nx"), F.col("hashes").alias("hx"))
    right = segments.select(F.col("class").alias("y"), "fragment", F.col("n").alias("ny"), F.col("hashes").alias("hy"))
    common = F.size(F.array_intersect("hx", "hy"))
    return (
        pairs.join(left, "x")
        .join(right, ["y", "fragment"])
        .groupBy("x", "y")
        .agg(F.sum(common).alias("both"), F.max("nx").alias("nx"), F.max("ny").alias("ny"))
        .where(100 * F.col("both") >= percent * (F.col("nx") + F.col("ny") - F.col("both")))
        .select("x", "y", "both")
    )


def _possible(percent: int):
    """Sizes and repeated counts of a pair allow the overlap that a link needs."""
    need = percent * (F.col("nx") + F.col("ny")) / (100 + percent)
    return (F.least("nx", "ny", "rx", "ry") >= need) & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))


def _ordered(
    docs: DataFrame, total: int, width: int, percent: int, buffer: int, times_often: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Segments of the classes that can have a link, their first shingles, and these as rows.

    A shingle that one task spreads is on the highest level of the order everywhere:
    its range learns so from the announcement, and spread occurrences carry it.
    """
    bits = max(0, (max(1, total // RANGE_SHINGLES) - 1).bit_length())
    dealt = docs.select(F.col("text").cast("string")).mapInArrow(_deal(width, bits, buffer, times_often), PACKET)
    repeated = dealt.groupBy("part").applyInArrow(_repeated(bits), REPEATED)
    segments = settle(repeated.groupBy("bucket").applyInArrow(_segments(percent), SEGMENT), "segments")

    # n - ceil(percent n / 100) + 1 shingles come first; the unrepeated ones before all others
    first = F.expr(f"cast(greatest(0, repeated - ceil({percent} * n / 100.0) + 1 - before) as int)")
    firsts = settle(
        segments.withColumn("hashes", F.slice("hashes", F.lit(1), first)).where(F.size("hashes") > 0), "first-shingles"
    )
    prefix = firsts.select(
        F.col("class").alias("y"), F.col("n").alias("ny"), F.col("repeated").alias("ry"), "before",
        F.posexplode("hashes").alias("_i", "shingle"),
    ).withColumn("py", F.col("ny") - F.col("ry") + F.col("before") + F.col("_i") + 1).drop("_i", "before")
    return segments, firsts, prefix


def hopeful(
    narrow: DataFrame, sets: DataFrame, total: int, width: int, percent: int, buffer: int = BUFFER, times_often: int = OFTEN
) -> tuple[DataFrame, int]:
    """One row of ``narrow`` of each class that can have a link, and their sizes summed.

    A filter of bounded size picks the rows, so a few others may be among them.
    """
    bits = max(0, (max(1, total * 2 // 5 // RANGE_SHINGLES) - 1).bit_length())
    dealt = narrow.select("text").mapInArrow(_deal(width, bits, buffer, times_often, percent), PACKET)
    repeats = dealt.groupBy("part").applyInArrow(_repeats(bits), REPEATS)
    some = settle(repeats.groupBy("bucket").applyInArrow(_hopeful_classes(percent), "class long, n long"), "hopeful")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash"))
    found = sets.join(some.select("class"), "class").groupBy("class").agg(first.alias("first"))
    keys = settle(found.select(F.col("first.id").alias("_id"), F.col("first.none").alias("_null"), F.col("first.text_hash").alias("_text")), "hopeful-rows")
    rows = split_by_keys(with_key(narrow), keys)[0].select("doc_id", "text")
    return rows, some.agg(F.sum("n")).first()[0] or 0


def connected_classes(
    docs: DataFrame, total: int, width: int, percent: int, buffer: int = BUFFER, times_often: int = OFTEN, block: int = BLOCK
) -> DataFrame:
    """``class, root`` of the classes with a candidate for a link: links connect those of one root."""
    segments, _, prefix = _ordered(docs, total, width, percent, buffer, times_often)
    ends = prefix.groupBy("shingle").agg(F.min("y").alias("low"), F.max("y").alias("high")).where("low <> high")
    ties = prefix.join(ends.select("shingle", "low"), "shingle").where("y <> low").select("y", "low").distinct()
    known = components(ties).withColumnRenamed("node", "class")
    weight = F.size("hashes") + SEGMENT_WEIGHT
    # of a text and its edited copies the text has the largest share of repeated shingles
    score = F.expr("1000000 * repeated div n")
    own = segments.join(known, "class").select("component", "class", "n", "fragment", "hashes", score.alias("score"), weight.alias("weight"))
    own = settle(own, "tied-segments")
    totals = own.groupBy("component").agg(F.sum("weight").alias("total"))
    return links_within(settle(own.join(totals, "component"), "tied"), percent, block, overlaps_by_fragment)


def all_class_links(
    docs: DataFrame, total: int, width: int, percent: int, buffer: int = BUFFER, times_often: int = OFTEN
) -> DataFrame:
    """All links ``x, y, both`` (``x < y``) between classes, with the shingles shared.

    Only prefix, size and place filters decide which pairs are compared. The pairs of a
    large group of similar texts are its square, as they are what is asked for.
    """
    segments, firsts, prefix = _ordered(docs, total, width, percent, buffer, times_often)
    pairs = _all_partners(prefix, firsts, percent)
    return settle(_overlaps(settle(pairs, "pairs"), segments, percent), "all-links")


def _all_partners(prefix: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """Every pair that shares enough of its first shingles.

    For the overlap that two sizes need, a pair must share a shingle among the first
    ``size - need + 1`` of either. The smaller set's place can be bounded by its own
    size alone, so few of its rows are joined at all. Two sets share at most what they
    share among their first shingles and, beyond these, what the one whose first
    shingles end earlier still has.
    """
    need = F.ceil(percent * (F.col("nx") + F.col("ny")) / (100 + percent))
    smaller = prefix.where(F.col("py") <= F.col("ny") - F.ceil(2 * percent * F.col("ny") / (100 + percent)) + 1)
    larger = prefix.select("shingle", F.col("y").alias("x"), F.col("ny").alias("nx"), F.col("ry").alias("rx"), F.col("py").alias("px"))
    pairs = (
        smaller.join(larger, "shingle")
        .where((F.col("ny") < F.col("nx")) | ((F.col("ny") == F.col("nx")) & (F.col("y") < F.col("x"))))
        .where(_possible(percent))
        .where((F.col("py") <= F.col("ny") - need + 1) & (F.col("px") <= F.col("nx") - need + 1))
        .select("x", "y", "nx", "ny")
        .distinct()
    )
    pairs = settle(pairs, "prefix-pairs")
    whole = _only(firsts, pairs.select(F.explode(F.array("x", "y")))).groupBy("class").agg(F.flatten(F.collect_list("hashes")).alias("hashes"))
    of = lambda name: whole.select(F.col("class").alias(name), F.col("hashes").alias(f"h{name}"))
    later = lambda n: F.ceil(percent * F.col(n) / 100) - 1
    return (
        pairs.join(of("x"), "x").join(of("y"), "y")
        .where(F.size(F.array_intersect("hx", "hy")) + F.greatest(later("nx"), later("ny")) >= need)
        .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    )


def _classed(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame, int]:
    """``docs`` narrowed, a row with size and class of the set per row, and all sizes summed."""
    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text))
    sets = settle(narrow.mapInArrow(_sets(width), "doc_id long, n_shingles long, class long, text_hash long"), "sets")
    return narrow, sets, sets.agg(F.sum("n_shingles")).first()[0] or 0


def similar_documents(
    docs: DataFrame, width: int = 5, percent: int = 75, buffer: int = BUFFER, times_often: int = OFTEN, block: int = BLOCK
) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, group_id, text_hash`` per row of ``docs``.

    Words are runs of non-space characters, A-Z lowered. Two documents link when the
    distinct ``width``-word shingles they share are ``percent`` % or more of those
    that either has. A text of fewer words is one shingle; a null or empty one, or one
    without words, has none and links with nothing, so it is its own component.
    ``component_id`` is the least doc_id reachable by links, itself included (nulls
    only if there is no other). Equal sets have one ``class_id``, linked ones one
    ``group_id`` (both null without words). Repeated rows give a
    row each. An empty table gives an empty result; other columns are ignored. Only links
    that connect components are looked for; ``linked_documents`` has all of them.
    """
    narrow, sets, total = _classed(docs, width)
    some = sets.where("n_shingles > 0")
    few, some_total = hopeful(narrow, some, total, width, percent, buffer, times_often)
    known = connected_classes(few, some_total, width, percent, buffer, times_often, block)
    classes = (
        some.groupBy("class").agg(F.min("doc_id").alias("least"))
        .join(known.withColumnRenamed("root", "component"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    classes = settle(classes, "classes")
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select("class", "component", "component_id")
    none = F.lit(None).cast("long")
    empty = sets.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), none.alias("class_id"), none.alias("group_id"), "text_hash"
    )
    linked = some.join(named, "class").select(
        "doc_id", "n_shingles", "component_id", F.col("class").alias("class_id"), F.col("component").alias("group_id"), "text_hash"
    )
    return linked.unionByName(empty)


def linked_documents(
    docs: DataFrame, width: int = 5, percent: int = 75, buffer: int = BUFFER, times_often: int = OFTEN
) -> tuple[DataFrame, DataFrame]:
    """All links: pairs of classes, and the number of links of every row of ``docs``.

    Links are those of ``similar_documents``. Pairs ``class_x, class_y, n_x, n_y, n_shared``
    (``class_x < class_y``) are of different sets; every row of one class links with every
    row of the other. Counts ``doc_id, n_shingles, class_id, n_links, text_hash`` are summed
    from the sizes of the linked classes and of the row's own, itself left out, so repeated
    rows and equal sets are links too. Rows without words have no class and no links.
    """
    narrow, sets, total = _classed(docs, width)
    some = sets.where("n_shingles > 0")
    few, some_total = hopeful(narrow, some, total, width, percent, buffer, times_often)
    links = all_class_links(few, some_total, width, percent, buffer, times_often)
    sizes = settle(some.groupBy("class").agg(F.count(F.lit(1)).alias("rows"), F.max("n_shingles").alias("n")), "class-sizes")
    of = lambda name: sizes.select(F.col("class").alias(name), F.col("n").alias(f"n_{name}"))
    pairs = links.join(of("x"), "x").join(of("y"), "y").select(
        F.col("x").alias("class_x"), F.col("y").alias("class_y"), "n_x", "n_y", F.col("both").alias("n_shared")
    )
    both = links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    others = both.join(sizes.select(F.col("class").alias("y"), "rows"), "y").groupBy(F.col("x").alias("class"))
    others = others.agg(F.sum("rows").alias("others"))
    linked = sizes.join(others, "class", "left").select(
        "class", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links")
    )
    counts = some.join(linked, "class").select("doc_id", "n_shingles", F.col("class").alias("class_id"), "n_links", "text_hash")
    empty = sets.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "text_hash"
    )
    return pairs, counts.unionByName(empty)


def one_of_each(found: DataFrame) -> DataFrame:
    """Verdicts ``doc_id, text_hash, kept`` from ``similar_documents``: of each component the
    row with the least doc_id (null last, then the least hash of the text) stays. Rows
    without words stay."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "row")
    rows = settle(found.withColumn("row", F.monotonically_increasing_id()), "similar")
    best = rows.where("group_id IS NOT NULL").groupBy("group_id").agg(F.min(order).alias("best"))
    judged = rows.join(best, "group_id", "left")
    stays = F.col("group_id").isNull() | (F.col("row") == F.col("best.row"))
    return judged.select("doc_id", "text_hash", stays.alias("kept"))


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
l AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= 75 * (nx.n + ny.n - o)),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.d)
SELECT r.d AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.d GROUP BY r.d
"""


@query("op1_ngram_jaccard_join", SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


LINKS_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
                               ELSE array_to_string(words[i:i + 4], ' ') END AS sh
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, count(*) AS n FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * o >= 75 * (nx.n + ny.n - o) GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(l.n, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN l ON l.x = d.doc_id
"""


@query("op1_ngram_jaccard_links", LINKS_SQL)
def op1_links(spark: SparkSession, folder: str) -> DataFrame:
    return linked_documents(table(spark, folder, "documents"))[1].select("doc_id", "n_shingles", "n_links")
