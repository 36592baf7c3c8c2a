"""Links between sets that lie in candidate components, whole components to a task.

Small components share tasks. Members of one linked group are not compared again; others
are pruned by size and by a parity sketch, which bounds the symmetric difference from
below, and then compared set by set. Components above ``block`` are cut into blocks: first
every block meets itself and the component's leader; what is then outside the largest
linked group meets all blocks, piece by piece.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsflow.llm.components import components
from opsflow.llm.textbytes import U, mix64
from opsflow.session import settle

#: Elements, and so many more for each set, that one task compares at once.
BLOCK = 1_500_000
SET_WEIGHT = 250
#: Bit of an element from which its fragment is written, if it has one.
FRAGMENT_AT = 56


def parity_sketches(sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A bit row per set, each hash turning one bit over.

    Two rows differ in no more bits than the sets have hashes of their own. The width
    follows the largest set and is bounded for all sets together.
    """
    largest = 1 << (4 * int(sizes.max(initial=1)) - 1).bit_length()
    room = 1 << max(6, ((1 << 24) // max(1, len(sizes))).bit_length() - 1)
    bits = max(64, min(largest, room, 1 << 14))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    odd = np.bincount(owner * bits + (mix64(hashes) % U(bits)).astype(np.int64), minlength=len(sizes) * bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64).reshape(len(sizes), bits // 64)


def whole_overlaps(one: np.ndarray, values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Elements of ``one`` (ascending) among each run of ``values`` that begins at ``firsts``."""
    at = np.minimum(np.searchsorted(one, values), len(one) - 1)
    return np.add.reduceat((one[at] == values).astype(np.int64), firsts)


def overlaps_by_fragment(one: np.ndarray, values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """``whole_overlaps`` as partial overlaps per pair and fragment, summed per pair."""
    at = np.minimum(np.searchsorted(one, values), len(one) - 1)
    fragment = values >> U(FRAGMENT_AT)
    begins = np.ones(len(values), bool)
    begins[1:] = fragment[1:] != fragment[:-1]
    begins[firsts] = True
    cuts = np.flatnonzero(begins)
    partial = np.add.reduceat((one[at] == values).astype(np.int64), cuts)
    return np.add.reduceat(partial, np.searchsorted(cuts, firsts))


def linked_groups(
    sets: list[np.ndarray],
    sizes: np.ndarray,
    labels: np.ndarray,
    percent: int,
    asking: np.ndarray | None = None,
    overlaps: Callable = whole_overlaps,
) -> np.ndarray:
    """``labels`` after joining the groups of all sets that link.

    ``sets`` hold, ascending, at least all elements that another set has as well; ``sizes``
    are those of the whole sets. ``asking``: places of the sets compared with all others,
    in this order (all of them, if not given). Sets that share a label already are not
    compared; others are pruned by size and by sketch first, which loses no link.
    """
    labels = labels.copy()
    held = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    sketch = parity_sketches(held, flat)
    starts = np.cumsum(held) - held
    for i in range(len(sets)) if asking is None else asking:
        other = np.flatnonzero(labels != labels[i])
        if not len(other):
            continue
        n, both = sizes[i], sizes[other] + sizes[i]
        possible = 100 * np.minimum(sizes[other], n) >= percent * np.maximum(sizes[other], n)
        other, both = other[possible], both[possible]
        apart = np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1, dtype=np.int64)
        other = other[apart * (100 + percent) <= both * (100 - percent)]
        if not len(other):
            continue
        lengths = held[other]
        firsts = np.cumsum(lengths) - lengths
        places = np.arange(int(lengths.sum())) - np.repeat(firsts - starts[other], lengths)
        shared = overlaps(sets[i], flat[places], firsts)
        linked = other[100 * shared >= percent * (sizes[other] + n - shared)]
        if len(linked):
            labels[np.isin(labels, labels[linked])] = labels[i]
    return labels


def _members(group: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, pa.Table]:
    """``component, class, sets, n`` of a task's classes, by component, then score, and a row of each.

    A set may come in segments, one row per ``fragment``, which leads its elements' order.
    """
    cut = "fragment" in group.column_names
    along = [("component", "ascending"), ("score", "descending"), ("class", "ascending")]
    rows = group.sort_by([*along, ("fragment", "ascending")] if cut else along)
    # a class may be there twice, by way of two roles: the first is the one that counts
    names = ["class", "fragment"] if cut else ["class"]
    rows = rows.filter(pa.array(~rows.select(names).to_pandas().duplicated().to_numpy()))
    own = rows.column("class").to_numpy()
    first = np.flatnonzero(np.diff(own, prepend=own[0] - 1)) if len(own) else np.zeros(0, np.int64)
    hashes = rows.column("hashes").combine_chunks()
    if pa.types.is_list(hashes.type):
        sizes = hashes.value_lengths().to_numpy()
        flat = hashes.flatten().to_numpy().view(np.uint64)
    else:
        sizes = np.array([len(h.as_buffer()) // 8 for h in hashes], np.int64)
        flat = np.frombuffer(b"".join(h.as_buffer() for h in hashes), np.uint64)
    if cut:
        flat = flat | (np.repeat(rows.column("fragment").to_numpy(), sizes).astype(np.uint64) << U(FRAGMENT_AT))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    sets = [flat[x:y] for x, y in zip(ends[first], np.append(ends[first[1:]], ends[-1]))]
    rows = rows.take(pa.array(first))
    return rows.column("component").to_numpy(), rows.column("class").to_numpy(), sets, rows.column("n").to_numpy(), rows


def linked_classes(percent: int, overlaps: Callable = whole_overlaps):
    """``class, root`` of all classes of a task's components: the links, as one star per linked group."""

    def run(group: pa.Table) -> pa.Table:
        component, own, sets, n, _ = _members(group)
        root = own.copy()
        edges = np.append(np.flatnonzero(np.diff(component, prepend=component[0] - 1)), len(own))
        for low, high in zip(edges, edges[1:]):
            labels = linked_groups(sets[low:high], n[low:high], np.arange(high - low), percent, None, overlaps)
            root[low:high] = own[low:high][labels]
        return pa.table({"class": pa.array(own), "root": pa.array(root)})

    return run


def _linked_across(percent: int, overlaps: Callable):
    """``class, root`` of one piece of the unsettled (``asks``) against one block."""

    def run(group: pa.Table) -> pa.Table:
        _, _, sets, n, rows = _members(group)
        known, labels = np.unique(rows.column("linked").to_numpy(), return_inverse=True)
        asks = np.flatnonzero(rows.column("asks").to_numpy(zero_copy_only=False))
        after = linked_groups(sets, n, labels, percent, asks, overlaps)
        moved = after != labels
        return pa.table({"class": pa.array(known[labels[moved]]), "root": pa.array(known[after[moved]])})

    return run


def links_within(candidates: DataFrame, percent: int, block: int = BLOCK, overlaps: Callable = whole_overlaps) -> DataFrame:
    """``class, root`` for all ``candidates``: classes that links connect have one root.

    ``candidates`` (a written table, as it is read several times) has ``component, class, n,
    score, hashes, weight, total``: the size of the set, a score that is high for sets
    that many others are like, its elements in ascending order (packed 64-bit numbers, or
    arrays in segments by ``fragment``), its share of a task's work and that of its component. Links across components are not
    looked for.
    """
    small = candidates.where(F.col("total") <= block)
    bundles = max(1, (small.agg(F.sum("weight")).first()[0] or 0) // block)
    dealt = small.withColumn("bundle", F.pmod(F.xxhash64("component"), F.lit(bundles)))
    found = dealt.groupBy("bundle").applyInArrow(linked_classes(percent, overlaps), "class long, root long")
    large = candidates.where(F.col("total") > block)
    if not large.isEmpty():
        found = found.unionByName(_large(large, percent, block, overlaps))
    return settle(found, "linked")


def _large(large: DataFrame, percent: int, block: int, overlaps: Callable) -> DataFrame:
    """``class, root`` of components above ``block``: blocks with the leader, then the rest against all."""
    blocks = F.ceil(F.col("total") / block).cast("int")
    dealt = large.withColumn("block", F.pmod(F.xxhash64("class"), blocks))
    leaders = large.groupBy("component").agg(F.max(F.struct("score", "class")).alias("best")).select("component", "best.class")
    leader = large.join(leaders, ["component", "class"]).withColumn("score", F.lit(1 << 62))
    asked = dealt.unionByName(leader.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))))
    links = settle(asked.groupBy("component", "block").applyInArrow(linked_classes(percent, overlaps), "class long, root long"), "block-links")

    known = components(links).withColumnRenamed("component", "linked")
    now = dealt.join(known.withColumnRenamed("node", "class"), "class", "left").withColumn("linked", F.coalesce("linked", "class"))
    now = settle(now, "blocks")
    sizes = now.groupBy("component", "linked").agg(F.sum("weight").alias("size"))
    main = sizes.groupBy("component").agg(F.max(F.struct("size", "linked")).alias("main"), F.sum("size").alias("all"))
    rest = now.join(main, "component").where(F.col("linked") != F.col("main.linked"))
    pieces = F.ceil((F.col("all") - F.col("main.size")) / block).cast("int")
    rest = rest.withColumn("piece", F.pmod(F.xxhash64("class", F.lit(1)), pieces)).drop("block")
    left = rest.select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(True).alias("asks"))
    parts = rest.groupBy("component").agg((F.max("piece") + 1).alias("pieces"))
    right = now.join(parts, "component").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(False).alias("asks")
    )
    columns = ["component", "class", "n", "score", "hashes", "linked", "asks", "piece", "block"]
    columns += ["fragment"] if "fragment" in large.columns else []
    met = left.select(*columns).unionByName(right.select(*columns))
    # a class that asks comes first of its two rows
    met = met.withColumn("score", F.when(F.col("asks"), F.lit(1 << 62)).otherwise(F.col("score")))
    across = met.groupBy("component", "piece", "block").applyInArrow(_linked_across(percent, overlaps), "class long, root long")
    final = components(settle(links.unionByName(across), "large-links")).withColumnRenamed("component", "root")
    return large.select("class").distinct().join(final.withColumnRenamed("node", "class"), "class", "left").select(
        "class", F.coalesce("root", "class").alias("root")
    )
