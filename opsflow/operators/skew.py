"""Splitting groups that hold a large share of all rows.

A group (an order, a tracking number, a blank reference ...) may hold a third
of a table. A window, a join or a collect on its key would then put a third of
the data in one task. The helpers here find such groups and cut them into pieces:

* ``group_pieces``  finds the groups to cut and into how many pieces;
* ``spread_join``   joins a fact with a small-per-key side, salting only them;
* ``join_in_place`` joins where there are none and both sides are dealt already;
* ``range_pieces``  cuts them along an order, so sequence numbers stay exact.

A group is cut once it holds more than ``1 / Skew.pieces`` of all rows, so there
are at most ``Skew.pieces`` of them, and at most twice as many pieces in total.
That bound, not a guess, is what lets their list be broadcast.

The search is a job of its own over the key columns: rows per bucket of key hashes,
at most ``_buckets`` small rows a task, so nothing grows with the number of keys. A
group to cut fills its bucket beyond the limit; only where a bucket is that full are
the keys in it counted one by one. Only these tiny results are kept, as written tables.
Where the search finds nothing, the operators use the plain Spark plan (one window, one join).
Where the frame at hand is costly, operators take a ``basis``: a plain scan with
the same keys to search in, or ``hot``, the result of an earlier search.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from opsflow.session import settle

Order = str | tuple[str, str]
SAMPLES_PER_PIECE = 32


@dataclass(frozen=True)
class Skew:
    """When to cut a group: above ``rows / pieces`` rows, never below ``min_rows``."""

    pieces: int = 10_000
    min_rows: int = 1_000_000


DEFAULT = Skew()


def order_terms(order_by: Sequence[Order]) -> list[tuple[str, bool]]:
    """``["a", ("b", "desc")]`` as ``[("a", False), ("b", True)]``."""
    terms = []
    for term in order_by:
        name, direction = (term, "asc") if isinstance(term, str) else term
        if direction not in ("asc", "desc"):
            raise ValueError(f"order direction must be asc or desc, not {direction!r}")
        terms.append((name, direction == "desc"))
    return terms


def sort_columns(order_by: Sequence[Order]) -> list[Column]:
    """Sort expressions; nulls come first ascending and last descending."""
    return [
        F.col(name).desc_nulls_last() if desc else F.col(name).asc_nulls_first()
        for name, desc in order_terms(order_by)
    ]


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on null-safe keys, keeping one copy of them (the left one)."""
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"_r_{key}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in keys])


FIND = object()


def _buckets(skew: Skew) -> int:
    """Buckets of the search: enough that an even spread fills none beyond the limit."""
    return max(1 << 16, 8 * skew.pieces)


def group_pieces(
    df: DataFrame, keys: Sequence[str], skew: Skew = DEFAULT
) -> DataFrame | None:
    """``keys, _rows, _pieces`` of the groups to cut, or None if there are none."""
    narrow = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(_buckets(skew))).alias("_bucket"))
    filled = settle(narrow.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_filled")), "filled")
    total, most = filled.agg(F.coalesce(F.sum("_filled"), F.lit(0)), F.coalesce(F.max("_filled"), F.lit(0))).first()
    limit = max(float(skew.min_rows), total / skew.pieces)
    if most <= limit:
        return None
    # fewer than Skew.pieces buckets hold more than the limit
    full = F.broadcast(filled.where(F.col("_filled") > limit).select("_bucket"))
    hot = (
        narrow.join(full, "_bucket", "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > limit)
        .withColumn("_pieces", F.ceil(F.col("_rows") / F.lit(limit)).cast("int"))
    )
    settled = settle(hot, "hot")
    return None if settled.isEmpty() else settled


def finer(hot: DataFrame | None) -> DataFrame | None | object:
    """What a search result says about keys that refine the searched ones: where
    no coarse group is hot, no finer one is, else they have to be searched."""
    return None if hot is None else FIND


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot: DataFrame | None | object = FIND,
    null_safe: bool = False,
    skew: Skew = DEFAULT,
) -> DataFrame:
    """Join ``left``, whose keys may be hot, with ``right``, few rows per key.

    ``hot`` is the result of ``group_pieces``, searched in ``left`` if not given.
    Rows of hot keys get a salt; the matching right rows are repeated once per
    salt, all others once. The salt depends only on the row and its partition,
    so a rerun task sends every row to the same place again.
    """
    keys = list(keys)
    if hot is FIND:
        hot = group_pieces(left, keys, skew)
    if hot is None:
        return attach(left, right, keys, how) if null_safe else left.join(right, keys, how)
    few = F.broadcast(hot.select(*keys, "_pieces"))
    plain = [f.name for f in left.schema if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
    spread = F.pmod(F.xxhash64(*plain) + F.spark_partition_id(), F.col("_pieces"))
    salted = attach(left, few, keys).withColumn(
        "_salt", F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(spread.cast("int"))
    ).drop("_pieces")
    repeated = attach(right, few, keys).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    ).drop("_pieces")
    if null_safe:
        return attach(salted, repeated, [*keys, "_salt"], how).drop("_salt")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def join_in_place(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of frames that are dealt alike by some of ``keys``, ``right`` few rows per key.

    A join by more keys than rows are dealt by would shuffle both sides again. A union leaves
    them where they are, and a window brings the right rows of a key to its left ones.
    """
    keys = list(keys)
    mine, found = (F.struct(*[c for c in side.columns if c not in keys]) for side in (left, right))
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    l = left.select(*keys, mine.alias("_left"))
    r = right.where(whole).select(*keys, found.alias("_right"))
    both = l.unionByName(r, allowMissingColumns=True)
    return (
        both.withColumn("_found", F.collect_list("_right").over(Window.partitionBy(*keys)))
        .where(F.col("_left").isNotNull())
        .select(*keys, "_left", F.explode_outer("_found").alias("_right"))
        .select(*keys, "_left.*", "_right.*")
    )


def _not_after(bound: Column, order_by: Sequence[Order]) -> Column:
    """True where ``bound`` (a struct of the order columns) is at or before the row."""
    result = F.lit(True)
    for name, desc in reversed(order_terms(order_by)):
        b, r = bound[name], F.col(name)
        if desc:
            before = (b.isNotNull() & r.isNull()) | F.coalesce(b > r, F.lit(False))
        else:
            before = (b.isNull() & r.isNotNull()) | F.coalesce(b < r, F.lit(False))
        result = before | (b.eqNullSafe(r) & result)
    return result


def _fan(skew: Skew) -> int:
    """Bounds per group of bounds: about as many groups as bounds in each."""
    return max(2, math.isqrt(2 * skew.pieces) + 1)


def _count_before(bounds: Column, order_by: Sequence[Order], most: int) -> Column:
    """How many of the sorted ``bounds`` are at or before the row: binary search."""
    steps = [F.lit(1 << i) for i in reversed(range(most.bit_length()))]

    def advance(position: Column, step: Column) -> Column:
        target = position + step
        inside = (target <= F.size(bounds)) & _not_after(F.get(bounds, target - 1), order_by)
        return F.when(F.coalesce(inside, F.lit(False)), target).otherwise(position)

    return F.when(bounds.isNull(), F.lit(0)).otherwise(
        F.aggregate(F.array(*steps), F.lit(0), advance)
    )


def range_pieces(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Order],
    skew: Skew = DEFAULT,
    basis: DataFrame | None = None,
    hot: DataFrame | None | object = FIND,
) -> tuple[DataFrame, DataFrame | None]:
    """Cut hot groups into consecutive ranges of ``order_by``.

    Returns ``df`` with a ``_piece`` number, and the bounds used (``keys, _group,
    _bounds``), or ``df`` as it is and None if no group needs cutting. ``order_by`` must tell
    the rows of one group apart; equal rows stay in one piece.

    Bounds come from a hash-selected sample of the hot rows of ``basis`` (by
    default ``df``). They steer balance only: any bounds give the same result.
    """
    keys = list(keys)
    names = [name for name, _ in order_terms(order_by)]
    narrow = (df if basis is None else basis).select(*dict.fromkeys([*keys, *names]))
    if hot is FIND:
        hot = group_pieces(narrow, keys, skew)
    if hot is None:
        return df, None
    every = F.greatest(
        F.lit(1), F.floor(F.col("_rows") / (F.col("_pieces") * SAMPLES_PER_PIECE))
    )
    sample = (
        attach(narrow, F.broadcast(hot), keys, "inner")
        .where(F.pmod(F.xxhash64(*names), every) == 0)
        .distinct()
    )
    by_key = Window.partitionBy(*keys)
    ranked = (
        sample.withColumn("_rank", F.row_number().over(by_key.orderBy(*sort_columns(order_by))))
        .withColumn("_step", F.ceil(F.count(F.lit(1)).over(by_key) / F.col("_pieces")))
        .where(F.col("_rank") % F.col("_step") == 0)
        .withColumn("_at", (F.col("_rank") / F.col("_step")).cast("int") - 1)
    )
    bounds = (
        ranked.groupBy(*keys, F.floor(F.col("_at") / _fan(skew)).cast("int").alias("_group"))
        .agg(F.array_sort(F.collect_list(F.struct("_at", *names))).alias("_bounds"))
    )
    bounds = settle(bounds, "bounds")
    return with_piece(df, keys, order_by, bounds, skew), bounds


def with_piece(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Order], bounds: DataFrame, skew: Skew
) -> DataFrame:
    """The ``_piece`` of every row, 0 in groups without bounds.

    Looked up in two steps, first the group of bounds, then the bound, so that a
    row meets two short arrays instead of one that grows with its group.
    """
    fan = _fan(skew)
    firsts = bounds.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_group", F.get("_bounds", F.lit(0)).alias("first")))),
            lambda group: group["first"],
        ).alias("_firsts")
    )
    grouped = (
        attach(df, F.broadcast(firsts), keys)
        .withColumn("_group", _count_before(F.col("_firsts"), order_by, 2 * fan) - 1)
        .drop("_firsts")
    )
    found = _count_before(F.col("_bounds"), order_by, fan)
    return (
        attach(grouped, F.broadcast(bounds), [*keys, "_group"])
        .withColumn("_piece", F.when(F.col("_group") < 0, 0).otherwise(F.col("_group") * fan + found))
        .drop("_bounds", "_group")
    )
