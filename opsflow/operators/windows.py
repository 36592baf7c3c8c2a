"""Sequence numbers, totals and picks inside groups."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsflow.operators.skew import (
    DEFAULT,
    FIND,
    Order,
    Skew,
    attach,
    finer,
    group_pieces,
    range_pieces,
    sort_columns,
    spread_join,
    with_piece,
)

Deal = Callable[[DataFrame], DataFrame]


def dealt(df: DataFrame, keys: Sequence[str], basis: DataFrame, hot: DataFrame | None, most: int = 250_000) -> DataFrame:
    """``df`` in so many partitions by ``keys`` that one has about ``most`` rows of ``basis``.

    A task's memory then stays as it is while the input grows. Nothing changes where the
    session's shuffle partitions are enough or groups have to be cut (``hot``).
    """
    if hot is not None:
        return df
    count = math.ceil(basis.count() / most)
    return df.repartition(count, *keys) if count > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def dealer(keys: Sequence[str], basis: DataFrame, most: int = 100_000) -> Deal:
    """Deals every frame by ``keys`` into one number of partitions, at most about ``most`` rows of ``basis`` in each.

    Frames dealt alike join on ``keys`` and any further columns without another shuffle. The
    number is given, as AQE would merge partitions by their shuffled bytes, which say little
    about the documents that a task makes of them; small inputs get as few as suits them.
    """
    rows, usual = basis.count(), int(basis.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = max(2, math.ceil(rows / most), min(usual, math.ceil(8 * rows / most)))
    return lambda df: df.repartition(count, *keys)


def top1(df: DataFrame, keys: Sequence[str], order_by: Sequence[Order]) -> DataFrame:
    """First row of each group. ``order_by`` needs a unique tie-breaker."""
    return top_n_per_key(df, keys, order_by, 1)


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Order], n: int
) -> DataFrame:
    """First ``n`` rows of each group.

    Spark keeps only ``n`` rows per group on the map side (WindowGroupLimit), so
    a hot group shuffles ``n`` rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order_by))
    return (
        df.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= n).drop("_n")
    )


def with_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Order],
    out: str = "seq",
    skew: Skew = DEFAULT,
    basis: DataFrame | None = None,
    hot: DataFrame | None | object = FIND,
) -> DataFrame:
    """Number the rows of each group from 1 along ``order_by``.

    Hot groups are numbered piece by piece, plus the rows of the pieces before.
    """
    keys = list(keys)
    rows, bounds = range_pieces(df, keys, order_by, skew, basis, hot)
    number = F.row_number()
    if bounds is None:
        plain = Window.partitionBy(*keys).orderBy(*sort_columns(order_by))
        return rows.withColumn(out, number.over(plain).cast("bigint"))
    local = Window.partitionBy(*keys, "_piece").orderBy(*sort_columns(order_by))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # rows per piece of the hot groups: at most two pieces per Skew.pieces
    source = attach(df if basis is None else basis, F.broadcast(bounds.select(*keys).distinct()), keys, "inner")
    offsets = (
        with_piece(source, keys, order_by, bounds, skew)
        .groupBy(*keys, "_piece")
        .agg(F.count(F.lit(1)).alias("_count"))
        .select(*keys, "_piece", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"))
    )
    return (
        attach(
            rows.withColumn(out, number.over(local).cast("bigint")),
            F.broadcast(offsets),
            [*keys, "_piece"],
        )
        .withColumn(out, F.col(out) + F.coalesce(F.col("_before"), F.lit(0)))
        .drop("_piece", "_before")
    )


def with_group_total(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    skew: Skew = DEFAULT,
    basis: DataFrame | None = None,
    hot: DataFrame | None | object = FIND,
) -> DataFrame:
    """Add whole-group aggregates ``{name: aggregate}`` to every row.

    Without hot groups a plain window. Else aggregated first (map-side partials)
    and joined back with salted hot keys; ``basis`` then stands for ``df`` in the
    aggregation. ``hot`` is the result of ``group_pieces`` if already known.
    """
    keys = list(keys)
    narrow = df if basis is None else basis
    if hot is FIND:
        hot = group_pieces(narrow, keys, skew)
    if hot is None:
        over = Window.partitionBy(*keys)
        return df.withColumns({name: agg.over(over) for name, agg in aggregates.items()})
    totals = narrow.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    return spread_join(df, totals, keys, "left", hot, null_safe=True)


def last_unless_default(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Order],
    col: str,
    default: str,
    out: str = "chosen",
) -> DataFrame:
    """One value per group: the last one, unless it is ``default`` and the group
    has more rows, then the one before it."""
    flipped = [
        (term, "desc") if isinstance(term, str) else
        (term[0], "asc" if term[1] == "desc" else "desc")
        for term in order_by
    ]
    last_two = Window.partitionBy(*keys).orderBy(*sort_columns(flipped))
    picked = (
        df.withColumn("_n", F.row_number().over(last_two))
        .where(F.col("_n") <= 2)
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col("_n") == 1, F.col(col))).alias("_last"),
            F.max(F.when(F.col("_n") == 2, F.col(col))).alias("_previous"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    falls_back = (F.col("_last") == default) & (F.col("_rows") > 1)
    return picked.select(
        *keys, F.when(falls_back, F.col("_previous")).otherwise(F.col("_last")).alias(out)
    )


def completion_label(
    df: DataFrame,
    group: str,
    item: str,
    own_qty: str,
    qty: str,
    source_status: str,
    pending_status: str,
    out: str = "complete",
    skew: Skew = DEFAULT,
) -> DataFrame:
    """'Complete' where a row's own quantity equals its item's total in the group,
    'Partially Complete' where, besides, the group has a pending row (null
    ``pending_status``) whose ``source_status`` is null or differs, else 'Not'.

    The existence test needs only the count of null statuses and the lowest and
    highest status of pending rows: no pair of rows is ever formed.
    """
    hot = group_pieces(df, [group], skew)
    pending = F.col(pending_status).isNull()
    status = F.when(pending, F.col(source_status))
    # the wider group first: rows dealt by it are dealt for its items as well
    with_pending = with_group_total(
        df,
        [group],
        {
            "_unknown": F.count_if(pending & F.col(source_status).isNull()),
            "_lowest": F.min(status),
            "_highest": F.max(status),
        },
        skew,
        hot=hot,
    )
    with_total = with_group_total(
        with_pending, [group, item], {"_item_total": F.sum(qty)}, skew, basis=df, hot=finer(hot)
    )
    own = F.col(source_status)
    other = (F.col("_unknown") > 0) | F.coalesce(
        (own != F.col("_lowest")) | (own != F.col("_highest")), F.lit(False)
    )
    full = F.col(own_qty) == F.col("_item_total")
    label = (
        F.when(full & other, "Partially Complete").when(full, "Complete").otherwise("Not")
    )
    return with_total.withColumn(out, label).drop(
        "_item_total", "_unknown", "_lowest", "_highest"
    )
