"""Matching of records from different sources on normalised references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.operators.joins import not_in_ledger
from opsflow.operators.skew import DEFAULT, Order, Skew, group_pieces, spread_join
from opsflow.operators.windows import top1


def keyed(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Add the match keys, each computed once per row."""
    return df.withColumns(dict(keys))


def match_all(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every pair with equal keys. Both sides are read as they are, so AQE can
    split a hot key on either of them."""
    return left.join(right, list(on), "inner")


@dataclass(frozen=True)
class Matches:
    """All pairs with equal keys, not written out.

    ``groups`` has a row per key of both sides, with ``n_left``, ``n_right`` and ``n_pairs``;
    ``left`` and ``right`` are the rows that have a partner. A key with many rows on
    both sides takes the sum of its rows, not their product; ``pairs`` expands.
    """

    groups: DataFrame
    left: DataFrame
    right: DataFrame
    on: tuple[str, ...]

    def pairs(self, where: Column | None = None) -> DataFrame:
        """The pairs, of all groups or of those that ``where`` picks (columns of ``groups``)."""
        if where is None:
            return self.left.join(self.right, list(self.on))
        chosen = self.groups.where(where).select(*self.on)
        return self.left.join(chosen, list(self.on), "left_semi").join(self.right, list(self.on))

    def one_to_one(self) -> DataFrame:
        """Pairs of the keys that both sides have once."""
        return self.pairs((F.col("n_left") == 1) & (F.col("n_right") == 1))


def match_groups(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Matches:
    """``match_all`` factorised by key. Null keys match nothing.

    Counts are combined on the map side; rows are only filtered by the keys of the other
    side, so no join makes more rows than it gets.
    """
    keys = list(on)
    count = lambda side, name: side.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    groups = count(left, "n_left").join(count(right, "n_right"), keys)
    groups = groups.withColumn("n_pairs", F.col("n_left").cast("decimal(38,0)") * F.col("n_right"))
    matched = groups.select(*keys)
    return Matches(groups, left.join(matched, keys, "left_semi"), right.join(matched, keys, "left_semi"), tuple(keys))


def precedence_groups(
    base: DataFrame,
    ranked: Sequence[tuple[str, DataFrame, Sequence[str]]],
    extra: Sequence[tuple[str, DataFrame, Sequence[str]]],
    tag: str = "source",
) -> DataFrame:
    """``match_precedence`` without its pairs: per base row and source, the number of matches ``n``."""
    parts, open_rows = [], base
    for number, (name, source, on) in enumerate([*ranked, *extra]):
        counts = source.dropna(subset=list(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
        rows = open_rows if number < len(ranked) else base
        parts.append(rows.join(counts, list(on)).withColumn(tag, F.lit(name)))
        if number + 1 < len(ranked):
            open_rows = open_rows.join(counts, list(on), "left_anti")
    return reduce(DataFrame.unionByName, parts)


def match_first(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    order_by: Sequence[Order],
    skew: Skew = DEFAULT,
    basis: DataFrame | None = None,
) -> DataFrame:
    """Each left row with the first right row of its key; none, no output row."""
    hot = group_pieces(left if basis is None else basis, on, skew)
    return spread_join(left, top1(right, on, order_by), on, "inner", hot)


def match_precedence(
    base: DataFrame,
    ranked: Sequence[tuple[str, DataFrame, Sequence[str]]],
    extra: Sequence[tuple[str, DataFrame, Sequence[str]]],
    tag: str = "source",
    skew: Skew = DEFAULT,
) -> DataFrame:
    """Match ``base`` with several sources, each ``(name, frame, keys)``.

    Of the ``ranked`` sources a base row takes the first that has any match;
    ``extra`` sources are added whether or not an earlier one matched. Sources
    must share their payload columns.
    """
    parts = []
    open_rows = base
    for number, (name, source, on) in enumerate(ranked):
        parts.append(match_all(open_rows, source, on).withColumn(tag, F.lit(name)))
        if number + 1 < len(ranked):
            open_rows = not_in_ledger(open_rows, source, on, skew, basis=base)
    for name, source, on in extra:
        parts.append(match_all(base, source, on).withColumn(tag, F.lit(name)))
    return reduce(DataFrame.unionByName, parts)
