"""Lookups, ledger checks and correlated tests, all as equi joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.operators.skew import DEFAULT, FIND, Skew, group_pieces, spread_join
from opsflow.operators.windows import top_n_per_key, with_group_total


@dataclass(frozen=True)
class Lookup:
    """A dimension joined to a fact.

    ``on`` maps fact columns to dimension columns, ``take`` maps output names to
    dimension columns. Only those columns are read. The same dimension may
    appear in several lookups with different roles. Catalyst broadcasts a
    dimension only below its size threshold; a larger one is shuffled, and AQE
    splits the hot keys of such a join.
    """

    dim: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str] = field(default_factory=dict)
    how: str = "left"
    where: Column | None = None


def enrich(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Join a fact with its dimensions, one after the other."""
    for number, lookup in enumerate(lookups):
        dim = lookup.dim if lookup.where is None else lookup.dim.where(lookup.where)
        key_names = {right: f"_k{number}_{i}" for i, right in enumerate(lookup.on.values())}
        side = dim.select(
            *[F.col(right).alias(name) for right, name in key_names.items()],
            *[F.col(source).alias(out) for out, source in lookup.take.items()],
        )
        condition = F.lit(True)
        for left, right in lookup.on.items():
            condition = condition & (fact[left] == side[key_names[right]])
        fact = fact.join(side, condition, lookup.how).drop(*key_names.values())
    return fact


def lookup_code(
    df: DataFrame, codes: DataFrame, domain: str, code: str, out: str, how: str = "left"
) -> DataFrame:
    """Meaning of a status code within one domain of a ``tbl, code, status`` table."""
    return enrich(
        df, [Lookup(codes, {code: "code"}, {out: "status"}, how, F.col("tbl") == domain)]
    )


def attach_attributes(
    df: DataFrame, attributes: DataFrame, on: Mapping[str, str], names: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Attributes of an entity-attribute-value table as columns.

    ``names`` maps output columns to ``(field name, value column)``. All of them
    come from one aggregation and one join, however many there are.
    """
    wanted = sorted({field_name for field_name, _ in names.values()})
    wide = (
        attributes.where(F.col("field_name").isin(*wanted))
        .groupBy(*on.values())
        .agg(
            *[
                F.max(F.when(F.col("field_name") == field_name, F.col(value))).alias(out)
                for out, (field_name, value) in names.items()
            ]
        )
    )
    return enrich(df, [Lookup(wide, on, {out: out for out in names})])


def attach_agg(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    aggregates: Sequence[Column],
    skew: Skew = DEFAULT,
    basis: DataFrame | None = None,
    hot: DataFrame | None | object = FIND,
) -> DataFrame:
    """Correlated scalar aggregates: ``other`` is aggregated per key, then joined.

    Hot keys are looked for in ``basis``, by default ``df`` itself.
    """
    if hot is FIND:
        hot = group_pieces(df if basis is None else basis, on, skew)
    return spread_join(df, other.groupBy(*on).agg(*aggregates), on, "left", hot)


def not_in_ledger(
    df: DataFrame,
    ledger: DataFrame,
    on: Sequence[str],
    skew: Skew = DEFAULT,
    basis: DataFrame | None = None,
    hot: DataFrame | None | object = FIND,
) -> DataFrame:
    """Rows whose key the ledger lacks. Null keys are never in the ledger."""
    if hot is FIND:
        hot = group_pieces(df if basis is None else basis, on, skew)
    return spread_join(df, ledger.select(*on).distinct(), on, "left_anti", hot)


def not_in_ledgers(
    df: DataFrame,
    ledgers: Sequence[tuple[DataFrame, Sequence[str]]],
    skew: Skew = DEFAULT,
) -> DataFrame:
    """Rows that none of several ledgers holds, each with its own key."""
    basis = df
    for ledger, on in ledgers:
        df = not_in_ledger(df, ledger, on, skew, basis)
    return df


def restrict_to(
    df: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    skew: Skew = DEFAULT,
    basis: DataFrame | None = None,
    hot: DataFrame | None | object = FIND,
) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    if hot is FIND:
        hot = group_pieces(df if basis is None else basis, on, skew)
    return spread_join(df, keys.select(*on).distinct(), on, "left_semi", hot)


def keys_having(df: DataFrame, keys: Sequence[str], agg: Column, condition: str) -> DataFrame:
    """Keys whose aggregate, named ``value``, meets the condition."""
    return df.groupBy(*keys).agg(agg.alias("value")).where(condition).select(*keys)


def where_group(
    df: DataFrame, keys: Sequence[str], agg: Column, condition: str, skew: Skew = DEFAULT
) -> DataFrame:
    """Rows of the groups whose aggregate, named ``value``, meets the condition."""
    return restrict_to(df, keys_having(df, keys, agg, condition), keys, skew)


def conflicting_rows(
    df: DataFrame, key: str, col: str, skew: Skew = DEFAULT
) -> DataFrame:
    """Rows whose key also occurs with another value of ``col``.

    A key conflicts when its lowest and highest value differ, so the pairs of a
    self join are never formed.
    """
    bounds = {"_lowest": F.min(col), "_highest": F.max(col)}
    return with_group_total(df, [key], bounds, skew).where(
        F.col(key).isNotNull()
        & F.col(col).isNotNull()
        & (F.col("_lowest") != F.col("_highest"))
    ).drop("_lowest", "_highest")


def ranked_conflicts(df: DataFrame, key: str, col: str, rank: Column) -> DataFrame:
    """Best-ranked value of every key that holds several, with the runner-up.

    Output: ``key, col, alternative, rank``. Values are made distinct first, so
    at most two rows of a key take part in the final step.
    """
    values = (
        df.where(F.col(key).isNotNull() & F.col(col).isNotNull())
        .select(key, col)
        .distinct()
        .withColumn("rank", rank)
    )
    best = top_n_per_key(values, [key], ["rank", col], 2).groupBy(key).agg(
        F.min(F.struct("rank", col)).alias("_best"),
        F.max(F.struct("rank", col)).alias("_other"),
        F.count(F.lit(1)).alias("_values"),
    )
    return best.where(F.col("_values") == 2).select(
        key,
        F.col(f"_best.{col}").alias(col),
        F.col(f"_other.{col}").alias("alternative"),
        F.col("_best.rank").alias("rank"),
    )


def exists_other(
    df: DataFrame, on: Sequence[str], col: str, among: Column, out: str, skew: Skew = DEFAULT
) -> DataFrame:
    """Flag rows for which a row of ``among`` has the same key and an unknown or
    different ``col``. Lowest, highest and null count decide it."""
    value = F.when(among, F.col(col))
    counted = with_group_total(
        df,
        on,
        {
            "_unknown": F.count_if(among & F.col(col).isNull()),
            "_lowest": F.min(value),
            "_highest": F.max(value),
        },
        skew,
    )
    differs = F.coalesce(
        (F.col(col) != F.col("_lowest")) | (F.col(col) != F.col("_highest")), F.lit(False)
    )
    return counted.withColumn(out, (F.col("_unknown") > 0) | differs).drop(
        "_unknown", "_lowest", "_highest"
    )


def differs_from_first(
    df: DataFrame, keys: Sequence[str], seq: str, col: str, skew: Skew = DEFAULT
) -> DataFrame:
    """Row number 1 of each group, and those others whose value differs from it.

    Where row 1 is missing or has no value, the others are dropped.
    """
    first = F.max(F.when(F.col(seq) == 1, F.col(col)))
    return (
        with_group_total(df, keys, {"_first": first}, skew)
        .where((F.col(seq) == 1) | (F.col(col) != F.col("_first")))
        .drop("_first")
    )


def derived_rows(
    df: DataFrame, key: Sequence[str], origin: Sequence[str], take: Mapping[str, str]
) -> DataFrame:
    """Left join of rows to the rows derived from them (``origin`` refers to ``key``)."""
    return enrich(df, [Lookup(df, dict(zip(key, origin)), take)])


def join_expr(
    left: DataFrame, right: DataFrame, left_key: Column, right_key: str, how: str = "left"
) -> DataFrame:
    """Join on a computed key: computed once, then an ordinary equi join."""
    keyed = left.withColumn("_key", left_key)
    return keyed.join(right, keyed["_key"] == right[right_key], how).drop("_key")


def map_lookup(
    df: DataFrame, col: str, mapping: DataFrame, key: str, value: str, out: str, default: str | None = None
) -> DataFrame:
    """Look a code up in a mapping table; ``default`` where it is missing."""
    found = enrich(df, [Lookup(mapping, {col: key}, {out: value})])
    return found if default is None else found.fillna(default, subset=[out])
