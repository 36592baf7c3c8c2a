"""What changed between two states of a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.functions import text
from opsflow.operators.joins import Lookup, enrich
from opsflow.operators.skew import DEFAULT, FIND, Skew, group_pieces, join_in_place, spread_join
from opsflow.operators.windows import Deal


def full_diff_join(
    old: DataFrame, new: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Full outer join with the two rows as structs ``old`` and ``new``."""
    o = old.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.struct("*").alias("old"))
    n = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.struct("*").alias("new"))
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"_o_{key}") == F.col(f"_n_{key}"))
    return o.join(n, condition, "full_outer").select("old", "new")


def tagged_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``full_diff_join`` as a tagged union and one aggregate per key.

    A full outer join cannot be split on a hot key; an aggregate is combined on the map
    side, and keys that either state has twice, if any, are paired by inner joins,
    which can. Rows with a null in their key match nothing and stay alone.
    """
    keys = list(keys)
    o = old.select(*keys, F.struct("*").alias("old"))
    n = new.select(*keys, F.struct("*").alias("new"))
    none = {"old": F.lit(None).cast(o.schema["old"].dataType), "new": F.lit(None).cast(n.schema["new"].dataType)}
    tagged = o.withColumn("new", none["new"]).unionByName(n.withColumn("old", none["old"]))
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    counted = tagged.where(whole).groupBy(*keys).agg(
        F.count("old").alias("_o"), F.count("new").alias("_n"), F.first("old", True).alias("old"), F.first("new", True).alias("new")
    )
    several = (F.col("_o") > 1) | (F.col("_n") > 1)
    single = counted.where(~several).select("old", "new")
    # narrow counts, as only keys are wanted of these
    one = F.lit(1)
    marks = old.select(*keys, one.alias("_o"), F.lit(0).alias("_n")).unionByName(new.select(*keys, F.lit(0).alias("_o"), one.alias("_n")))
    twice = marks.where(whole).groupBy(*keys).agg(F.sum("_o").alias("_o"), F.sum("_n").alias("_n")).where(several)
    in_both, one_sided = twice.where("_o > 0 AND _n > 0").select(*keys), twice.where("_o = 0 OR _n = 0").select(*keys)
    pairs = o.join(in_both, keys, "left_semi").join(n, keys).select("old", "new")
    lonely = tagged.join(one_sided, keys, "left_semi").select("old", "new")
    return single.unionByName(pairs).unionByName(lonely).unionByName(tagged.where(~whole).select("old", "new"))


def metric_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    stamp: str,
    diff: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = full_diff_join,
) -> tuple[DataFrame, DataFrame]:
    """Log of compared rows, and the new rows to write.

    Rows in both states are logged with old and new metrics and a flag; new rows
    and flagged ones are to be written; rows only in the old state are ignored.
    ``diff``: ``tagged_diff`` where a key may be hot in one of the states.
    """
    joined = diff(old.select(*keys, *metrics, stamp), new, keys)
    in_both = F.col("old").isNotNull() & F.col("new").isNotNull()
    differs = F.lit(False)
    for metric in metrics:
        differs = differs | ~F.col(f"old.{metric}").eqNullSafe(F.col(f"new.{metric}"))
    log = joined.where(in_both).select(
        *[F.col(f"new.{key}").alias(key) for key in keys],
        F.col(f"old.{stamp}").alias("last_ts"),
        F.col(f"new.{stamp}").alias("current_ts"),
        *[
            F.col(f"{side}.{metric}").alias(f"{metric}_{label}")
            for metric in metrics
            for side, label in (("old", "last"), ("new", "current"))
        ],
        differs.alias("diff"),
    )
    writes = joined.where(
        F.col("new").isNotNull() & (F.col("old").isNull() | differs)
    ).select("new.*")
    return log, writes


def changed_blocks(
    old: DataFrame, new: DataFrame, on: Sequence[str], blocks: Sequence[str]
) -> DataFrame:
    """Records whose blocks (nested columns) differ apart from case, with only
    the changed blocks filled. A null new block is not compared."""
    renamed = new.select(*on, *[F.col(b).alias(f"_new_{b}") for b in blocks])
    joined = old.select(*on, *blocks).join(renamed, list(on))
    changed = {
        block: F.col(f"_new_{block}").isNotNull()
        & ~text.comparable(F.struct(F.col(block).alias("v"))).eqNullSafe(
            text.comparable(F.struct(F.col(f"_new_{block}").alias("v")))
        )
        for block in blocks
    }
    some = F.lit(False)
    for condition in changed.values():
        some = some | condition
    return joined.where(some).select(
        *on, *[F.when(c, F.col(f"_new_{block}")).alias(block) for block, c in changed.items()]
    )


def changed_payloads(
    df: DataFrame,
    ledger: DataFrame,
    keys: Sequence[str],
    payload: str,
    skew: Skew = DEFAULT,
    hot: DataFrame | None | object = FIND,
    deal: Deal | None = None,
) -> DataFrame:
    """Rows never sent, or sent with another payload. Digests are compared, so
    the ledger's payload text never crosses the network.

    Without a ledger row everything is sent. With several, one that differs is
    enough to send. Pass ``hot=None`` where ``keys`` are unique in ``df``. Where ``df`` is
    dealt by some of ``keys``, pass that ``deal``: the digests come to it, it is not shuffled.
    """
    digests = (
        ledger.select(*keys, F.sha2(payload, 256).alias("_sent"))
        .groupBy(*keys)
        .agg(F.min("_sent").alias("_low"), F.max("_sent").alias("_high"), F.lit(True).alias("_known"))
    )
    own = df.withColumn("_own", F.sha2(payload, 256))
    joined = spread_join(own, digests, keys, "left", hot, skew=skew) if deal is None else join_in_place(own, deal(digests), keys)
    differs = (F.col("_own") != F.col("_low")) | (F.col("_own") != F.col("_high"))
    return joined.where(F.col("_known").isNull() | differs).drop("_own", "_low", "_high", "_known")


def resolve_status_conflicts(
    copy: DataFrame,
    conflicts: DataFrame,
    truth: DataFrame,
    key: str,
    status: str,
    skew: Skew = DEFAULT,
) -> DataFrame:
    """Rows of conflicting keys whose status is not the true one: to be deleted."""
    actual = conflicts.select(key).distinct().join(
        truth.select(key, F.col(status).alias("_true")), key
    )
    return (
        spread_join(copy, actual, [key], "inner", skew=skew)
        .where(F.col(status) != F.col("_true"))
        .drop("_true")
    )


def capture_deletes(
    previous: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    scope: Column | None = None,
    users: Lookup | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Rows of the previous state that are gone, with deleter and time."""
    scoped = previous if scope is None else previous.where(scope)
    gone = scoped.join(current.select(*keys), list(keys), "left_anti")
    if users is not None:
        gone = enrich(gone, [users])
    return gone if as_of is None else gone.withColumn("deleted_at", as_of)


def delete_by_keys(
    target: DataFrame, tombstones: DataFrame, on: Sequence[str], skew: Skew = DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """Rows that stay and rows that go, by keys of a tombstone table."""
    keys = tombstones.select(*on).distinct()
    hot = group_pieces(target, on, skew)
    return (
        spread_join(target, keys, on, "left_anti", hot),
        spread_join(target, keys, on, "left_semi", hot),
    )


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows that stay: those for which the condition does not hold or is unknown."""
    return target.where(~F.coalesce(condition, F.lit(False)))


def field_changes(df: DataFrame, fields: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One row per changed field: ``field, old, new``. Null equals null."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("field"), old.cast("string").alias("old"), new.cast("string").alias("new"))
        for name, (old, new) in fields.items()
    ])
    changed = F.filter(pairs, lambda p: ~p["old"].eqNullSafe(p["new"]))
    return df.select("*", F.inline(changed))


def attribute_updates(
    wanted: DataFrame, source: DataFrame, on: Mapping[str, str], by_name: Mapping[str, Column], out: str = "value_string"
) -> DataFrame:
    """Values to write back for missing attributes: the source column that the
    attribute's name selects."""
    condition = F.lit(True)
    for left, right in on.items():
        condition = condition & (wanted[left] == source[right])
    joined = wanted.join(source, condition)
    choice = F.when(F.lit(False), None)
    for name, column in by_name.items():
        choice = choice.when(F.col("field_name") == name, column.cast("string"))
    return joined.withColumn(out, choice)
