"""Operators on keyed tables: deduplication, upsert, insert-if-absent, missing keys."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; NULL keys are equal to each other.

    All columns end the order, so the choice never depends on partitioning.
    Spark limits each group to its first row before the shuffle
    (``WindowGroupLimit``), which keeps a hot key from reaching one task whole.
    """
    rest = [F.col(name) for name in df.columns if name not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    ranked = df.withColumn("_place", F.row_number().over(window))
    return ranked.where(F.col("_place") == 1).drop("_place")


def missing_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys of ``child`` that ``parent`` lacks."""
    wanted = child.where(F.col(key).isNotNull()).select(key).distinct()
    return wanted.join(parent.select(key), key, "left_anti")


def upsert(current: DataFrame, incoming: DataFrame, key: str, stamp: datetime) -> DataFrame:
    """``current`` with every row of ``incoming`` inserted or written over.

    A row counts as new by presence, so an incoming NULL also overwrites.
    ``created_at`` stays, ``updated_at`` is set on touched rows. ``key`` is
    unique on both sides.
    """
    now = F.lit(stamp).cast("timestamp")
    old, new = current.alias("old"), incoming.withColumn("_incoming", F.lit(True)).alias("new")
    touched = F.col("new._incoming").isNotNull()

    def merged(name: str) -> Column:
        if name == key:
            return F.col(key)
        if name == "created_at":
            return F.coalesce(F.col("old.created_at"), now).alias(name)
        if name == "updated_at":
            return F.when(touched, now).otherwise(F.col("old.updated_at")).alias(name)
        fresh = F.col(f"new.{name}") if name in incoming.columns else F.lit(None)
        return F.when(touched, fresh).otherwise(F.col(f"old.{name}")).alias(name)

    return old.join(new, key, "full_outer").select(*[merged(name) for name in current.columns])


def insert_absent(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = False,
    order: Sequence[Column] = (),
    unique: bool = False,
) -> DataFrame:
    """The rows of ``incoming`` to add to ``current``: those whose key it lacks.

    Of several incoming rows with one key the first in ``order`` is taken. By
    default a key with a NULL part conflicts with nothing, as in a SQL unique
    constraint; with ``null_safe`` NULLs are equal.

    ``unique`` says that no key occurs twice in ``incoming``, NULLs taken as
    equal. It is then read once. Else rows with NULL keys skip deduplication
    and join on a branch of their own, so they cannot pile up in one partition.

    With ``null_safe`` and without ``unique`` one shuffle of ``incoming`` serves both the deduplication and the join.
    """
    held = current.select(*keys)
    if null_safe and unique:
        return _without(incoming, held, keys, null_safe=True)
    if null_safe:
        return _first_without(incoming, held, keys, order)
    keyed = reduce(Column.__and__, [F.col(name).isNotNull() for name in keys])
    held_keys = held.where(keyed)
    if unique:
        return _without(incoming, held_keys, keys, null_safe=False)
    once = first_per_key(incoming.where(keyed), keys, order)
    return _without(once, held_keys, keys, null_safe=False).unionByName(incoming.where(~keyed))


def _without(rows: DataFrame, held: DataFrame, keys: Sequence[str], *, null_safe: bool) -> DataFrame:
    if not null_safe:
        return rows.join(held, list(keys), "left_anti")
    left, right = rows.alias("left"), held.alias("right")
    same = reduce(
        Column.__and__, [F.col(f"left.{name}").eqNullSafe(F.col(f"right.{name}")) for name in keys]
    )
    return left.join(right, same, "left_anti")


def _first_without(rows: DataFrame, held: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key of those whose key ``held`` lacks; NULLs are equal.

    The key is one struct: it is not NULL itself, and structs with NULLs in the same places are equal, in a window as in a
    join. So rows lie where the join wants them once the window has them; comparing the parts null-safely would shuffle them again.
    """
    rest = [name for name in rows.columns if name not in keys]
    window = Window.partitionBy("_key").orderBy(*order, *[F.col(name) for name in rest])
    ranked = rows.select(F.struct(*keys).alias("_key"), *rest).withColumn("_place", F.row_number().over(window))
    once = ranked.where(F.col("_place") == 1).join(held.select(F.struct(*keys).alias("_key")), "_key", "left_anti")
    return once.select(*[F.col(f"_key.{name}").alias(name) if name in keys else F.col(name) for name in rows.columns])
