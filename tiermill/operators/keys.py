"""Surrogate keys and key-based writes: insert-ignore, upsert, versioned dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.session import freeze, literal_rows

_ROW_BITS = 33


def surrogate_key(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Dense 1..n key in the order of the given columns.

    The columns should be unique together; rows that tie share a partition and are numbered
    in any order. Rows are range-partitioned and sorted once, then frozen with the position that
    ``monotonically_increasing_id`` gives (partition number and row in partition). The
    frozen copy makes the numbering survive lost executors; a count per partition, one
    row each, turns positions into a dense sequence without a global window.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = freeze(placed.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    sizes = fixed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    # One row per partition of the stage, so this window is as small as the task list.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    row = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    keyed = fixed.withColumn("_part", part).join(
        F.broadcast(offsets), F.col("_part") == F.col("part")
    )
    return keyed.select(*df.columns, (F.col("base") + row + start).alias(name))


def insert_ignore(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target plus the batch rows with new keys. Within the batch the row that sorts first
    by all columns is kept for each key."""
    rest = [c for c in batch.columns if c not in key]
    first = batch.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")) if rest else batch.distinct()
    unpacked = first.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])
    fresh = unpacked.join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def seed_dim(target: DataFrame, rows: Sequence[tuple], schema: str, key: str) -> DataFrame:
    """Idempotent seeding of a dimension from literal rows."""
    seeds = literal_rows(target.sparkSession, rows, schema)
    return insert_ignore(target, seeds, [key])


def single_or_raise(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows unchanged, keyed once; a repeated key fails the job when it is run.

    Rows are counted beside their neighbours in a sort by key, which a sort-merge join by that key takes over. Grouping
    them would hold every row in a hash table, twice where they lie by their key already, and sort them again for the join.
    """
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in key])
    counted = df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    checked = F.when(
        F.col("_n") > 1, F.raise_error(F.concat(F.lit("key occurs twice in one batch: "), shown))
    ).otherwise(F.lit(True))
    return counted.filter(checked).select(*df.columns)


def upsert_merge(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    touched: Mapping[str, Column] | None = None,
    checked: bool = False,
) -> DataFrame:
    """Target with batch rows inserted or, on an existing key, replacing its values.

    ``touched`` sets columns (such as a change time) on inserted and replaced rows. Both
    sides have unique keys; a key that occurs twice in the batch fails the job, since
    there is no right row to pick. ``checked`` says that :func:`single_or_raise` has passed the batch.
    """
    rest = [c for c in target.columns if c not in key]
    incoming = batch if checked else single_or_raise(batch, key)
    set_columns = {**{c: F.col(c) for c in incoming.columns if c in rest}, **(touched or {})}
    incoming = incoming.select(
        *key, F.struct(*[v.alias(c) for c, v in set_columns.items()]).alias("_new")
    )
    old = target.select(*key, F.struct(*rest).alias("_old"))
    merged = old.join(incoming, list(key), "full_outer")

    def pick(column: str) -> Column:
        kept = F.col(f"_old.{column}")
        if column not in set_columns:
            return kept
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{column}")).otherwise(kept)

    return merged.select(*key, *[pick(c).alias(c) for c in rest]).select(*target.columns)


def scd2_merge(
    history: DataFrame,
    current: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    as_of: Column,
) -> DataFrame:
    """Versioned dimension: close changed rows and append their new version.

    ``history`` has key and tracked columns plus ``valid_from, valid_to, is_active``.
    Keys missing from ``current`` stay open. Closed versions pass through untouched, and so
    do rows that do not say whether they are active.
    """
    state = ("valid_from", "valid_to", "is_active")
    columns = [*key, *tracked, *state]
    active = F.col("is_active").eqNullSafe(F.lit(True))
    closed = history.filter(~active).select(*columns)
    open_rows = history.filter(active).select(
        *key, F.struct(*tracked, *state).alias("_old")
    )
    incoming = current.select(*key, F.struct(*tracked).alias("_new"))
    both = open_rows.join(incoming, list(key), "full_outer")
    old_values = F.struct(*[F.col(f"_old.{c}") for c in tracked])
    changed = F.col("_old").isNotNull() & F.col("_new").isNotNull() & ~old_values.eqNullSafe(F.col("_new"))
    ended = F.struct(
        *[F.col(f"_old.{c}").alias(c) for c in tracked],
        F.col("_old.valid_from").alias("valid_from"),
        F.when(changed, as_of).otherwise(F.col("_old.valid_to")).alias("valid_to"),
        (~changed).alias("is_active"),
    )
    started = F.struct(
        *[F.col(f"_new.{c}").alias(c) for c in tracked],
        as_of.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_active"),
    )
    versions = F.array_compact(
        F.array(
            F.when(F.col("_old").isNotNull(), ended),
            F.when(F.col("_old").isNull() | changed, started),
        )
    )
    live = both.select(*key, F.inline(versions))
    return closed.unionByName(live.select(*columns))
