"""RANK and top-k over groups of any size.

A window partitioned by period sorts each period in one task, and a mart has only a few
periods. Here the values are counted first (map-side combined), the rank of each distinct
value follows from counts of better values, and rows look their rank up by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.session import freeze_counted

# Values are taken apart in digits of this many bits, so that no window group holds more
# than 2**21 distinct values however many rows or values a period has.
_DIGIT_BITS = 20

# About 20 MB of rank rows; building a larger hash table costs more than a shuffle saves.
BROADCAST_ROWS = 250_000


def _scaled(column: Column, kind: T.DataType) -> tuple[Column, int]:
    """Order-preserving integer form of the value and the bits it needs beside the sign."""
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        whole = (column * F.lit(10**kind.scale)).cast("bigint")
        return whole, (10**kind.precision).bit_length()
    bits = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}.get(type(kind))
    if bits is None:
        raise TypeError(f"rank needs an integer or decimal(<=18) value, not {kind.simpleString()}")
    return column.cast("bigint"), bits


def rank_table(df: DataFrame, value: str, by: str = "period") -> DataFrame:
    """Per (group, value): its row count and the competition ranks in both directions.

    Columns: ``by``, ``value``, ``n``, ``rank_desc`` (nulls first) and ``rank_asc`` (nulls
    last).
    """
    return ranked_counts(value_counts(df, value, by), value, by)


def value_counts(df: DataFrame, value: str, by: str = "period") -> DataFrame:
    """Rows per (group, value), from which all ranks follow."""
    return df.groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))


def changed_counts(counts: DataFrame, before: DataFrame, after: DataFrame, value: str, by: str = "period") -> DataFrame:
    """Counts after some rows have changed: those as they were are taken away, those as they are added.

    New rows are only in ``after``, removed ones only in ``before``.
    """
    gone = value_counts(before, value, by).withColumn("n", -F.col("n"))
    both = counts.select(by, value, "n").unionByName(gone).unionByName(value_counts(after, value, by))
    return both.groupBy(by, value).agg(F.sum("n").alias("n")).filter("n <> 0")


def ranked_counts(counts: DataFrame, value: str, by: str = "period") -> DataFrame:
    """The rows of :func:`rank_table` from counts."""
    whole, bits = _scaled(F.col(value), counts.schema[value].dataType)
    counts = counts.select(by, value, "n").withColumn("_v", whole)
    levels = max(1, -(-bits // _DIGIT_BITS))
    ranked = _before(counts, "_v", by, levels).withColumn("_null", F.col("_v").isNull())
    after = F.col("_filled") - F.col("_before") - F.col("n")
    return ranked.select(
        by,
        value,
        "n",
        F.when(F.col("_null"), 1).otherwise(F.col("_nulls") + after + 1).alias("rank_desc"),
        (F.col("_before") + 1).alias("rank_asc"),
    )


def _before(counts: DataFrame, value: str, by: str, levels: int) -> DataFrame:
    """Add ``_before``, the rows of the group with a smaller value (all filled ones for a
    null), and the group's ``_nulls`` and ``_filled`` row counts.

    With one level this is a running sum over the distinct values of a group. With more,
    values are split by their leading digits: sums run inside each part, and each part
    starts from the sum of the parts below, found the same way on the part totals.
    """
    part = f"{value}_"
    group = [by] if levels == 1 else [by, part]
    split = counts if levels == 1 else counts.withColumn(part, F.shiftright(value, _DIGIT_BITS))
    smaller = (
        Window.partitionBy(*group).orderBy(F.asc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = split.withColumn("_before", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
    if levels == 1:
        everything = Window.partitionBy(by)
        is_null = F.col(value).isNull()
        return inside.withColumns(
            {
                "_nulls": F.sum(F.when(is_null, F.col("n")).otherwise(0)).over(everything),
                "_filled": F.sum(F.when(is_null, 0).otherwise(F.col("n"))).over(everything),
            }
        )
    parts = _before(split.groupBy(by, part).agg(F.sum("n").alias("n")), part, by, levels - 1)
    base = parts.select(
        F.col(by).alias("_by"), F.col(part).alias("_part"), F.col("_before").alias("_base"), "_nulls", "_filled"
    )
    placed = inside.join(base, (F.col(by) == F.col("_by")) & F.col(part).eqNullSafe(F.col("_part")))
    return placed.withColumn("_before", F.col("_before") + F.col("_base")).drop("_by", "_part", "_base", part)


def _lookup(df: DataFrame, ranks: DataFrame, value: str, by: str, names: dict[str, str]) -> DataFrame:
    found = ranks.select(
        F.col(by).alias("_by"), F.col(value).alias("_value"), *[F.col(s).alias(n) for s, n in names.items()]
    )
    same = (F.col(by) == F.col("_by")) & F.col(value).eqNullSafe(F.col("_value"))
    return df.join(found, same).drop("_by", "_value")


def with_ranks(
    df: DataFrame,
    value: str,
    names: dict[str, str],
    by: str = "period",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add rank columns; ``names`` maps columns of :func:`rank_table` to output names.

    ``df`` is read twice, so it should be a stored table. The rank table, one row per
    distinct value, is written first and its rows counted on the way. Up to
    ``broadcast_rows`` it is broadcast and ``df`` is not shuffled at all; beyond that the
    join shuffles by value, where adaptive execution splits the hot values.
    """
    ranks, size = freeze_counted(rank_table(df, value, by).select(by, value, *names))
    return look_up_ranks(df, ranks, size, value, names, by, broadcast_rows)


def look_up_ranks(
    df: DataFrame, ranks: DataFrame, size: int, value: str, names: dict[str, str], by: str = "period", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rank columns from a stored rank table of ``size`` rows."""
    return _lookup(df, F.broadcast(ranks) if size <= broadcast_rows else ranks, value, by, names)


def top_k(
    df: DataFrame,
    value: str,
    k: int,
    name: str,
    highest: bool = True,
    by: str = "period",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of rank at most ``k`` with ties, under the rank column ``name``.

    Nulls rank first among the highest and last among the lowest. At most ``k`` values per
    group can qualify. They are cut down to that in every task before they are shuffled,
    and the rows of ``df`` are neither shuffled nor sorted to look them up. The lookup
    table is counted all the same, for groups other than periods.
    """
    order = F.desc_nulls_first(value) if highest else F.asc_nulls_last(value)
    ordered = Window.partitionBy(by).orderBy(order)
    counts = df.groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))
    first = counts.withColumn("_i", F.row_number().over(ordered)).filter(F.col("_i") <= k)
    better = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    ranked = first.select(by, value, (F.coalesce(better, F.lit(0)) + 1).alias(name))
    best, size = freeze_counted(ranked.filter(F.col(name) <= k))
    return _lookup(df, F.broadcast(best) if size <= broadcast_rows else best, value, by, {name: name})
