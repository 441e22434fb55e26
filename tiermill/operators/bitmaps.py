"""Exact distinct counts that can be rolled up: bitmaps over dense ids.

One bitmap of 32768 ids per group and bucket of ids is stored; the counts of any coarser grouping
follow from the bitwise or of its groups' bitmaps, without the rows they came from. The bitmaps of a
bucket are combined in every task before they are shuffled, so a hot group is as small as its ids.
Ids are whole numbers from 1, as surrogate keys are; null ids do not count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(rows: DataFrame, by: Sequence[str], id: str) -> DataFrame:
    """``by, bucket, bitmap``: the ids of every group, to be stored."""
    known = rows.filter(F.col(id).isNotNull())
    placed = known.select(*by, F.bitmap_bucket_number(id).alias("bucket"), F.bitmap_bit_position(id).alias("place"))
    return placed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def add_bitmaps(stored: DataFrame, more: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored bitmaps with those of further rows."""
    return stored.unionByName(more).groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_count(stored: DataFrame, by: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """Exact number of distinct ids by some of the stored grouping columns, or in all."""
    merged = stored.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name))


def distinct_cube(stored: DataFrame, by: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """Counts for every subset of the columns; ``level`` has a bit for each column that is rolled up, the first highest."""
    kinds = {f.name: f.dataType for f in stored.schema}
    parts = []
    for n in range(len(by) + 1):
        for chosen in combinations(by, n):
            level = sum(1 << (len(by) - 1 - i) for i, c in enumerate(by) if c not in chosen)
            columns = [F.col(c) if c in chosen else F.lit(None).cast(kinds[c]).alias(c) for c in by]
            parts.append(distinct_count(stored, chosen, name).select(*columns, F.lit(level).cast("long").alias("level"), name))
    return reduce(DataFrame.unionByName, parts)
