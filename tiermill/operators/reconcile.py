"""From landed rows to one value per entity, period and measure.

Landed rows carry ``kind, period, file_rank, raw_name, row_idx, amount, category``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions.numeric import numeric_coerce
from tiermill.functions.text import name_clean, region_key

_FILE = ("kind", "period", "file_rank")

# Whole amounts below this are added as integers: four thousand million of them fit a sum.
_WHOLE = 1 << 31


def _lead(name: str) -> Column:
    """First grouping key of aggregations that sort: a number tells names apart where their first letters are alike."""
    return F.xxhash64(name).alias("_lead")


def region_filter(df: DataFrame, region: str, contains: str) -> DataFrame:
    """Keep rows whose region key contains the text; a null region never does."""
    return df.filter(region_key(F.col(region)).contains(contains))


def entity_sum(rows: DataFrame, per_file: Sequence[str] = ()) -> DataFrame:
    """Total and first category per file and raw name; rows without a name drop out.
    ``per_file`` names further columns that are constant in a file and kept.

    The first aggregation also groups by category, so its buffers are plain numbers and
    a name with very many rows is combined before any shuffle. The second one sees a
    handful of rows per name. Whole amounts are added as integers and others as decimals,
    which cost much more, so the truncated total does not depend on the order of the rows.
    """
    named = rows.filter(F.col("raw_name").isNotNull()).withColumn("_amount", numeric_coerce(F.col("amount")))
    amount = F.col("_amount")
    is_whole = (amount == F.floor(amount)) & (F.abs(amount) < _WHOLE)
    partial = named.groupBy(_lead("raw_name"), *_FILE, *per_file, "raw_name", "category").agg(
        F.sum(F.when(is_whole, amount.cast("bigint"))).alias("whole"),
        F.sum(F.when(~is_whole, amount.cast("decimal(28,10)"))).alias("other"),
        F.min("row_idx").alias("row_idx"),
    )
    whole, other = F.sum("whole"), F.sum("other")
    # Of these two types the sum keeps all ten places.
    both = F.coalesce(whole, F.lit(0)).cast("decimal(20,0)") + other.cast("decimal(30,10)")
    summed = partial.groupBy("_lead", *_FILE, *per_file, "raw_name").agg(
        F.when(other.isNull(), whole).otherwise(both.cast("bigint")).alias("total"),
        F.min_by("category", "row_idx").alias("category"),
    )
    return summed.drop("_lead")


def region_tag(df: DataFrame, region: str, contains: Mapping[str, str]) -> DataFrame:
    """Rows of several regions, under their names: the first whose text the region key contains."""
    key = region_key(F.col(region))
    named = F.coalesce(*[F.when(key.contains(text), F.lit(name)) for name, text in contains.items()])
    return df.withColumn(region, named).filter(F.col(region).isNotNull())


def collapse(totals: DataFrame, how: str = "last", within: Sequence[str] = ()) -> DataFrame:
    """One total per kind, clean name and period, and ``within`` further columns.

    ``last`` keeps the raw name that sorts last in the last file that has the name and
    loses the others, which is the default rule; ``sum`` adds them up.
    """
    clean = totals.withColumn("entity", name_clean(F.col("raw_name")))
    key = ("kind", *within, "entity", "period")
    if how == "sum":
        return clean.groupBy(*key).agg(F.sum("total").alias("total"))
    if how == "last":
        last = F.max_by("total", F.struct("file_rank", "raw_name")).alias("total")
        return clean.groupBy(_lead("entity"), *key).agg(last).drop("_lead")
    raise ValueError(f"unknown collapse rule {how!r}")


def category_pick(totals: DataFrame, has_category: Column | None = None, within: Sequence[str] = ()) -> DataFrame:
    """Category per clean name, and ``within`` further columns: the last file that has a category column wins, and inside
    it the last raw name. ``has_category`` marks rows of files with that column."""
    rows = totals if has_category is None else totals.filter(has_category)
    clean = rows.withColumn("entity", name_clean(F.col("raw_name")))
    return clean.groupBy(*within, "entity").agg(
        F.max_by("category", F.struct("file_rank", "raw_name")).alias("category")
    )


def named_categories(totals: DataFrame, kinds: Sequence[str], has_category: Column, within: Sequence[str] = ()) -> DataFrame:
    """Every clean name that one of the kinds has, and ``within`` further columns, with the category of
    :func:`category_pick`, '' if there is none.

    Totals that differ in kind and period only are made one first, so a name is cleaned once per file name and category.
    """
    wanted = F.coalesce(F.col("kind").isin(*kinds), F.lit(False)).alias("_wanted")
    place = F.when(has_category, F.struct("file_rank", "raw_name")).alias("_place")
    few = totals.select(*within, "raw_name", "category", wanted, place).distinct()
    clean = few.withColumn("entity", name_clean(F.col("raw_name")))
    picked = clean.groupBy(_lead("entity"), *within, "entity").agg(
        F.coalesce(F.max_by("category", "_place"), F.lit("")).alias("category"), F.bool_or("_wanted").alias("_wanted")
    )
    return picked.filter("_wanted").select(*within, "entity", "category")


def store_of(collapsed: DataFrame, kind: str, measure: str) -> DataFrame:
    """One measure as (entity, period, value)."""
    return collapsed.filter(F.col("kind") == kind).select(
        "entity", "period", F.col("total").alias(measure)
    )


def distinct_keys(stores: Sequence[DataFrame], key: str) -> DataFrame:
    """Set union of one key column over several stores."""
    return reduce(DataFrame.union, [s.select(key) for s in stores]).distinct()


def outer_merge(stores: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Cells present in any store, absent measures as 0.

    A union grouped once takes one shuffle where a chain of full joins takes one per store.
    """
    aligned = [
        s.select(*keys, *[F.col(n) if n == m else F.lit(None).cast("bigint").alias(n) for n in measures])
        for s, m in zip(stores, measures)
    ]
    merged = reduce(DataFrame.unionByName, aligned).groupBy(*keys)
    return merged.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])


def run_profile(totals: DataFrame) -> DataFrame:
    """Distinct names, sorted distinct periods and grand total of a run, one row."""
    return totals.agg(
        F.count_distinct("raw_name").alias("n_entities"),
        F.array_join(F.array_sort(F.collect_set("period")), ",").alias("periods"),
        F.sum("total").alias("total"),
    )
