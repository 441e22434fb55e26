"""Described for the mart but not part of its current build: region rollups, a partitioned
fact, a calendar dimension and category codes. The versioned dimension is
:func:`tiermill.operators.keys.scd2_merge`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.functions.numeric import average_decimal, quotient, safe_ratio


def region_rollup(s: DataFrame, regions: DataFrame) -> DataFrame:
    """Sums and ratios by region and period. ``regions`` maps entity_id to region."""
    located = s.join(regions, "entity_id")
    return located.groupBy("region", "period").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.sum("measure_a").alias("sum_a"),
        F.sum("measure_b").alias("sum_b"),
        quotient(F.sum("measure_a"), F.sum("measure_b"), 2).alias("ratio_of_sums"),
        average_decimal(F.col("ratio")).alias("avg_ratio"),
    )


def write_partitioned(fact: DataFrame, path: str, by: tuple[str, ...] = ("period",)) -> None:
    """Write by period (and region), replacing only the partitions present in ``fact``.

    The rebalance hint gathers rows of a partition into files of the advisory size and
    splits a large period over many tasks.
    """
    balanced = fact.hint("rebalance", *by)
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def ratio_variation(rows: DataFrame, ratio_kind: str = "decimal(5,2)") -> DataFrame:
    """Sums per entity and period, their ratio and its change against the period before."""
    keys = ("entity", "category", "is_member", "period")
    sums = rows.groupBy(*keys).agg(F.sum("measure_a").alias("measure_a"), F.sum("measure_b").alias("measure_b"))
    ratio = safe_ratio(F.col("measure_a"), F.col("measure_b"), ratio_kind)
    by_entity = Window.partitionBy("entity", "category", "is_member").orderBy("period")
    with_ratio = sums.withColumn("ratio", ratio)
    return with_ratio.withColumn("variation", F.col("ratio") - F.lag("ratio").over(by_entity))


def time_dim(dates: DataFrame, column: str) -> DataFrame:
    """Calendar attributes of the distinct dates of a column."""
    days = dates.select(F.to_date(column).alias("day")).distinct()
    year, quarter = F.year("day"), F.quarter("day")
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return days.select(
        "day",
        year.alias("period"),
        year.cast("string").alias("period_label"),
        quarter.alias("quarter"),
        F.when(quarter <= 2, 1).otherwise(2).alias("semester"),
        leap.alias("is_leap"),
    )


def category_dim_lookup(rows: DataFrame, dim: DataFrame, category: str, default: str) -> DataFrame:
    """Add the dimension code of a category text, ``default`` where there is none."""
    codes = dim.select(F.col("code").alias("category_code"))
    matched = rows.join(codes, F.lower(F.trim(F.col(category))) == F.col("category_code"), "left")
    return matched.withColumn("category_code", F.coalesce("category_code", F.lit(default)))


def day_of(text: str) -> Column:
    return F.lit(text).cast("date")
