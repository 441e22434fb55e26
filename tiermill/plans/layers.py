"""Builders of the silver and gold layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.functions.numeric import STORED_RATIO, safe_ratio
from tiermill.operators.densify import dense_grid
from tiermill.operators.keys import single_or_raise, surrogate_key


def silver_entity(bronze: DataFrame, member_text: str) -> DataFrame:
    """One row per entity name with category and member flag.

    Of several variants the one that sorts first is kept, so reruns agree.
    """
    flag = F.coalesce(F.col("label") == member_text, F.lit(False)).alias("is_member")
    variant = F.struct("category", flag)
    first = bronze.groupBy("entity").agg(F.min(variant).alias("v"))
    return first.select("entity", "v.category", "v.is_member")


def entity_keys(entities: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Surrogate id of every entity name ever seen.

    A known name keeps its id and new names are numbered after the largest one, so what is
    stored under an id stays true whichever layer has been loaded since.
    """
    names = entities.select("entity").distinct()
    if known is None:
        return surrogate_key(names, ["entity"], "entity_id")
    last = known.agg(F.coalesce(F.max("entity_id"), F.lit(0))).first()[0]
    fresh = names.join(known.select("entity"), "entity", "left_anti")
    return known.select("entity", "entity_id").unionByName(surrogate_key(fresh, ["entity"], "entity_id", last + 1))


def silver_measure(bronze: DataFrame, entities: DataFrame, measure: str) -> DataFrame:
    """One measure by (entity_id, period); missing values are left out.

    A key that occurs twice fails the job. Keys are checked by name before the surrogate
    key is looked up, so a hot key is combined before it meets the join.
    """
    filled = bronze.filter(F.col(measure).isNotNull()).select("entity", "period", measure)
    once = single_or_raise(filled, ["entity", "period"])
    ids = entities.select("entity", "entity_id")
    return once.join(ids, "entity").select("entity_id", "period", measure)


def dim_entity(entities: DataFrame) -> DataFrame:
    """Entity dimension with validity columns at their defaults."""
    return entities.select(
        "entity_id",
        "entity",
        "category",
        "is_member",
        F.current_date().alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_active"),
    )


def dim_period(spark: SparkSession, periods: Column) -> DataFrame:
    """Period dimension. The period number is its own key, so facts need no lookup."""
    years = spark.range(0, 1, 1, 1).select(F.explode(periods).alias("period"))
    return years.select("period", F.col("period").cast("string").alias("period_label"))


def gold_fact(
    entities: DataFrame,
    stores: Sequence[DataFrame],
    periods: Column,
    ratio_kind: str = STORED_RATIO,
    on_overflow: str = "raise",
) -> DataFrame:
    """Dense fact of active entities: both measures zero-filled, and their safe ratio."""
    active = entities.filter("is_active") if "is_active" in entities.columns else entities
    grid = dense_grid(active, stores, ("measure_a", "measure_b"), periods)
    ratio = safe_ratio(F.col("measure_a"), F.col("measure_b"), ratio_kind, on_overflow)
    return grid.withColumn("ratio", ratio)


def overflowed(fact: DataFrame) -> DataFrame:
    """Cells of a fact whose ratio did not fit its column, with the full value."""
    value = safe_ratio(F.col("measure_a"), F.col("measure_b"), "decimal(20,2)").alias("value")
    lost = fact.filter(F.col("ratio").isNull() & (F.col("measure_b") > 0))
    return lost.select("entity_id", "period", "measure_a", "measure_b", value)


def star_join(fact: DataFrame, entities: DataFrame, periods: DataFrame) -> DataFrame:
    """Fact with the attributes of both dimensions, active entities only."""
    active = entities.filter("is_active") if "is_active" in entities.columns else entities
    return fact.join(active, "entity_id").join(periods, "period")
