"""Dense entity-by-period grid."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def period_array(frames: Sequence[DataFrame] | None = None, fixed: Sequence[int] | None = None) -> Column:
    """Sorted periods as one array value: a closed list, or all periods that occur.

    Periods are calendar years. The distinct values are found with map-side combine, so
    the scalar subquery moves a few integers whatever the size of the stores.
    """
    if fixed is not None:
        return F.array(*[F.lit(int(p)) for p in sorted(set(fixed))])
    if not frames:
        raise ValueError("periods need a closed list or at least one store")
    seen = reduce(DataFrame.union, [f.select("period") for f in frames]).distinct()
    return seen.filter("period is not null").agg(F.sort_array(F.collect_list("period"))).scalar()


def dense_grid(
    entities: DataFrame,
    stores: Sequence[DataFrame],
    measures: Sequence[str],
    periods: Column,
    key: str = "entity_id",
) -> DataFrame:
    """Every entity in every period, absent measures as 0.

    ``entities`` has unique keys, each store has unique (key, period) and one measure.
    The period array is exploded beside each entity and the stores are unioned in, so the
    grid takes one shuffle by entity in place of a join per store. The result stays
    partitioned by entity, which later joins and lags on the entity reuse. Store cells
    outside the grid are dropped, as a left join from the grid would.
    """
    zero = F.lit(0).cast("bigint")
    grid = entities.select(key, F.explode(periods).alias("period")).select(
        key, "period", *[zero.alias(m) for m in measures], F.lit(True).alias("_wanted")
    )
    cells = [
        s.select(
            key,
            "period",
            *[F.col(n).cast("bigint").alias(n) if n == m else zero.alias(n) for n in measures],
            F.lit(False).alias("_wanted"),
        )
        for s, m in zip(stores, measures)
    ]
    rows = reduce(DataFrame.unionByName, cells, grid).repartition(key)
    summed = rows.groupBy(key, "period").agg(
        *[F.coalesce(F.sum(m), zero).alias(m) for m in measures],
        F.bool_or("_wanted").alias("_wanted"),
    )
    return summed.filter("_wanted").drop("_wanted")


def grid_invariant(fact: DataFrame, entities: DataFrame, periods: DataFrame) -> DataFrame:
    """Row counts that must satisfy fact = entities x periods, one row."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).scalar() for df in (fact, entities, periods)
    ]
    one = fact.sparkSession.range(0, 1, 1, 1).select(
        *[c.alias(n) for c, n in zip(counts, ("n_facts", "n_entities", "n_periods"))]
    )
    return one.withColumn("complete", F.expr("n_facts = n_entities * n_periods"))
