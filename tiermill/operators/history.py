"""Dimension history: versions kept over loads, and facts joined to the version of their time.

Versions have ``valid_from, valid_to, is_active``; a version holds from its first day up to, not
including, its last. The first version of a key holds from the beginning of time, since nothing is known
that would contradict it; a change holds from the day it was loaded for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.operators.keys import scd2_merge

BEGINNING = "0001-01-01"


def keep_history(history: DataFrame | None, current: DataFrame, key: Sequence[str], tracked: Sequence[str], as_of: Column) -> DataFrame:
    """The versions after a load: changed ones closed and begun at ``as_of``, new keys from the beginning."""
    first = current.select(
        *key, *tracked, F.lit(BEGINNING).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_active")
    )
    if history is None:
        return first
    known = history.select(*key).distinct()
    merged = scd2_merge(history, current.join(known, list(key), "left_semi"), key, tracked, as_of)
    return merged.unionByName(first.join(known, list(key), "left_anti"))


def asof_join(facts: DataFrame, versions: DataFrame, key: Sequence[str], day: Column, attributes: Sequence[str]) -> DataFrame:
    """Facts with the attributes of the version that holds on ``day``; null where none does.

    Facts and versions of a key are put in one order by day, and each fact takes the last version before
    it: one shuffle by key and no comparison of intervals. A version that begins on the day counts; of
    versions that begin on one day the one that ends last is taken.
    """
    version = F.struct("valid_to", *attributes)
    timed = facts.select(*key, day.alias("_day"), F.lit(1).alias("_kind"), F.lit(None).cast("date").alias("_until"), F.struct(*facts.columns).alias("_fact"))
    began = versions.select(*key, F.col("valid_from").alias("_day"), F.lit(0).alias("_kind"), F.col("valid_to").alias("_until"), version.alias("_version"))
    both = timed.unionByName(began, allowMissingColumns=True)
    order = Window.partitionBy(*key).orderBy("_day", "_kind", F.col("_until").asc_nulls_last())
    found = both.withColumn("_found", F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    holds = F.col("_found.valid_to").isNull() | (F.col("_day") < F.col("_found.valid_to"))
    told = found.filter("_kind = 1").select("_fact.*", *[F.when(holds, F.col(f"_found.{a}")).alias(a) for a in attributes])
    return told


def interval_problems(versions: DataFrame, key: Sequence[str]) -> DataFrame:
    """Gaps and overlaps between the versions of a key: ``key, problem, first_day, last_day``."""
    order = Window.partitionBy(*key).orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    # The latest end of all versions before; one without an end never ends.
    far = F.lit("9999-12-31").cast("date")
    until = F.max(F.coalesce("valid_to", far)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    met = versions.select(*key, "valid_from", F.coalesce("valid_to", far).alias("_to"), until.alias("_until")).filter(F.col("_until").isNotNull())
    problem = F.when(F.col("valid_from") > F.col("_until"), "gap").when(F.col("valid_from") < F.col("_until"), "overlap")
    found = met.withColumn("problem", problem).filter(F.col("problem").isNotNull())
    first, last = F.least("valid_from", "_until"), F.when(F.col("problem") == "gap", F.col("valid_from")).otherwise(F.least("_until", "_to"))
    return found.select(*key, "problem", first.alias("first_day"), last.alias("last_day"))


def period_end(period: Column) -> Column:
    """Last day of a year."""
    return F.make_date(period, F.lit(12), F.lit(31))
