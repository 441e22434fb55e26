"""Ranks kept up over loads: the counts of values per period are stored with their ranks, in parts by period.

A load that changes some cells adds their new values to the counts and takes their old ones away; only
the periods of changed cells are ranked and written again, the others stay by reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.operators import ranking
from tiermill.plans.warehouse import Warehouse
from tiermill.session import freeze

TABLE = "value_rank"
_RANKS = {"rank_desc": "rank_desc", "rank_asc": "rank_asc"}


def create(warehouse: Warehouse, fact: DataFrame, value: str = "ratio") -> None:
    """Counts and ranks of all periods."""
    batch = warehouse.batch("gold")
    batch.write_parts(TABLE, ranking.rank_table(fact, value), ["period"], lambda part: True)
    batch.commit()


def refresh(warehouse: Warehouse, before: DataFrame, after: DataFrame, value: str = "ratio") -> list[int]:
    """Ranks after a load. ``before`` and ``after`` have the changed cells with ``period`` and the value as it was
    and is; cells that are new or gone are in one of them only. Gives the periods that were ranked again."""
    before, after = freeze(before.select("period", value)), freeze(after.select("period", value))
    periods = sorted(r.period for r in before.unionByName(after).select("period").distinct().collect())  # a handful
    if not periods:
        return []
    batch = warehouse.batch("gold")
    stored = warehouse.read("gold", TABLE).filter(F.col("period").isin(periods))  # a filter on partitions
    counts = freeze(ranking.changed_counts(stored, before, after, value))
    wrong = counts.filter("n < 0").limit(1).collect()
    if wrong:
        raise ValueError(f"more cells of {wrong[0].asDict()} are gone than there were")
    batch.write_parts(TABLE, ranking.ranked_counts(counts, value), ["period"], lambda part: int(part["period"]) in periods)
    batch.commit()
    return periods


def with_stored_ranks(warehouse: Warehouse, fact: DataFrame, value: str = "ratio") -> DataFrame:
    """``fact`` with ``rank_desc`` and ``rank_asc`` looked up by period and value, without any ranking."""
    stored = warehouse.read("gold", TABLE)
    return ranking.look_up_ranks(fact, stored, stored.count(), value, _RANKS)
