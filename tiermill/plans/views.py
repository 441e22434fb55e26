"""Report views over a gold star.

A star has ``entity_id, entity, category, is_member, period, measure_a, measure_b, ratio``
and one row per entity and period. That grain is guaranteed by the fact builder, so
counting rows counts entities; pass ``unique_grain=False`` for frames without it.
Views return rows in the stated order where the report defines one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tiermill.functions import numeric
from tiermill.operators.ranking import top_k, with_ranks

LABELS = ("member", "other")
TRENDS = ("base", "up", "down", "same")
_NAMED = ("entity", "category", "is_member", "label", "period", "measure_a", "measure_b", "ratio")


def star(fact: DataFrame, entities: DataFrame, labels: tuple[str, str] = LABELS) -> DataFrame:
    """Fact joined to its entities, with the label. Every period of a fact is in the period
    dimension, so that join is left out."""
    active = entities.filter("is_active") if "is_active" in entities.columns else entities
    names = active.select("entity_id", "entity", "category", "is_member")
    label = numeric.member_label(F.col("is_member"), labels).alias("label")
    return fact.join(names, "entity_id").select("entity_id", *[label if c == "label" else c for c in _NAMED])


def ratio_report(s: DataFrame, exclude_null_ratio: bool = False) -> DataFrame:
    """All cells with both ranks, latest period first. Null ratios rank first in the
    descending rank and last in the ascending one unless they are excluded."""
    rows = s.filter("ratio is not null") if exclude_null_ratio else s
    ranked = with_ranks(rows, "ratio", {"rank_desc": "rank_desc", "rank_asc": "rank_asc"})
    return ranked.select(*_NAMED, "rank_desc", "rank_asc").orderBy(F.desc("period"), "entity")


def year_filter(s: DataFrame, period: int) -> DataFrame:
    """The ratio report of one period, highest ratio first.

    Ranks are taken within periods, so filtering first gives the same ranks.
    """
    one = s.filter(F.col("period") == period)
    ranked = with_ranks(one, "ratio", {"rank_desc": "rank_desc", "rank_asc": "rank_asc"})
    return ranked.select(*_NAMED, "rank_desc", "rank_asc").orderBy(F.desc_nulls_first("ratio"), "entity")


def rank_desc(s: DataFrame) -> DataFrame:
    """Position of each entity by ratio, highest first, without a limit."""
    ranked = with_ranks(s, "ratio", {"rank_desc": "position"})
    return ranked.select("period", "position", *_position_columns())


def rank_asc(s: DataFrame) -> DataFrame:
    ranked = with_ranks(s, "ratio", {"rank_asc": "position"})
    return ranked.select("period", "position", *_position_columns())


def _position_columns() -> list[str]:
    return ["entity", "label", "category", "measure_a", "measure_b", "ratio"]


def topk_high(s: DataFrame, k: int = 10) -> DataFrame:
    """Highest ratios per period, ties kept."""
    best = top_k(s, "ratio", k, "position")
    return best.select("period", "position", *_position_columns()).orderBy(F.desc("period"), "position", "entity")


def topk_low(s: DataFrame, k: int = 10) -> DataFrame:
    """Lowest ratios per period, ties kept."""
    best = top_k(s, "ratio", k, "position_asc", highest=False)
    chosen = best.select("entity", "label", "category", "period", "measure_a", "measure_b", "ratio", "position_asc")
    return chosen.orderBy(F.desc("period"), "position_asc", "entity")


def topk_one_year(s: DataFrame, period: int, k: int = 10) -> DataFrame:
    return topk_high(s.filter(F.col("period") == period), k)


def best_n_one_year(s: DataFrame, period: int, n: int = 10) -> DataFrame:
    """The n lowest non-null ratios of one period; names break ties."""
    rows = s.filter((F.col("period") == period) & F.col("ratio").isNotNull())
    return rows.select("entity", "period", "measure_a", "measure_b", "ratio").orderBy("ratio", "entity").limit(n)


def _by_entity() -> WindowSpec:
    """An entity has one row per period, so these groups are as long as the period list."""
    return Window.partitionBy("entity_id").orderBy("period")


def lag_ratio(s: DataFrame) -> DataFrame:
    """Evolution of each entity with the ratio of the period before."""
    previous = F.lag("ratio").over(_by_entity()).alias("prev_ratio")
    columns = ("entity", "category", "label", "period", "measure_a", "measure_b", "ratio")
    return s.select(*columns, previous)


def ilike_filter(s: DataFrame, fragment: str) -> DataFrame:
    """Evolution of the entities whose name has the fragment, in any case.

    All rows of an entity share its name, so the filter goes below the window.
    """
    return lag_ratio(s.filter(F.col("entity").ilike(f"%{fragment}%"))).orderBy("period", "entity")


def entity_trend(s: DataFrame, fragment: str, labels: tuple[str, str, str, str] = TRENDS) -> DataFrame:
    """Evolution of the matching entities with a trend label."""
    trend = numeric.trend_label(F.col("ratio"), F.col("prev_ratio"), labels).alias("trend")
    columns = ("entity", "period", "measure_a", "measure_b", "ratio", "prev_ratio")
    return ilike_filter(s, fragment).select(*columns, trend)


def yoy_change(s: DataFrame, after: int | None = None) -> DataFrame:
    """Change of both measures against the period before. ``after`` drops early periods
    from the output only; they still serve as a base."""
    with_previous = s.select(
        "entity", "label", "period", "measure_a", "measure_b", "ratio",
        F.lag("measure_a").over(_by_entity()).alias("_a"),
        F.lag("measure_b").over(_by_entity()).alias("_b"),
    )
    rows = with_previous if after is None else with_previous.filter(F.col("period") > after)
    changed = rows.select(
        "entity", "label", "period", "measure_a", "measure_b", "ratio",
        (F.col("measure_a") - F.col("_a")).alias("delta_a"),
        numeric.pct_change(F.col("measure_a"), F.col("_a")).alias("pct_a"),
        (F.col("measure_b") - F.col("_b")).alias("delta_b"),
    )
    return changed.orderBy(F.desc("period"), "entity")


def _entities(unique_grain: bool, condition: Column | None = None) -> Column:
    if unique_grain:
        return F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return F.count_distinct("entity_id" if condition is None else F.when(condition, F.col("entity_id")))


def member_averages(s: DataFrame, unique_grain: bool = True) -> DataFrame:
    """Averages per period and group. Zero-filled measures count, null ratios do not."""
    grouped = s.groupBy("period", "label").agg(
        _entities(unique_grain).alias("n_entities"),
        numeric.average(F.col("measure_a")).alias("avg_a"),
        numeric.average(F.col("measure_b")).alias("avg_b"),
        numeric.average_decimal(F.col("ratio")).alias("avg_ratio"),
    )
    return grouped.orderBy(F.desc("period"), "label")


def period_stats(s: DataFrame, unique_grain: bool = True) -> DataFrame:
    """Counts, sums, averages and ratio range per period."""
    member = F.col("is_member")
    grouped = s.groupBy("period").agg(
        _entities(unique_grain).alias("n_entities"),
        _entities(unique_grain, member).alias("n_members"),
        _entities(unique_grain, ~member).alias("n_others"),
        F.sum("measure_a").alias("sum_a"),
        F.sum("measure_b").alias("sum_b"),
        numeric.average(F.col("measure_a")).alias("avg_a"),
        numeric.average(F.col("measure_b")).alias("avg_b"),
        numeric.average_decimal(F.col("ratio")).alias("avg_ratio"),
        F.min("ratio").alias("min_ratio"),
        F.max("ratio").alias("max_ratio"),
    )
    return grouped.orderBy(F.desc("period"))


def short_period_stats(s: DataFrame, unique_grain: bool = True) -> DataFrame:
    return period_stats(s, unique_grain).select("period", "n_entities", "sum_a", "sum_b", "avg_ratio")


def executive_report(s: DataFrame, unique_grain: bool = True) -> DataFrame:
    """Group by period summary with the ratio of sums next to the average of ratios."""
    grouped = s.groupBy("is_member", "label", "period").agg(
        _entities(unique_grain).alias("n_entities"),
        F.sum("measure_a").alias("sum_a"),
        numeric.average(F.col("measure_a"), 0).alias("avg_a"),
        F.sum("measure_b").alias("sum_b"),
        numeric.average(F.col("measure_b"), 0).alias("avg_b"),
        numeric.quotient(F.sum("measure_a"), F.sum("measure_b"), 2).alias("ratio_of_sums"),
        numeric.average_decimal(F.col("ratio")).alias("avg_ratio"),
    )
    return grouped.orderBy(F.desc("period"), "is_member").drop("is_member")


def efficiency_rank(s: DataFrame, n: int = 20) -> DataFrame:
    """First n rows by period and rank among cells with a ratio and a positive measure;
    names break ties."""
    rows = s.filter(F.col("ratio").isNotNull() & (F.col("measure_a") > 0))
    # A row among the first n of all has at most n - 1 better ones in its period.
    ranked = top_k(rows, "ratio", n, "rank_efficiency")
    columns = ("entity", "label", "period", "measure_a", "measure_b", "ratio", "rank_efficiency")
    return ranked.select(*columns).orderBy(F.desc("period"), "rank_efficiency", "entity").limit(n)


def export_report(s: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """All cells under display headers, latest period first."""
    ordered = s.orderBy(F.desc("period"), "entity")
    return ordered.select(*[F.col(c).alias(h) for c, h in headers.items()])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """A view under the column names of a data domain."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def cell_ranks(fact: DataFrame) -> DataFrame:
    """Both ranks of every cell, for storing beside the fact."""
    ranked = with_ranks(fact.select("entity_id", "period", "ratio"), "ratio", {"rank_desc": "rank_desc", "rank_asc": "rank_asc"})
    return ranked.select("entity_id", "period", "rank_desc", "rank_asc")


def standing_views(labels: tuple[str, str], names: Mapping[str, str], columns: Mapping[str, str]) -> dict[str, str]:
    """Name to SQL of the four standing views over the gold tables, without any sort.

    ``{{gold}}`` stands for the database. Filters on the period reach the scans of the fact
    and of the stored ranks.
    """

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def named(*chosen: str, **other: str) -> str:
        given = {c: c for c in chosen} | other
        return ", ".join(f"{e} AS `{columns.get(c, c)}`" for c, e in given.items())

    label = f"CASE WHEN e.is_member THEN {quoted(labels[0])} ELSE {quoted(labels[1])} END"
    star_sql = (
        f"SELECT f.entity_id, e.entity, e.category, e.is_member, {label} AS label, f.period, f.measure_a, f.measure_b, f.ratio "
        "FROM `{gold}`.`fact` f JOIN `{gold}`.`dim_entity` e ON f.entity_id = e.entity_id WHERE e.is_active"
    )
    ranked = (
        f"({star_sql}) s JOIN (SELECT entity_id AS r_id, period AS r_period, rank_desc, rank_asc FROM `{{gold}}`.`cell_rank`) r "
        "ON s.entity_id = r.r_id AND s.period = r.r_period"
    )
    rounded = (
        "round(CAST(sum({0}) AS decimal(20,0)) / nullif(CAST(count({0}) AS decimal(18,0)), 0), 2)"
    )
    hundredths = (
        "round(CAST(sum(CAST(ratio * 100 AS bigint)) AS decimal(20,0)) / nullif(CAST(count(ratio) * 100 AS decimal(18,0)), 0), 2)"
    )
    group_label = columns.get("group_label", "label")
    averages = named("period", n_entities="count(*)", avg_a=rounded.format("measure_a"), avg_b=rounded.format("measure_b"), avg_ratio=hundredths)
    lag = "lag(ratio) OVER (PARTITION BY entity_id ORDER BY period)"
    texts = {
        "ratio_report": f"SELECT {named(*_NAMED, 'rank_desc', 'rank_asc')} FROM {ranked}",
        "member_averages": f"SELECT label AS `{group_label}`, {averages} FROM ({star_sql}) s GROUP BY period, label",
        "top_by_ratio": f"SELECT {named('period', *_position_columns(), position='rank_desc')} FROM {ranked}",
        "evolution": f"SELECT {named('entity', 'category', 'label', 'period', 'measure_a', 'measure_b', 'ratio', prev_ratio=lag)} FROM ({star_sql}) s",
    }
    return {names.get(k, k): v for k, v in texts.items()}
