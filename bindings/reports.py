"""Star, ranks, reports and period comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.tables import (
    RATIO, REPORT_YEAR, entities, fact, half_up, mart, periods, plain, star, store_a, store_b, stored_star, table, year,
)
from tiermill.functions import numeric
from tiermill.operators import densify
from tiermill.plans import layers, views
from tiermill.profile import HIGHER_EDUCATION
from tiermill.session import freeze

_CELL = "entity, category, is_member, label, period, measure_a, measure_b, ratio"
_POSITION = "entity, label, category, measure_a, measure_b, ratio"
_DESC = "rank() OVER (PARTITION BY period ORDER BY ratio DESC NULLS FIRST)"
_ASC = "rank() OVER (PARTITION BY period ORDER BY ratio ASC NULLS LAST)"
_LAG = "lag({0}) OVER (PARTITION BY entity_id ORDER BY period)"
_EVOLUTION = f"evo AS (SELECT *, {_LAG.format('ratio')} AS prev_ratio FROM star)"
_PCT = "sign(d) * ((20000 * abs(d) + p) // (2 * nullif(p, 0)))::DOUBLE / 100"
_CHANGES = f"""chg AS (
  SELECT *, measure_a - p AS d, measure_b - pb AS delta_b FROM (
    SELECT *, {_LAG.format('measure_a')} AS p, {_LAG.format('measure_b')} AS pb FROM star))"""
_AVG_RATIO = half_up("sum(CAST(round(ratio * 100) AS BIGINT))", "(100 * count(ratio))")

EXPORT = HIGHER_EDUCATION.export_headers
_FRAGMENT = "omer#00000000"


def _report(view, *args):
    return lambda spark, sf: plain(view(star(spark, sf), *args))


def _ranked(view, *args):
    return lambda spark, sf: plain(view(stored_star(spark, sf), *args))


def _ranked_year(view):
    """Ranks are taken within periods, so only the period that is asked for is stored."""
    return lambda spark, sf: plain(view(freeze(star(spark, sf).filter(F.col("period") == REPORT_YEAR)), REPORT_YEAR))


def _distinct_period_stats(spark, sf):
    """Order rows, many per customer and year, counted by distinct customers."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity_id"), year("o_orderdate").alias("period"))
    rows = orders.join(star(spark, sf), ["entity_id", "period"])
    columns = ("period", "n_entities", "n_members", "n_others")
    return plain(views.period_stats(rows, unique_grain=False).select(*columns))


def _dense_grid(spark, sf):
    stores = [store_a(spark, sf), store_b(spark, sf)]
    return densify.dense_grid(entities(spark, sf), stores, ("measure_a", "measure_b"), periods(spark, sf))


def _star_join(spark, sf):
    years = layers.dim_period(spark, periods(spark, sf))
    joined = layers.star_join(fact(spark, sf), entities(spark, sf), years)
    return plain(joined.select("entity", "category", "is_member", "period_label", "measure_a", "measure_b", "ratio"))


def _line_ratio(spark, sf):
    """Quantity per finished order of each customer over all years, members and not."""
    s = star(spark, sf).groupBy("entity").agg(F.sum("measure_a").alias("a"), F.sum("measure_b").alias("b"))
    return plain(s.select("entity", numeric.safe_ratio(F.col("a"), F.col("b"), RATIO).alias("ratio")))


def _member_label(spark, sf):
    return entities(spark, sf).select(
        "entity", numeric.member_label(F.col("is_member"), ("member", "other")).alias("label")
    )


def _trend_label(spark, sf):
    s = views.lag_ratio(star(spark, sf))
    return s.select("entity", "period", numeric.trend_label(F.col("ratio"), F.col("prev_ratio"), views.TRENDS).alias("trend"))


def _yoy_delta(spark, sf):
    return views.yoy_change(star(spark, sf)).select("entity", "period", "delta_a", "delta_b")


def _yoy_pct(spark, sf):
    return plain(views.yoy_change(star(spark, sf)).select("entity", "period", "pct_a"))


def _round_numeric(spark, sf):
    tenths = star(spark, sf).select(
        "entity", "period", (F.col("measure_a").cast("decimal(18,0)") / F.lit(8).cast("decimal(2,0)")).alias("x")
    )
    return plain(tenths.select("entity", "period", F.round("x", 0).alias("round_0"), F.round("x", 2).alias("round_2")))


def _ratio_of_sums(spark, sf):
    grouped = star(spark, sf).groupBy("category", "period").agg(
        numeric.quotient(F.sum("measure_a"), F.sum("measure_b"), 2).alias("ratio_of_sums"),
        numeric.average_decimal(F.col("ratio")).alias("avg_ratio"),
    )
    return plain(grouped)


def _grid_invariant(spark, sf):
    years = layers.dim_period(spark, periods(spark, sf))
    return densify.grid_invariant(fact(spark, sf), entities(spark, sf), years)


def _gold_fact(spark, sf):
    return plain(fact(spark, sf))


_AVG_A = half_up("sum(measure_a)", "count(*)")
_AVG_B = half_up("sum(measure_b)", "count(*)")
_SUMS = "CAST(sum(measure_a) AS BIGINT) AS sum_a, CAST(sum(measure_b) AS BIGINT) AS sum_b"
_RATIO_OF_SUMS = half_up("sum(measure_a)", "CAST(sum(measure_b) AS BIGINT)")

QUERIES = {
    "dense_grid": (_dense_grid, mart("SELECT entity_id, period, measure_a, measure_b FROM star")),
    "safe_ratio": (
        _line_ratio,
        mart(
            f"SELECT entity, CASE WHEN b > 0 THEN {half_up('a', 'b')} END AS ratio FROM t",
            "t AS (SELECT entity, CAST(sum(measure_a) AS BIGINT) AS a, CAST(sum(measure_b) AS BIGINT) AS b FROM star GROUP BY 1)",
        ),
    ),
    "gold_fact": (_gold_fact, mart("SELECT entity_id, period, measure_a, measure_b, ratio FROM star")),
    "star_join": (
        _star_join,
        mart("SELECT entity, category, is_member, CAST(period AS VARCHAR) AS period_label, measure_a, measure_b, ratio FROM star"),
    ),
    "grid_invariant": (
        _grid_invariant,
        mart(
            """SELECT f AS n_facts, e AS n_entities, y AS n_periods, f = e * y AS complete FROM (
            SELECT (SELECT count(*) FROM star) AS f, (SELECT count(*) FROM customer) AS e, (SELECT count(*) FROM yrs) AS y)"""
        ),
    ),
    "member_label": (_member_label, mart("SELECT entity, CASE WHEN is_member THEN 'member' ELSE 'other' END AS label FROM ent")),
    "ratio_report": (_ranked(views.ratio_report), mart(f"SELECT {_CELL}, {_DESC} AS rank_desc, {_ASC} AS rank_asc FROM star")),
    "year_filter": (
        _ranked_year(views.year_filter),
        mart(f"SELECT * FROM (SELECT {_CELL}, {_DESC} AS rank_desc, {_ASC} AS rank_asc FROM star) WHERE period = {REPORT_YEAR}"),
    ),
    "rank_desc": (_ranked(views.rank_desc), mart(f"SELECT period, {_DESC} AS position, {_POSITION} FROM star")),
    "rank_asc": (_ranked(views.rank_asc), mart(f"SELECT period, {_ASC} AS position, {_POSITION} FROM star")),
    "topk_high": (
        _ranked(views.topk_high),
        mart(f"SELECT * FROM (SELECT period, {_DESC} AS position, {_POSITION} FROM star) WHERE position <= 10"),
    ),
    "topk_low": (
        _ranked(views.topk_low),
        mart(f"SELECT * FROM (SELECT period, {_ASC} AS position_asc, {_POSITION} FROM star) WHERE position_asc <= 10"),
    ),
    "topk_one_year": (
        _ranked_year(views.topk_one_year),
        mart(f"SELECT * FROM (SELECT period, {_DESC} AS position, {_POSITION} FROM star) WHERE position <= 10 AND period = {REPORT_YEAR}"),
    ),
    "best_n_one_year": (
        _report(views.best_n_one_year, REPORT_YEAR),
        mart(
            f"""SELECT entity, period, measure_a, measure_b, ratio FROM star
            WHERE period = {REPORT_YEAR} AND ratio IS NOT NULL ORDER BY ratio, entity LIMIT 10"""
        ),
    ),
    "lag_ratio": (
        _report(views.lag_ratio),
        mart("SELECT entity, category, label, period, measure_a, measure_b, ratio, prev_ratio FROM evo", _EVOLUTION),
    ),
    "ilike_filter": (
        _report(views.ilike_filter, _FRAGMENT),
        mart(
            f"""SELECT entity, category, label, period, measure_a, measure_b, ratio, prev_ratio
            FROM evo WHERE entity ILIKE '%{_FRAGMENT}%'""",
            _EVOLUTION,
        ),
    ),
    "entity_trend": (
        _report(views.entity_trend, _FRAGMENT),
        mart(
            f"""SELECT entity, period, measure_a, measure_b, ratio, prev_ratio,
            CASE WHEN prev_ratio IS NULL THEN 'base' WHEN ratio > prev_ratio THEN 'up'
                 WHEN ratio < prev_ratio THEN 'down' ELSE 'same' END AS trend
            FROM evo WHERE entity ILIKE '%{_FRAGMENT}%'""",
            _EVOLUTION,
        ),
    ),
    "trend_label": (
        _trend_label,
        mart(
            """SELECT entity, period, CASE WHEN prev_ratio IS NULL THEN 'base' WHEN ratio > prev_ratio THEN 'up'
                 WHEN ratio < prev_ratio THEN 'down' ELSE 'same' END AS trend FROM evo""",
            _EVOLUTION,
        ),
    ),
    "yoy_delta": (_yoy_delta, mart("SELECT entity, period, d AS delta_a, delta_b FROM chg", _CHANGES)),
    "yoy_pct": (_yoy_pct, mart(f"SELECT entity, period, {_PCT} AS pct_a FROM chg", _CHANGES)),
    "yoy_change": (
        _report(views.yoy_change, 1995),
        mart(
            f"""SELECT entity, label, period, measure_a, measure_b, ratio, d AS delta_a, {_PCT} AS pct_a, delta_b
            FROM chg WHERE period > 1995""",
            _CHANGES,
        ),
    ),
    "round_numeric": (
        _round_numeric,
        mart(
            f"SELECT entity, period, {half_up('measure_a', '8', 0)} AS round_0, {half_up('measure_a', '8')} AS round_2 FROM star"
        ),
    ),
    "ratio_of_sums": (
        _ratio_of_sums,
        mart(f"SELECT category, period, {_RATIO_OF_SUMS} AS ratio_of_sums, {_AVG_RATIO} AS avg_ratio FROM star GROUP BY 1, 2"),
    ),
    "member_averages": (
        _report(views.member_averages),
        mart(
            f"""SELECT period, label, count(DISTINCT entity_id) AS n_entities, {_AVG_A} AS avg_a, {_AVG_B} AS avg_b,
            {_AVG_RATIO} AS avg_ratio FROM star GROUP BY 1, 2"""
        ),
    ),
    "period_stats": (
        _report(views.period_stats),
        mart(
            f"""SELECT period, count(DISTINCT entity_id) AS n_entities,
            count(DISTINCT CASE WHEN is_member THEN entity_id END) AS n_members,
            count(DISTINCT CASE WHEN NOT is_member THEN entity_id END) AS n_others,
            {_SUMS}, {_AVG_A} AS avg_a, {_AVG_B} AS avg_b, {_AVG_RATIO} AS avg_ratio,
            min(ratio) AS min_ratio, max(ratio) AS max_ratio FROM star GROUP BY 1"""
        ),
    ),
    "short_period_stats": (
        _report(views.short_period_stats),
        mart(f"SELECT period, count(DISTINCT entity_id) AS n_entities, {_SUMS}, {_AVG_RATIO} AS avg_ratio FROM star GROUP BY 1"),
    ),
    "executive_report": (
        _report(views.executive_report),
        mart(
            f"""SELECT label, period, count(DISTINCT entity_id) AS n_entities, {_SUMS},
            {half_up('sum(measure_a)', 'count(*)', 0)} AS avg_a, {half_up('sum(measure_b)', 'count(*)', 0)} AS avg_b,
            {_RATIO_OF_SUMS} AS ratio_of_sums, {_AVG_RATIO} AS avg_ratio FROM star GROUP BY 1, 2"""
        ),
    ),
    "distinct_period_stats": (
        _distinct_period_stats,
        mart(
            """SELECT CAST(year(o_orderdate) AS INTEGER) AS period, count(DISTINCT o_custkey) AS n_entities,
            count(DISTINCT o_custkey) FILTER (is_member) AS n_members, count(DISTINCT o_custkey) FILTER (NOT is_member) AS n_others
            FROM orders JOIN ent ON o_custkey = entity_id GROUP BY 1"""
        ),
    ),
    "efficiency_rank": (
        _ranked(views.efficiency_rank),
        mart(
            f"""SELECT entity, label, period, measure_a, measure_b, ratio, {_DESC} AS rank_efficiency
            FROM star WHERE ratio IS NOT NULL AND measure_a > 0
            ORDER BY period DESC, rank_efficiency, entity LIMIT 20"""
        ),
    ),
    "export_report": (
        _report(views.export_report, EXPORT),
        mart("SELECT " + ", ".join(f'{c} AS "{h}"' for c, h in EXPORT.items()) + " FROM star"),
    ),
}
