from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tiermill.operators import densify, keys, quality, ranking, reconcile
from tiermill.plans import layers, views
from tiermill.profile import HIGHER_EDUCATION as PROFILE

CELLS = [
    ("A", 2022, 100, 8), ("B", 2022, 50, 0), ("A", 2023, 120, 8), ("B", 2023, 60, 10), ("C", 2023, 0, 4),
    ("A", 2024, 120, 8), ("B", 2024, 30, 5), ("C", 2024, 15, 4),
]
MEMBER = {"A": True, "B": False, "C": False}


@pytest.fixture
def star(spark):
    entities = spark.createDataFrame(
        [(i, n, "x", m) for i, (n, m) in enumerate(MEMBER.items(), 1)],
        "entity_id bigint, entity string, category string, is_member boolean",
    )
    cells = spark.createDataFrame(CELLS, "entity string, period int, measure_a bigint, measure_b bigint").join(
        entities.select("entity", "entity_id"), "entity"
    )
    stores = [cells.select("entity_id", "period", m) for m in ("measure_a", "measure_b")]
    fact = layers.gold_fact(entities, stores, densify.period_array(stores))
    return views.star(fact, entities)


def test_gold_fixture(star, rows):
    report = {(r.entity, r.period): r for r in views.ratio_report(star).collect()}
    evolution = {(r.entity, r.period): r for r in views.entity_trend(star, "").collect()}
    change = {(r.entity, r.period): r for r in views.yoy_change(star).collect()}
    expected = [
        ("A", 2022, 100, 8, "12.50", 3, 1, None, "base", None, None),
        ("B", 2022, 50, 0, None, 1, 2, None, "base", None, None),
        ("C", 2022, 0, 0, None, 1, 2, None, "base", None, None),
        ("A", 2023, 120, 8, "15.00", 1, 3, "12.50", "up", 20, 20.00),
        ("B", 2023, 60, 10, "6.00", 2, 2, None, "base", 10, 20.00),
        ("C", 2023, 0, 4, "0.00", 3, 1, None, "base", 0, None),
        ("A", 2024, 120, 8, "15.00", 1, 3, "15.00", "same", 0, 0.00),
        ("B", 2024, 30, 5, "6.00", 2, 2, "6.00", "same", -30, -50.00),
        ("C", 2024, 15, 4, "3.75", 3, 1, "0.00", "up", 15, None),
    ]
    assert len(report) == len(expected)
    for entity, period, a, b, ratio, desc, asc, previous, trend, delta, pct in expected:
        r, e, c = (m[(entity, period)] for m in (report, evolution, change))
        number = None if ratio is None else Decimal(ratio)
        assert (r.measure_a, r.measure_b, r.ratio, r.rank_desc, r.rank_asc) == (a, b, number, desc, asc)
        assert (e.prev_ratio, e.trend) == (None if previous is None else Decimal(previous), trend)
        assert c.delta_a == delta
        assert (None if c.pct_a is None else float(c.pct_a)) == pct


def test_group_results(star):
    got = {(r.period, r.label): r for r in views.member_averages(star).collect()}
    last, other = got[(2024, "member")], got[(2024, "other")]
    assert (last.n_entities, float(last.avg_a), float(last.avg_b), float(last.avg_ratio)) == (1, 120, 8, 15)
    assert (other.n_entities, float(other.avg_a), float(other.avg_b), float(other.avg_ratio)) == (2, 22.5, 4.5, 4.88)
    first = got[(2022, "other")]
    assert (float(first.avg_a), float(first.avg_b), first.avg_ratio) == (25, 0, None)
    sums = {(r.period, r.label): r.ratio_of_sums for r in views.executive_report(star).collect()}
    assert (float(sums[(2024, "member")]), float(sums[(2024, "other")]), sums[(2022, "other")]) == (15, 5, None)


def test_year_on_year_keeps_base_outside_filter(star, rows):
    got = rows(views.yoy_change(star, after=2022), "entity", "period", "delta_a")
    assert ("A", 2023, 20) in got and len(got) == 6


def test_distinct_counts_agree_on_unique_grain(star, rows):
    for view in (views.member_averages, views.period_stats, views.executive_report):
        assert rows(view(star)) == rows(view(star, unique_grain=False))


def test_null_ratio_option(star, rows):
    kept = rows(views.ratio_report(star, exclude_null_ratio=True), "entity", "period", "rank_desc")
    assert ("A", 2022, 1) in kept and len(kept) == 7


def test_row_orders(star):
    order = [(r.period, r.entity) for r in views.ratio_report(star).collect()]
    assert order == sorted(order, key=lambda x: (-x[0], x[1]))
    best = views.best_n_one_year(star, 2024, 2).collect()
    assert [r.entity for r in best] == ["C", "B"]


def test_efficiency(star):
    got = [(r.period, r.entity, r.rank_efficiency) for r in views.efficiency_rank(star, 4).collect()]
    assert got == [(2024, "A", 1), (2024, "B", 2), (2024, "C", 3), (2023, "A", 1)]


@pytest.mark.parametrize("kind", ["decimal(5,2)", "decimal(12,2)", "bigint", "int"])
@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
def test_ranks_match_window(spark, rows, kind, broadcast_rows):
    """Ties, nulls, negatives, far-apart values and one value holding a third of the rows."""
    rng = random.Random(7)
    scale = 900 if kind == "decimal(5,2)" else 2_000_000
    data = []
    for i in range(900):
        value = 3 if i % 3 == 0 else None if i % 7 == 0 else rng.choice([rng.randint(-scale, scale), rng.randint(-5, 5)])
        data.append((i, i % 2 if i % 5 else 9, value))
    df = spark.createDataFrame(data, "i int, period int, v int")
    if kind.startswith("decimal"):
        df = df.withColumn("v", F.col("v") + F.lit(0.25).cast("decimal(3,2)"))
    df = df.withColumn("v", F.col("v").cast(kind))
    by = Window.partitionBy("period")
    want = df.select(
        "i",
        F.rank().over(by.orderBy(F.desc_nulls_first("v"))).alias("d"),
        F.rank().over(by.orderBy(F.asc_nulls_last("v"))).alias("a"),
    )
    got = ranking.with_ranks(df, "v", {"rank_desc": "d", "rank_asc": "a"}, broadcast_rows=broadcast_rows)
    assert rows(got, "i", "d", "a") == rows(want)
    for name, highest in (("a", False), ("d", True)):
        top = ranking.top_k(df, "v", 10, name, highest, broadcast_rows=broadcast_rows)
        assert rows(top, "i", name) == rows(want.filter(f"{name} <= 10"), "i", name)


def test_rank_rejects_doubles(spark):
    with pytest.raises(TypeError):
        ranking.rank_table(spark.createDataFrame([(1, 1.5)], "period int, v double"), "v")


def _landed(spark, data):
    schema = "kind string, period int, file_rank int, raw_name string, row_idx int, amount string, category string"
    return spark.createDataFrame(data, schema)


def test_last_write_wins(spark, rows):
    data = [
        ("a", 2022, 0, "Uni A", 1, "10", "x"),
        ("a", 2022, 0, "Uni A -", 2, "4", "y"),
        ("a", 2022, 0, None, 3, "9", "z"),
        ("a", 2022, 0, "B", 5, "2.5", "later"),
        ("a", 2022, 0, "B", 4, "bad", "first"),
        ("a", 2022, 0, "B", 6, "0.4", "later"),
    ]
    for order in (data, data[::-1]):
        for parts in (1, 3):
            totals = reconcile.entity_sum(_landed(spark, order).repartition(parts))
            assert rows(reconcile.collapse(totals), "entity", "total") == [("B", 2), ("Uni A", 4)]
            assert rows(reconcile.collapse(totals, "sum"), "entity", "total") == [("B", 2), ("Uni A", 14)]
            assert rows(totals, "raw_name", "category") == [("B", "first"), ("Uni A -", "y"), ("Uni A", "x")]
    with pytest.raises(ValueError):
        reconcile.collapse(totals, "first")


def test_whole_and_other_amounts_add_up(spark, rows):
    """Whole amounts are added apart from the others; the sum is cut only once."""
    amounts = {"A": ["0.9999999999", "4"], "B": ["0.5", "3000000000.5", "7"], "C": ["-2", "-0.5"], "D": ["5000000000", "1"], "E": ["bad"]}
    data = [("a", 2022, 0, n, i, x, "c") for n, xs in amounts.items() for i, x in enumerate(xs)]
    totals = reconcile.entity_sum(_landed(spark, data))
    assert rows(totals, "raw_name", "total") == [("A", 4), ("B", 3000000008), ("C", -2), ("D", 5000000001), ("E", 0)]
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "sum(cast" not in plan and totals.columns == ["kind", "period", "file_rank", "raw_name", "total", "category"]


def test_names_with_categories_in_one_aggregation(spark, rows):
    """As the names of the stores joined to the picked categories, but totals of one name are made one before it is cleaned."""
    data = [
        ("a", 2022, 4, "Uni A", "Oficial", True, "x"), ("b", 2022, 5, "Uni A -", "Privado", True, "x"), ("a", 2024, 9, "Uni A", "Mixto", False, "x"),
        ("a", 2022, 4, "Uni A", "Otra", True, "y"), ("c", 2022, 4, "Uni B", "Otra", True, "x"), ("b", 2022, 4, "Uni C", None, True, "x"),
        ("b", 2023, 1, "Uni D", "Otra", False, "x"), ("c", 2023, 7, "Uni D", "Otra", True, "x"),
    ]
    schema = "kind string, period int, file_rank int, raw_name string, category string, has_category boolean, region string"
    totals = spark.createDataFrame(data, schema).withColumn("total", F.lit(1).cast("long"))
    found = reconcile.named_categories(totals, ["a", "b"], F.col("has_category"), ["region"])
    assert rows(found) == [("x", "Uni A", "Privado"), ("x", "Uni C", ""), ("x", "Uni D", "Otra"), ("y", "Uni A", "Otra")]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_category_of_last_file_wins(spark, rows):
    data = [("a", 2022, 4, "Uni A", 1, "1", "Oficial"), ("b", 2022, 5, "Uni A", 1, "1", "Privado"), ("a", 2024, 1, "Uni A", 1, "1", "Mixto")]
    totals = reconcile.entity_sum(_landed(spark, data))
    assert rows(reconcile.category_pick(totals)) == [("Uni A", "Privado")]


def test_dense_grid(spark, rows):
    a = spark.createDataFrame([(1, 2022, 5), (2, 2024, 6), (9, 2022, 7)], "entity_id int, period int, m bigint")
    b = spark.createDataFrame([(1, 2022, 2)], "entity_id int, period int, n bigint")
    entities = spark.createDataFrame([(1,), (2,)], "entity_id int")
    got = densify.dense_grid(entities, [a, b], ["m", "n"], densify.period_array([a, b]))
    assert rows(got) == [(1, 2022, 5, 2), (1, 2024, 0, 0), (2, 2022, 0, 0), (2, 2024, 6, 0)]
    closed = densify.dense_grid(entities, [a, b], ["m", "n"], densify.period_array(fixed=[2023]))
    assert rows(closed) == [(1, 2023, 0, 0), (2, 2023, 0, 0)]
    with pytest.raises(ValueError):
        densify.period_array([])


def test_dense_grid_keeps_entity_partitioning(spark):
    """One shuffle for the grid, none for the lag that follows it."""
    a = spark.range(50).select(F.col("id").alias("entity_id"), F.lit(2022).alias("period"), F.lit(1).alias("m"))
    grid = densify.dense_grid(a.select("entity_id"), [a], ["m"], densify.period_array(fixed=[2022, 2023]))
    lagged = grid.select("entity_id", F.lag("m").over(Window.partitionBy("entity_id").orderBy("period")))
    plan = lagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_surrogate_key_is_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("k"), F.lit("x").alias("x")).repartition(7)
    got = keys.surrogate_key(df, ["k"], "sk").orderBy("k").collect()
    assert [r.sk for r in got] == list(range(1, 5001))
    shared = spark.createDataFrame([(1, "a")] * 40 + [(0, "b")], "k int, x string")
    assert sorted(r.sk for r in keys.surrogate_key(shared, ["k"], "sk", start=0).collect()) == list(range(41))


def test_insert_ignore_and_seed(spark, rows):
    target = spark.createDataFrame([("a", 1)], "code string, v int")
    batch = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "code string, v int")
    assert rows(keys.insert_ignore(target, batch, ["code"])) == [("a", 1), ("b", 2)]
    once = keys.seed_dim(target, [("c", 5)], "code string, v int", "code")
    assert rows(keys.seed_dim(once, [("c", 5)], "code string, v int", "code")) == [("a", 1), ("c", 5)]


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, "old", None), (2, "old", None)], "k int, v string, at string")
    batch = spark.createDataFrame([(2, None), (3, "new")], "k int, v string")
    merged = keys.upsert_merge(target, batch, ["k"], {"at": F.lit("now")})
    assert rows(merged) == [(1, "old", None), (2, None, "now"), (3, "new", "now")]
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(Exception, match="key occurs twice"):
        keys.upsert_merge(target, twice, ["k"]).collect()


def test_batch_is_checked_in_the_sort_of_the_join(spark):
    """Sides that lie by their key are sorted once each; the check holds no hash table of the batch."""
    side = lambda: spark.range(100).selectExpr("id % 50 AS k", "id AS v").groupBy("k").agg(F.sum("v").alias("v"))
    plan = keys.upsert_merge(side(), side(), ["k"])._jdf.queryExecution().executedPlan().toString()
    # What is left are the two aggregations of each side itself.
    assert (plan.count("HashAggregate("), plan.count("Sort ["), plan.count("Exchange hashpartitioning")) == (4, 2, 2)


def test_single_or_raise_keeps_rows_and_finds_every_repeat(spark, rows):
    schema = "k int, l string, v string, m map<string,int>, d double"
    once = [(1, "a", None, {"x": 1}, -0.0), (1, "b", "v", None, None), (None, "a", "v", {}, 1.0), (None, None, "v", {}, 2.0)]
    assert rows(keys.single_or_raise(spark.createDataFrame(once, schema), ["k", "l"])) == sorted(once, key=repr)
    for repeat in once:
        twice = spark.createDataFrame([*once, repeat], schema)
        with pytest.raises(Exception, match="key occurs twice"):
            keys.single_or_raise(twice, ["k", "l"]).collect()
    many = spark.range(20000, numPartitions=5).selectExpr("0 AS k", "'x' AS l", "id AS v")
    with pytest.raises(Exception, match="key occurs twice in one batch: 0, x"):
        keys.single_or_raise(many, ["k", "l"]).count()


def test_scd2(spark, rows):
    schema = "k int, v string, valid_from date, valid_to date, is_active boolean"
    start, then = date(2020, 1, 1), date(2024, 1, 1)
    history = spark.createDataFrame([(1, "a", start, None, True), (2, None, start, None, True), (3, "c", start, None, True)], schema)
    current = spark.createDataFrame([(1, "b"), (2, None), (4, "d")], "k int, v string")
    as_of = F.lit("2024-01-01").cast("date")
    merged = keys.scd2_merge(history, current, ["k"], ["v"], as_of)
    want = [
        (1, "a", start, then, False), (1, "b", then, None, True), (2, None, start, None, True),
        (3, "c", start, None, True), (4, "d", then, None, True),
    ]
    assert rows(merged) == sorted(want, key=repr)
    assert rows(keys.scd2_merge(merged, current, ["k"], ["v"], as_of)) == rows(merged)


def test_quality(spark, rows):
    df = spark.createDataFrame([(1, "abc", 10.0), (1, None, 1000.0), (2, "abcdef", None)], "k int, s string, d double")
    assert rows(quality.unique_violations(df, ["k"])) == [(1, 2)]
    assert rows(quality.null_violations(df, ["k", "s"])) == [("k", 0), ("s", 1)]
    assert rows(quality.domain_violations(df, {"s": 3}, {"d": "decimal(5,2)"})) == [("d", 1), ("s", 1)]
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    orphans = quality.fk_orphans(df, parent, "k", "id")
    assert rows(orphans, "k") == [(2,)]
    report = quality.quality_report({"orphans": orphans, "nulls": quality.null_violations(df, ["s"])})
    assert rows(report) == [("nulls", 1), ("orphans", 1)]


def test_grid_invariant(star):
    entities = star.select("entity_id").distinct()
    periods = star.select("period").distinct()
    assert densify.grid_invariant(star, entities, periods).first().complete
    assert not densify.grid_invariant(star.limit(3), entities, periods).first().complete


def test_totals_do_not_depend_on_partitions(spark):
    from tiermill.operators.reconcile import entity_sum

    data = [("k", 2022, 0, "U", i, "0.1", "c") for i in range(10)]
    schema = "kind string, period int, file_rank int, raw_name string, row_idx int, amount string, category string"
    for n in (1, 2, 3, 4):
        assert entity_sum(spark.createDataFrame(data, schema).repartition(n)).first().total == 1


def test_unknown_activity_passes_through(spark, rows):
    history = spark.createDataFrame([(1, "a", None, None, None)], "k int, v string, valid_from date, valid_to date, is_active boolean")
    current = spark.createDataFrame([], "k int, v string")
    got = keys.scd2_merge(history, current, ["k"], ["v"], F.lit("2024-01-01").cast("date"))
    assert rows(got, "k", "v", "is_active") == [(1, "a", None)]


def test_bitmaps_count_distinct_ids(spark, rows):
    from tiermill.operators import bitmaps

    data = [(i % 3, "x" if i % 2 else None, 1 + (i * 7919) % 70_000) for i in range(5000)] + [(0, "x", None), (1, None, 32768), (1, None, 32769)]
    table = spark.createDataFrame(data, "a int, b string, id long")
    half = table.filter("id % 2 = 0 or id is null"), table.filter("id % 2 = 1")
    stored = bitmaps.add_bitmaps(*[bitmaps.id_bitmaps(h, ["a", "b"], "id") for h in half], ["a", "b"])
    want = []
    for level, key in enumerate([(0, 1), (0,), (1,), ()]):
        found = {}
        for r in data:
            found.setdefault(tuple(r[k] for k in key), set()).add(r[2])
        want += [(k[0] if 0 in key else None, k[key.index(1)] if 1 in key else None, level, len(v - {None})) for k, v in found.items()]
    assert rows(bitmaps.distinct_cube(stored, ["a", "b"])) == sorted(want, key=repr)
    nothing = bitmaps.id_bitmaps(table.limit(0), ["a"], "id")
    assert rows(bitmaps.distinct_count(nothing, [])) == [(0,)]


def test_asof_join_and_interval_problems(spark, rows):
    from tiermill.operators import history

    day = lambda s: F.lit(s).cast("date")
    versions = spark.sql(
        """SELECT id, a, CAST(f AS DATE) AS valid_from, CAST(t AS DATE) AS valid_to FROM VALUES
        (1, 'a1', '2020-01-01', '2021-01-01'), (1, 'a2', '2021-01-01', '2022-01-01'), (1, 'a3', '2023-01-01', null),
        (2, 'b1', '2020-01-01', null), (2, 'b2', '2021-01-01', '2021-06-01'), (3, 'c', '2020-01-01', '2020-02-01') AS v(id, a, f, t)"""
    )
    facts = spark.sql(
        """SELECT id, n, CAST(d AS DATE) AS d FROM VALUES (1, 1, '2019-12-31'), (1, 2, '2020-01-01'), (1, 3, '2020-12-31'), (1, 4, '2021-01-01'),
        (1, 5, '2022-06-01'), (1, 6, '2024-01-01'), (2, 7, '2020-05-05'), (3, 8, '2020-02-01'), (3, 9, '2020-01-31'), (4, 10, '2020-01-01'), (1, 4, '2021-01-01')
        AS f(id, n, d)"""
    )
    got = history.asof_join(facts, versions, ["id"], F.col("d"), ["a"])
    assert rows(got, "n", "a") == sorted(
        [(1, None), (2, "a1"), (3, "a1"), (4, "a2"), (4, "a2"), (5, None), (6, "a3"), (7, "b1"), (8, None), (9, "c"), (10, None)], key=repr
    )
    problems = history.interval_problems(versions, ["id"])
    assert rows(problems, "id", "problem", F.col("first_day").cast("string"), F.col("last_day").cast("string")) == [
        (1, "gap", "2022-01-01", "2023-01-01"), (2, "overlap", "2021-01-01", "2021-06-01"),
    ]
    first = history.keep_history(None, spark.sql("SELECT 1 AS id, 'a' AS a"), ["id"], ["a"], day("2022-01-01"))
    second = history.keep_history(first, spark.sql("SELECT * FROM VALUES (1, 'b'), (2, 'c') AS v(id, a)"), ["id"], ["a"], day("2023-01-01"))
    assert rows(second, "id", "a", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"), "is_active") == [
        (1, "a", "0001-01-01", "2023-01-01", False), (1, "b", "2023-01-01", None, True), (2, "c", "0001-01-01", None, True),
    ]
