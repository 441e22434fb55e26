"""Several regions in one run, and layouts by region. A customer's region is that of its nation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from bindings.tables import MART_SQL, RATIO, entities, fact, half_up, mart, order_quantity, plain, table, year
from bindings.warehousing import _PROFILE, _warehouse
from tiermill.functions.numeric import safe_ratio
from tiermill.operators import bitmaps
from tiermill.operators.reconcile import region_tag
from tiermill.plans import extensions, rank_store, regional
from tiermill.session import freeze, run_folder

_FIRST, _SECOND = ("AFRICA", "ASIA", "EUROPE"), ("ASIA", "MIDDLE EAST", "AMERICA")


def customer_regions(spark, sf):
    """``entity_id, region`` of every customer."""
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    located = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, sf, "customer").join(located, F.col("c_nationkey") == F.col("n_nationkey"))
    return customers.select(F.col("c_custkey").alias("entity_id"), F.col("r_name").alias("region"))


def _placed_orders(spark, sf):
    """Orders of all regions with their quantity, as a table that is written once for all runs."""
    orders = table(spark, sf, "orders").join(order_quantity(spark, sf), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    customers = table(spark, sf, "customer").join(customer_regions(spark, sf), F.col("c_custkey") == F.col("entity_id"))
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        year("o_orderdate").alias("period"),
        F.col("c_name").alias("raw_name"),
        F.col("o_orderkey").cast("long").alias("row_idx"),
        F.col("c_mktsegment").alias("category"),
        F.col("region").alias("place"),
        "quantity",
        "o_orderstatus",
    )
    return freeze(placed)


def _landed(placed, tagged, scale: int):
    """Orders in the tagged places as landed rows: a quantity for one measure, a one for the other if the order is finished."""
    amounts = {"a": (F.col("quantity") * scale).cast("decimal(18,2)").cast("string"), "b": F.when(F.col("o_orderstatus") == "F", "1")}
    sides = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("amount")) for k, v in amounts.items()])
    columns = ("period", F.lit(0).alias("file_rank"), "raw_name", "row_idx", "category", "region", F.lit(True).alias("has_category"))
    return placed.join(F.broadcast(tagged), "place").select(*columns, F.inline(sides)).filter("amount is not null")


def _multi_region_load(spark, sf):
    """Two runs over regions that overlap; the first one's amounts are doubled."""
    warehouse, profile, placed = _warehouse(spark, "regions"), replace(_PROFILE, kinds=("a", "b")), _placed_orders(spark, sf)
    places = table(spark, sf, "region").select(F.col("r_name").alias("place"), F.col("r_name").alias("region"))
    for names, scale in ((_FIRST, 2), (_SECOND, 1)):
        # Region keys have no blanks and no upper case.
        wanted = {n: n.lower().replace(" ", "") for n in names}
        # The few names of places are tagged, not every row.
        tagged = region_tag(places, "region", wanted)
        regional.load(warehouse, *regional.reconcile(_landed(placed, tagged, scale), profile), ratio_kind=RATIO, checked=True)
    built = regional.star(warehouse, profile.member_labels)
    return plain(built.select("region", "entity", "category", "period", "measure_a", "measure_b", "ratio"))


def _region_fact(spark, sf):
    return fact(spark, sf).join(customer_regions(spark, sf), "entity_id")


def _period_region_layout(spark, sf):
    """The fact by period and region; afterwards the partition of one year in one region is replaced."""
    path = run_folder(spark, "regions")
    by = ("period", "region")
    extensions.write_partitioned(_region_fact(spark, sf), path, by)
    late = _region_fact(spark, sf).filter("period = 1998 AND region = 'ASIA'")
    extensions.write_partitioned(late.withColumn("measure_a", F.col("measure_a") + 1), path, by)
    schema = f"entity_id bigint, measure_a bigint, measure_b bigint, ratio {RATIO}, period int, region string"
    return plain(spark.read.schema(schema).parquet(path))


def region_buckets(spark, sf):
    """The fact in eight hash partitions by region, as a stored table."""
    warehouse = _warehouse(spark, "buckets")
    warehouse.refresh("gold", "region_fact", _region_fact(spark, sf), bucket_by=(8, ["region"]))
    return warehouse.read("gold", "region_fact")


def _region_bucket_rollup(spark, sf):
    """Sums by region over the buckets, without an exchange."""
    stored = region_buckets(spark, sf)
    return stored.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_facts"), F.sum("measure_a").alias("sum_a"), F.sum("measure_b").alias("sum_b")
    )


def _bitmap_distinct_rollup(spark, sf):
    """Entities with a finished order, for every subset of period, group and region, from stored bitmaps alone."""
    by = ["period", "is_member", "region"]
    members = entities(spark, sf).select("entity_id", "is_member")
    active = _region_fact(spark, sf).filter("measure_b > 0").join(members, "entity_id")
    return bitmaps.distinct_cube(freeze(bitmaps.id_bitmaps(active, by, "entity_id")), by)


def _rank_refresh(spark, sf):
    """Ranks after the machinery customers' quantities of 1998 have doubled: one period is ranked again."""
    warehouse = _warehouse(spark, "ranks")
    cells = freeze(fact(spark, sf).join(entities(spark, sf).select("entity_id", "category"), "entity_id"))
    rank_store.create(warehouse, cells)
    touched = (F.col("period") == 1998) & (F.col("category") == "MACHINERY")
    doubled = safe_ratio(F.col("measure_a") * 2, F.col("measure_b"), RATIO)
    after = cells.withColumn("ratio", F.when(touched, doubled).otherwise(F.col("ratio")))
    rank_store.refresh(warehouse, cells.filter(touched), after.filter(touched))
    ranked = rank_store.with_stored_ranks(warehouse, after)
    return plain(ranked.select("entity_id", "period", "ratio", "rank_desc", "rank_asc"))


_LOCATED = "JOIN customer ON c_custkey = entity_id JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_NAMES = ", ".join(f"'{n}'" for n in set(_FIRST) - set(_SECOND))

QUERIES = {
    "multi_region_load": (
        _multi_region_load,
        f"""WITH {MART_SQL}, cells AS (SELECT entity_id, period FROM qty UNION SELECT entity_id, period FROM fin),
        placed AS (SELECT DISTINCT r_name AS region, entity_id, c_name AS entity, c_mktsegment AS category FROM cells {_LOCATED}),
        seen AS (SELECT DISTINCT r_name AS region, period FROM cells {_LOCATED}),
        grid AS (
          SELECT p.*, seen.period, coalesce(qty.v, 0) * CASE WHEN p.region IN ({_NAMES}) THEN 2 ELSE 1 END AS measure_a,
                 coalesce(fin.v, 0) AS measure_b
          FROM placed p JOIN seen USING (region) LEFT JOIN qty ON qty.entity_id = p.entity_id AND qty.period = seen.period
          LEFT JOIN fin ON fin.entity_id = p.entity_id AND fin.period = seen.period)
        SELECT region, entity, category, period, measure_a, measure_b,
               CASE WHEN measure_b > 0 THEN {half_up('measure_a', 'measure_b')} END AS ratio FROM grid""",
    ),
    "period_region_layout": (
        _period_region_layout,
        mart(
            f"""SELECT entity_id, period, r_name AS region, measure_b, ratio,
            measure_a + CASE WHEN period = 1998 AND r_name = 'ASIA' THEN 1 ELSE 0 END AS measure_a FROM star {_LOCATED}"""
        ),
    ),
    "rank_refresh": (
        _rank_refresh,
        mart(
            """SELECT entity_id, period, ratio, rank() OVER (PARTITION BY period ORDER BY ratio DESC NULLS FIRST) AS rank_desc,
            rank() OVER (PARTITION BY period ORDER BY ratio ASC NULLS LAST) AS rank_asc FROM changed""",
            f"""changed AS (SELECT entity_id, period, CASE WHEN period = 1998 AND category = 'MACHINERY'
              THEN {half_up('2 * measure_a', 'measure_b')} ELSE ratio END AS ratio FROM star)""",
        ),
    ),
    "bitmap_distinct_rollup": (
        _bitmap_distinct_rollup,
        mart(
            f"""SELECT period, is_member, r_name AS region, grouping(period, is_member, r_name) AS level,
            count(DISTINCT entity_id) AS n_distinct FROM star {_LOCATED} WHERE measure_b > 0 GROUP BY CUBE (period, is_member, r_name)"""
        ),
    ),
    "region_bucket_rollup": (
        _region_bucket_rollup,
        mart(
            f"""SELECT r_name AS region, count(*) AS n_facts, CAST(sum(measure_a) AS BIGINT) AS sum_a,
            CAST(sum(measure_b) AS BIGINT) AS sum_b FROM star {_LOCATED} GROUP BY 1"""
        ),
    ),
}
