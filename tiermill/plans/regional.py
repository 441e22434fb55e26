"""Several regions in one run: a star whose partitions are period and region.

The workbooks are read once for all regions of a run. A run replaces the partitions of its
regions and keeps those of all others by reference; a region whose rows break a rule keeps
what it had, and the others of the run are committed. An entity that occurs in two regions has
one id and a row in each. Tables of the gold layer:

* ``region_fact``: the dense grid of each region over the periods seen in it, with the safe ratio;
* ``region_entity``: the entities of each region with category and member flag;
* ``dim_region``: one row per region with its counts, made from both.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.functions.membership import member_flag
from tiermill.functions.numeric import STORED_RATIO, member_label, safe_ratio
from tiermill.operators.densify import dense_grid
from tiermill.operators.keys import single_or_raise
from tiermill.operators.reconcile import collapse, entity_sum, named_categories, store_of
from tiermill.plans import layers, medallion
from tiermill.plans.warehouse import Warehouse
from tiermill.profile import Profile
from tiermill.session import freeze
from tiermill.sources import manifest

MEASURES = ("measure_a", "measure_b")


def reconcile(rows: DataFrame, profile: Profile, collapse_rule: str = "last") -> tuple[DataFrame, list[DataFrame]]:
    """Landed rows with a ``region`` to entities (region, entity, category, is_member) and one store per measure.

    The stores are one written table, in which every key is once.
    """
    totals = freeze(entity_sum(rows, ["has_category", "region"]))
    values = freeze(collapse(totals, collapse_rule, ["region"]))
    place = F.struct("region", "entity").alias("entity")
    placed = values.select("kind", "period", "total", place)
    stores = [store_of(placed, k, m).select("entity.*", "period", m) for k, m in zip(profile.kinds, MEASURES)]
    named = named_categories(totals, profile.kinds, F.col("has_category"), ["region"])
    return named.withColumn("is_member", member_flag(F.col("entity"), profile.members)), stores


def region_grid(entities: DataFrame, stores: list[DataFrame], ratio_kind: str = STORED_RATIO) -> DataFrame:
    """Every entity of a region in every period seen in that region.

    A ratio that does not fit is null here; :func:`load` refuses the region of such a row.
    """
    seen = stores[0].select("region", "period")
    for s in stores[1:]:
        seen = seen.unionByName(s.select("region", "period"))
    # A region has a handful of periods; they are made distinct in every task first.
    periods = seen.distinct().groupBy("region").agg(F.sort_array(F.collect_list("period")).alias("_periods"))
    key = F.struct("region", "entity_id").alias("place")
    placed = entities.join(periods, "region").select(key, "_periods")
    grid = dense_grid(placed, [s.select(key, "period", m) for s, m in zip(stores, MEASURES)], MEASURES, F.col("_periods"), key="place")
    ratio = safe_ratio(F.col("measure_a"), F.col("measure_b"), ratio_kind, "quarantine")
    return grid.select("place.entity_id", *MEASURES, ratio.alias("ratio"), "period", "place.region")


def broken_regions(fact: DataFrame, entities: DataFrame) -> dict[str, str]:
    """Regions whose rows break a rule, with what is wrong. One row per region comes to the driver."""
    cells = fact.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_facts"),
        F.count_distinct("period").alias("n_periods"),
        F.count_if(F.col("ratio").isNull() & (F.col("measure_b") > 0)).alias("n_over"),
    )
    most = medallion.TEXT_LIMITS
    names = entities.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.count_if((F.length("entity") > most["entity"]) | (F.length("category") > most["category"])).alias("n_long"),
    )
    found = {}
    for r in cells.join(names, "region", "full_outer").collect():
        if r.n_over:
            found[r.region] = f"{r.n_over} ratios do not fit their column"
        elif r.n_long:
            found[r.region] = f"{r.n_long} names or categories are too long"
        elif r.n_facts != (r.n_entities or 0) * (r.n_periods or 0):
            found[r.region] = f"{r.n_facts} facts of {r.n_entities} entities in {r.n_periods} periods"
    return found


def load(
    warehouse: Warehouse, entities: DataFrame, stores: list[DataFrame], ratio_kind: str = STORED_RATIO, checked: bool = False
) -> dict[str, dict]:
    """Commit the regions that occur in ``entities``; status, rows and problem of each.

    ``checked`` says that the stores are written and have every key once, as those of :func:`reconcile`.
    """
    started = datetime.now(timezone.utc)
    entities = freeze(entities)
    if not checked:
        stores = [freeze(single_or_raise(s, ["region", "entity", "period"])) for s in stores]
    keyed = warehouse.batch("silver")
    known = warehouse.read("silver", "entity_key") if warehouse.exists("silver", "entity_key") else None
    keyed.write("entity_key", layers.entity_keys(entities, known))
    keyed.commit()
    ids = warehouse.read("silver", "entity_key")
    entities = freeze(entities.join(ids, "entity").select("entity_id", "entity", "category", "is_member", "region"))
    stores = [s.join(ids, "entity").select("region", "entity_id", "period", m) for s, m in zip(stores, MEASURES)]

    batch, problems = warehouse.batch("gold"), {}

    def check(fact: DataFrame) -> dict[str, str]:
        problems.update(broken_regions(fact, entities))
        return problems

    regions = [r.region for r in entities.select("region").distinct().collect()]

    def replaced(part: dict[str, str]) -> bool:
        return part["region"] in regions

    batch.write_parts("region_fact", region_grid(entities, stores, ratio_kind), ["period", "region"], replaced, check)
    batch.write_parts("region_entity", entities, ["region"], replaced, lambda _: problems)
    batch.write("dim_region", dim_region(batch.read("region_fact"), batch.read("region_entity")))
    batch.commit()
    rows = {r.region: r.n_facts for r in warehouse.read("gold", "dim_region").collect()}
    told = {}
    for region in sorted(regions):
        if region in problems:
            told[region] = {"status": "error", "rows": 0, "problem": problems[region]}
        else:
            told[region] = {"status": "success", "rows": rows[region], "problem": ""}
        message = told[region]["problem"] or f"loaded {told[region]['rows']} facts"
        medallion._quiet(lambda m=message, t=told[region], r=region: warehouse.log(f"region {r}", t["status"], m, t["rows"], started))
    return told


def dim_region(fact: DataFrame, entities: DataFrame) -> DataFrame:
    """One row per region: entities, members, facts and periods."""
    cells = fact.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_facts"), F.min("period").alias("first_period"), F.max("period").alias("last_period")
    )
    names = entities.groupBy("region").agg(F.count(F.lit(1)).alias("n_entities"), F.count_if("is_member").alias("n_members"))
    return names.join(cells, "region").select("region", "n_entities", "n_members", "n_facts", "first_period", "last_period")


def star(warehouse: Warehouse, labels: tuple[str, str]) -> DataFrame:
    """The regional fact with entity attributes, as report views take it, and the region."""
    fact, entities = warehouse.read("gold", "region_fact"), warehouse.read("gold", "region_entity")
    joined = fact.join(entities, ["region", "entity_id"])
    return joined.withColumn("label", member_label(F.col("is_member"), labels))


def run(spark: SparkSession, source: str, root: str, profile: Profile, regions: Mapping[str, str], **options) -> dict[str, dict]:
    """Workbooks to the regional star in one call. ``regions`` maps a name to the text that its region keys contain."""
    warehouse = Warehouse(spark, root).create()
    return ingest(warehouse, source, profile, regions, **options)


def ingest(
    warehouse: Warehouse, source: str, profile: Profile, regions: Mapping[str, str], collapse_rule: str = "last", ratio_kind: str = STORED_RATIO
) -> dict[str, dict]:
    """One read of the landed workbooks for all the regions."""
    listed = manifest.manifest_frame(warehouse.spark, profile.manifest)
    cells, _ = medallion.land(warehouse, source, listed)
    rows = medallion.landed_rows(cells, profile, listed, regions)
    entities, stores = reconcile(rows, profile, collapse_rule)
    told = load(warehouse, entities, stores, ratio_kind, checked=True)
    if not told:
        raise ValueError(f"no usable rows of {', '.join(regions)} in the workbooks below {source}")
    return told
