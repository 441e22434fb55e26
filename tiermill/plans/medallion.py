"""End-to-end runs: landed workbooks to the curated CSV, and the CSV through the layers."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.functions.membership import member_flag
from tiermill.functions.numeric import STORED_RATIO, member_label, safe_ratio
from tiermill.operators.densify import dense_grid, grid_invariant, period_array
from tiermill.operators.history import asof_join, interval_problems, keep_history, period_end
from tiermill.operators.keys import seed_dim
from tiermill.operators.quality import (
    domain_violations,
    fk_orphans,
    layer_counts,
    null_violations,
    quality_report,
    unique_violations,
)
from tiermill.operators.reconcile import (
    category_pick,
    collapse,
    distinct_keys,
    entity_sum,
    region_filter,
    region_tag,
    store_of,
)
from tiermill.plans import extensions, layers, views
from tiermill.plans.warehouse import Warehouse
from tiermill.profile import Profile
from tiermill.session import freeze
from tiermill.sources import curated_csv, grid, manifest, workbook
from tiermill.sources.ledger import ingest_ledger

logger = logging.getLogger(__name__)

# Longest texts the layer tables take; fixed by their column types.
TEXT_LIMITS = {"entity": 500, "category": 50, "label": 20, "source_file": 255}

# What the entity dimension keeps the history of.
TRACKED = ("entity", "category", "is_member")

ROLES = ("region", "entity", "category", "amount")


def placed_files(cells: DataFrame, profile: Profile, listed: DataFrame) -> DataFrame:
    """One row per listed file, in a written table: sheet, header row and the position of each role's column."""
    first, second = profile.kinds
    found = grid.layout(
        cells, profile.skip_sheets, profile.header_any, profile.header_all, profile.default_header_row
    )
    tagged = manifest.manifest_join(manifest.file_id_from_path(found, "file"), listed)
    placed = grid.column_resolve(
        tagged,
        {
            "region": profile.region_patterns,
            "entity": profile.entity_patterns,
            "category": profile.category_patterns,
            "_first": profile.amount_patterns[first],
            "_second": profile.amount_patterns[second],
        },
    ).withColumn("amount", F.when(F.col("kind") == first, F.col("_first")).otherwise(F.col("_second")))
    # Stored, its size is known and decides whether joins broadcast it.
    return freeze(placed)


def landed_rows(
    cells: DataFrame, profile: Profile, listed: DataFrame, regions: Mapping[str, str] | None = None, placed: DataFrame | None = None
) -> DataFrame:
    """Grid of the listed files to rows with names, in the region of the profile or, under their names, in ``regions``."""
    placed = placed_files(cells, profile, listed) if placed is None else placed
    rows = grid.named_rows(cells, placed, ROLES, ("region", "entity", "amount"))
    local = region_tag(rows, "region", regions) if regions else region_filter(rows, "region", profile.region_contains)
    facts = manifest.manifest_join(manifest.file_id_from_path(local, "file"), listed)
    return facts.withColumnRenamed("entity", "raw_name")


def reconcile(rows: DataFrame, profile: Profile, collapse_rule: str = "last") -> DataFrame:
    """Landed rows to the curated frame: every name in every period seen."""
    # A row per file and name, read several times below; the landed rows are read once.
    totals = freeze(entity_sum(rows, ["has_category"]))
    values = collapse(totals, collapse_rule)
    stores = [store_of(values, k, m) for k, m in zip(profile.kinds, ("measure_a", "measure_b"))]
    cells = dense_grid(
        distinct_keys(stores, "entity"), stores, ("measure_a", "measure_b"), period_array(stores), key="entity"
    )
    categories = category_pick(totals, F.col("has_category"))
    # The ratio of the hand-off file is informative; gold computes its own.
    ratio = safe_ratio(F.col("measure_a"), F.col("measure_b"), "decimal(20,2)")
    label = member_label(member_flag(F.col("entity"), profile.members), profile.member_labels)
    full = cells.join(categories, "entity", "left").withColumns({"ratio": ratio, "label": label})
    return full.withColumn("category", F.coalesce("category", F.lit(""))).select(*curated_csv.COLUMNS)


def land(warehouse: Warehouse, source: str, listed: DataFrame) -> tuple[DataFrame, int]:
    """Cells of the listed workbooks, decoded once into a landing table, and the number of unreadable files."""
    files = manifest.file_id_from_path(workbook.workbook_files(warehouse.spark, source))
    wanted = files.join(listed, "file_id", "left_semi")
    warehouse.refresh("bronze", "landing", workbook.workbook_scan(wanted))
    landing = warehouse.read("bronze", "landing")
    return workbook.readable(landing), warehouse.refresh("bronze", "unreadable", workbook.unreadable(landing))


def ingest(
    warehouse: Warehouse, source: str, csv_path: str, profile: Profile, collapse_rule: str = "last", listed: DataFrame | None = None
) -> dict:
    """Landed workbooks to the curated CSV.

    Workbooks are decoded once into a landing table; everything after reads that table. ``listed`` is a manifest
    table (``file_id, kind, period, file_rank``) in place of the profile's. What became of every file is kept in
    ``bronze.ingest_ledger`` and, as JSON, in ``ingest_metadata`` below the root.
    """
    listed = manifest.manifest_frame(warehouse.spark, profile.manifest) if listed is None else listed
    cells, damaged = land(warehouse, source, listed)
    placed = placed_files(cells, profile, listed)
    rows = landed_rows(cells, profile, listed, placed=placed)
    files = workbook.workbook_files(warehouse.spark, source).select(F.col("path").alias("file"))
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))
    ledger = ingest_ledger(
        manifest.file_id_from_path(files, "file"), listed, warehouse.read("bronze", "unreadable"), placed, counts, ("region", "entity", "amount")
    )
    warehouse.refresh("bronze", "ingest_ledger", ledger)
    kept = warehouse.read("bronze", "ingest_ledger")
    manifest.write_metadata(kept, f"{warehouse.root}/ingest_metadata")
    outcomes = {r.outcome: r["count"] for r in kept.groupBy("outcome").count().collect()}
    written = curated_csv.write_csv(reconcile(rows, profile, collapse_rule), csv_path, profile.csv_names)
    if not written:
        raise ValueError(f"no usable rows in the workbooks below {source}")
    return {"curated": written, "unreadable": damaged, "files": outcomes}


def load(
    warehouse: Warehouse,
    csv_path: str,
    profile: Profile,
    ratio_kind: str = STORED_RATIO,
    on_overflow: str = "raise",
    buckets: int | None = None,
    by_range: bool = False,
    as_of: str | None = None,
) -> dict:
    """Curated CSV through bronze, silver and gold, then validation.

    ``by_range`` lets many tasks read one large file. With ``as_of``, the day the data holds from, changes of
    entities are kept in ``gold.dim_history``.

    Each layer is one refresh with an audit row. The first failure is logged and raised.
    Returns counters, errors and a status.
    """
    spark = warehouse.spark
    warehouse.create()
    summary: dict = {"errors": []}

    def stage(name: str, work: Callable[[], int], message: str) -> None:
        started = datetime.now(timezone.utc)
        try:
            n = work()
        except Exception as problem:
            summary["errors"].append(f"{name}: {problem}")
            summary["status"] = "failed"
            _quiet(lambda: warehouse.log(name, "error", str(problem), 0, started))
            raise
        _quiet(lambda: warehouse.log(name, "success", message.format(n), n, started))

    def bronze() -> int:
        text = curated_csv.read_csv(spark, csv_path, profile.csv_names, by_range)
        parsed = curated_csv.typed_parse(text, ratio_kind, on_overflow)
        if on_overflow == "quarantine":  # a text over its limit makes the row a reject
            long = [F.when(F.length(c) > n, F.lit(f"{c}: over {n} characters")) for c, n in TEXT_LIMITS.items()]
            parsed = parsed.withColumn("errors", F.concat("errors", F.array_compact(F.array(*long))))
        # Good and bad rows are written in one pass and kept apart by partition; the tables
        # of either are views on it, so a refresh shows both at once.
        both = curated_csv.split_form(parsed).withColumns(
            {"id": F.monotonically_increasing_id(), "loaded_at": F.current_timestamp()}
        )

        def check(version: DataFrame) -> None:
            counts = {r.is_good: r["count"] for r in version.groupBy("is_good").count().collect()}
            summary["bronze"], summary["rejected"] = counts.get(True, 0), counts.get(False, 0)
            if summary["rejected"]:
                summary["errors"].append(f"bronze: {summary['rejected']} rows rejected")
            for row in domain_violations(version.filter("is_good"), TEXT_LIMITS).filter("n_bad > 0").collect():
                raise ValueError(f"{row.n_bad} values of {row.column_name} exceed {TEXT_LIMITS[row.column_name]} characters")

        batch = warehouse.batch("bronze")
        batch.write("parsed", both, ["is_good"], check=check)
        names = [c for c in both.columns if c != "is_good"]
        good = curated_csv.good_columns(names)
        batch.define_columns("curated", good, "parsed", "is_good")
        batch.define_columns("rejected", curated_csv.reject_columns(names), "parsed", "NOT is_good")
        full = {c: good[c] for c in good if c != "ratio"} | {"ratio": "`ratio`"}
        batch.define_columns("quarantined", full, "parsed", "is_good AND `_ratio` IS NULL AND `ratio` IS NOT NULL")
        batch.commit()
        lost = warehouse.read("bronze", "quarantined").count() if on_overflow == "quarantine" else 0
        if lost:
            summary["errors"].append(f"bronze: {lost} ratios quarantined")
        return summary["bronze"]

    def silver() -> int:
        batch = warehouse.batch("silver")
        rows = warehouse.read("bronze", "curated")
        entities = layers.silver_entity(rows, profile.member_labels[0])
        known = warehouse.read("silver", "entity_key") if warehouse.exists("silver", "entity_key") else None
        batch.write("entity_key", layers.entity_keys(entities, known))
        keyed = entities.join(batch.read("entity_key"), "entity")
        stamps = {"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()}
        summary["entities"] = batch.write("entity", keyed.withColumns(stamps))
        ids = batch.read("entity")
        for measure in ("measure_a", "measure_b"):
            built = layers.silver_measure(rows, ids, measure)
            summary[measure] = batch.write(measure, built.withColumn("created_at", F.current_timestamp()))
        batch.commit()
        return summary["entities"] + summary["measure_a"] + summary["measure_b"]

    def gold() -> int:
        batch = warehouse.batch("gold")
        bucketing = (buckets, ["entity_id"]) if buckets else None
        entities = layers.dim_entity(warehouse.read("silver", "entity"))
        if profile.categories:
            schema = "code string, name string, description string"
            old = warehouse.exists("gold", "dim_category")
            dim = warehouse.read("gold", "dim_category") if old else spark.createDataFrame([], schema)
            batch.write("dim_category", seed_dim(dim, profile.categories, schema, "code"))
            entities = extensions.category_dim_lookup(entities, batch.read("dim_category"), "category", profile.categories[-1][0])
        batch.write("dim_entity", entities, bucket_by=bucketing)
        if as_of:
            before = warehouse.read("gold", "dim_history") if warehouse.exists("gold", "dim_history") else None
            kept = keep_history(before, batch.read("dim_entity"), ["entity_id"], TRACKED, F.lit(as_of).cast("date"))
            batch.write("dim_history", kept)
        stores = [
            warehouse.read("silver", m).select("entity_id", "period", m) for m in ("measure_a", "measure_b")
        ]
        batch.write("dim_period", layers.dim_period(spark, period_array(stores, profile.periods)))
        years = batch.read("dim_period")
        outside = stores[0].unionByName(stores[1], allowMissingColumns=True).join(years, "period", "left_anti")
        dropped = batch.write("outside_period", outside) if profile.periods else 0
        if dropped:
            summary["errors"].append(f"gold: {dropped} values of periods outside the closed list, kept in outside_period")
        fact = layers.gold_fact(batch.read("dim_entity"), stores, period_array([years]), ratio_kind, on_overflow)
        stamps = {"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()}
        summary["gold"] = batch.write("fact", fact.withColumns(stamps), bucket_by=bucketing)
        summary["quarantined"] = batch.write("quarantine", layers.overflowed(batch.read("fact")))
        if summary["quarantined"]:
            summary["errors"].append(f"gold: {summary['quarantined']} ratios do not fit {ratio_kind}, kept in quarantine")
        batch.write("cell_rank", views.cell_ranks(batch.read("fact")), bucket_by=bucketing)
        for name, text in views.standing_views(profile.member_labels, profile.view_names, profile.view_columns).items():
            batch.define(name, text)
        batch.commit()
        return summary["gold"]

    stage("bronze", bronze, "loaded {} rows")
    stage("silver", silver, "loaded {} rows")
    stage("gold", gold, "loaded {} facts")
    validate(warehouse, summary)
    summary["status"] = "success with warnings" if summary["errors"] else "success"
    return summary


def _quiet(work: Callable[[], None]) -> None:
    """A failed audit write must not undo or hide the work itself."""
    try:
        work()
    except Exception as problem:
        logger.warning("audit row not written: %s", problem)


def validate(warehouse: Warehouse, summary: dict) -> None:
    """Row counts of the layer tables, and the check that the fact is a full grid."""
    counted = layer_counts(
        {
            f"{layer}.{table}": warehouse.read(layer, table)
            for layer, table in (
                ("bronze", "curated"),
                ("silver", "entity"),
                ("silver", "measure_a"),
                ("silver", "measure_b"),
                ("gold", "fact"),
            )
        }
    )
    summary["counts"] = {row.table_name: row.n_rows for row in counted.collect()}
    grid_row = grid_invariant(
        warehouse.read("gold", "fact"),
        warehouse.read("gold", "dim_entity").filter("is_active"),
        warehouse.read("gold", "dim_period"),
    ).first()
    if not grid_row.complete:
        raise ValueError(f"fact is not a full grid: {grid_row.asDict()}")


def quality(warehouse: Warehouse) -> DataFrame:
    """Violations of the layer constraints: unique keys, required columns, references."""
    entity, fact = warehouse.read("silver", "entity"), warehouse.read("gold", "fact")
    dim = warehouse.read("gold", "dim_entity")
    checks = {
        "silver.entity unique": unique_violations(entity, ["entity"]),
        "silver.entity required": null_violations(entity, ["entity_id", "entity"]),
        "gold.dim_entity unique": unique_violations(dim, ["entity_id"]),
        "gold.dim_entity reference": fk_orphans(dim, entity, "entity_id", "entity_id"),
        "gold.fact unique": unique_violations(fact, ["entity_id", "period"]),
        "gold.fact required": null_violations(fact, ["entity_id", "period", "measure_a", "measure_b"]),
        "gold.fact entity reference": fk_orphans(fact, dim, "entity_id", "entity_id"),
        "gold.fact period reference": fk_orphans(fact, warehouse.read("gold", "dim_period"), "period", "period"),
        "gold.fact ratio domain": warehouse.read("gold", "quarantine"),
    }
    if warehouse.exists("gold", "dim_history"):
        checks["gold.dim_history intervals"] = interval_problems(warehouse.read("gold", "dim_history"), ["entity_id"])
    for measure in ("measure_a", "measure_b"):
        store = warehouse.read("silver", measure)
        checks[f"silver.{measure} unique"] = unique_violations(store, ["entity_id", "period"])
        checks[f"silver.{measure} reference"] = fk_orphans(store, entity, "entity_id", "entity_id")
    return quality_report(checks)


def gold_star(warehouse: Warehouse, profile: Profile) -> DataFrame:
    """The gold layer as the star that report views take."""
    fact = warehouse.read("gold", "fact").drop("created_at", "updated_at")
    return views.star(fact, warehouse.read("gold", "dim_entity"), profile.member_labels)


def asof_star(warehouse: Warehouse) -> DataFrame:
    """The fact with the entity attributes that held at the end of each period."""
    fact = warehouse.read("gold", "fact").drop("created_at", "updated_at")
    return asof_join(fact, warehouse.read("gold", "dim_history"), ["entity_id"], period_end(F.col("period")), TRACKED)


def run(spark: SparkSession, source: str, root: str, profile: Profile, **options) -> dict:
    """Workbooks to gold in one call."""
    warehouse = Warehouse(spark, root).create()
    csv_path = f"{root}/curated_csv"
    ingested = ingest(warehouse, source, csv_path, profile)
    return {**ingested, **load(warehouse, csv_path, profile, **options)}
