"""Layers, key-based writes, checks, hand-off files and the described extensions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from bindings import texts
from bindings.tables import MART_SQL, RATIO, entities, fact, half_up, mart, plain, star, store_a, table, year
from tiermill.operators import history, keys, quality
from tiermill.plans import extensions, layers, medallion, upserts
from tiermill.plans.warehouse import Warehouse
from tiermill.profile import Profile
from tiermill.session import freeze, literal_rows, run_folder
from tiermill.sources import curated_csv

# --- layers ------------------------------------------------------------------------


def _silver_entity(spark, sf):
    """Orders as bronze rows: many category variants per customer."""
    bronze = table(spark, sf, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("entity"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderstatus").alias("label"),
    )
    return layers.silver_entity(bronze, "F")


def _silver_measure(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("entity"))
    named = store_a(spark, sf).join(names, "entity_id")
    # Years without a quantity above 100 stand for missing values.
    bronze = named.withColumn("measure_a", F.when(F.col("measure_a") > 100, F.col("measure_a"))).drop("entity_id")
    return layers.silver_measure(bronze, names, "measure_a")


def _dim_entity(spark, sf):
    return layers.dim_entity(entities(spark, sf)).drop("valid_from")


def _curated(spark, sf):
    """The rows of the curated hand-off file, written once: the sort of the file reads them twice, and a second load again."""
    columns = [F.col(c).cast("decimal(18,2)").alias(c) if c == "ratio" else c for c in curated_csv.COLUMNS]
    return freeze(star(spark, sf).select(*columns))


# The curated frame carries order years, measured over whatever periods occur.
_PROFILE = Profile(
    kinds=("a", "b"),
    manifest=(),
    amount_patterns={},
    region_patterns=(),
    entity_patterns=(),
    category_patterns=(),
    region_contains="",
    skip_sheets=(),
    header_any=(),
    header_all=(),
    default_header_row=7,
    members=(),
)


def _warehouse(spark, purpose: str) -> Warehouse:
    root = run_folder(spark, purpose)
    prefix = root.rsplit("-", 1)[-1][:12]
    return Warehouse(spark, root, {layer: f"{layer}_{prefix}" for layer in ("bronze", "silver", "gold", "audit")}).create()


def _medallion_gold(spark, sf):
    """Curated file, bronze, silver, gold: every layer written and read back."""
    warehouse = _warehouse(spark, "medallion")
    path = f"{warehouse.root}/curated"
    curated_csv.write_csv(_curated(spark, sf), path)
    medallion.load(warehouse, path, _PROFILE, ratio_kind=RATIO)
    built = medallion.gold_star(warehouse, _PROFILE)
    return plain(built.select("entity", "category", "is_member", "label", "period", "measure_a", "measure_b", "ratio"))


def _medallion_reload(spark, sf):
    """Two loads, the second with names that sort earlier: ids of known names stay."""
    warehouse = _warehouse(spark, "reload")
    frame = _curated(spark, sf)
    known = F.regexp_extract("entity", "([0-9]+)$", 1).cast("int") % 3 != 0
    for step, rows in (("first", frame.filter(known)), ("second", frame)):
        path = f"{warehouse.root}/{step}"
        curated_csv.write_csv(rows, path)
        medallion.load(warehouse, path, _PROFILE, ratio_kind=RATIO)
    return warehouse.read("gold", "dim_entity").select("entity", "entity_id")


def _gold_views(spark, sf):
    """The standing views, as a client of the gold database reads them, after a second load."""
    warehouse = _warehouse(spark, "views")
    path = f"{warehouse.root}/curated"
    curated_csv.write_csv(_curated(spark, sf), path)
    for _ in range(2):
        medallion.load(warehouse, path, _PROFILE, ratio_kind=RATIO)
    gold = warehouse.database("gold")
    return plain(
        spark.sql(
            f"""SELECT r.period, r.entity, r.ratio, r.rank_desc, r.rank_asc, t.position, e.prev_ratio, m.n_entities, m.avg_ratio
            FROM `{gold}`.ratio_report r JOIN `{gold}`.top_by_ratio t ON r.entity = t.entity AND r.period = t.period
            JOIN `{gold}`.evolution e ON r.entity = e.entity AND r.period = e.period
            JOIN `{gold}`.member_averages m ON r.period = m.period AND r.label = m.label"""
        )
    )


def _ratio_quarantine(spark, sf):
    """Ratios that do not fit the stored column, kept with their full value."""
    warehouse = _warehouse(spark, "quarantine")
    path = f"{warehouse.root}/curated"
    curated_csv.write_csv(_curated(spark, sf).withColumn("ratio", F.lit(None).cast("decimal(18,2)")), path)
    medallion.load(warehouse, path, _PROFILE, ratio_kind="decimal(4,2)", on_overflow="quarantine")
    names = warehouse.read("gold", "dim_entity").select("entity_id", "entity")
    return plain(warehouse.read("gold", "quarantine").join(names, "entity_id").select("entity", "period", "value"))


def _bronze_load(spark, sf):
    """Events as a faulty curated file; good rows land in the bronze table."""
    warehouse = _warehouse(spark, "bronze")
    rows = curated_csv.good_rows(texts.parsed(spark, sf)).withColumn("loaded_at", F.current_timestamp())
    warehouse.refresh("bronze", "curated", rows)
    return plain(warehouse.read("bronze", "curated").drop("loaded_at"))


def _document_rows(spark, sf):
    """Whole document texts with their quotes, commas and line breaks as curated rows."""
    return table(spark, sf, "documents").select(
        F.col("text").alias("entity"),
        F.col("n_chars").cast("int").alias("period"),
        F.col("doc_id").alias("measure_a"),
        F.when(F.col("lang") != "en", F.col("doc_id")).alias("measure_b"),
        F.when(F.col("lang") == "de", F.round(F.col("n_chars") / 8, 2).cast("decimal(18,2)")).alias("ratio"),
        F.col("source").alias("category"),
        F.concat(F.lit('"'), F.col("lang"), F.lit('", ')).alias("label"),
    )


def _csv_roundtrip(spark, sf):
    """Documents through the file and back."""
    path = run_folder(spark, "csv")
    curated_csv.write_csv(_document_rows(spark, sf), path)
    return curated_csv.read_csv(spark, path).drop("source_file")


#: Of :func:`_csv_split_scan`: characters of one written file on average, and most bytes of a file that one task reads.
_FILE_CHARS, _RANGE_BYTES = 8 << 20, 64 << 20


def _csv_split_scan(spark, sf):
    """Documents as files that are written by many tasks and read in ranges, each a sixteenth of the largest file and at most 64 MB."""
    path = run_folder(spark, "csv")
    # The longest texts are last, so a range of as many rows as others may have ten times their bytes.
    chars = table(spark, sf, "documents").agg(F.sum("n_chars")).first()[0]
    curated_csv.write_csv(_document_rows(spark, sf), path, ranges=(chars or 0) // _FILE_CHARS + 1)
    size = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    each = min((size or 0) // 16 + 1, _RANGE_BYTES)
    small = {"spark.sql.files.maxPartitionBytes": str(each), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        return freeze(curated_csv.read_csv(spark, path, by_range=True).drop("source_file"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _audit_log(spark, sf):
    """Audit rows of two layer builds over the tables."""
    warehouse = _warehouse(spark, "audit")
    for layer, name, df in (
        ("bronze", "lines", table(spark, sf, "lineitem")),
        ("gold", "fact", fact(spark, sf)),
    ):
        started = datetime.now(timezone.utc)
        n = warehouse.refresh(layer, name, df)
        warehouse.log(layer, "success", f"loaded {n} rows", n, started)
    # Ids and times differ from run to run, so only their order is kept.
    return warehouse.audit_log(20).select("stage", "status", "message", "n_rows")


# --- keys and writes ---------------------------------------------------------------


def _surrogate_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return keys.surrogate_key(orders, ["o_orderdate", "o_orderkey"], "order_id").drop("o_orderdate")


def _seed_dim(spark, sf):
    """Seeds join the segments that are there already; 'building' is not replaced."""
    segments = table(spark, sf, "customer").select(
        F.lower("c_mktsegment").alias("code"), F.col("c_mktsegment").alias("name")
    ).distinct()
    seeds = [("building", "Seed"), ("unknown", "Unknown"), ("retail", "Retail")]
    once = keys.seed_dim(segments, seeds, "code string, name string", "code")
    return keys.seed_dim(once, seeds, "code string, name string", "code")


_PAIR = ("l_partkey", "l_suppkey")


def _insert_ignore(spark, sf):
    lines = table(spark, sf, "lineitem")
    target = lines.filter("l_returnflag = 'A'").groupBy(*_PAIR).agg(F.max("l_quantity").alias("q"), F.max("l_tax").alias("t"))
    batch = lines.filter("l_returnflag <> 'A'").select(*_PAIR, F.col("l_quantity").alias("q"), F.col("l_tax").alias("t"))
    return keys.insert_ignore(target, batch, _PAIR)


def _upsert_merge(spark, sf):
    lines = table(spark, sf, "lineitem")
    key = ["l_orderkey", "l_linenumber"]

    def side(flag: str, name: str):
        grouped = lines.filter(f"l_returnflag {flag} 'A'").groupBy(*key)
        return grouped.agg(F.sum("l_quantity").cast("bigint").alias("quantity")).withColumn("origin", F.lit(name))

    target, batch = side("=", "old"), side("<>", "batch")
    return keys.upsert_merge(target, batch, key, {"origin": F.lit("updated")})


def _incremental_upsert(spark, sf):
    """Returned lines, then two batches of the others, into a table that is kept in pieces."""
    warehouse, key = _warehouse(spark, "pieces"), ["l_orderkey", "l_linenumber"]

    def side(flag: str, name: str):
        grouped = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == flag).groupBy(*key)
        return grouped.agg(F.sum("l_quantity").cast("bigint").alias("quantity")).withColumn("origin", F.lit(name))

    size = {"key": key, "slices": 4, "piece_rows": 50_000}
    upserts.create(warehouse, "silver", "lines", side("A", "old"), **size)
    for flag in ("N", "R"):
        upserts.upsert(warehouse, "silver", "lines", side(flag, "batch"), **size, touched={"origin": F.lit("updated")})
    return upserts.read(warehouse, "silver", "lines")


def _scd2_merge(spark, sf):
    """Known customers have a balance; machinery customers have since changed segment."""
    customers = table(spark, sf, "customer")
    history = customers.filter("c_acctbal >= 0").select(
        "c_custkey",
        "c_mktsegment",
        extensions.day_of("2020-01-01").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_active"),
    )
    earlier = customers.filter("c_acctbal < 0").select(
        "c_custkey",
        F.lit("OLD").alias("c_mktsegment"),
        extensions.day_of("2018-01-01").alias("valid_from"),
        extensions.day_of("2019-01-01").alias("valid_to"),
        F.when(F.col("c_custkey") % 2 == 0, False).alias("is_active"),  # null: not known
    )
    history = history.unionByName(earlier)
    moved = F.when(F.col("c_mktsegment") == "MACHINERY", "FURNITURE").otherwise(F.col("c_mktsegment"))
    current = customers.select("c_custkey", moved.alias("c_mktsegment"))
    return keys.scd2_merge(history, current, ["c_custkey"], ["c_mktsegment"], extensions.day_of("2024-06-01"))


# --- checks ------------------------------------------------------------------------

_LINE_KEY = ("l_orderkey", "l_linenumber")


def _unique_violations(spark, sf):
    return quality.unique_violations(table(spark, sf, "lineitem"), _LINE_KEY)


def _null_violations(spark, sf):
    cells = star(spark, sf)
    return quality.null_violations(cells, ["entity", "category", "measure_b", "ratio"])


_LENGTHS = {"text": 500, "source": 4}


def _domain_violations(spark, sf):
    return quality.domain_violations(table(spark, sf, "documents"), _LENGTHS, {"n_chars": "decimal(5,2)"})


def _fk_orphans(spark, sf):
    """Orders that no line refers to."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return quality.fk_orphans(orders, table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


def _quality_report(spark, sf):
    return quality.quality_report(
        {
            "line key repeated": _unique_violations(spark, sf),
            "order without lines": _fk_orphans(spark, sf),
            "document domain": _domain_violations(spark, sf),
            "cell without value": _null_violations(spark, sf),
        }
    )


def _layer_counts(spark, sf):
    names = ("customer", "orders", "lineitem", "part")
    return quality.layer_counts({**{n: table(spark, sf, n) for n in names}, "fact": fact(spark, sf)})


# --- extensions --------------------------------------------------------------------


def _customer_regions(spark, sf):
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    joined = joined.join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(F.col("c_custkey").alias("entity_id"), F.col("r_name").alias("region"))


def _region_rollup(spark, sf):
    return plain(extensions.region_rollup(star(spark, sf), _customer_regions(spark, sf)))


def _partitioned_fact(spark, sf):
    """The fact by period, with the partition of one period replaced afterwards."""
    path = run_folder(spark, "fact")
    extensions.write_partitioned(fact(spark, sf), path)
    schema = "entity_id bigint, measure_a bigint, measure_b bigint, ratio " + RATIO + ", period int"
    stored = spark.read.schema(schema).parquet(path)
    late = stored.filter("period = 1998").withColumn("measure_a", F.col("measure_a") + 1)
    # Rows read from the folder are frozen in a side copy before their partition goes.
    side = run_folder(spark, "late")
    late.write.parquet(side)
    extensions.write_partitioned(spark.read.parquet(side), path)
    return plain(spark.read.schema(schema).parquet(path))


def _dim_history(spark, sf):
    """Three loads: machinery customers become household ones in 1996 and automobile ones in 1998."""
    versions = None
    for day, segment in (("1992-01-01", None), ("1996-07-01", "HOUSEHOLD"), ("1998-01-01", "AUTOMOBILE")):
        changed = F.when(F.col("category") == "MACHINERY", segment) if segment else F.lit(None)
        current = entities(spark, sf).withColumn("category", F.coalesce(changed, "category"))
        tracked = ["entity", "category", "is_member"]
        versions = history.keep_history(versions, current, ["entity_id"], tracked, extensions.day_of(day))
    return versions


def _asof_star(spark, sf):
    """Facts with the category that held at the end of their year."""
    return plain(
        history.asof_join(fact(spark, sf), _dim_history(spark, sf), ["entity_id"], history.period_end(F.col("period")), ["entity", "category", "is_member"])
    )


_SEGMENT_AT = """CASE WHEN category = 'MACHINERY' AND period >= 1998 THEN 'AUTOMOBILE'
  WHEN category = 'MACHINERY' AND period >= 1996 THEN 'HOUSEHOLD' ELSE category END"""


def _ratio_variation(spark, sf):
    """From order rows, one per order, rather than from ready cells."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity_id"),
        year("o_orderdate").alias("period"),
        F.floor("o_totalprice").alias("measure_a"),
        F.when(F.col("o_orderstatus") == "F", 1000).otherwise(0).alias("measure_b"),
    )
    summed = orders.groupBy("entity_id", "period").agg(F.sum("measure_a").alias("measure_a"), F.sum("measure_b").alias("measure_b"))
    rows = summed.join(entities(spark, sf), "entity_id")
    return plain(extensions.ratio_variation(rows, RATIO)).withColumn("variation", F.round("variation", 2))


def _time_dim(spark, sf):
    return extensions.time_dim(table(spark, sf, "orders"), "o_orderdate")


def _category_dim_lookup(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    codes = [("building", "Building"), ("machinery", "Machinery"), ("unknown", "Unknown")]
    dim = literal_rows(spark, codes, "code string, name string")
    return extensions.category_dim_lookup(rows, dim, "c_mktsegment", "unknown")


_ROUNDTRIP = """SELECT text AS entity, CAST(n_chars AS VARCHAR) AS period,
  CAST(doc_id AS VARCHAR) AS measure_a, CASE WHEN lang <> 'en' THEN CAST(doc_id AS VARCHAR) ELSE '' END AS measure_b,
  CASE WHEN lang = 'de' THEN CAST(CAST(CAST((25 * n_chars + 1) // 2 AS DECIMAL(16,0)) * 0.01 AS DECIMAL(18,2)) AS VARCHAR)
    ELSE '' END AS ratio,
  source AS category, '"' || lang || '", ' AS label FROM documents"""
_DATE = "CAST('{0}' AS DATE)"
_STAR_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_bad FROM star"
    for c in ("entity", "category", "measure_b", "ratio")
)
_DOMAIN = """SELECT 'text' AS column_name, count(*) FILTER (length(text) > 500) AS n_bad FROM documents
UNION ALL SELECT 'source', count(*) FILTER (length(source) > 4) FROM documents
UNION ALL SELECT 'n_chars', count(*) FILTER (n_chars >= 1000) FROM documents"""
_DUPLICATES = "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
_ORPHANS = "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"

QUERIES = {
    "silver_entity": (
        _silver_entity,
        """SELECT 'C' || o_custkey AS entity, o_orderpriority AS category, o_orderstatus = 'F' AS is_member FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderstatus = 'F') = 1""",
    ),
    "silver_measure": (
        _silver_measure,
        mart("SELECT entity_id, period, v AS measure_a FROM qty WHERE v > 100"),
    ),
    "dim_entity": (
        _dim_entity,
        mart("SELECT entity_id, entity, category, is_member, CAST(NULL AS DATE) AS valid_to, true AS is_active FROM ent"),
    ),
    "medallion_gold": (
        _medallion_gold,
        mart("SELECT entity, category, is_member, label, period, measure_a, measure_b, ratio FROM star"),
    ),
    "medallion_reload": (
        _medallion_reload,
        """SELECT c_name AS entity, row_number() OVER (
          ORDER BY CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS INTEGER) % 3 = 0, c_name) AS entity_id FROM customer""",
    ),
    "gold_views": (
        _gold_views,
        mart(
            f"""SELECT period, entity, ratio, rank() OVER d AS rank_desc, rank() OVER (PARTITION BY period ORDER BY ratio ASC NULLS LAST) AS rank_asc,
            rank() OVER d AS position, lag(ratio) OVER (PARTITION BY entity_id ORDER BY period) AS prev_ratio,
            count(*) OVER g AS n_entities, {half_up("sum(CAST(round(ratio * 100) AS BIGINT)) OVER g", "(100 * count(ratio) OVER g)")} AS avg_ratio
            FROM star WINDOW d AS (PARTITION BY period ORDER BY ratio DESC NULLS FIRST), g AS (PARTITION BY period, label)"""
        ),
    ),
    "ratio_quarantine": (_ratio_quarantine, mart("SELECT entity, period, ratio AS value FROM star WHERE ratio >= 100")),
    "bronze_load": (_bronze_load, texts.GOOD_SQL),
    "csv_roundtrip": (_csv_roundtrip, _ROUNDTRIP),
    "csv_split_scan": (_csv_split_scan, _ROUNDTRIP),
    "audit_log": (
        _audit_log,
        mart(
            """SELECT stage, 'success' AS status, 'loaded ' || n_rows || ' rows' AS message, n_rows FROM (
            SELECT 'bronze' AS stage, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'gold', count(*) FROM star)"""
        ),
    ),
    "surrogate_key": (
        _surrogate_key,
        "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id FROM orders",
    ),
    "seed_dim": (
        _seed_dim,
        """SELECT DISTINCT lower(c_mktsegment) AS code, c_mktsegment AS name FROM customer
        UNION ALL SELECT 'unknown', 'Unknown' UNION ALL SELECT 'retail', 'Retail'""",
    ),
    "insert_ignore": (
        _insert_ignore,
        """WITH t AS (SELECT l_partkey, l_suppkey, max(l_quantity) AS q, max(l_tax) AS t FROM lineitem
          WHERE l_returnflag = 'A' GROUP BY 1, 2)
        SELECT * FROM t UNION ALL
        SELECT l_partkey, l_suppkey, l_quantity, l_tax FROM lineitem WHERE l_returnflag <> 'A'
          AND (l_partkey, l_suppkey) NOT IN (SELECT (l_partkey, l_suppkey) FROM t)
        QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_quantity, l_tax) = 1""",
    ),
    "upsert_merge": (
        _upsert_merge,
        """SELECT l_orderkey, l_linenumber,
          CAST(coalesce(sum(l_quantity) FILTER (l_returnflag <> 'A'), sum(l_quantity) FILTER (l_returnflag = 'A')) AS BIGINT) AS quantity,
          CASE WHEN count(*) FILTER (l_returnflag <> 'A') > 0 THEN 'updated' ELSE 'old' END AS origin
        FROM lineitem GROUP BY 1, 2""",
    ),
    "incremental_upsert": (
        _incremental_upsert,
        """WITH s AS (SELECT l_orderkey, l_linenumber, l_returnflag AS f, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL)
        SELECT l_orderkey, l_linenumber, coalesce(max(q) FILTER (f = 'R'), max(q) FILTER (f = 'N'), max(q)) AS quantity,
               CASE WHEN bool_or(f <> 'A') THEN 'updated' ELSE 'old' END AS origin
        FROM s GROUP BY 1, 2""",
    ),
    "scd2_merge": (
        _scd2_merge,
        f"""WITH cur AS (SELECT *, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'FURNITURE' ELSE c_mktsegment END AS now_segment FROM customer)
        SELECT c_custkey, c_mktsegment, {_DATE.format('2020-01-01')} AS valid_from,
          CASE WHEN c_mktsegment <> now_segment THEN {_DATE.format('2024-06-01')} END AS valid_to,
          c_mktsegment = now_segment AS is_active FROM cur WHERE c_acctbal >= 0
        UNION ALL SELECT c_custkey, now_segment, {_DATE.format('2024-06-01')}, CAST(NULL AS DATE), true FROM cur
        WHERE c_acctbal < 0 OR c_mktsegment <> now_segment
        UNION ALL SELECT c_custkey, 'OLD', {_DATE.format('2018-01-01')}, {_DATE.format('2019-01-01')},
          CASE WHEN c_custkey % 2 = 0 THEN false END FROM cur WHERE c_acctbal < 0""",
    ),
    "unique_violations": (_unique_violations, _DUPLICATES),
    "null_violations": (_null_violations, mart(_STAR_NULLS)),
    "domain_violations": (_domain_violations, _DOMAIN),
    "fk_orphans": (_fk_orphans, _ORPHANS),
    "quality_report": (
        _quality_report,
        mart(
            f"""SELECT 'line key repeated' AS check_name, (SELECT count(*) FROM ({_DUPLICATES})) AS n_violations
            UNION ALL SELECT 'order without lines', (SELECT count(*) FROM ({_ORPHANS}))
            UNION ALL SELECT 'document domain', (SELECT CAST(sum(n_bad) AS BIGINT) FROM ({_DOMAIN}))
            UNION ALL SELECT 'cell without value', (SELECT CAST(sum(n_bad) AS BIGINT) FROM ({_STAR_NULLS}))"""
        ),
    ),
    "layer_counts": (
        _layer_counts,
        mart(
            " UNION ALL ".join(
                f"SELECT '{label}' AS table_name, count(*) AS n_rows FROM {source}"
                for label, source in (
                    ("customer", "customer"), ("orders", "orders"), ("lineitem", "lineitem"), ("part", "part"), ("fact", "star"),
                )
            )
        ),
    ),
    "region_rollup": (
        _region_rollup,
        mart(
            f"""SELECT r_name AS region, period, count(*) AS n_entities,
            CAST(sum(measure_a) AS BIGINT) AS sum_a, CAST(sum(measure_b) AS BIGINT) AS sum_b,
            {half_up('sum(measure_a)', 'CAST(sum(measure_b) AS BIGINT)')} AS ratio_of_sums,
            {half_up('sum(CAST(round(ratio * 100) AS BIGINT))', '(100 * count(ratio))')} AS avg_ratio
            FROM star JOIN customer ON c_custkey = entity_id JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"""
        ),
    ),
    "partitioned_fact": (
        _partitioned_fact,
        mart(
            """SELECT entity_id, period, measure_a + CASE WHEN period = 1998 THEN 1 ELSE 0 END AS measure_a,
            measure_b, ratio FROM star"""
        ),
    ),
    "dim_history": (
        _dim_history,
        mart(
            """SELECT entity_id, entity, CASE WHEN n = 1 THEN category ELSE v.c END AS category, is_member, v.f AS valid_from, v.t AS valid_to,
            v.t IS NULL AS is_active FROM ent JOIN (VALUES
              (1, 'x', DATE '0001-01-01', NULL, false), (1, '', DATE '0001-01-01', DATE '1996-07-01', true),
              (2, 'HOUSEHOLD', DATE '1996-07-01', DATE '1998-01-01', true), (3, 'AUTOMOBILE', DATE '1998-01-01', NULL, true)) AS v(n, c, f, t, changes)
            ON v.changes = (category = 'MACHINERY')"""
        ),
    ),
    "asof_star": (
        _asof_star,
        mart(f"SELECT entity_id, entity, {_SEGMENT_AT} AS category, is_member, period, measure_a, measure_b, ratio FROM star"),
    ),
    "ratio_variation": (
        _ratio_variation,
        f"""WITH {MART_SQL}, cells AS (
          SELECT o_custkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS period,
                 CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS measure_a,
                 CAST(1000 * count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS measure_b
          FROM orders GROUP BY 1, 2),
        ratios AS (SELECT *, CASE WHEN measure_b > 0 THEN {half_up('measure_a', 'measure_b')} END AS ratio FROM cells)
        SELECT entity, category, is_member, period, measure_a, measure_b, ratio,
          round(ratio - lag(ratio) OVER (PARTITION BY entity_id ORDER BY period), 2) AS variation
        FROM ratios JOIN ent USING (entity_id)""",
    ),
    "time_dim": (
        _time_dim,
        """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS period,
        CAST(year(o_orderdate) AS VARCHAR) AS period_label, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
        CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS semester,
        dayofyear(make_date(year(o_orderdate), 12, 31)) = 366 AS is_leap FROM orders""",
    ),
    "category_dim_lookup": (
        _category_dim_lookup,
        """SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY')
        THEN lower(c_mktsegment) ELSE 'unknown' END AS category_code FROM customer""",
    ),
}
