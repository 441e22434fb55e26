"""Text keys, list membership and value parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.tables import table
from tiermill.functions import membership, numeric, text
from tiermill.operators.reconcile import region_filter
from tiermill.sources import curated_csv

# Entries longer and shorter than the part names, some with accents and hyphens.
PART_LIST = ("Réd Widget", "hot-gear", "cold", "small ring kit", "blue bolt and nut", "anvil")
_FOLDED_LIST = "['red widget', 'hot gear', 'cold', 'small ring kit', 'blue bolt and nut', 'anvil']"
_BOTH_WAYS = "len(list_filter({1}, lambda m: contains({0}, m) OR contains(m, {0}))) > 0"

_WS = r"[\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _squeeze(sql: str) -> str:
    return f"trim(regexp_replace({sql}, '{_WS}', ' ', 'g'))"


def _of_text(make, name):
    return lambda spark, sf: table(spark, sf, "documents").select("doc_id", make(F.col("text")).alias(name))


def _region_filter(spark, sf):
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    located = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    located = located.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return region_filter(located, "r_name", "middleeast").select("c_custkey", "c_name", "r_name")


def _member_flag(spark, sf):
    flag = membership.member_flag(F.col("p_name"), PART_LIST)
    return table(spark, sf, "part").select("p_partkey", "p_name", flag.alias("is_member"))


def _part_entries(parts):
    """An entry from every part: its name with a word more, or a piece of its name."""
    longer = F.concat("p_name", F.lit(" kit"))
    return parts.select(F.when(F.col("p_partkey") % 2 == 0, longer).otherwise(F.substring("p_name", 2, 6)).alias("entry"))


def _member_semi_join(spark, sf):
    parts = table(spark, sf, "part")
    return membership.member_semi_join(parts, "p_name", _part_entries(parts), "entry").select("p_partkey", "p_name")


def _member_semi_join_long_list(spark, sf):
    """Documents whose whole text holds, or is held by, an entry made from a part or a benchmark item."""
    items = table(spark, sf, "benchmark")
    listed = _part_entries(table(spark, sf, "part")).unionByName(items.select(F.col("text").alias("entry")))
    listed = listed.unionByName(items.select(F.substring("text", 1, 24).alias("entry")))
    return membership.member_semi_join(table(spark, sf, "documents"), "text", listed, "entry").select("doc_id")


_PART_ENTRY = "CASE WHEN p_partkey % 2 = 0 THEN p_name || ' kit' ELSE substr(p_name, 2, 6) END"
_SEMI_SQL = f"""SELECT p_partkey, p_name FROM part WHERE EXISTS (
  SELECT 1 FROM (SELECT DISTINCT {_PART_ENTRY} AS e FROM part) l
  WHERE contains(part.p_name, trim(l.e)) OR contains(trim(l.e), part.p_name))"""


def _folded(sql: str) -> str:
    return _squeeze(f"replace(strip_accents(lower(coalesce({sql}, ''))), '-', ' ')")


_LONG_LIST_SQL = f"""WITH listed AS (
  SELECT DISTINCT {_folded('e')} AS e FROM (
    SELECT {_PART_ENTRY} AS e FROM part UNION ALL SELECT text FROM benchmark UNION ALL SELECT substr(text, 1, 24) FROM benchmark)),
names AS (SELECT doc_id, {_folded('text')} AS n FROM documents)
SELECT doc_id FROM names WHERE EXISTS (SELECT 1 FROM listed WHERE contains(n, e) OR contains(e, n))"""

# Numbers written well and badly, chosen by the event id.
_NUMBER_TEXT = """CASE event_id % 7 WHEN 0 THEN CAST(CAST(value AS DECIMAL(10,2)) AS STRING)
  WHEN 1 THEN CAST(CAST(floor(value) AS BIGINT) AS STRING) WHEN 2 THEN 'abc' WHEN 3 THEN ''
  WHEN 4 THEN '1d' WHEN 5 THEN concat(' ', CAST(event_id AS STRING), ' ') ELSE NULL END"""


def _numeric_coerce(spark, sf):
    events = table(spark, sf, "events").withColumn("raw", F.expr(_NUMBER_TEXT))
    return events.select("event_id", numeric.numeric_coerce(F.col("raw")).alias("value"))


# A curated file with the usual faults: blanks, decimals for integers, words, no period.
_CURATED = {
    "entity": "concat('U', CAST(user_id AS STRING))",
    "period": "CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST(2000 + event_id % 20 AS STRING) END",
    "measure_a": """CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN '12.0' WHEN 2 THEN 'abc'
      ELSE CAST(event_id AS STRING) END""",
    "measure_b": "CASE WHEN event_id % 17 = 0 THEN '7x' ELSE CAST(event_id % 30 AS STRING) END",
    "ratio": """CASE event_id % 19 WHEN 0 THEN '' WHEN 1 THEN '1d'
      ELSE CAST(CAST(value AS DECIMAL(10,2)) AS STRING) END""",
}
_CURATED_SQL = ", ".join(f"{v} AS {k}" for k, v in _CURATED.items())


def parsed(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", *[f"{v} AS {k}" for k, v in _CURATED.items()])
    return curated_csv.typed_parse(raw)


def _typed_parse_good(spark, sf):
    good = curated_csv.good_rows(parsed(spark, sf))
    return good.withColumn("ratio", F.col("ratio").cast("double"))


def _typed_parse_rejects(spark, sf):
    bad = curated_csv.rejected_rows(parsed(spark, sf))
    return bad.withColumn("errors", F.array_join("errors", "; "))


_INT = "regexp_full_match({0}, '[+-]?[0-9]+')"
_DEC = r"regexp_full_match({0}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)')"
_CHECKS_SQL = f"""raw AS (SELECT event_id, {_CURATED_SQL.replace('STRING', 'VARCHAR')} FROM events),
bad AS (SELECT *,
  CASE WHEN measure_a <> '' AND NOT {_INT.format('measure_a')} THEN 'measure_a: ''' || measure_a || '''' END AS e1,
  CASE WHEN measure_b <> '' AND NOT {_INT.format('measure_b')} THEN 'measure_b: ''' || measure_b || '''' END AS e2,
  CASE WHEN ratio <> '' AND NOT {_DEC.format('ratio')} THEN 'ratio: ''' || ratio || '''' END AS e3,
  CASE WHEN NOT {_INT.format('period')} THEN 'period: ''' || period || '''' END AS e4 FROM raw)"""

GOOD_SQL = f"""WITH {_CHECKS_SQL} SELECT event_id, entity, CAST(period AS INTEGER) AS period,
  CAST(nullif(measure_a, '') AS INTEGER) AS measure_a, CAST(nullif(measure_b, '') AS INTEGER) AS measure_b,
  CAST(nullif(ratio, '') AS DOUBLE) AS ratio
FROM bad WHERE e1 IS NULL AND e2 IS NULL AND e3 IS NULL AND e4 IS NULL"""

QUERIES = {
    "header_normalize": (
        _of_text(text.header_normalize, "header"),
        f"SELECT doc_id, lower({_squeeze('text')}) AS header FROM documents",
    ),
    "region_key": (
        _of_text(text.region_key, "region_key"),
        f"""SELECT doc_id, regexp_replace(replace(replace(replace(replace(
          strip_accents(lower(text)), 'd.c.', ''), 'dc', ''), ',', ''), '.', ''), '{_WS}', '', 'g') AS region_key
        FROM documents""",
    ),
    "name_clean": (
        _of_text(text.name_clean, "name"),
        "SELECT doc_id, trim(regexp_replace(" + _squeeze("replace(text, ',', '')") + ", '-+$', '')) AS name FROM documents",
    ),
    "match_fold": (
        _of_text(text.match_fold, "folded"),
        "SELECT doc_id, " + _squeeze("replace(strip_accents(lower(text)), '-', ' ')") + " AS folded FROM documents",
    ),
    "region_filter": (
        _region_filter,
        """SELECT c_custkey, c_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE contains(replace(lower(r_name), ' ', ''), 'middleeast')""",
    ),
    "member_flag": (
        _member_flag,
        f"SELECT p_partkey, p_name, {_BOTH_WAYS.format('lower(p_name)', _FOLDED_LIST)} AS is_member FROM part",
    ),
    "member_semi_join": (_member_semi_join, _SEMI_SQL),
    "member_semi_join_long_list": (_member_semi_join_long_list, _LONG_LIST_SQL),
    "numeric_coerce": (
        _numeric_coerce,
        f"""SELECT event_id, CASE WHEN regexp_full_match(trim(raw), '[0-9]+(\\.[0-9]+)?')
          THEN CAST(trim(raw) AS DOUBLE) ELSE 0.0 END AS value
        FROM (SELECT event_id, {_NUMBER_TEXT.replace('STRING', 'VARCHAR')} AS raw FROM events)""",
    ),
    "typed_parse_good": (
        _typed_parse_good,
        GOOD_SQL,
    ),
    "typed_parse_rejects": (
        _typed_parse_rejects,
        f"""WITH {_CHECKS_SQL} SELECT event_id, entity, period, measure_a, measure_b, ratio,
          concat_ws('; ', e1, e2, e3, e4) AS errors
        FROM bad WHERE coalesce(e1, e2, e3, e4) IS NOT NULL""",
    ),
}
