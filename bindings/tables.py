"""How the test tables stand in for the concepts of a data mart.

An entity is a customer, a period is an order year, measure_a is the ordered quantity,
measure_b is the number of finished orders. The market segment is the category and decides
membership; the customer's region stands for the region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.functions.membership import member_flag
from tiermill.operators.densify import period_array
from tiermill.plans import layers, views
from tiermill.session import freeze

# Ratios of this data exceed the default decimal(5,2).
RATIO = "decimal(12,2)"
MEMBERS = ("Auto", "building works", "MACHINERY", "household-goods")
REPORT_YEAR = 1998


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once and then given."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def year(column: str) -> Column:
    return F.year(column).cast("int")


def order_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity per order, combined before the orders are joined."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"))


def store_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("entity_id"), year("o_orderdate").alias("period")
    )
    lines = order_quantity(spark, sf_dir)
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("entity_id", "period").agg(F.sum("quantity").cast("bigint").alias("measure_a"))


def store_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    keyed = orders.select(F.col("o_custkey").alias("entity_id"), year("o_orderdate").alias("period"))
    return keyed.groupBy("entity_id", "period").agg(F.count(F.lit(1)).alias("measure_b"))


def periods(spark: SparkSession, sf_dir: str) -> Column:
    seen = table(spark, sf_dir, "orders").select(year("o_orderdate").alias("period"))
    return period_array([seen])


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity_id"),
        F.col("c_name").alias("entity"),
        F.col("c_mktsegment").alias("category"),
        member_flag(F.col("c_mktsegment"), MEMBERS).alias("is_member"),
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = [store_a(spark, sf_dir), store_b(spark, sf_dir)]
    return layers.gold_fact(entities(spark, sf_dir), stores, periods(spark, sf_dir), RATIO)


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.star(fact(spark, sf_dir), entities(spark, sf_dir))


def stored_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star as a written table, as gold is. Ranks read it twice."""
    return freeze(star(spark, sf_dir))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type the comparison uses."""
    casts = [
        F.col(f"`{n}`").cast("double").alias(n) if kind.startswith("decimal") else F.col(f"`{n}`")
        for n, kind in df.dtypes
    ]
    return df.select(*casts)


# The same mart in SQL. Ratios are rounded half up in whole numbers, so that no binary
# tie can fall to the other side.
MEMBER_SQL = """len(list_filter(['auto', 'building works', 'machinery', 'household goods'],
    lambda m: contains(lower({0}), m) OR contains(m, lower({0})))) > 0"""
_FOLDED = MEMBER_SQL.format("c_mktsegment")

MART_SQL = f"""
qty AS (
  SELECT o_custkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS period,
         CAST(sum(l_quantity) AS BIGINT) AS v
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
fin AS (
  SELECT o_custkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS v
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
yrs AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS period FROM orders),
ent AS (
  SELECT c_custkey AS entity_id, c_name AS entity, c_mktsegment AS category,
         {_FOLDED} AS is_member
  FROM customer),
star AS (
  SELECT ent.*, CASE WHEN is_member THEN 'member' ELSE 'other' END AS label, yrs.period,
         coalesce(qty.v, 0) AS measure_a, coalesce(fin.v, 0) AS measure_b,
         CASE WHEN fin.v > 0
              THEN ((200 * coalesce(qty.v, 0) + fin.v) // (2 * fin.v))::DOUBLE / 100 END AS ratio
  FROM ent CROSS JOIN yrs
  LEFT JOIN qty ON qty.entity_id = ent.entity_id AND qty.period = yrs.period
  LEFT JOIN fin ON fin.entity_id = ent.entity_id AND fin.period = yrs.period)
"""


def mart(select: str, *more: str) -> str:
    """A query over the CTE ``star`` and any further CTEs given."""
    return f"WITH {', '.join([MART_SQL, *more])} {select}"


def half_up(total: str, count: str, places: int = 2) -> str:
    """SQL for a non-negative total / count rounded half up."""
    scale = 10**places
    return (
        f"((2 * {scale} * CAST({total} AS BIGINT) + {count}) // (2 * nullif({count}, 0)))::DOUBLE / {scale}"
    )
