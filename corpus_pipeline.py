"""A training-data pipeline over ``documents`` in five written stages.

Rejected documents go, one of each group of near duplicates stays, documents that hold a
benchmark item go, personal data is masked, and sources are mixed to target weights.
Every stage reads what its predecessor wrote as Parquet. Input rows may be empty, null or
repeated; each stage states what it does with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm import leaks, mixing, neardup, pii, quality
from tiermill.session import freeze, freeze_counted


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group; of rows that repeat its id, one.

    A row without an id goes if a row with one is in its group, and stays otherwise. Rows are
    judged one by one: a row that goes takes no other row of its id, or without an id, with it.
    Of rows with one id that are left in several groups, the one with most shingles stays.
    """
    _, found = freeze_counted(docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").select("doc_id"))
    if not found:  # ids are keys of rows
        gone, count = freeze_counted(neardup.link(docs).filter("not kept").select("doc_id"))
        if count <= neardup.BROADCAST_ROWS:  # then the documents stay where they are
            gone = F.broadcast(gone)
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    key = "_row"
    while key in docs.columns:
        key += "_"
    rows = freeze(docs.withColumn(key, F.monotonically_increasing_id()))
    linked = neardup.link(rows, doc_id=key).select(key, "n_shingles", F.col("component_id").alias("_group"))
    linked = freeze(linked.join(rows.select(key, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash")), key))
    least = linked.groupBy("_group").agg(F.min("_id").alias("_least"))
    judged = linked.join(least, "_group").withColumn("_stays", F.coalesce(F.col("_id") == F.col("_least"), F.col("_least").isNull()))
    judged = freeze(judged.select(key, "_id", "n_shingles", "_hash", "_stays"))
    # Of rows with one id one stays; an id with many rows is combined in every task first.
    order = F.struct(-F.col("n_shingles"), "_hash", key)
    first = judged.filter("_stays and _id is not null").groupBy("_id").agg(F.min(order)[key].alias(key))
    unnamed = judged.filter("_stays and _id is null").select(key)
    gone = judged.select(key).join(first.select(key).unionByName(unnamed), key, "left_anti")
    return rows.join(gone, key, "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a leaked benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return leaks.drop_leaks(docs, leaks.question_and_answer(items))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked, and their new lengths."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, mixed to the target weights and shuffled."""
    return mixing.replicate(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("source mix", source_mix),
]

#: The trained model of the fourth stage cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
