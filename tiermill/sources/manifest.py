"""Which landed file is what: kind and period come from the manifest, never from content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.session import literal_rows

SCHEMA = "file_id string, kind string, period int, file_rank int"


def manifest_frame(spark: SparkSession, entries: Sequence[tuple[str, str, int]]) -> DataFrame:
    """Manifest as rows; ``file_rank`` keeps its order."""
    rows = [(*entry, rank) for rank, entry in enumerate(entries)]
    return literal_rows(spark, rows, SCHEMA)


def manifest_join(df: DataFrame, manifest: DataFrame, file_id: str = "file_id") -> DataFrame:
    """Tag rows with kind, period and rank; rows of unlisted files fall out.

    A manifest made of constants is known to be small, so the planner broadcasts it and a
    file with very many rows stays spread over its tasks.
    """
    listed = manifest.withColumnRenamed("file_id", file_id)
    return df.join(listed, file_id, "inner")


def file_id_from_path(df: DataFrame, path: str = "path") -> DataFrame:
    """Add ``file_id``: the base name without its extension."""
    base = F.regexp_extract(F.col(path), r"([^/]+?)(\.[^./]*)?$", 1)
    return df.withColumn("file_id", base)


def ingest_metadata(df: DataFrame, keys: Sequence[str] = ("file_id", "kind", "period")) -> DataFrame:
    """Rows read per file."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def write_metadata(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
