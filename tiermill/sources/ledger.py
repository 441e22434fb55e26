"""What became of every landed file: one row each, with the reason where it was left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ("file", "file_id", "kind", "period", "sheet", "outcome", "detail", "n_rows")
#: Outcomes in the order in which they are tested; a file without a column of role r is "no r column".
UNLISTED, DAMAGED, HEADLESS, EMPTY, LOADED = "unlisted", "damaged", "no header", "no rows", "loaded"


def ingest_ledger(
    files: DataFrame, listed: DataFrame, damaged: DataFrame, layouts: DataFrame, counts: DataFrame, required: Sequence[str]
) -> DataFrame:
    """``file, file_id, kind, period, sheet, outcome, detail, n_rows``.

    ``files`` has ``file, file_id``; ``listed`` is the manifest, ``file_id, kind, period``; ``damaged`` has
    ``file, error``; ``layouts`` has ``file, sheet, headers`` and a position for each role, null where the file lacks
    the column; ``counts`` has ``file, n_rows``, the rows of the region, and no row where there are none. All have a
    row per file at most and are joined by file, so a ledger of very many files is spread like any table.
    """
    known = listed.select("file_id", "kind", "period", F.lit(True).alias("_listed"))
    broken = damaged.groupBy("file").agg(F.min("error").alias("_error"))
    placed = layouts.select("file", "sheet", F.col("headers").isNotNull().alias("_headed"), *[F.col(r).isNotNull().alias(f"_{r}") for r in required])
    told = files.join(known, "file_id", "left").join(broken, "file", "left").join(placed, "file", "left").join(counts, "file", "left")
    outcome = F.when(F.col("_listed").isNull(), UNLISTED).when(F.col("_error").isNotNull(), DAMAGED)
    outcome = outcome.when(~F.coalesce("_headed", F.lit(False)), HEADLESS)
    for role in required:
        outcome = outcome.when(~F.col(f"_{role}"), f"no {role} column")
    outcome = outcome.when(F.coalesce("n_rows", F.lit(0)) == 0, EMPTY).otherwise(LOADED)
    named = told.withColumns({"outcome": outcome, "detail": F.when(outcome == DAMAGED, F.col("_error"))})
    return named.withColumn("n_rows", F.when(F.col("outcome") == LOADED, F.col("n_rows")).otherwise(0).cast("long")).select(*COLUMNS)
