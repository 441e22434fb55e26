"""CSV files with line breaks in quoted cells, read in ranges by many tasks.

Whether a line begins inside a quoted cell depends on all quotes before it. Ranges of a file are
read as plain lines; each range counts its quotes, the counts of the ranges before it are summed
over a table with one row per range, and from the parity of that sum every line knows whether a
record begins or ends with it. A record on one line is done. The lines of a longer record are
gathered under the place of its first line, which for the first lines of a range may be in a range
before it. A quote is a doubled quote or the edge of a cell, as :func:`curated_csv.write_csv` writes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, nth, value, starts, ends``: lines in order within their range, and whether a record starts or ends there."""
    # Within a range lines come in order, so the running id orders them.
    raw = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    raw = raw.withColumn("quotes", quotes.cast("long"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = raw.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    ranges = ranges.select("file", "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before"))
    # A range is what one task reads, and its lines are sorted and numbered by one task.
    inside = Window.partitionBy("file", "block").orderBy("at")
    upto = F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = raw.select("file", "block", F.row_number().over(inside).alias("nth"), "value", "quotes", upto.alias("upto"))
    told = numbered.join(ranges, ["file", "block"]).withColumn("upto", F.col("before") + F.col("upto"))
    return told.select(
        "file", "block", "nth", "value", ((F.col("upto") - F.col("quotes")) % 2 == 0).alias("starts"), (F.col("upto") % 2 == 0).alias("ends")
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, nth, record``: whole records with the place of their first line; empty lines between records are left out."""
    lines = _lines(spark, path)
    done = lines.filter("starts and ends").select("file", "block", "nth", F.col("value").alias("record"))
    place = F.when(F.col("starts"), F.struct("block", "nth"))
    inside = Window.partitionBy("file", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = lines.groupBy("file", "block").agg(F.max(place).alias("last"))  # null in a range within one cell
    carried = last.select("file", "block", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    open_ = lines.withColumn("own", F.last(place, ignorenulls=True).over(inside)).filter("not (starts and ends)")
    placed = open_.join(carried, ["file", "block"]).withColumn("first", F.coalesce("own", "carried"))
    parts = F.sort_array(F.collect_list(F.struct("block", "nth", "value")))
    joined = placed.groupBy("file", "first").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("record"))
    return done.unionByName(joined.select("file", "first.*", "record")).withColumn("record", F.rtrim("record", F.lit("\r"))).filter("record <> ''")


def read_ranges(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """All columns as text, with the file's name in ``_file``. The header is the first line of every file and must have these names."""
    found = spark.read.option("header", True).option("escape", '"').csv(path).columns  # reads one line
    if list(found) != list(names):
        raise ValueError(f"columns {list(found)} of {path} are not {list(names)}")
    schema = ", ".join(f"`{n}` string" for n in names)
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    body = records(spark, path).filter("not (block = 0 and nth = 1)")
    cells: Column = F.from_csv("record", schema, options)
    return body.select(cells.alias("c"), F.element_at(F.split("file", "/"), -1).alias("_file")).select("c.*", "_file")
