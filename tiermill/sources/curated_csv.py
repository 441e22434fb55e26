"""The curated CSV between reconciliation and the warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermill.functions.numeric import fit_decimal, parse_integer, parse_number
from tiermill.sources.csv_ranges import read_ranges

COLUMNS = ("entity", "period", "measure_a", "measure_b", "ratio", "category", "label")

# Texts a spreadsheet export uses for a missing value; fixed by the format.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def write_csv(df: DataFrame, path: str, names: Mapping[str, str] | None = None, ranges: int | None = None) -> int:
    """Sorted by period and entity, quoted, with a header. ``names`` renames columns.

    The other columns settle ties, so that many rows of one name and period are dealt over several tasks. ``ranges`` sets the number of sorted ranges, for rows whose sizes differ much.
    Gives the row count. It is observed above the sort, because the sort also reads its
    input once to sample the ranges.
    """
    names = names or {}
    order = ["period", "entity", *[c for c in COLUMNS if c not in ("period", "entity")]]
    rows = df.select(*COLUMNS)
    ordered = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order) if ranges else rows.orderBy(*order)
    renamed = ordered.select(*[F.col(c).alias(names.get(c, c)) for c in COLUMNS])
    counted = Observation()
    renamed.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").csv(
        path,
        header=True,
        quoteAll=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return counted.get["n"]


def read_csv(spark: SparkSession, path: str, names: Mapping[str, str] | None = None, by_range: bool = False) -> DataFrame:
    """All columns as text, missing values as '', plus the source file's base name.

    Cells may hold line breaks. A hand-off of many files is read in parallel as it is;
    ``by_range`` reads a large file by many tasks, at the cost of a shuffle.
    """
    names = names or {}
    told = [names.get(c, c) for c in COLUMNS]
    if by_range:
        raw = read_ranges(spark, path, told).withColumnRenamed("_file", "source_file")
    else:
        schema = ", ".join(f"`{n}` string" for n in told)
        raw = spark.read.schema(schema).csv(path, header=True, escape='"', enforceSchema=False, multiLine=True)
        raw = raw.select("*", F.col("_metadata.file_name").alias("source_file"))
    cells = [missing_to_empty(F.col(f"`{n}`")).alias(c) for c, n in zip(COLUMNS, told)]
    return raw.select(*cells, "source_file")


def missing_to_empty(text: Column) -> Column:
    return F.when(text.isNull() | text.isin(*NULL_TOKENS), "").otherwise(text)


def typed_parse(
    df: DataFrame, ratio_kind: str = "decimal(5,2)", on_overflow: str = "raise"
) -> DataFrame:
    """Typed columns plus ``errors``; '' means missing, except in ``period``.

    A row with any error is a reject; no row fails the job.
    """
    whole = {f"_{c}": parse_integer(F.col(c)) for c in ("period", "measure_a", "measure_b")}
    typed = df.withColumns({**whole, "_number": parse_number(F.col("ratio"))})  # each text is parsed once

    def failed(name: str, parsed: str, blank_ok: bool) -> Column:
        text = F.coalesce(F.col(name), F.lit(""))
        bad = F.col(parsed).isNull() & (F.lit(not blank_ok) | (text != ""))
        return F.when(bad, F.concat(F.lit(f"{name}: '"), text, F.lit("'")))

    problems = F.array_compact(
        F.array(
            failed("measure_a", "_measure_a", True),
            failed("measure_b", "_measure_b", True),
            failed("ratio", "_number", True),
            failed("period", "_period", False),
        )
    )
    checked = typed.withColumn("errors", problems)
    stored = F.when(F.size("errors") == 0, F.round(F.col("_number").cast("decimal(38,10)"), 2))
    columns = [*df.columns, "errors", *whole]
    return checked.select(*columns, stored.alias("_stored")).select(
        *columns, fit_decimal(F.col("_stored"), ratio_kind, on_overflow).alias("_ratio")
    )


_TYPED = ("period", "measure_a", "measure_b", "ratio")


def _plain(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if not c.startswith("_") and c != "errors"]


def good_columns(columns: Sequence[str]) -> dict[str, str]:
    """Name to SQL expression of a parsed row that is good: its typed values."""
    return {c: f"`_{c}`" if c in _TYPED else f"`{c}`" for c in _plain(columns)}


def reject_columns(columns: Sequence[str]) -> dict[str, str]:
    """Name to SQL expression of a reject: its original text and the error list."""
    return {c: f"`{c}`" for c in [*_plain(columns), "errors"]}


def good_rows(parsed: DataFrame) -> DataFrame:
    """Rows that parsed, under their typed values."""
    chosen = good_columns(parsed.columns)
    return parsed.filter("size(errors) = 0").select(*[F.expr(e).alias(c) for c, e in chosen.items()])


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """Rows that did not parse, as the original text plus the error list."""
    return parsed.filter("size(errors) > 0").select(*reject_columns(parsed.columns))


def split_form(parsed: DataFrame) -> DataFrame:
    """Parsed rows as one table: ``is_good`` tells the two kinds apart, and the text of
    numbers is kept for rejects, and for a good row's ratio that its column cannot hold."""
    bad = F.size("errors") > 0
    texts = {c: F.when(bad, F.col(c)) for c in _TYPED}
    texts["ratio"] = F.when(bad | (F.col("_ratio").isNull() & (F.col("ratio") != "")), F.col("ratio"))
    return parsed.withColumns({**texts, "is_good": ~bad})
