"""From a grid of cells to named columns: sheet choice, header row, column search.

A grid has the columns ``file, sheet, sheet_pos, row_idx, cells``. All the layout of a
file is settled by its first ten rows, so only those are aggregated; the data rows are
joined once with that small layout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions.text import header_normalize

SEARCH_ROWS = 10


def _excluded(sheet: Column, words: Sequence[str]) -> Column:
    lowered = F.lower(sheet)
    hit = F.lit(False)
    for word in words:
        hit = hit | lowered.contains(word)
    return hit


def sheet_pick(grid: DataFrame, skip_words: Sequence[str]) -> DataFrame:
    """Per file the first sheet whose name has none of the words, else the first sheet."""
    sheets = grid.groupBy("file", "sheet").agg(F.min("sheet_pos").alias("sheet_pos"))
    order = F.struct(_excluded(F.col("sheet"), skip_words), F.col("sheet_pos"))
    return sheets.groupBy("file").agg(F.min_by("sheet", order).alias("sheet"))


def is_header(cells: Column, any_words: Sequence[str], all_words: Sequence[str]) -> Column:
    """The joined text of a row has one of ``any_words`` and each of ``all_words``."""
    text = F.lower(F.array_join(cells, " "))
    some = F.lit(not any_words)
    for word in any_words:
        some = some | text.contains(word)
    for word in all_words:
        some = some & text.contains(word)
    return F.coalesce(some, F.lit(False))


def header_row_detect(
    grid: DataFrame,
    any_words: Sequence[str],
    all_words: Sequence[str],
    default: int = 7,
    keys: Sequence[str] = ("file",),
) -> DataFrame:
    """Row index of the first header-like row among the first ten, else ``default``."""
    head = grid.filter(F.col("row_idx") < SEARCH_ROWS)
    index = F.when(
        (F.col("row_idx") >= 0) & is_header(F.col("cells"), any_words, all_words),
        F.col("row_idx"),
    )
    return head.groupBy(*keys).agg(
        F.coalesce(F.min(index), F.lit(default)).cast("int").alias("header_row")
    )


def drop_empty_rows(grid: DataFrame) -> DataFrame:
    """Keep rows with at least one filled cell."""
    return grid.filter(F.exists("cells", lambda c: c.isNotNull()))


def data_rows(grid: DataFrame, header_rows: DataFrame) -> DataFrame:
    """Filled rows below the header of their file."""
    below = grid.join(header_rows, "file").filter(F.col("row_idx") > F.col("header_row"))
    return drop_empty_rows(below)


def _holds_all(words: Sequence[str]):
    def test(header: Column) -> Column:
        return reduce(Column.__and__, [header.contains(w) for w in words], F.lit(True))

    return test


def find_column(headers: Column, patterns: Sequence[str]) -> Column:
    """Zero-based position of the column a pattern list points at, null if there is none.

    Headers are normalised already. Patterns are tried in order; within one, the first
    header holding all its words wins.
    """
    found = []
    for pattern in patterns:
        held = F.transform(headers, _holds_all(pattern.lower().split()))
        position = F.array_position(held, F.lit(True))
        found.append(F.when(position > 0, (position - 1).cast("int")))
    return F.coalesce(*found)


def column_resolve(
    headers: DataFrame, roles: Mapping[str, Sequence[str]], column: str = "headers"
) -> DataFrame:
    """Add the position of each role's column. Works row by row, without a shuffle."""
    plain = headers.withColumn("_plain", F.transform(column, header_normalize))
    return plain.withColumns({r: find_column(F.col("_plain"), p) for r, p in roles.items()}).drop("_plain")


def layout(
    grid: DataFrame,
    skip_words: Sequence[str],
    any_words: Sequence[str],
    all_words: Sequence[str],
    default: int = 7,
) -> DataFrame:
    """One row per file: chosen sheet, header row and header cells.

    The header is looked for in the first ``SEARCH_ROWS`` rows; the default may be any row.
    """
    head = grid.filter(F.col("row_idx") < max(SEARCH_ROWS, default + 1))
    index = F.when(
        (F.col("row_idx") >= 0) & (F.col("row_idx") < SEARCH_ROWS) & is_header(F.col("cells"), any_words, all_words),
        F.col("row_idx"),
    )
    filled = F.when(F.col("row_idx") >= 0, F.struct("row_idx", "cells"))
    sheets = head.groupBy("file", "sheet").agg(
        F.min("sheet_pos").alias("sheet_pos"),
        F.coalesce(F.min(index), F.lit(default)).alias("header_row"),
        F.collect_list(filled).alias("top"),
    )
    order = F.struct(_excluded(F.col("sheet"), skip_words), F.col("sheet_pos"))
    picked = sheets.groupBy("file").agg(
        F.min_by(F.struct("sheet", "header_row", "top"), order).alias("p")
    )
    at_header = F.filter("p.top", lambda r: r["row_idx"] == F.col("p.header_row"))
    return picked.select(
        "file",
        F.col("p.sheet").alias("sheet"),
        F.col("p.header_row").cast("int").alias("header_row"),
        F.get(at_header, F.lit(0))["cells"].alias("headers"),
    )


def named_rows(
    grid: DataFrame, layouts: DataFrame, roles: Sequence[str], required: Sequence[str]
) -> DataFrame:
    """Data rows with one column per role; files lacking a required column are ignored.

    ``layouts`` carries ``file, sheet, header_row`` and a position column per role. Each
    optional role also gives ``has_<role>``: whether the file has that column at all.
    """
    usable = layouts.filter(F.expr(" and ".join(f"`{r}` is not null" for r in required)))
    places = usable.select("file", "sheet", "header_row", *[F.col(r).alias(f"_{r}") for r in roles])
    kept = [c for c in grid.columns if c not in ("sheet", "sheet_pos", "cells")]
    rows = grid.filter(F.col("row_idx") >= 0).join(places, ["file", "sheet"])
    rows = drop_empty_rows(rows.filter(F.col("row_idx") > F.col("header_row")))
    present = [F.col(f"_{r}").isNotNull().alias(f"has_{r}") for r in roles if r not in required]
    values = [F.get("cells", F.col(f"_{r}")).alias(r) for r in roles]
    return rows.select(*kept, *values, *present)
