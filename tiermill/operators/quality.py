"""Constraint checks as data: uniqueness, not-null, domain, references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def _per_column(df: DataFrame, tests: Mapping) -> DataFrame:
    """One scan for all columns, then one (column_name, n_bad) row each."""
    counted = df.agg(*[F.count_if(t).alias(c) for c, t in tests.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_bad")) for c in tests])
    return counted.select(F.inline(pairs))


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Null count of each required column."""
    return _per_column(df, {c: F.col(c).isNull() for c in required})


def domain_violations(
    df: DataFrame, lengths: Mapping[str, int] | None = None, decimals: Mapping[str, str] | None = None
) -> DataFrame:
    """Per column, how many texts are too long or numbers do not fit a decimal type."""
    tests = {c: F.coalesce(F.char_length(c) > n, F.lit(False)) for c, n in (lengths or {}).items()}
    for column, kind in (decimals or {}).items():
        tests[column] = F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()
    return _per_column(df, tests)


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is absent from the parent; a null key refers to nothing.

    Parent keys are made distinct first: the duplicates of a hot key are combined before
    the shuffle, and the join then reuses that partitioning.
    """
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def quality_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Number of violations per named check.

    A check is a DataFrame of offending rows, or of ``n_bad`` counts.
    """
    rows = []
    for name, df in checks.items():
        n = F.sum("n_bad") if "n_bad" in df.columns else F.count(F.lit(1))
        rows.append(df.agg(F.coalesce(n, F.lit(0)).alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations"))
    return reduce(DataFrame.unionByName, rows)


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)
