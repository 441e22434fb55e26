"""Documents dealt into groups, and facts about content exchanged between the groups.

Operators that look for content that occurs elsewhere work in passes. Every pass reads the
same groups of documents (one shuffle of the texts, reused). A group states facts about its
content as small binary arrays addressed to slices of a hash space, each content once per
group however often it occurs there, so one very common content adds one entry per group to
its slice. A slice task merges what all groups said and answers each group about its own
content only. No fact is keyed by document, none is sent to the driver, and what a task
holds is bounded by the size of a group or of a slice, whose numbers grow with the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a group; smaller ones are made while there are fewer groups than partitions.
GROUP_BYTES, LEAST_BYTES = 4 << 20, 1 << 19


def grouped(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int, int]:
    """Columns ``g``, ``id`` and ``text``; number of groups; bytes of text."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, math.ceil(size / GROUP_BYTES), min(partitions, math.ceil(size / LEAST_BYTES)))
    group = F.pmod(F.xxhash64("id", "text"), F.lit(groups)).cast("int")
    return rows.withColumn("g", group).repartition(max(partitions, groups // 2), "g"), groups, size


def both(left: DataFrame, right: DataFrame, key: str, step, schema: str) -> DataFrame:
    """``step(left table, right table)`` for every value of ``key``; either table may be empty."""
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(lambda a, b: step(a, b), schema)


def blobs(column: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), dtype) for part in column.chunks for x in part]


def joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    parts = blobs(column, dtype)
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def by_slice(keys: np.ndarray, slices: int) -> list[tuple[int, np.ndarray]]:
    """Slice number and the places of its keys, in their order."""
    number = (keys % np.uint64(slices)).astype(np.int64)
    order = np.argsort(number, kind="stable")
    cuts = np.flatnonzero(np.diff(number[order])) + 1
    return [(int(number[x[0]]), x) for x in np.split(order, cuts) if len(x)]


def records(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    """Rows as a table."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
