"""Upserts that rewrite only the files a batch can touch.

A table is kept in pieces, one file each, dealt into slices by a hash of the key and cut by key
range within a slice. The commit names the pieces; a table of statistics has for each its least
and largest key, its number of rows and a Bloom filter over its keys, made of Spark's bitmaps.
A batch is cut by key range as the table is, and a batch key meets only the pieces of its own slice whose range
its cut overlaps. Those that may hold it, by range and filter, are read, merged and written anew; the others are kept by reference, and so are those of slices that
no batch key is in. Keys that no piece can hold are inserted with them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.operators.keys import single_or_raise, upsert_merge
from tiermill.plans.warehouse import Batch, Warehouse
from tiermill.session import freeze, freeze_counted

#: Bits of a filter per key, and of one of Spark's bitmaps.
BITS_PER_KEY, BITMAP = 10, 32768
_PARTS = ("key_slice", "key_piece")


def _hashes(key: Sequence[str]) -> tuple[Column, Column]:
    return F.xxhash64(*key), F.xxhash64(F.lit("second"), *key)


def _with_slice(df: DataFrame, key: Sequence[str], slices: int) -> DataFrame:
    return df.withColumn("key_slice", F.pmod(F.xxhash64(F.lit("slice"), *key), F.lit(slices)).cast("int"))


def _bit(bitmaps: Column, place: Column) -> Column:
    """Whether a bit is set in a map of bitmaps; a bitmap that is not there has none."""
    bitmap = F.try_element_at(bitmaps, F.floor(place / BITMAP).cast("int"))
    inside = (place % BITMAP).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(inside / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.shiftright(byte, 0).bitwiseAND(F.pow(F.lit(2), inside % 8).cast("int")) > 0, F.lit(False))


def _bounds(key: Sequence[str], low: str, high: str) -> tuple[Column, Column]:
    own = F.struct(*key)
    return F.min(own).alias(low), F.max(own).alias(high)


def statistics(pieces: DataFrame, key: Sequence[str]) -> DataFrame:
    """``key_slice, key_piece, low, high, n, size, filter`` of every piece; ``size`` is in bitmaps."""
    ranges = pieces.groupBy(*_PARTS).agg(*_bounds(key, "low", "high"), F.count(F.lit(1)).alias("n"))
    sized = ranges.withColumn("size", F.greatest(F.lit(1), F.ceil(F.col("n") * BITS_PER_KEY / BITMAP)).cast("int"))
    places = F.array(*[F.pmod(h, F.col("size") * F.lit(BITMAP)) for h in _hashes(key)])
    keyed = pieces.select(*_PARTS, *key).join(sized.select(*_PARTS, "size"), list(_PARTS))
    bits = keyed.select(*_PARTS, F.explode(places).alias("place"))
    # Spark's bitmap positions are within one bitmap of 32768 bits.
    maps = bits.groupBy(*_PARTS, F.floor(F.col("place") / BITMAP).cast("int").alias("number")).agg(
        F.bitmap_construct_agg((F.col("place") % BITMAP)).alias("bitmap")
    )
    filters = maps.groupBy(*_PARTS).agg(F.map_from_entries(F.collect_list(F.struct("number", "bitmap"))).alias("filter"))
    return sized.join(filters, list(_PARTS))


def _cut(rows: DataFrame, key: Sequence[str], count: int, load: str) -> DataFrame:
    """``rows`` with the name of the piece each goes to: a range of keys of a slice."""
    return freeze(rows.repartitionByRange(count, "key_slice", *key).withColumn("key_piece", F.concat_ws("-", F.lit(load), "key_slice", F.spark_partition_id())))


def _stage(batch: Batch, table: str, rows: DataFrame, key: Sequence[str], gone: set[str], old_stats: DataFrame | None) -> None:
    """New pieces in place of those that are gone, with their statistics in place of those of the slices they are in."""
    batch.write_parts(table, rows, list(_PARTS), lambda p: p["key_piece"] in gone, gathered=True)
    fresh = statistics(rows, key)
    slices = {str(r[0]) for r in rows.select("key_slice").distinct().collect()}
    if old_stats is not None:
        slices |= {p["key_slice"] for p in _parts(batch.warehouse, batch.layer, table) if p["key_piece"] in gone}
        kept = old_stats.filter(F.col("key_slice").cast("string").isin(*slices) & ~F.col("key_piece").isin(*gone))
        fresh = freeze(fresh.unionByName(kept))
    batch.write_parts(f"{table}_stats", fresh, ["key_slice"], lambda p: p["key_slice"] in slices)


def _parts(warehouse: Warehouse, layer: str, table: str) -> list[dict[str, str]]:
    entry = warehouse.commits(layer).state()[table]
    return [dict(zip(entry["partition_by"], p["values"])) for p in entry["parts"]]


def create(warehouse: Warehouse, layer: str, table: str, df: DataFrame, key: Sequence[str], slices: int, piece_rows: int) -> None:
    """A table in pieces of about ``piece_rows`` rows. Its key must be unique; a repeated one fails the job."""
    rows, n = freeze_counted(_with_slice(single_or_raise(df, key), key, slices))
    batch = warehouse.batch(layer)
    load = str(batch.parent + 1)
    _stage(batch, table, _cut(rows, key, max(1, math.ceil(n / piece_rows)), load), key, set(), None)
    batch.commit()


def read(warehouse: Warehouse, layer: str, table: str) -> DataFrame:
    return warehouse.read(layer, table).drop(*_PARTS)


def may_hold(keys: DataFrame, stats: DataFrame, key: Sequence[str], chunk: str | None = None) -> DataFrame:
    """``key_slice, key_piece`` for every key and piece that may hold it: by slice, then range, then filter.

    ``chunk`` names a column of ``keys`` whose values are ranges of keys of a slice. The ranges of chunks, one row
    each, are then compared with those of pieces, and a key meets only the few pieces that its chunk overlaps.
    """
    own, (first, second) = F.struct(*key), _hashes(key)
    inside = (own >= F.col("low")) & (own <= F.col("high"))
    if chunk:
        bounds = keys.groupBy("key_slice", chunk).agg(*_bounds(key, "_least", "_most"))
        ranges = stats.select(*_PARTS, "low", "high")
        near = bounds.join(ranges, "key_slice").filter((F.col("_least") <= F.col("high")) & (F.col("_most") >= F.col("low")))
        met = keys.join(near.select("key_slice", chunk, "key_piece", "low", "high"), ["key_slice", chunk]).filter(inside)
        met = met.select(*_PARTS, *key).join(stats.select(*_PARTS, "size", "filter"), list(_PARTS))
    else:
        met = keys.join(stats, "key_slice").filter(inside)
    room = F.col("size") * F.lit(BITMAP)
    return met.filter(_bit(F.col("filter"), F.pmod(first, room)) & _bit(F.col("filter"), F.pmod(second, room))).select(*_PARTS, *key)


def upsert(
    warehouse: Warehouse, layer: str, table: str, df: DataFrame, key: Sequence[str], slices: int, piece_rows: int,
    touched: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Insert or update the rows of a batch; a key that occurs twice in it fails the job.

    Gives the number of pieces before, of those rewritten and of rows written. The names of the pieces
    to be rewritten come to the driver, as the commit has to name them anyway.
    """
    batch = warehouse.batch(layer)
    rows, n = freeze_counted(_with_slice(single_or_raise(df, key), key, slices))
    before = len(_parts(warehouse, layer, table))
    if not n:
        return {"pieces": before, "rewritten": 0, "rows": 0}
    stats = warehouse.read(layer, f"{table}_stats")
    chunks = _cut(rows.select("key_slice", *key), key, max(1, math.ceil(n / piece_rows)), "batch").withColumnRenamed("key_piece", "_chunk")
    gone = {r.key_piece for r in may_hold(chunks, stats, key, "_chunk").select("key_piece").distinct().collect()}
    current = warehouse.read(layer, table)
    old = current.filter(F.col("key_piece").isin(*gone)) if gone else current.limit(0)  # a filter on partitions
    merged, total = freeze_counted(upsert_merge(old.drop("key_piece"), rows, [*key, "key_slice"], touched, checked=True))
    _stage(batch, table, _cut(merged, key, max(1, math.ceil(total / piece_rows)), str(batch.parent + 1)), key, gone, stats)
    batch.commit()
    return {"pieces": before, "rewritten": len(gone), "rows": total}
