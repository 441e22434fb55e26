"""Upserts into tables kept in pieces: equal to a full merge, and only touched pieces are written."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tiermill.plans import upserts
from tiermill.plans.warehouse import Warehouse

KEY, SCHEMA = ["a", "b"], "a long, b string, v long"


@pytest.fixture
def warehouse(spark, tmp_path):
    names = {layer: f"{layer}_{tmp_path.name}".replace("-", "_") for layer in ("bronze", "silver", "gold", "audit")}
    return Warehouse(spark, str(tmp_path / "wh"), names).create()


def pieces(warehouse):
    return {(p["key_slice"], p["key_piece"]) for p in upserts._parts(warehouse, "gold", "t")}


def test_batches_equal_full_merges(spark, warehouse):
    draw = random.Random(3)
    held = {(i, f"k{i % 7}"): i for i in range(3000)}
    frame = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], SCHEMA)
    upserts.create(warehouse, "gold", "t", frame(held), KEY, 4, 100)
    first = pieces(warehouse)
    assert len(first) >= 30
    for turn in range(3):
        batch = {(i, f"k{i % 7}"): -turn - 1 for i in draw.sample(range(3000), 3)}
        batch |= {(5000 + 10 * turn + i, "new"): turn for i in range(2)}
        before = pieces(warehouse)
        told = upserts.upsert(warehouse, "gold", "t", frame(batch), KEY, 4, 100)
        held |= batch
        assert told["pieces"] == len(before) and 1 <= told["rewritten"] <= 6
        assert len(before - pieces(warehouse)) == told["rewritten"]  # all others are the same files
        assert {tuple(r) for r in upserts.read(warehouse, "gold", "t").collect()} == {(*k, v) for k, v in held.items()}
        stats = warehouse.read("gold", "t_stats")
        assert {(str(r.key_slice), r.key_piece) for r in stats.collect()} == pieces(warehouse)
        assert stats.agg(F.sum("n")).first()[0] == len(held)
    none = upserts.upsert(warehouse, "gold", "t", frame(held).limit(0), KEY, 4, 100)
    assert none == {"pieces": len(pieces(warehouse)), "rewritten": 0, "rows": 0}


def test_new_keys_in_range_rewrite_little(spark, warehouse):
    """The filter tells keys that are in the range of a piece but not in it."""
    upserts.create(warehouse, "gold", "t", spark.range(0, 20000, 2).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.col("id").alias("v")), KEY, 2, 500)
    batch = spark.range(1, 4000, 200).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(0).cast("long").alias("v"))
    told = upserts.upsert(warehouse, "gold", "t", batch, KEY, 2, 500)
    assert told["pieces"] >= 20 and told["rewritten"] <= 4
    assert upserts.read(warehouse, "gold", "t").count() == 10020


def test_repeated_key_fails(spark, warehouse):
    rows = spark.createDataFrame([(1, "x", 1), (1, "x", 2)], SCHEMA)
    with pytest.raises(Exception, match="key occurs twice"):
        upserts.create(warehouse, "gold", "t", rows, KEY, 2, 10)


def test_large_filters_have_several_bitmaps(spark):
    rows = spark.range(10_000).select(F.lit(0).alias("key_slice"), F.lit("p").alias("key_piece"), F.col("id").alias("k"))
    stats = upserts.statistics(rows, ["k"])
    assert stats.first()["size"] == 4
    keys = spark.range(20_000).select(F.lit(0).alias("key_slice"), F.col("id").alias("k"))
    found = upserts.may_hold(keys, stats.withColumn("high", F.struct(F.lit(10**6).cast("long").alias("k"))), ["k"]).groupBy((F.col("k") < 10_000).alias("own")).count()
    counts = {r.own: r["count"] for r in found.collect()}
    assert counts[True] == 10_000 and counts.get(False, 0) < 1000


def test_chunks_meet_the_same_pieces(spark):
    """A batch cut by key range finds the pieces that comparing each key with every piece finds, by joins on cut and piece."""
    rows = spark.range(6000).select((F.col("id") % 2).cast("int").alias("key_slice"), F.concat(F.lit("p"), F.floor(F.col("id") / 500)).alias("key_piece"), F.col("id").alias("k"))
    stats = upserts.statistics(rows, ["k"])
    keys = spark.range(0, 9000, 7).select((F.col("id") % 2).cast("int").alias("key_slice"), F.col("id").alias("k"), F.floor(F.col("id") / 1100).alias("_chunk"))
    told = lambda df: sorted(map(tuple, df.select("key_slice", "key_piece", "k").collect()))
    found = upserts.may_hold(keys, stats, ["k"], "_chunk")
    assert told(found) == told(upserts.may_hold(keys, stats, ["k"])) and found.count() >= 800
    assert "_chunk" in found._jdf.queryExecution().optimizedPlan().toString()


def test_upsert_probes_by_chunks(spark, warehouse, monkeypatch):
    asked, probe = [], upserts.may_hold
    monkeypatch.setattr(upserts, "may_hold", lambda keys, *more: asked.append(keys.columns) or probe(keys, *more))
    frame = spark.range(4000).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.col("id").alias("v"))
    upserts.create(warehouse, "gold", "t", frame, KEY, 2, 500)
    told = upserts.upsert(warehouse, "gold", "t", frame.filter("a < 3000").withColumn("v", F.lit(-1).cast("long")), KEY, 2, 500)
    assert "_chunk" in asked[0] and told["rewritten"] >= 5
    assert upserts.read(warehouse, "gold", "t").agg(F.count("*"), F.count_if(F.col("v") == -1)).first() == (4000, 3000)
