"""Commits, tables kept in parts, and several regions in one run."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_sources import PROFILE, book

from tiermill.plans import commits, regional
from tiermill.plans.warehouse import Warehouse

REGIONS = {"bogota": "bogota", "antioquia": "antioquia", "valle": "valle"}


@pytest.fixture
def warehouse(spark, tmp_path):
    names = {layer: f"{layer}_{tmp_path.name}".replace("-", "_") for layer in ("bronze", "silver", "gold", "audit")}
    return Warehouse(spark, str(tmp_path / "wh"), names).create()


def folders(warehouse, layer="gold"):
    top = os.path.join(warehouse.root, layer)
    return sorted(d for d in os.listdir(top) if "__" in d)


def test_interleaved_batches_have_one_winner(spark, warehouse):
    first, second = warehouse.batch("gold"), warehouse.batch("gold")
    for batch, n in ((first, 3), (second, 5)):
        batch.write("t", spark.range(n))
    second.commit()
    with pytest.raises(commits.CommitConflict, match="another load committed 1 while this one was at work on 0"):
        first.commit()
    assert warehouse.read("gold", "t").count() == 5
    assert warehouse.refresh("gold", "t", spark.range(7)) == 7  # a new batch begins on the newest commit


def test_a_number_is_put_once(spark, warehouse):
    files = warehouse.files()
    assert files.put("_commits/gold/x.json", "one") and not files.put("_commits/gold/x.json", "two")
    assert files.read("_commits/gold/x.json") == "one"
    assert [n for n in os.listdir(f"{warehouse.root}/_commits/gold") if "x.json-" in n and not n.endswith(".crc")] == []


def test_only_the_last_two_commits_keep_files(spark, warehouse, monkeypatch):
    """However many commits there are, the files of the log and the versions on disk stay few."""
    monkeypatch.setattr(commits, "EVERY", 3)
    for n in range(14):
        warehouse.refresh("gold", "t", spark.range(n))
        if n % 4 == 0:
            warehouse.refresh("gold", "u", spark.range(n))
    log = warehouse.commits("gold")
    assert log.latest() == 18
    numbers, full = log._listed()
    assert len(numbers) <= 6 and len(full) <= 2
    assert {k: e["version"].split("__")[0] for k, e in log.state().items()} == {"t": "t", "u": "u"}
    assert len(folders(warehouse)) == 3  # two of t and one of u
    assert (warehouse.read("gold", "t").count(), warehouse.read("gold", "u").count()) == (13, 12)
    again = Warehouse(spark, warehouse.root, {k: f"{v}_again" for k, v in warehouse.names.items()}).create()
    assert (again.read("gold", "t").count(), again.read("gold", "u").count()) == (13, 12)
    again.refresh("gold", "t", spark.range(2))
    again.refresh("gold", "t", spark.range(3))
    assert len(folders(warehouse)) == 3  # versions that another session wrote are removed as well


_PROCESS = """
import sys
sys.path[:0] = [{root!r}]
from tiermill.plans.warehouse import Warehouse
from tiermill.session import build_session
spark = build_session("more", spark_master="local[2]", spark_ui_enabled="false", spark_sql_warehouse_dir={spare!r})
warehouse = Warehouse(spark, {wh!r}).create()
for n in range({n}):
    warehouse.refresh("gold", "t", spark.range(n))
print("ROWS", warehouse.read("gold", "t").count())
"""


def test_versions_of_other_processes_are_removed(spark, warehouse, tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    for turn in range(2):
        code = _PROCESS.format(root=str(Path(__file__).parents[1]), spare=str(tmp_path / f"spare{turn}"), wh=warehouse.root, n=6)
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
        assert "ROWS 5" in out.stdout, out.stderr[-2000:]
    warehouse.refresh("gold", "t", spark.range(9))
    assert len(folders(warehouse)) == 2 and warehouse.commits("gold").latest() == 13


def cells(spark, rows):
    return spark.createDataFrame(rows, "v long, period int, region string")


def parts_of(warehouse, table):
    return {tuple(p["values"]): p["folder"] for p in warehouse.commits("gold").state()[table]["parts"]}


def test_parts_are_replaced_or_kept_by_reference(spark, warehouse, rows):
    by = ["period", "region"]
    one = warehouse.batch("gold")
    assert one.write_parts("f", cells(spark, [(1, 2022, "a"), (2, 2023, "a"), (3, 2022, "b's /x=é%"), (4, 2022, "c")]), by, lambda p: True) == 4
    one.commit()
    before = parts_of(warehouse, "f")
    two = warehouse.batch("gold")
    two.write_parts("f", cells(spark, [(10, 2022, "a"), (40, 2022, "c"), (50, 2024, "d")]), by, lambda p: p["region"] in "acd", lambda df: ["c"])
    assert rows(two.read("f")) != rows(warehouse.read("gold", "f"))  # staged, not committed
    two.commit()
    after = parts_of(warehouse, "f")
    assert rows(warehouse.read("gold", "f")) == [(10, 2022, "a"), (3, 2022, "b's /x=é%"), (4, 2022, "c"), (50, 2024, "d")]
    same = {k for k in after if after[k] == before.get(k)}
    assert same == {("2022", "b's /x=é%"), ("2022", "c")}  # not written again; c was refused
    one_cell = warehouse.read("gold", "f").filter("period = 2022 AND region = 'a'")
    assert {os.path.dirname(f).split("/gold/")[1] for f in one_cell.inputFiles()} == {after["2022", "a"]}
    for n in (100, 101, 102):
        more = warehouse.batch("gold")
        more.write_parts("f", cells(spark, [(n, 2022, "a")]), by, lambda p: p["region"] == "a")
        more.commit()
    assert rows(warehouse.read("gold", "f")) == [(102, 2022, "a"), (3, 2022, "b's /x=é%"), (4, 2022, "c"), (50, 2024, "d")]
    state = [set(parts_of(warehouse, "f").values()), *[{p["folder"] for p in s["f"]["parts"]} for _, s in warehouse.commits("gold").states(2)]]
    on_disk = {
        f"{top}/{a}/{b}"
        for top in folders(warehouse)
        if not top.endswith("_all")
        for a in os.listdir(f"{warehouse.root}/gold/{top}")
        if "=" in a
        for b in os.listdir(f"{warehouse.root}/gold/{top}/{a}")
        if "=" in b
    }
    assert on_disk == set.union(*state)
    again = Warehouse(spark, warehouse.root, {k: f"{v}_again" for k, v in warehouse.names.items()}).create()
    assert rows(again.read("gold", "f")) == rows(warehouse.read("gold", "f"))


def landing(folder, scale=1):
    """Two measures for 2023, three regions, one entity in two of them."""
    rows = [
        [1, "Bogotá, D.C.", "Uni A", "Oficial", 10 * scale], [2, "Bogotá D.C.", "Uni A", "Oficial", 5], [3, "Antioquia", "Uni A", "Oficial", 7 * scale],
        [4, "ANTIOQUIA", "Uni B", "Privada", 40], [5, "Valle del Cauca", "Uni C", "Privada", 8], [6, "Chocó", "Uni D", "Privada", 9],
    ]
    folder.mkdir()
    (folder / "articles-421539_recurso.xlsx").write_bytes(book(4, rows))
    (folder / "articles-421822_recurso.xlsx").write_bytes(book(2, [[r[0], r[1], r[2], r[3], 2] for r in rows], amount="No. de Docentes"))
    return str(folder)


def facts(warehouse):
    s = regional.star(warehouse, PROFILE.member_labels)
    return sorted((r.region, r.entity, r.period, r.measure_a, r.measure_b, float(r.ratio)) for r in s.collect())


def test_runs_over_overlapping_regions(spark, warehouse, tmp_path):
    first = regional.ingest(warehouse, landing(tmp_path / "one"), PROFILE, {k: REGIONS[k] for k in ("bogota", "antioquia")})
    assert first == {k: {"status": "success", "rows": n, "problem": ""} for k, n in (("bogota", 1), ("antioquia", 2))}
    assert facts(warehouse) == [
        ("antioquia", "Uni A", 2023, 7, 2, 3.5), ("antioquia", "Uni B", 2023, 40, 2, 20.0), ("bogota", "Uni A", 2023, 15, 4, 3.75),
    ]
    kept = parts_of(warehouse, "region_fact")["2023", "bogota"]
    regional.ingest(warehouse, landing(tmp_path / "two", 2), PROFILE, {k: REGIONS[k] for k in ("valle", "antioquia")})
    assert facts(warehouse) == [
        ("antioquia", "Uni A", 2023, 14, 2, 7.0), ("antioquia", "Uni B", 2023, 40, 2, 20.0), ("bogota", "Uni A", 2023, 15, 4, 3.75),
        ("valle", "Uni C", 2023, 8, 2, 4.0),
    ]
    assert parts_of(warehouse, "region_fact")["2023", "bogota"] == kept
    ids = {(r.entity, r.entity_id) for r in warehouse.read("gold", "region_entity").collect()}
    assert len(ids) == 3  # Uni A has one id in both regions
    dim = {r.region: (r.n_entities, r.n_facts) for r in warehouse.read("gold", "dim_region").collect()}
    assert dim == {"antioquia": (2, 2), "bogota": (1, 1), "valle": (1, 1)}
    assert warehouse.audit_log(50).filter("stage like 'region %' and status = 'success'").count() == 4
    bogota = regional.star(warehouse, PROFILE.member_labels).filter("region = 'bogota'").groupBy("label").agg(F.sum("measure_a")).collect()
    assert len(bogota) == 1


def test_a_failed_region_leaves_the_others(spark, warehouse, tmp_path):
    regional.ingest(warehouse, landing(tmp_path / "one"), PROFILE, REGIONS)
    told = regional.ingest(warehouse, landing(tmp_path / "two", 1000), replace(PROFILE), REGIONS)
    assert told["bogota"]["status"] == told["antioquia"]["status"] == "error" and told["valle"]["status"] == "success"
    assert "do not fit" in told["bogota"]["problem"]
    assert [f for f in facts(warehouse) if f[0] == "bogota"] == [("bogota", "Uni A", 2023, 15, 4, 3.75)]
    assert warehouse.audit_log(50).filter("status = 'error'").count() == 2
    with pytest.raises(ValueError, match="no usable rows"):
        regional.ingest(warehouse, landing(tmp_path / "three"), PROFILE, {"none": "nowhere"})


def test_runs_read_orders_that_are_placed_once(spark):
    from bindings import regions

    sf = "/root/testdata/sf0.001"
    tagged = spark.createDataFrame([("ASIA", "east")], "place string, region string")
    placed = regions._placed_orders(spark, sf)
    landed = regions._landed(placed, tagged, 2)
    assert not [f for f in landed.inputFiles() if "lineitem" in f or "orders" in f]
    assert landed.select("region").distinct().collect() == [("east",)] and placed.select("place").distinct().count() == 5
    warehouse = regions._warehouse(spark, "checked")
    entities, stores = regions.regional.reconcile(landed, replace(regions._PROFILE, kinds=("a", "b")))
    assert all("Aggregate" not in s._jdf.queryExecution().optimizedPlan().toString() for s in stores)
    twice = [s.unionByName(s) for s in stores]
    with pytest.raises(Exception, match="key occurs twice"):  # only stores that are told to be checked are not
        regions.regional.load(warehouse, entities, twice, ratio_kind=regions.RATIO)


def test_layouts_reach_one_folder_and_need_no_exchange(spark):
    from bindings import regions

    sf = "/root/testdata/sf0.001"
    stored = regions.QUERIES["period_region_layout"][0](spark, sf)
    cell = stored.filter("period = 1997 AND region = 'ASIA'")
    wanted = cell._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "period" in wanted and "= 1997" in wanted and "= ASIA" in wanted
    assert cell.count() > 0
    plan = regions.QUERIES["region_bucket_rollup"][0](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_only_changed_periods_are_ranked_again(spark, warehouse, rows):
    from tiermill.operators.ranking import with_ranks
    from tiermill.plans import rank_store

    cells = [(i, 2020 + i % 3, None if i % 7 == 0 else (i * 37 % 23)) for i in range(300)]
    table = lambda data: spark.createDataFrame([(i, p, r) for i, p, r in data], "entity_id int, period int, ratio int").select(
        "entity_id", "period", F.col("ratio").cast("decimal(5,2)")
    )
    names = {"rank_desc": "rank_desc", "rank_asc": "rank_asc"}
    rank_store.create(warehouse, table(cells))
    first = parts_of(warehouse, "value_rank")
    assert set(first) == {("2020",), ("2021",), ("2022",)}
    assert rows(rank_store.with_stored_ranks(warehouse, table(cells))) == rows(with_ranks(table(cells), "ratio", names))
    gone = [c for c in cells if c[1] == 2021 and c[0] < 60]
    new = [(i, p, None if r is not None and r > 11 else 99) for i, p, r in gone[5:]] + [(900, 2021, 5), (901, 2021, 5)]
    after = [c for c in cells if c not in gone] + new
    assert rank_store.refresh(warehouse, table(gone), table(new)) == [2021]
    second = parts_of(warehouse, "value_rank")
    assert {k for k in second if second[k] != first[k]} == {("2021",)}
    assert rows(rank_store.with_stored_ranks(warehouse, table(after))) == rows(with_ranks(table(after), "ratio", names))
    assert rank_store.refresh(warehouse, table([]), table([])) == []
    with pytest.raises(ValueError, match="are gone than there were"):
        rank_store.refresh(warehouse, table([(1, 2022, 98)]), table([]))
