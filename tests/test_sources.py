from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from bindings.landing import book_bytes
from tiermill.plans import medallion
from tiermill.plans.warehouse import Warehouse
from tiermill.profile import HIGHER_EDUCATION as PROFILE
from tiermill.sources import curated_csv, grid, manifest, workbook

HEADER = ["Código", "Departamento de domicilio de la IES", "Institución de  Educación\nSuperior (IES)", "Sector IES"]


def book(header_row, rows, amount="Matriculados", sheets=("Índice", "Datos"), category=True):
    head = HEADER[: 4 if category else 3] + [amount]
    body = [(header_row, head)] + [(header_row + 1 + i, r) for i, r in enumerate(rows)]
    filler = [(i, [f"titulo {i}"]) for i in range(header_row)]
    return book_bytes({sheets[0]: [(0, ["nada"])], sheets[1]: filler + body})


@pytest.fixture
def landing(tmp_path):
    """Students and teachers of 2024, students of 2022 without a category column, one
    damaged file, one file without a region column and one that is not listed."""
    region = "Bogotá D.C."
    files = {
        "articles-425156_recurso": book(
            4,
            [[1, region, "Uni A", "Privado", 8], [2, region, "Uni B,", "Oficial", 0], [3, "Antioquia", "Uni Z", "Oficial", 5]],
            amount="No. de Docentes",
        ),
        "articles-425151_recurso": book(
            2,
            [
                [1, region, "Uni A", "Oficial", 100],
                [None, None, None, None, None],
                [2, "BOGOTA", "Uni  B", "Oficial", "50"],
                [2, "BOGOTA", "Uni  B", "Oficial", "x"],
                [3, region, "UNIVERSIDAD NACIONAL DE COLOMBIA -", "Oficial", 7.5],
                [3, region, "UNIVERSIDAD NACIONAL DE COLOMBIA -", "Oficial", 7.5],
            ],
        ),
        "articles-416244_recurso": book(7, [[1, region, "Uni A", 70]], category=False),
        "articles-421822_recurso": b"not a zip file",
        "articles-416249_recurso": book_bytes({"Hoja": [(7, ["Institución", "departamento", "docentes"]), (8, ["x", "y", 1])]}),
        "other": book(4, [[1, region, "Uni X", "Privado", 8]]),
    }
    folder = tmp_path / "landing"
    folder.mkdir()
    for name, content in files.items():
        (folder / f"{name}.xlsx").write_bytes(content)
    return str(folder)


def test_scan_reads_files_and_flags_damage(spark, landing):
    cells = workbook.workbook_scan(workbook.workbook_files(spark, landing))
    bad = workbook.unreadable(cells).collect()
    assert len(bad) == 1 and "421822" in bad[0].file and "BadZipFile" in bad[0].error
    good = workbook.readable(cells)
    marks = good.filter("row_idx = -1 and file like '%425151%'").orderBy("sheet_pos")
    assert [r.sheet for r in marks.collect()] == ["Índice", "Datos"]
    row = good.filter("row_idx = 3 and file like '%425151%'").first()
    assert row.cells == ["1", "Bogotá D.C.", "Uni A", "Oficial", "100"]


def test_cell_kinds(spark):
    import io
    import zipfile

    source = io.BytesIO(book_bytes({"S": []}))
    made = io.BytesIO()
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(source) as old, zipfile.ZipFile(made, "w") as new:
        for name in old.namelist():
            if "sheet1" not in name:
                new.writestr(name, old.read(name))
        new.writestr(
            "xl/sharedStrings.xml",
            f'<sst xmlns="{main}"><si><t>uno</t></si><si><r><t>do</t></r><r><t>s</t></r><rPh><t>no</t></rPh></si></sst>',
        )
        new.writestr(
            "xl/worksheets/sheet1.xml",
            f"""<worksheet xmlns="{main}"><sheetData><row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2"><v>3.5</v></c>
            <c r="D2" t="b"><v>1</v></c><c r="E2" t="e"><v>#REF!</v></c><c r="AA2" t="str"><v>z</v></c></row>
            <row><c><v>4</v></c><c t="str"><v>N/A</v></c></row></sheetData></worksheet>""",
        )
    files = spark.createDataFrame([("f", bytearray(made.getvalue()))], "path string, content binary")
    rows = workbook.workbook_scan(files).filter("row_idx >= 0").orderBy("row_idx").collect()
    assert rows[0].cells == ["dos", None, "3.5", "True"] + [None] * 22 + ["z"]
    assert (rows[1].row_idx, rows[1].cells) == (2, ["4", None])


def test_sheet_pick(spark, rows):
    df = spark.createDataFrame(
        [("f", "Índice", 0), ("f", "Datos 2024", 1), ("g", "Resumen", 0), ("g", "Tabla 1", 1)],
        "file string, sheet string, sheet_pos int",
    )
    assert rows(grid.sheet_pick(df, PROFILE.skip_sheets)) == [("f", "Datos 2024"), ("g", "Resumen")]


def test_header_row(spark, rows):
    data = [("f", i, ["x"]) for i in range(12)] + [("f", 4, ["Código", None, "Departamento"]), ("f", 6, ["código", "departamento"])]
    data += [("g", 0, ["nada"]), ("g", 11, ["código", "departamento"])]
    df = spark.createDataFrame(data, "file string, row_idx int, cells array<string>")
    got = grid.header_row_detect(df, PROFILE.header_any, PROFILE.header_all)
    assert rows(got) == [("f", 4), ("g", 7)]


def test_a_late_default_header_row(spark, rows):
    """A default row beyond those that are searched is still found."""
    cells = [("f", "s", 0, i, ["x", "y"] if i != 12 else ["Departamento", "Name"]) for i in range(15)]
    table = spark.createDataFrame(cells, "file string, sheet string, sheet_pos int, row_idx int, cells array<string>")
    got = grid.layout(table, [], ["nothing"], ["departamento"], 12).first()
    assert (got.header_row, got.headers) == (12, ["Departamento", "Name"])
    table = table.withColumn("cells", F.when(F.col("row_idx") == 11, F.array(F.lit("departamento nothing"))).otherwise(F.col("cells")))
    assert grid.layout(table, [], ["nothing"], ["departamento"], 12).first().header_row == 12


def test_column_priority(spark):
    headers = ["Estudiantes inscritos", "matriculados  total", "IES sector\n"]
    df = spark.createDataFrame([(headers,)], "headers array<string>")
    got = grid.column_resolve(
        df, {"amount": PROFILE.amount_patterns["estudiantes"], "category": PROFILE.category_patterns, "none": ("zzz",)}
    ).first()
    assert (got.amount, got.category, got.none) == (1, 2, None)


def test_manifest(spark, rows):
    df = spark.createDataFrame([("/x/a.b.xlsx",), ("s3://y/c.xlsx",), ("/x/plain",)], "path string")
    named = manifest.file_id_from_path(df)
    assert rows(named, "file_id") == [("a.b",), ("c",), ("plain",)]
    listed = manifest.manifest_frame(spark, [("c", "a", 2024), ("gone", "b", 2024), ("a.b", "b", 2022)])
    joined = manifest.manifest_join(named, listed)
    assert rows(joined, "file_id", "kind", "file_rank") == [("a.b", "b", 2), ("c", "a", 0)]


def test_metadata_sink(spark, tmp_path):
    df = spark.createDataFrame([("f", "a", 2024)] * 3, "file_id string, kind string, period int")
    manifest.write_metadata(manifest.ingest_metadata(df), str(tmp_path / "meta"))
    (part,) = (tmp_path / "meta").glob("*.json")
    assert json.loads(part.read_text()) == {"file_id": "f", "kind": "a", "period": 2024, "n_rows": 3}


def test_typed_parse(spark, rows):
    data = [
        ("U1", "2022", "100", "8", "12.5"), ("U2", "2022", "", "5", ""), ("U3", "", "1", "1", "1"),
        ("U4", "2022", "12.0", "1", "12"), ("U5", "2022", "abc", "1", "1"),
    ]
    df = spark.createDataFrame(data, "entity string, period string, measure_a string, measure_b string, ratio string")
    parsed = curated_csv.typed_parse(df)
    good = {r.entity: r for r in curated_csv.good_rows(parsed).collect()}
    assert set(good) == {"U1", "U2"}
    assert (good["U2"].measure_a, good["U2"].measure_b, good["U2"].ratio) == (None, 5, None)
    bad = {r.entity: r.errors for r in curated_csv.rejected_rows(parsed).collect()}
    assert bad == {"U3": ["period: ''"], "U4": ["measure_a: '12.0'"], "U5": ["measure_a: 'abc'"]}


def test_csv_null_tokens_and_blanks(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text(
        'nombre_ies,año,total_estudiantes,total_docentes,estudiantes_por_docente,sector_ies,clasificacion_sue\n'
        '" Uni ""A"", norte",2024,NA,8,,"","No SUE"\n',
        encoding="utf-8",
    )
    got = curated_csv.read_csv(spark, str(path), PROFILE.csv_names)
    assert rows(got) == [(' Uni "A", norte', "2024", "", "8", "", "", "No SUE", "in.csv")]


@pytest.fixture
def warehouse(spark, tmp_path):
    tag = tmp_path.name.replace("-", "_")
    names = {layer: f"{layer}_{tag}" for layer in ("bronze", "silver", "gold", "audit")}
    return Warehouse(spark, str(tmp_path / "wh"), names).create()


def test_workbooks_to_gold(spark, landing, warehouse, tmp_path, rows):
    csv_path = str(tmp_path / "curated")
    told = medallion.ingest(warehouse, landing, csv_path, PROFILE)
    # Three names, two periods seen in usable files.
    assert told["curated"] == 6 and told["unreadable"] == 1
    lines = sorted(line for p in (tmp_path / "curated").glob("*.csv") for line in p.read_text().splitlines()[1:])
    assert [line for line in lines if line.startswith('"Uni A","2022"')] == ['"Uni A","2022","70","0","","Oficial","No SUE"']

    summary = medallion.load(warehouse, csv_path, PROFILE, buckets=4)
    assert summary["status"] == "success" and summary["errors"] == []
    assert (summary["bronze"], summary["entities"], summary["gold"]) == (6, 3, 6)
    assert warehouse.read("bronze", "unreadable").select("file").distinct().count() == 1
    codes = dict(warehouse.read("gold", "dim_entity").select("entity", "category_code").collect())
    assert codes["Uni A"] == "oficial" and warehouse.read("gold", "dim_category").count() == 3
    star = medallion.gold_star(warehouse, PROFILE)
    got = rows(star, "entity", "category", "label", "period", "measure_a", "measure_b", F.col("ratio").cast("string"))
    national = "UNIVERSIDAD NACIONAL DE COLOMBIA"
    # The category of Uni A is from the later listed file; 2022 had no category column.
    assert got == sorted(
        [
            ("Uni A", "Oficial", "No SUE", 2022, 70, 0, None),
            ("Uni A", "Oficial", "No SUE", 2024, 100, 8, "12.50"),
            ("Uni B", "Oficial", "No SUE", 2022, 0, 0, None),
            ("Uni B", "Oficial", "No SUE", 2024, 50, 0, None),
            (national, "Oficial", "SUE", 2022, 0, 0, None),
            (national, "Oficial", "SUE", 2024, 15, 0, None),
        ],
        key=repr,
    )

    report = {r.check_name: r.n_violations for r in medallion.quality(warehouse).collect()}
    assert len(report) == 13 and not any(report.values())

    again = medallion.load(warehouse, csv_path, PROFILE, buckets=4)
    assert rows(medallion.gold_star(warehouse, PROFILE).drop("entity_id")) == rows(star.drop("entity_id"))
    assert again["counts"] == summary["counts"]
    log = warehouse.audit_log().collect()
    assert [r.stage for r in log] == ["gold", "silver", "bronze"] * 2
    assert all(r.duration_s > 0 and r.ended_at >= r.started_at for r in log)


def test_bucketed_gold_joins_without_shuffle(spark, landing, warehouse, tmp_path):
    from tiermill.plans import views

    csv_path = str(tmp_path / "curated")
    medallion.ingest(warehouse, landing, csv_path, PROFILE)
    medallion.load(warehouse, csv_path, PROFILE, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = views.lag_ratio(medallion.gold_star(warehouse, PROFILE))
        assert "Exchange" not in view._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nothing_usable(spark, warehouse, tmp_path):
    folder = tmp_path / "empty"
    folder.mkdir()
    (folder / "articles-425151_recurso.xlsx").write_bytes(book(4, [[1, "Antioquia", "Uni A", "x", 3]]))
    with pytest.raises(ValueError, match="no usable rows"):
        medallion.ingest(warehouse, str(folder), str(tmp_path / "c"), PROFILE)


def _curated(spark, path, data):
    schema = "entity string, period int, measure_a bigint, measure_b bigint, ratio string, category string, label string"
    curated_csv.write_csv(spark.createDataFrame(data, schema), path, PROFILE.csv_names)


@pytest.mark.parametrize("broken", ["silver_measure", "dim_entity", "gold_fact"])
def test_failures_are_logged_and_leave_old_answers(spark, warehouse, tmp_path, rows, monkeypatch, broken):
    """Whatever step of a load fails, the star tells the same as before, under the same names."""
    good, more = str(tmp_path / "good"), str(tmp_path / "more")
    _curated(spark, good, [("U1", 2022, 10, 2, "5", "x", "SUE"), ("U2", 2022, 3, 1, "3", "y", "No SUE")])
    _curated(spark, more, [("A0", 2022, 99, 9, "11", "x", "SUE"), ("U1", 2022, 10, 2, "5", "x", "SUE"), ("U2", 2022, 3, 1, "3", "y", "No SUE")])
    medallion.load(warehouse, good, PROFILE)
    before = rows(medallion.gold_star(warehouse, PROFILE))

    def fail(*args, **kwargs):
        raise RuntimeError("broken on purpose")

    with monkeypatch.context() as patch:
        patch.setattr(medallion.layers, broken, fail)
        with pytest.raises(RuntimeError, match="on purpose"):
            medallion.load(warehouse, more, PROFILE)
    assert rows(medallion.gold_star(warehouse, PROFILE)) == before
    assert warehouse.audit_log(1).first().status == "error"
    medallion.load(warehouse, more, PROFILE)
    after = rows(medallion.gold_star(warehouse, PROFILE))
    assert set(before) < set(after)  # ids of known names stay


def test_repeated_key_fails_the_load(spark, warehouse, tmp_path):
    bad = str(tmp_path / "bad")
    _curated(spark, bad, [("U1", 2022, 10, 2, "5", "x", "SUE"), ("U1", 2022, 11, 2, "5", "x", "SUE")])
    with pytest.raises(Exception, match="key occurs twice"):
        medallion.load(warehouse, bad, PROFILE)


_SECOND = """
import sys
sys.path[:0] = [{root!r}]
from tiermill.plans import medallion
from tiermill.plans.warehouse import Warehouse
from tiermill.profile import HIGHER_EDUCATION
from tiermill.session import build_session
spark = build_session("again", spark_master="local[2]", spark_sql_shuffle_partitions="2", spark_ui_enabled="false",
                      spark_sql_warehouse_dir={spare!r})
warehouse = Warehouse(spark, {wh!r}, {names!r}).create()
print("SEEN", medallion.gold_star(warehouse, HIGHER_EDUCATION).count())
medallion.load(warehouse, {csv!r}, HIGHER_EDUCATION, buckets=4)
print("LOG", warehouse.audit_log().count(), spark.sql("SELECT * FROM " + warehouse.name("gold", "v_top_ies_by_ratio")).count())
"""


def test_second_process_reads_and_loads(spark, warehouse, tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    path = str(tmp_path / "in")
    _curated(spark, path, [("U1", 2022, 10, 2, "5", "x", "SUE"), ("U2", 2023, 3, 1, "3", "y", "No SUE")])
    medallion.load(warehouse, path, PROFILE, buckets=4)
    code = _SECOND.format(root=str(Path(__file__).parents[1]), spare=str(tmp_path / "spare"), wh=warehouse.root, names=warehouse.names, csv=path)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    assert "SEEN 4" in out.stdout and "LOG 6 4" in out.stdout, out.stdout + out.stderr[-2000:]


def test_standing_views_follow_reloads(spark, warehouse, tmp_path, rows):
    for turn, amount in enumerate((10, 20, 30, 40)):
        path = str(tmp_path / f"in{turn}")
        _curated(spark, path, [("U1", 2022, amount, 2, "", "x", "SUE"), ("U2", 2022, 3, 1, "3", "y", "No SUE")])
        medallion.load(warehouse, path, PROFILE)
    gold = warehouse.database("gold")
    report = spark.sql(f"SELECT nombre_ies, total_estudiantes, rank_ratio_desc FROM `{gold}`.v_relacion_estudiante_docente")
    assert rows(report) == [("U1", 40, 1), ("U2", 3, 2)]
    assert rows(spark.sql(f"SELECT tipo, cantidad_ies FROM `{gold}`.v_promedio_por_sue")) == [("No SUE", 1), ("SUE", 1)]
    assert spark.sql(f"SHOW TABLES IN `{gold}` LIKE 'fact__*'").count() == 2


def test_line_breaks_stay_in_their_cell(spark, warehouse, tmp_path):
    path = str(tmp_path / "in")
    _curated(spark, path, [("U1", 2022, 10, 2, "5", "Oficial\nestatal", "SUE"), ("U\r\n2", 2022, 3, 1, "3", "y", "No SUE")])
    summary = medallion.load(warehouse, path, PROFILE)
    assert (summary["bronze"], summary["rejected"]) == (2, 0)
    assert dict(warehouse.read("bronze", "curated").select("category", "label").collect()) == {"Oficial\nestatal": "SUE", "y": "No SUE"}


def test_nothing_is_lost_without_a_trace(spark, warehouse, tmp_path, rows):
    from dataclasses import replace

    path = str(tmp_path / "in")
    _curated(spark, path, [("U1", 2022, 5000, 1, "5000", "x", "SUE"), ("U2", 2025, 3, 1, "3", "y", "No SUE")])
    closed = replace(PROFILE, periods=(2022, 2023))
    summary = medallion.load(warehouse, path, closed, on_overflow="quarantine")
    assert summary["status"] == "success with warnings" and len(summary["errors"]) == 3
    assert rows(warehouse.read("gold", "quarantine"), "period", F.col("value").cast("string")) == [(2022, "5000.00")]
    assert rows(warehouse.read("bronze", "quarantined"), "entity", "ratio") == [("U1", "5000")]
    assert warehouse.read("gold", "outside_period").count() == 2
    report = {r.check_name: r.n_violations for r in medallion.quality(warehouse).collect()}
    assert report["gold.fact ratio domain"] == 1


def test_rejects_give_warnings_and_overflow_raises(spark, warehouse, tmp_path):
    path = str(tmp_path / "in")
    _curated(spark, path, [("U1", 2022, 10, 2, "5", "x", "SUE"), ("U2", 2022, 3, 1, "abc", "y", "No SUE")])
    summary = medallion.load(warehouse, path, PROFILE)
    assert (summary["status"], summary["rejected"], summary["bronze"]) == ("success with warnings", 1, 1)
    big = str(tmp_path / "big")
    _curated(spark, big, [("U1", 2022, 5000, 1, "", "x", "SUE")])
    with pytest.raises(Exception, match="does not fit"):
        medallion.load(warehouse, big, PROFILE)
    kept = medallion.load(warehouse, big, PROFILE, on_overflow="quarantine")
    assert kept["gold"] == 1 and kept["quarantined"] == 1
    wide = str(tmp_path / "wide")
    _curated(spark, wide, [("U" * 501, 2022, 5, 1, "", "x", "SUE")])
    with pytest.raises(ValueError, match="exceed 500"):
        medallion.load(warehouse, wide, PROFILE)
    _curated(spark, wide, [("U" * 501, 2022, 5, 1, "", "x", "SUE"), ("U1", 2022, 5, 1, "", "y" * 51, "SUE"), ("U2", 2022, 5, 1, "", "x", "SUE")])
    kept = medallion.load(warehouse, wide, PROFILE, on_overflow="quarantine", by_range=True)
    assert (kept["bronze"], kept["rejected"]) == (1, 2)
    said = {e for r in warehouse.read("bronze", "rejected").collect() for e in r.errors}
    assert said == {"entity: over 500 characters", "category: over 50 characters"}


def test_category_seed(spark, rows):
    from tiermill.operators.keys import seed_dim

    empty = spark.createDataFrame([], "code string, name string, description string")
    seeded = seed_dim(empty, PROFILE.categories, "code string, name string, description string", "code")
    assert rows(seeded, "code") == [("desconocido",), ("oficial",), ("privado",)]


def _texts(seed):
    import random

    draw = random.Random(seed)
    pieces = ['"', '""', ",", "\n", "\r\n", "a", "b c", "é", " ", '",\n"', "x" * 50, ""]
    return ["".join(draw.choice(pieces) for _ in range(draw.randrange(9))) for _ in range(700)] + ["\n" * 3000, '"\n' * 2000]


@pytest.mark.parametrize("seed", [1, 2])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, seed):
    """Cells of quotes and line breaks, cut anywhere by ranges, as one task reads them."""
    texts = _texts(seed)
    data = [(t, i, i, None, "5", texts[-i % 700], "SUE") for i, t in enumerate(texts)]
    schema = "entity string, period int, measure_a bigint, measure_b bigint, ratio string, category string, label string"
    path = str(tmp_path / "in")
    curated_csv.write_csv(spark.createDataFrame(data, schema).coalesce(1), path, PROFILE.csv_names)
    sizes = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in sizes:
            spark.conf.set(k, "700")
        lines = spark.read.option("lineSep", "\n").text(path)
        assert lines.rdd.getNumPartitions() > 20
        whole = curated_csv.read_csv(spark, path, PROFILE.csv_names).collect()
        assert len(whole) == len(texts)
        got = curated_csv.read_csv(spark, path, PROFILE.csv_names, by_range=True).collect()
    finally:
        for k, v in sizes.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))


def test_range_reader_checks_the_header(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_bytes(b'"a","b"\r\n"1","x\r\ny"\r\n\r\n"2",""\r\n3,\r\n')
    from tiermill.sources.csv_ranges import read_ranges

    got = sorted((r.a, r.b, r._file) for r in read_ranges(spark, str(path), ["a", "b"]).na.fill("").collect())
    assert got == [("1", "x\r\ny", "odd.csv"), ("2", "", "odd.csv"), ("3", "", "odd.csv")]
    with pytest.raises(ValueError, match="are not"):
        read_ranges(spark, str(path), ["b", "a"])


def test_history_over_loads(spark, warehouse, tmp_path):
    """Two loads with changed categories: facts of earlier years keep the category of their time."""
    for day, category, names in (("2022-01-01", "x", ("U1", "U2")), ("2023-06-01", "z", ("U1", "U2", "U3"))):
        path = str(tmp_path / day)
        _curated(spark, path, [(n, y, 10, 2, "", category if n == "U1" else "y", "SUE") for n in names for y in (2022, 2023)])
        medallion.load(warehouse, path, PROFILE, as_of=day)
    star = {(r.entity, r.period): r.category for r in medallion.asof_star(warehouse).collect()}
    assert star == {("U1", 2022): "x", ("U1", 2023): "z", **{(n, y): "y" for n in ("U2", "U3") for y in (2022, 2023)}}
    report = {r.check_name: r.n_violations for r in medallion.quality(warehouse).collect()}
    assert report["gold.dim_history intervals"] == 0


def test_ledger_of_every_file(spark, landing, warehouse, tmp_path):
    from pathlib import Path

    elsewhere = book(4, [[1, "Antioquia", "Uni Z", "Oficial", 5]])
    (Path(landing) / "articles-421539_recurso.xlsx").write_bytes(elsewhere)
    (Path(landing) / "late.xlsx").write_bytes(book_bytes({"Hoja": [(0, ["x"])]}))
    listed = [(*m, i) for i, m in enumerate([*PROFILE.manifest, ("late", "docentes", 2020)])]
    table = spark.createDataFrame(listed, manifest.SCHEMA)
    told = medallion.ingest(warehouse, landing, str(tmp_path / "csv"), PROFILE, listed=table)
    ledger = {r.file_id: (r.outcome, r.n_rows) for r in warehouse.read("bronze", "ingest_ledger").collect()}
    assert ledger == {
        "articles-425156_recurso": ("loaded", 2), "articles-425151_recurso": ("loaded", 5), "articles-416244_recurso": ("loaded", 1),
        "articles-421822_recurso": ("damaged", 0), "articles-416249_recurso": ("no region column", 0), "other": ("unlisted", 0),
        "articles-421539_recurso": ("no rows", 0), "late": ("no header", 0),
    }
    assert told["files"] == {"loaded": 3, "damaged": 1, "no region column": 1, "unlisted": 1, "no rows": 1, "no header": 1}
    kept = spark.read.json(f"{warehouse.root}/ingest_metadata")
    assert kept.count() == 8 and {"sheet", "kind", "period", "outcome", "n_rows"} <= set(kept.columns)
    assert kept.filter("outcome = 'damaged'").first().detail


def test_split_scan_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """No task of the split scan reads all documents; rows of one name and period are dealt over several files."""
    from bindings import warehousing

    folder, parts, write = tmp_path / "csv", [], curated_csv.write_csv
    monkeypatch.setattr(warehousing, "run_folder", lambda *_: str(folder))
    monkeypatch.setattr(curated_csv, "write_csv", lambda df, path, **more: parts.append(df.rdd.getNumPartitions()) or write(df, path, **more))
    monkeypatch.setattr(warehousing, "_FILE_CHARS", 1 << 20)
    docs = spark.createDataFrame([(i, "same, text\nof two lines " * 40, "de", "web", 1000) for i in range(4000)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    scanned = warehousing._csv_split_scan(spark, str(tmp_path))
    assert parts[0] > 1 and len(list(folder.glob("part-*"))) > 1
    assert scanned.count() == 4000 and scanned.select("entity").distinct().count() == 1
    assert scanned.select("measure_a").distinct().count() == 4000


def test_each_text_is_parsed_once(spark):
    """The error list and the typed columns share one parse, so the plan has one pattern for each of the four columns."""
    text = spark.createDataFrame([("u", "2022", "1", "x", "0.5", "c", "l")], ", ".join(f"{c} string" for c in curated_csv.COLUMNS))
    parsed = curated_csv.split_form(curated_csv.typed_parse(text))
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 4
    row = parsed.first()
    assert (row.errors, row._period, row._measure_a, row._measure_b, row._ratio, row.is_good) == (["measure_b: 'x'"], 2022, 1, None, None, False)


def test_curated_rows_are_written_before_the_file_is_sorted(spark):
    from bindings import warehousing

    rows = warehousing._curated(spark, "/root/testdata/sf0.001")
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString() and rows.inputFiles()
