"""Landed files: manifest, grids, workbooks and reconciliation.

Orders stand for the rows of landed files: a file per order year and status, the customer
as a name in three spellings, the priority as its category.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from bindings.tables import table
from tiermill.operators import reconcile
from tiermill.profile import HIGHER_EDUCATION
from tiermill.session import freeze
from tiermill.sources import grid, manifest, workbook
from tiermill.sources.ledger import ingest_ledger

# Fixed order of files; finished orders are kind b, open ones kind a, other files are not
# listed and the last entry never arrives.
MANIFEST = (
    ("1998-F", "b", 1998), ("1998-O", "a", 1998), ("1997-O", "a", 1997), ("1997-F", "b", 1997),
    ("1996-O", "a", 1996), ("1996-F", "b", 1996), ("1995-F", "b", 1995), ("1995-O", "a", 1995),
    ("1999-O", "a", 1999), ("1999-F", "b", 1999), ("2000-F", "b", 2000), ("2000-O", "a", 2000),
    ("2001-O", "a", 2001), ("2001-F", "b", 2001), ("1994-F", "b", 1994),
)
_MANIFEST_SQL = "listed(file_id, kind, period, file_rank) AS (VALUES " + ", ".join(
    f"('{f}', '{k}', {p}, {i})" for i, (f, k, p) in enumerate(MANIFEST)
) + ")"

_LANDED = {
    "file_id": "concat(CAST(year(o_orderdate) AS STRING), '-', o_orderstatus)",
    "row_idx": "o_orderkey",
    "raw_name": """CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE concat('Customer  #', CAST(o_custkey AS STRING),
      CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' -' ELSE ',' END) END""",
    "category": "o_orderpriority",
    "amount": """CASE o_orderkey % 11 WHEN 0 THEN 'n/a' WHEN 1 THEN concat(CAST(o_orderkey % 500 AS STRING), '.5')
      ELSE CAST(o_orderkey % 500 AS STRING) END""",
}
_LANDED_SQL = ", ".join(f"{v.replace('STRING', 'VARCHAR')} AS {k}" for k, v in _LANDED.items())

_TOTALS_SQL = f"""{_MANIFEST_SQL},
landed AS (SELECT * FROM (SELECT {_LANDED_SQL} FROM orders) JOIN listed USING (file_id)),
totals AS (
  SELECT kind, period, file_rank, raw_name,
         CAST(trunc(sum(coalesce(TRY_CAST(amount AS DOUBLE), 0))) AS BIGINT) AS total,
         arg_min(category, row_idx) AS category
  FROM landed WHERE raw_name IS NOT NULL GROUP BY ALL),
clean AS (
  SELECT *, trim(regexp_replace(trim(regexp_replace(replace(raw_name, ',', ''), '\\s+', ' ', 'g')), '-+$', '')) AS entity
  FROM totals),
merged AS (
  SELECT kind, entity, period, total FROM clean
  QUALIFY row_number() OVER (PARTITION BY kind, entity, period ORDER BY file_rank DESC, raw_name DESC) = 1)"""


def _q(select: str, *more: str) -> str:
    return f"WITH {', '.join([_TOTALS_SQL, *more])} {select}"


def landed(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(*[f"{v} AS {k}" for k, v in _LANDED.items()])
    return manifest.manifest_join(rows, manifest.manifest_frame(spark, MANIFEST))


def totals(spark, sf):
    return reconcile.entity_sum(landed(spark, sf))


def stores(spark, sf):
    values = reconcile.collapse(totals(spark, sf))
    return [reconcile.store_of(values, "a", "measure_a"), reconcile.store_of(values, "b", "measure_b")]


def _manifest_join(spark, sf):
    return landed(spark, sf).select("file_id", "kind", "period", "file_rank", "row_idx")


def _ingest_metadata(spark, sf):
    return manifest.ingest_metadata(landed(spark, sf))


def _entity_sum(spark, sf):
    return totals(spark, sf).drop("file_rank")


def _collapse(how):
    return lambda spark, sf: reconcile.collapse(totals(spark, sf), how)


def _category_pick(spark, sf):
    return reconcile.category_pick(totals(spark, sf))


def _distinct_keys(spark, sf):
    return reconcile.distinct_keys(stores(spark, sf), "entity")


def _outer_merge(spark, sf):
    return reconcile.outer_merge(stores(spark, sf), ["entity", "period"], ["measure_a", "measure_b"])


def _run_profile(spark, sf):
    return reconcile.run_profile(totals(spark, sf))


# --- grids -------------------------------------------------------------------------


def _sheets(spark, sf):
    """A conversation as a workbook whose sheets are named by its turns."""
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("file"), F.col("text").alias("sheet"), F.col("turn").cast("int").alias("sheet_pos")
    )


_SKIP = ("the", "der", "que")


def _sheet_pick(spark, sf):
    return grid.sheet_pick(_sheets(spark, sf), _SKIP)


_SHORT = 6


def _document_grid(spark, sf):
    """A document as one sheet: a line is a row, a word a cell, short words empty cells."""
    lines = table(spark, sf, "documents").select(
        F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("row_idx", "line")
    )
    words = F.transform(F.split("line", " "), lambda w: F.when(F.length(w) >= _SHORT, w))
    return lines.select("file", "row_idx", words.alias("cells"))


_HEADER = (("ent", "ung"), ("on",))


def _header_row_detect(spark, sf):
    return grid.header_row_detect(_document_grid(spark, sf), *_HEADER)


def _drop_empty_rows(spark, sf):
    cells = _document_grid(spark, sf)
    rows = grid.data_rows(cells, grid.header_row_detect(cells, *_HEADER))
    filled = F.size(F.filter("cells", lambda c: c.isNotNull())).alias("n_filled")
    return rows.select("file", "row_idx", filled)


_LINES_SQL = f"""lines AS (
  SELECT doc_id AS file, CAST(i - 1 AS INTEGER) AS row_idx, line,
         list_filter(string_split(line, ' '), lambda w: length(w) >= {_SHORT}) AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
heads AS (
  SELECT file, CAST(coalesce(min(row_idx) FILTER (
    (contains(lower(list_aggregate(words, 'string_agg', ' ')), 'ent')
     OR contains(lower(list_aggregate(words, 'string_agg', ' ')), 'ung'))
    AND contains(lower(list_aggregate(words, 'string_agg', ' ')), 'on')), 7) AS INTEGER) AS header_row
  FROM lines WHERE row_idx < 10 GROUP BY file)"""

_ROLES = {
    "amount": ("xyz", "ent on", "en"),
    "name": ("ación", "den ung", "th er"),
    "never": ("no such word at all",),
}


def _column_resolve(spark, sf):
    """The lines of a document as the headers of one file."""
    headers = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("headers"))
    return grid.column_resolve(headers, _ROLES).drop("headers")


def _resolve_sql() -> str:
    def role(name, patterns):
        tests = [
            f"SELECT {rank} AS rank, * FROM heads WHERE "
            + " AND ".join(f"contains(header, '{w}')" for w in pattern.split())
            for rank, pattern in enumerate(patterns)
        ]
        return f"""{name}_hit AS (SELECT doc_id, arg_min(pos, rank * 1000000 + pos) AS {name}
          FROM ({' UNION ALL '.join(tests)}) GROUP BY doc_id)"""

    ctes = ", ".join(role(n, p) for n, p in _ROLES.items())
    joins = " ".join(f"LEFT JOIN {n}_hit USING (doc_id)" for n in _ROLES)
    return f"""WITH heads AS (
      SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS p0, CAST(p0 AS INTEGER) AS pos,
             lower(trim(regexp_replace(l[p0 + 1], '\\s+', ' ', 'g'))) AS header
      FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)), {ctes}
    SELECT doc_id, {', '.join(_ROLES)} FROM documents {joins}"""


_REQUIRED = ("amount", "name")


def _ingest_report(spark, sf):
    """Documents as landed files: listed if labelled, unreadable in German, their lines as headers and as rows."""
    docs = table(spark, sf, "documents").withColumn("file", F.col("doc_id").cast("string"))
    listed = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("file_id"), F.col("quality").cast("string").alias("kind"), F.col("toxic").cast("int").alias("period")
    )
    lines = F.split("text", "\n")
    headed = docs.select("file", F.col("source").alias("sheet"), F.when(F.contains("text", F.lit(" ")), lines).alias("headers"))
    counts = docs.select("file", (F.size(lines) - 1).cast("long").alias("n_rows")).filter("n_rows > 0")
    damaged = docs.filter("lang = 'de'").select("file", F.concat(F.lit("in "), "lang").alias("error"))
    files = docs.select("file", F.col("file").alias("file_id"))
    return ingest_ledger(files, listed, damaged, grid.column_resolve(headed, _ROLES), counts, _REQUIRED)


_REPORT_SQL = f"""WITH placed AS ({_resolve_sql()}),
told AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS file, file AS file_id, CAST(l.quality AS VARCHAR) AS kind, CAST(l.toxic AS INTEGER) AS period,
         d.source AS sheet, len(string_split(d.text, chr(10))) - 1 AS n, d.lang,
         CASE WHEN l.doc_id IS NULL THEN 'unlisted' WHEN d.lang = 'de' THEN 'damaged' WHEN NOT contains(d.text, ' ') THEN 'no header'
              WHEN p.amount IS NULL THEN 'no amount column' WHEN p.name IS NULL THEN 'no name column'
              WHEN n = 0 THEN 'no rows' ELSE 'loaded' END AS outcome
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id JOIN placed p ON p.doc_id = d.doc_id)
SELECT file, file_id, kind, period, sheet, outcome, CASE WHEN outcome = 'damaged' THEN 'in ' || lang END AS detail,
       CASE WHEN outcome = 'loaded' THEN CAST(n AS BIGINT) ELSE 0 END AS n_rows FROM told"""


# --- workbooks ---------------------------------------------------------------------

BOOK_ROWS = 500
_BOOK_ROLES = {
    "region": HIGHER_EDUCATION.region_patterns,
    "entity": HIGHER_EDUCATION.entity_patterns,
    "category": HIGHER_EDUCATION.category_patterns,
    "amount": HIGHER_EDUCATION.amount_patterns["estudiantes"][:2],
}
_BOOK_HEADER = (
    "Código", "Sector\n  IES ", "Departamento de  domicilio de la IES", "Institución de Educación Superior (IES)",
    None, "Estudiantes  matriculados",
)


def sheet_xml(rows) -> str:
    """Sheet part with inline strings; a null cell is left out."""
    out = []
    for number, cells in rows:
        parts = [
            f'<c r="{chr(65 + i)}{number + 1}" t="inlineStr"><is><t xml:space="preserve">{escape(str(c))}</t></is></c>'
            for i, c in enumerate(cells)
            if c is not None
        ]
        out.append(f'<row r="{number + 1}">{"".join(parts)}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    return f'<?xml version="1.0"?><worksheet xmlns="{main}"><sheetData>{"".join(out)}</sheetData></worksheet>'


def book_bytes(sheets: dict) -> bytes:
    """A minimal workbook: sheet name to (row number, cells) pairs."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    listed = "".join(
        f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)
    )
    links = "".join(
        f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(sheets) + 1)
    )
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{package}">{links}</Relationships>'
        )
        for i, rows in enumerate(sheets.values(), 1):
            book.writestr(f"xl/worksheets/sheet{i}.xml", sheet_xml(rows))
    return buffer.getvalue()


def _to_book(frame: pd.DataFrame) -> pd.DataFrame:
    """One workbook of at most BOOK_ROWS customers: an index sheet, then a data sheet with
    title rows, a header row that moves with the book, and an empty row in the middle."""
    number = int(frame["book"].iloc[0])
    frame = frame.sort_values("c_custkey")
    head = 2 + number % 3
    rows = [(0, ["Reporte anual"]), (1, [None, "uso interno"]), (head, list(_BOOK_HEADER))]
    for i, row in enumerate(frame.itertuples()):
        at = head + 1 + i + (1 if i >= BOOK_ROWS // 2 else 0)
        rows.append((at, [row.c_custkey, row.c_mktsegment, row.r_name, row.c_name, None, row.c_nationkey]))
    rows.append((head + 1 + BOOK_ROWS // 2, [None] * 6))
    content = book_bytes({"Índice": [(0, ["Contenido"])], "Datos": sorted(rows, key=lambda r: r[0])})
    return pd.DataFrame({"path": [f"/landing/book-{number}.xlsx"], "content": [content]})


def books(spark, sf):
    """The customers as workbooks; keys are unique, so a book has a bounded size."""
    located = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "r_name")
        .withColumn("book", F.floor(F.col("c_custkey") / BOOK_ROWS))
    )
    return located.groupBy("book").applyInPandas(_to_book, "path string, content binary")


def _workbook_scan(spark, sf):
    cells = workbook.readable(freeze(workbook.workbook_scan(books(spark, sf))))
    found = grid.layout(cells, ("índice", "contenido"), ("institución", "código"), ("departamento",))
    placed = freeze(grid.column_resolve(found, _BOOK_ROLES))
    rows = grid.named_rows(cells, placed, tuple(_BOOK_ROLES), ("region", "entity", "amount"))
    named = manifest.file_id_from_path(rows, "file")
    return named.select("file_id", "row_idx", *_BOOK_ROLES, "has_category")


_BOOK_SQL = f"""SELECT 'book-' || book AS file_id,
  CAST(3 + book % 3 + i + CASE WHEN i >= {BOOK_ROWS // 2} THEN 1 ELSE 0 END AS INTEGER) AS row_idx,
  r_name AS region, c_name AS entity, c_mktsegment AS category, CAST(c_nationkey AS VARCHAR) AS amount,
  true AS has_category
FROM (SELECT *, c_custkey // {BOOK_ROWS} AS book,
        row_number() OVER (PARTITION BY c_custkey // {BOOK_ROWS} ORDER BY c_custkey) - 1 AS i
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

QUERIES = {
    "manifest_join": (
        _manifest_join,
        _q("SELECT file_id, kind, period, file_rank, row_idx FROM landed"),
    ),
    "ingest_report": (_ingest_report, _REPORT_SQL),
    "ingest_metadata": (_ingest_metadata, _q("SELECT file_id, kind, period, count(*) AS n_rows FROM landed GROUP BY ALL")),
    "entity_sum": (_entity_sum, _q("SELECT kind, period, raw_name, total, category FROM totals")),
    "collapse_last_wins": (_collapse("last"), _q("SELECT * FROM merged")),
    "collapse_sum": (
        _collapse("sum"),
        _q("SELECT kind, entity, period, CAST(sum(total) AS BIGINT) AS total FROM clean GROUP BY ALL"),
    ),
    "category_pick": (
        _category_pick,
        _q(
            """SELECT entity, category FROM clean
            QUALIFY row_number() OVER (PARTITION BY entity ORDER BY file_rank DESC, raw_name DESC) = 1"""
        ),
    ),
    "distinct_keys": (_distinct_keys, _q("SELECT DISTINCT entity FROM merged")),
    "outer_merge": (
        _outer_merge,
        _q(
            """SELECT entity, period, coalesce(a.total, 0) AS measure_a, coalesce(b.total, 0) AS measure_b
            FROM (SELECT * FROM merged WHERE kind = 'a') a
            FULL JOIN (SELECT * FROM merged WHERE kind = 'b') b USING (entity, period)"""
        ),
    ),
    "run_profile": (
        _run_profile,
        _q(
            """SELECT count(DISTINCT raw_name) AS n_entities,
            (SELECT string_agg(period, ',' ORDER BY period) FROM (SELECT DISTINCT period FROM totals)) AS periods,
            CAST(sum(total) AS BIGINT) AS total FROM totals"""
        ),
    ),
    "sheet_pick": (
        _sheet_pick,
        """SELECT conv_id AS file, text AS sheet FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id
          ORDER BY contains(lower(text), 'the') OR contains(lower(text), 'der') OR contains(lower(text), 'que'), turn) = 1""",
    ),
    "header_row_detect": (_header_row_detect, f"WITH {_LINES_SQL} SELECT file, header_row FROM heads"),
    "drop_empty_rows": (
        _drop_empty_rows,
        f"""WITH {_LINES_SQL} SELECT file, row_idx, CAST(len(words) AS INTEGER) AS n_filled
        FROM lines JOIN heads USING (file) WHERE row_idx > header_row AND len(words) > 0""",
    ),
    "column_resolve": (_column_resolve, _resolve_sql()),
    "workbook_scan": (_workbook_scan, _BOOK_SQL),
}
