"""Layer tables: staged versions, one commit per layer, views on the current versions, audit log.

A batch writes new versions of the tables of a layer beside the old ones and commits them
together (:mod:`tiermill.plans.commits`): one small file names the versions and view texts that
hold from now on, and then the views of the layer are pointed at them. A failure before that
leaves every table of the layer as it was, and of two loads that began on the same commit only
one can commit. A new session on the same root reads the commits and registers what they name.

A table may also be kept in parts: a commit then names a folder for every partition, and a batch
replaces the partitions of some values and keeps the others by reference.

What the last two commits of a layer do not name is removed, whichever session wrote it. A session
that was opened earlier sees newer commits after :meth:`Warehouse.create`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermill.plans.commits import CommitLog, Files
from tiermill.session import literal_rows

LAYERS = ("bronze", "silver", "gold", "audit")
_AUDIT = (
    "log_id bigint, stage string, status string, message string, n_rows bigint, started_at timestamp, "
    "ended_at timestamp, duration_s double, created_at timestamp"
)
AUDIT_COLUMNS = tuple(c.split()[0] for c in _AUDIT.split(", "))


@dataclass
class Warehouse:
    """Tables below ``root``. ``names`` maps layers to database names."""

    spark: SparkSession
    root: str
    names: dict[str, str] = field(default_factory=dict)

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return self.names.get(layer, layer)

    def create(self) -> Warehouse:
        """Databases, and what earlier commits below the root name."""
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{self.database(layer)}` LOCATION '{self.root}/{layer}'"
            )
            state = self.commits(layer).state()
            for name in sorted(state, key=lambda n: state[n]["kind"] == "view"):  # views on tables come after them
                self._register(layer, name, state[name])
        return self

    def files(self) -> Files:
        return Files(self.spark, self.root)

    def commits(self, layer: str) -> CommitLog:
        return CommitLog(self.files(), layer)

    def name(self, layer: str, table: str) -> str:
        return f"`{self.database(layer)}`.`{table}`"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def batch(self, layer: str) -> Batch:
        return Batch(self, layer)

    def refresh(self, layer: str, table: str, df: DataFrame, *args, **options) -> int:
        """Replace one table and give its row count; arguments as for :meth:`Batch.write`."""
        staged = self.batch(layer)
        n = staged.write(table, df, *args, **options)
        staged.commit()
        return n

    def _register(self, layer: str, name: str, entry: dict) -> None:
        if entry["kind"] == "view":
            columns = entry["text"].format(**{x: self.database(x) for x in LAYERS})
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, name)} AS {columns}")
            return
        target = self._store(layer, entry)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, name)} AS SELECT * FROM {target}")

    def _store(self, layer: str, entry: dict) -> str:
        """Name of the table that holds a version, which the catalog is told of if it has to be."""
        version = entry["version"]
        target = self.name(layer, version)
        if not self.spark.catalog.tableExists(target):
            parts = f" PARTITIONED BY ({', '.join(entry['partition_by'])})" if entry["partition_by"] else ""
            if entry["bucket_by"]:
                keys = ", ".join(entry["bucket_by"][1])
                parts += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {entry['bucket_by'][0]} BUCKETS"
            self.spark.sql(
                f"CREATE TABLE {target} ({entry['columns']}) USING parquet{parts} "
                f"LOCATION '{self.root}/{layer}/{version}'"
            )
            if entry["kind"] == "parts":
                self._locate(layer, target, entry)
            elif entry["partition_by"]:
                self.spark.sql(f"MSCK REPAIR TABLE {target}")
        return target

    def _locate(self, layer: str, target: str, entry: dict) -> None:
        """Tell the catalog where each partition is: filters on their columns then reach only these folders."""
        found = []
        for part in entry["parts"]:
            values = ", ".join(f"`{c}` = '{_quoted(v)}'" for c, v in zip(entry["partition_by"], part["values"]))
            found.append(f"PARTITION ({values}) LOCATION '{_quoted(self.root)}/{layer}/{_quoted(part['folder'])}'")
        if found:
            self.spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {' '.join(found)}")

    def _remove_outdated(self, layer: str) -> None:
        """Tables, folders and commit files that the last commits have no use for."""
        log, files = self.commits(layer), self.files()
        held = {f for _, state in log.states(2) for e in state.values() for f in _folders(e)}
        for entry in log.outdated():
            target = self.name(layer, entry["version"]) if entry["version"] else None
            if target and self.spark.catalog.tableExists(target):
                self.spark.sql(f"DROP TABLE {target}")
            for folder in set(_folders(entry)) - held:
                files.delete(f"{layer}/{folder}")
                top = folder.split("/")[0]
                if not any(f.split("/")[0] == top for f in held):
                    files.delete(f"{layer}/{top}")
        log.forget()

    def log(
        self, stage: str, status: str, message: str, n_rows: int, started: datetime, ended: datetime | None = None
    ) -> None:
        """Append one audit row, on its own and apart from any layer write."""
        ended = ended or datetime.now(timezone.utc)
        schema = "stage string, status string, message string, n_rows bigint, started_at timestamp, ended_at timestamp"
        entry = literal_rows(self.spark, [(stage, status, message, n_rows, started, ended)], schema)
        columns: dict[str, Column] = {
            "log_id": F.unix_micros(F.current_timestamp()),
            "duration_s": (F.unix_micros("ended_at") - F.unix_micros("started_at")) / F.lit(1e6),
            "created_at": F.current_timestamp(),
        }
        path = f"{self.root}/audit/run_log"
        entry.withColumns(columns).select(*AUDIT_COLUMNS).write.mode("append").parquet(path)
        target = self.name("audit", "run_log")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {target} ({_AUDIT}) USING parquet LOCATION '{path}'")
        self.spark.catalog.refreshTable(target)

    def audit_log(self, n: int = 20) -> DataFrame:
        """Newest audit rows first, of all sessions that used this root."""
        log = self.spark.read.schema(_AUDIT).parquet(f"{self.root}/audit/run_log")
        return log.orderBy(F.desc("created_at"), F.desc("log_id")).limit(n)

    def write_jdbc(self, df: DataFrame, url: str, table: str, **options: str) -> None:
        """Copy a layer to a relational database for BI tools; each partition writes its rows."""
        df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, truncate="true", **options).save()


class Batch:
    """New versions of tables and views of one layer, seen by no reader until :meth:`commit`."""

    def __init__(self, warehouse: Warehouse, layer: str):
        self.warehouse, self.layer = warehouse, layer
        self.parent = warehouse.commits(layer).latest()
        self.staged: dict[str, dict] = {}

    def write(
        self,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        bucket_by: tuple[int, Sequence[str]] | None = None,
        check: Callable[[DataFrame], None] | None = None,
    ) -> int:
        """Stage a table and give its row count, counted while it is written.

        ``check`` sees the new version; if it raises, nothing of the batch is committed.
        Bucketing the fact and the entity dimension alike by ``entity_id`` lets later
        joins and lags by entity run without a shuffle.
        """
        counted = Observation()
        watched = df.observe(counted, F.count(F.lit(1)).alias("n"))
        version = f"{table}__{uuid.uuid4().hex}"
        writer = watched.write.format("parquet").mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            buckets, keys = bucket_by
            writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
        writer.saveAsTable(self.warehouse.name(self.layer, version))
        stored = self.warehouse.read(self.layer, version)
        if check:
            check(stored)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
        self.staged[table] = {
            "kind": "table", "version": version, "columns": columns, "partition_by": list(partition_by), "bucket_by": bucket_by,
        }
        return counted.get["n"]

    def write_parts(
        self,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str],
        replaces: Callable[[dict[str, str]], bool],
        check: Callable[[DataFrame], Collection[str]] | None = None,
        gathered: bool = False,
    ) -> int:
        """Stage new partitions of a table and give their row count.

        Of the partitions there are now, those that ``replaces`` accepts (column to value, as text)
        give way; the others stay where they are, by reference. ``check`` sees the new rows and
        names values of the last partition column that are not to be committed: their
        partitions stay as they were. The rebalance hint gathers a partition's rows into files of
        the advisory size and splits a large one over many tasks; it is left out if ``gathered`` says that the rows of
        a partition are together already.
        """
        warehouse, counted = self.warehouse, Observation()
        version, columns = f"{table}__{uuid.uuid4().hex}", [c for c in df.columns if c not in partition_by]
        ordered = df.select(*columns, *partition_by)
        path = f"{warehouse.root}/{self.layer}/{version}"
        placed = ordered if gathered else ordered.hint("rebalance", *partition_by)
        watched = placed.observe(counted, F.count(F.lit(1)).alias("n"))
        watched.write.partitionBy(*partition_by).parquet(path)
        refused = set(check(warehouse.spark.read.schema(ordered.schema).parquet(path)) if check else ())
        leaves = self._leaves(version, len(partition_by))
        fresh = [{"values": v, "folder": f"{version}/{f}"} for v, f in leaves if v[-1] not in refused]
        for values, folder in leaves:
            if values[-1] in refused:
                warehouse.files().delete(f"{self.layer}/{version}/{folder}")
        old = warehouse.commits(self.layer).state().get(table, {"parts": []})["parts"]

        def gives_way(part: dict) -> bool:
            named = dict(zip(partition_by, part["values"]))
            return replaces(named) and part["values"][-1] not in refused

        kept = [p for p in old if not gives_way(p)]
        told = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
        self.staged[table] = {
            "kind": "parts", "version": f"{version}_all", "columns": told, "partition_by": list(partition_by), "bucket_by": None,
            "parts": sorted(kept + fresh, key=lambda p: p["values"]),
        }
        return counted.get["n"]

    def _leaves(self, folder: str, depth: int) -> list[tuple[list[str], str]]:
        """Values and folders of the partitions below a folder: one listing for each, no data is read."""
        found, files = [([], "")], self.warehouse.files()
        for _ in range(depth):
            found = [
                ([*values, unquote(name.partition("=")[2])], f"{at}/{name}".lstrip("/"))
                for values, at in found
                for name in files.names(f"{self.layer}/{folder}/{at}".rstrip("/"), folders=True)
            ]
        return found

    def read(self, table: str) -> DataFrame:
        """The staged version, or the current one of a table that the batch does not write."""
        if table in self.staged:
            return self.warehouse.spark.table(self.warehouse._store(self.layer, self.staged[table]))
        return self.warehouse.read(self.layer, table)

    def define(self, view: str, text: str) -> None:
        """Stage a view. ``text`` is SQL over current names, with ``{gold}`` and so on for the databases."""
        self.staged[view] = {"kind": "view", "version": "", "text": text}

    def define_columns(self, view: str, columns: Mapping[str, str], source: str, where: str) -> None:
        """A view on another table of the layer: name to expression, and a condition."""
        chosen = ", ".join(f"{expression} AS `{name}`" for name, expression in columns.items())
        self.define(view, f"SELECT {chosen} FROM {{{self.layer}}}.`{source}` WHERE {where}")

    def commit(self) -> None:
        """All that is staged, at once. Raises if another load has committed since the batch was begun."""
        warehouse, layer = self.warehouse, self.layer
        warehouse.commits(layer).append(self.parent, self.staged)
        for name, entry in self.staged.items():
            warehouse._register(layer, name, entry)
        warehouse._remove_outdated(layer)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _folders(entry: dict) -> list[str]:
    """Folders below the layer's that an entry's rows are in."""
    if entry["kind"] == "parts":
        return [p["folder"] for p in entry["parts"]]
    return [entry["version"]] if entry["version"] else []
