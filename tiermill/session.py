"""Session defaults and the shared folder that materialised intermediates go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Runtime re-planning is what keeps skewed joins whole and small dimensions broadcast.
# Nothing here depends on the size of the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A private temporary folder is used only when nothing is configured and the
    session runs in a single local process.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = context.getConf().get("spark.checkpoint.dir")
        if configured is None:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
            configured = tempfile.mkdtemp(prefix="tiermill-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def run_folder(spark: SparkSession, purpose: str) -> str:
    """Fresh sub-folder of the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Constant rows as part of the plan, so that their small size is known to the planner."""
    fields = T.StructType.fromDDL(schema).fields
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def freeze(df: DataFrame) -> DataFrame:
    """The rows as a table written to the shared folder.

    Readers see the same rows however often executors are lost, and scan only the columns
    they need.
    """
    return freeze_counted(df)[0]


def freeze_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """:func:`freeze` with the row count, which is taken while the table is written."""
    spark = df.sparkSession
    path = run_folder(spark, "table")
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), counted.get["n"]
