"""Session settings and the one way this library cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # checkpoints of finished jobs go away with their DataFrames
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Look-up tables up to this many rows and bytes are broadcast; both are counted first.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def build_session(app: str = "scanledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, adaptive execution)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the session's own, else ``spark.checkpoint.dir``, else (local only) a temp one."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive executor loss and are never recomputed."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row has."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = 16 + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = 16 + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            size = F.lit(8)
        total = total + size
    return total


def lookup(df: DataFrame, pinned: bool = True, max_rows: int | None = None) -> DataFrame:
    """A look-up side of a join: broadcast if rows and bytes are counted small enough, else left to shuffle joins.

    Saves the shuffle of the large side, which adaptive execution can only skip after writing it.
    """
    rows = pin(df) if pinned else df
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    counted = rows.agg(F.count(F.lit(1)), F.sum(_row_bytes(rows))).first()
    return F.broadcast(rows) if counted[0] <= limit and (counted[1] or 0) <= BROADCAST_BYTES else rows
