"""Session and shared-storage helpers.

On a cluster the checkpoint folder is named by ``spark.checkpoint.dir`` and is
shared by all executors; every written intermediate table goes below it.  A
private folder is created only when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

# Largest number of rows and of bytes that a derived "small" table may have to be broadcast.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 32 << 20
# Largest number of classes that a label may have; tables of one row per class are broadcast.
MAX_CLASSES = 10_000


def get_spark(master: str | None = None, app: str = "flowguard",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    running = SparkSession.getActiveSession()
    if running is not None:  # its master and sizes are the submitter's
        ensure_checkpoint_dir(running)
        return running
    builder = SparkSession.builder
    if master or "PYSPARK_SUBMIT_ARGS" not in os.environ:
        builder = builder.master(master or os.environ.get("FLOWGUARD_MASTER", "local[*]"))
    builder = (
        builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if "FLOWGUARD_DRIVER_MEMORY" in os.environ:
        builder = builder.config("spark.driver.memory", os.environ["FLOWGUARD_DRIVER_MEMORY"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="flowguard-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_rows(df: DataFrame, limit: int = MAX_CLASSES, what: str = "classes") -> list[Row]:
    """The rows of a table of one row per class, file or feature; an error beyond ``limit``."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}: this table must stay small")
    return rows


def value_bytes(value: Column, kind: DataType) -> Column:
    """Bytes of a value of the given type: eight and what it holds (null: eight)."""
    if isinstance(kind, (StringType, BinaryType)):
        held = F.octet_length(value)
    elif isinstance(kind, ArrayType):
        held = F.aggregate(value, F.lit(0).cast("bigint"), lambda so_far, x: so_far + value_bytes(x, kind.elementType))
    elif isinstance(kind, MapType):
        held = value_bytes(F.map_keys(value), ArrayType(kind.keyType)) + value_bytes(F.map_values(value), ArrayType(kind.valueType))
    elif isinstance(kind, StructType):
        held = sum((value_bytes(value.getField(f.name), f.dataType) for f in kind.fields), F.lit(0))
    else:
        return F.lit(8).cast("bigint")
    return F.coalesce(held.cast("bigint"), F.lit(0)) + 8


def small_table(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, int]:
    """Checkpoint a derived table and broadcast it only if its size is proven small.

    Returns ``(table, rows)``; above ``max_rows`` rows or ``max_bytes`` bytes (of all its
    values, as they are) the table is returned without a broadcast hint so the planner
    uses a shuffle join instead.
    """
    # a reliable checkpoint: survives executor loss and gives later plans a
    # shallow lineage (fast planning, fast cache matching)
    df = materialize(df)
    size = sum((value_bytes(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType) for f in df.schema.fields), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()
    return (F.broadcast(df) if r["n"] <= max_rows and r["size"] <= max_bytes else df), r["n"]
