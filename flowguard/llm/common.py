"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.session import ensure_checkpoint_dir, materialize, scratch_path  # noqa: F401

#: Words: runs of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
#: The same characters as bytes, for splitting UTF-8 without decoding it.
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes that a derived table may have to be broadcast.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package through Spark, once per application, for workers that cannot import it."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    import flowguard

    root = Path(flowguard.__file__).parent
    with tempfile.NamedTemporaryFile(prefix="flowguard-", suffix=".zip", delete=False) as f:
        with zipfile.ZipFile(f, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, str(p.relative_to(root.parent)))
    spark.sparkContext.addPyFile(f.name)
    _SHIPPED.add(spark.sparkContext.applicationId)


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Keep Arrow batches small: a batch of very long texts must fit in a Python worker."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def crc_remainder(key: str, mod: int) -> Column:
    """crc32 of the key as text, modulo ``mod`` (null keys: remainder of the empty text)."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % F.lit(mod)).cast("int")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Checkpoint a derived table; hint a broadcast only where rows times ``row_bytes`` is within the limit.

    Beyond it the table is returned without a hint, and the planner uses a shuffle join.
    """
    df = materialize(df)
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def arrow_rows(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of at most ``rows`` rows and, but for single rows, ``size`` bytes."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).get_total_buffer_size() > size and batch.slice(at, n).nbytes > size:
                n = max(1, n // 2)
            yield batch.slice(at, n)
            at += n
    pa.default_memory_pool().release_unused()  # workers live on; executors' memory is shared with them


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of undirected edges ``(a, b)`` of long ids: one row ``(id, component)`` per node.

    ``component`` is the smallest id reachable.  Alternates large-star and small-star steps, each an
    aggregate (map-side combined) and an equi-join, until the edge set no longer changes; a node of very
    high degree only makes a skewed join side, which adaptive execution splits.  Self loops and repeated
    edges are allowed, null ends are ignored.
    """
    e = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, seen = materialize(e), None
    while True:
        state = e.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if tuple(state) == seen or state["n"] == 0:
            break
        seen = tuple(state)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return (e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
