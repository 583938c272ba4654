"""Stage tables by run: each run writes its own folders, a manifest says which are complete.

A table enters the manifest (run, table, path, schema, rows, content hash) only after it was written and read
back, so a run that broke off leaves no half table behind.  A later stage asks for names: it gets those of
the current run, else the newest complete ones of an earlier run, and an error that names what is missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.operators.clean import q
from flowguard.sources.csv_flows import path_exists

MANIFEST = ("run string, name string, path string, schema string, rows bigint, content string, written timestamp")


def content_hash(df: DataFrame) -> Column:
    """A digest of all rows that does not depend on their order (repeated rows count)."""
    rows = F.sum(F.xxhash64(*[F.col(q(c)) for c in df.columns]).cast("decimal(38,0)"))
    return F.coalesce(rows, F.lit(0).cast("decimal(38,0)")).cast("string")


def _manifest(base: str) -> str:
    return f"{base.rstrip('/')}/manifest"


def save_run(spark: SparkSession, base: str, run: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Write tables below ``base/runs/<run>``, verify each, enter them in the manifest: (name, rows, cols, ok).

    Rows and digest are taken while writing and again while reading back.  A name is written once per run.
    """
    done = []
    for name, df in tables.items():
        path = f"{base.rstrip('/')}/runs/{run}/{name}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), content_hash(df).alias("content")).write.mode("errorifexists").parquet(path)
        back = spark.read.schema(df.schema).parquet(path)
        got = back.agg(F.count(F.lit(1)).alias("rows"), content_hash(back).alias("content")).first()
        ok = (got["rows"], got["content"]) == (seen.get["rows"], seen.get["content"])
        if ok:
            entry = spark.createDataFrame([(run, name, path, df.schema.json(), got["rows"], got["content"])],
                                          "run string, name string, path string, schema string, rows bigint, content string")
            entry.withColumn("written", F.current_timestamp()).coalesce(1).write.mode("append").parquet(_manifest(base))
        done.append((name, got["rows"], len(df.columns), ok))
    return spark.createDataFrame(done, "name string, rows bigint, cols int, ok boolean")


def manifest(spark: SparkSession, base: str) -> DataFrame:
    if not path_exists(spark, _manifest(base)):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(_manifest(base))


def resolve(spark: SparkSession, base: str, names: Sequence[str], run: str) -> DataFrame:
    """(name, run, status, rows, path, schema, content) of every wanted name: status ``current``, ``earlier`` or ``missing``.

    An earlier run is one whose table was written before the current run's first (any, if the current has none).
    """
    entries = manifest(spark, base)
    own = entries.filter(F.col("run") == run)
    start = own.agg(F.min("written").alias("start"))
    before = entries.filter(F.col("run") != run).join(start, F.col("start").isNull() | (F.col("written") < F.col("start"))).drop("start")
    newest = Window.partitionBy("name").orderBy(F.desc("mine"), F.desc("written"), F.desc("run"))
    best = (own.withColumn("mine", F.lit(True)).unionByName(before.withColumn("mine", F.lit(False)))
            .withColumn("_r", F.row_number().over(newest)).filter("_r = 1"))
    wanted = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, position int")
    status = F.when(F.col("mine"), "current").when(F.col("mine").isNotNull(), "earlier").otherwise("missing")
    return wanted.join(best, "name", "left").orderBy("position").select("name", "run", status.alias("status"), "rows", "path", "schema", "content")


def read_run(spark: SparkSession, base: str, names: Sequence[str], run: str, verify: bool = False) -> dict[str, DataFrame]:
    """The wanted tables by name, read with the schema they were written with.

    ``verify`` reads each once more and compares rows and digest with the manifest.
    """
    found = resolve(spark, base, names, run).collect()  # one row per wanted name
    gone = [r["name"] for r in found if r["status"] == "missing"]
    if gone:
        raise FileNotFoundError(f"MISSING: {', '.join(gone)} ({base}, run {run} and earlier); rerun the stage that writes it")
    out = {}
    for r in found:
        df = spark.read.schema(T.StructType.fromJson(_json(r["schema"]))).parquet(r["path"])
        if verify:
            got = df.agg(F.count(F.lit(1)).alias("rows"), content_hash(df).alias("content")).first()
            if (got["rows"], got["content"]) != (r["rows"], r["content"]):
                raise ValueError(f"CHANGED: {r['name']} ({r['path']}) is not what run {r['run']} wrote")
        out[r["name"]] = df
    return out


def _json(text: str) -> dict:
    import json
    return json.loads(text)
