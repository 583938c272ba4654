"""Stage tables as Parquet: verified writes, reads with a clear missing-table error."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_verified(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write Parquet, read it back, compare rows, names and types: (path, rows, cols, ok).

    Rows are counted while they are written, so the source is computed once.  Partition
    columns carry no type in Parquet; they are read back with the source's types.
    """
    spark = df.sparkSession
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    own = {f.name: f.dataType for f in spark.read.parquet(path).schema if f.name not in (partition_by or ())}
    want = {f.name: f.dataType for f in df.schema if f.name not in (partition_by or ())}
    back = spark.read.schema(df.schema).parquet(path)
    n_back = back.count()
    ok = seen.get["rows"] == n_back and own == want and sorted(back.columns) == sorted(df.columns)
    return spark.createDataFrame([(path, n_back, len(back.columns), ok)],
                                 "path string, rows bigint, cols int, ok boolean")


def read_stage(spark: SparkSession, path: str, name: str) -> DataFrame:
    from flowguard.sources.csv_flows import path_exists
    if not path_exists(spark, path):
        raise FileNotFoundError(f"MISSING: {name} ({path}); rerun the stage that writes it")
    return spark.read.parquet(path)


def save_stage(tables: dict[str, DataFrame], base: str) -> DataFrame:
    """Save several tables under ``base/<name>`` and verify each: (table, rows, cols, ok)."""
    out = None
    for name, df in tables.items():
        v = write_verified(df, f"{base.rstrip('/')}/{name}").select(F.lit(name).alias("table"),
                                                                      "rows", "cols", "ok")
        out = v if out is None else out.unionByName(v)
    return out
