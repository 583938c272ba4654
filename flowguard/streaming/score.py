"""Streaming operators.

Both are stateless per row (projections and a stream-static join, broadcast where
the mapping's size is proven), so they need no watermark; results go to a Parquet sink with its checkpoint in
the shared checkpoint folder, and ``trigger(availableNow=True)`` processes
everything present and stops (exactly-once through the sink's commit log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.functions.labels import strip_ws
from flowguard.operators import clean, models, preprocess
from flowguard.session import scratch_path, small_table
from flowguard.sources.contract import check_schema

EVENTS_SCHEMA = ("event_id bigint, ts timestamp, user_id bigint, event_type string, "
                 "value double, props string")


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table read as a file stream with an explicit schema (all new files
    of a trigger in one batch, unless bounded)."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{{events}}.parquet")  # a pattern of exactly this name


def run_to_parquet(df: DataFrame, name: str) -> str:
    """Run a streaming DataFrame until the available input is consumed; return the sink path."""
    spark = df.sparkSession
    out = scratch_path(spark, f"stream-{name}")
    q = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", out + "-checkpoint")
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def flag_unknown(flows: DataFrame, mapping: DataFrame, label: str = "Label") -> DataFrame:
    """Rows whose (stripped) label is not in the class mapping (stream-static anti join)."""
    m, _ = small_table(mapping.select(F.col("label").alias("_known")))
    s = flows.withColumn(label, strip_ws(F.col(label)))
    return s.join(m, s[label] == m["_known"], "left_anti")


def score(flows: DataFrame, medians: dict, params: DataFrame, model, features: list[str],
          mapping: DataFrame, keep: list[str], benign: str = "benign",
          contract: DataFrame | None = None) -> DataFrame:
    """validate -> contract check -> fill train medians -> scale -> predict -> class name + binary alert.

    A stream that lacks a feature of the contract, or has it with another type, is
    refused before it starts; values that cannot be read are missing values."""
    v = clean.validate(flows)
    if contract is not None:
        check_schema(v, contract)
    v = v.select(*[F.coalesce(F.col(clean.q(c)), F.lit(medians[c])).alias(c)
                   if c in medians else F.col(clean.q(c)) for c in v.columns])
    x = preprocess.apply_preprocess(v, params, keep=keep)
    pred = models.predict(model, x, features, keep=keep)
    m, _ = small_table(mapping.select(F.col("label_id").alias("prediction"),
                                      F.col("label").alias("predicted_class")))
    return (pred.join(m, "prediction", "left")
            .withColumn("alert", (F.lower("predicted_class") != benign.lower()).cast("int")))
