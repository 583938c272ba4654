"""Derived fixtures: flow-like tables built from the driver tables by deterministic
Spark SQL (same definitions in ``oracle.py`` for DuckDB).

The driver tables are clean, so faults are planted by rules over whole tables
(every row is kept; some get a planted fault).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "row_key"
LABEL = "Label"
DAY = "Day"
# Fixed order of the planted flow features (column order of the raw table).
FLOW_FEATURES = (
    "Flow Duration",
    "Total Fwd Packets",
    "Flow Bytes/s",
    "Fwd Packet Length Max",
    "Bwd PSH Flags",
    "Destination Port",
)
# The raw label texts the rules plant (stripped form is the pivot key).
RAW_LABELS_STRIPPED = ("BENIGN", "DoS Hulk", "FTP-Patator", "Infiltration",
                       "Web Attack - XSS", "ftp patator")
SEED = 42
WIDE = 64  # features of the wide table: the dimensions of ``embeddings``


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flows_from_events(e: DataFrame) -> DataFrame:
    """Flow rows from ``events`` with planted label variants and faults, plus a
    second copy of every row with ``row_key % 50 = 0`` (exact duplicates).
    A pure projection + union, so it serves batch and streaming alike."""
    eid, v = F.col("event_id"), F.col("value")
    et = F.col("event_type")
    label = (F.when(eid % 499 == 1, "Infiltration")
             .when(et == "purchase", "DoS Hulk")
             .when((et == "error") & (eid % 2 == 0), "FTP-Patator")
             .when(et == "error", " ftp patator")
             .when((et == "signup") & (eid % 7 == 0), "Web Attack - XSS")
             .otherwise("BENIGN "))
    base = e.select(
        eid.alias(KEY),
        F.concat(F.lit("Day"), F.dayofmonth("ts").cast("string"),
                 F.lit("-WorkingHours.pcap_ISCX.csv")).alias(DAY),
        F.when(eid % 101 == 0, -v).otherwise(v).alias("Flow Duration"),
        F.when(eid % 211 == 0, F.lit("abc")).otherwise(F.col("user_id").cast("string"))
         .alias("Total Fwd Packets"),
        F.when(eid % 89 == 0, F.lit(float("inf")))
         .when(eid % 97 == 0, F.lit(None).cast("double"))
         .otherwise(v * F.col("user_id")).alias("Flow Bytes/s"),
        (v * 2 + (eid % 3) * 0.5).alias("Fwd Packet Length Max"),
        F.lit(0.0).alias("Bwd PSH Flags"),
        (eid % 65536).cast("double").alias("Destination Port"),
        label.alias(LABEL),
    )
    return base.unionByName(base.filter(F.col(KEY) % 50 == 0))


def flows_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows_from_events(table(spark, sf_dir, "events"))


def rare_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` joined to ``documents``: class = quality-toxic, features from the text."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    j = lab.join(doc, "doc_id")
    return j.select(
        F.col("doc_id").alias(KEY),
        F.concat_ws("-", F.col("quality").cast("string"), F.col("toxic").cast("string")).alias(LABEL),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.col("text"), " ")).cast("double").alias("n_words"),
    )


def wide_features(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """``embeddings`` as a table of ``WIDE`` feature columns; with ``gaps`` every seventh value is NULL."""
    e = table(spark, sf_dir, "embeddings")

    def value(i: int):
        v = F.get(F.col("embedding"), F.lit(i)).cast("double")
        return F.when((F.col("vec_id") + i) % 7 != 0, v) if gaps else v
    return e.select(F.col("vec_id").alias(KEY), F.col("label").alias(LABEL), *[value(i).alias(f"e{i}") for i in range(WIDE)])
