"""Label encoding, class tables and class-balance statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.operators.clean import numeric_columns, q
from flowguard.session import small_table


def class_mapping(df: DataFrame, label: str = "Label") -> DataFrame:
    """(label_id, label): code = position of the label in the sorted distinct labels.

    The distinct-label table is tiny; ranking it in one window is bounded by the
    number of classes, never by the number of rows.
    """
    d = df.select(F.col(label).alias("label")).distinct()
    return d.select((F.row_number().over(Window.orderBy("label")) - 1).cast("int")
                    .alias("label_id"), "label")


def encode_labels(df: DataFrame, mapping: DataFrame, label: str = "Label",
                  out: str = "label_id") -> DataFrame:
    """Attach the class code (broadcast join against the size-checked mapping)."""
    m, _ = small_table(mapping.select(F.col("label").alias(label), F.col("label_id").alias(out)))
    return df.join(m, label, "left")


def unknown_labels(df: DataFrame, mapping: DataFrame, label: str = "Label") -> DataFrame:
    """Rows whose label is not in the mapping (to flag for human review)."""
    m, _ = small_table(mapping.select(F.col("label").alias(label)))
    return df.join(m, label, "left_anti")


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("Label", "Day")) -> list[str]:
    return numeric_columns(df, exclude)


def features(df: DataFrame, exclude: Sequence[str] = ("Label", "Day"),
             keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns as DOUBLE (minus ``exclude``), plus ``keep`` columns first."""
    feats = [c for c in feature_columns(df, list(exclude) + list(keep))]
    return df.select(*[F.col(q(k)) for k in keep],
                     *[F.col(q(c)).cast("double").alias(c) for c in feats])


def class_counts(df: DataFrame, mapping: DataFrame, label_id: str = "label_id") -> DataFrame:
    """(label_id, label, count, pct); classes of the mapping without rows get 0."""
    cnt = df.groupBy(label_id).agg(F.count(F.lit(1)).alias("count"))
    m, _ = small_table(mapping.select("label_id", "label"))
    full = (m.join(cnt.withColumnRenamed(label_id, "label_id"), "label_id", "left")
            .select("label_id", "label",
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))
    return full.withColumn("pct", F.try_divide(F.col("count") * 100.0,
                                               F.sum("count").over(Window.partitionBy())))


def class_counts_by(df: DataFrame, mapping: DataFrame, by: str, values: Sequence[str],
                    label_id: str = "label_id") -> DataFrame:
    """``class_counts`` per value of ``by`` (e.g. train / test), unioned."""
    out = None
    for v in values:
        part = class_counts(df.filter(F.col(by) == F.lit(v)), mapping, label_id) \
            .select(F.lit(v).alias(by), "*")
        out = part if out is None else out.unionByName(part)
    return out


def binary_label(df: DataFrame, label: str = "Label", benign: str = "benign",
                 out: str = "label_binary") -> DataFrame:
    """1 for attack, 0 for benign (benign named, case-insensitive)."""
    return df.withColumn(out, (F.lower(F.col(label)) != F.lit(benign.lower())).cast("int"))


def imbalance(counts: DataFrame) -> DataFrame:
    """(max_count, min_count, ratio, rarest_id, rarest) from a class-count table."""
    return counts.agg(
        F.max("count").alias("max_count"),
        F.min("count").alias("min_count"),
        F.min_by("label_id", F.struct("count", "label_id")).alias("rarest_id"),
        F.min_by("label", F.struct("count", "label_id")).alias("rarest"),
    ).withColumn("ratio", F.try_divide(F.col("max_count").cast("double"), F.col("min_count")))
