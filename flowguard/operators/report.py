"""Synthesis tables: the facts of the workflow as (section, key, value) rows
and per-class tables, computed from the data (no typed-in numbers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.session import small_table


def synthesis_profile(facts: DataFrame, funnel: DataFrame, encoding_issues: DataFrame | None = None) -> DataFrame:
    """Dataset profile (section, key, value) from ``clean.quality_facts`` (one row), the feature funnel and the load
    log's rows of encoding issues."""
    issues = encoding_issues.count() if encoding_issues is not None else 0
    rows = [("profile", "rows_after_cleaning", F.col("rows")), ("profile", "source_files", F.col("files")),
            ("quality", "duplicates_removed", F.col("duplicates")), ("quality", "duplicate_pct", F.col("duplicate_pct")),
            ("quality", "negatives_fixed", F.col("negatives")), ("quality", "infinities_fixed", F.col("infinities")),
            ("quality", "encoding_issues", F.lit(issues))]
    known = facts.select(F.inline(F.array(*[F.struct(F.lit(section).alias("section"), F.lit(key).alias("key"), v.cast("double").alias("value"))
                                            for section, key, v in rows])))
    return known.unionByName(funnel.select(F.lit("features").alias("section"), F.concat(F.lit("after_"), F.col("step")).alias("key"),
                                           F.col("remaining").cast("double").alias("value")))


def synthesis_imbalance(weights_report: DataFrame, imbalance: DataFrame) -> DataFrame:
    """Weights by class (weight-descending) with n and share, and the ratio."""
    ratio = imbalance.select(F.col("ratio").alias("imbalance_ratio"))
    r = ratio.first()["imbalance_ratio"]  # one value
    return weights_report.select(F.col("label").alias("class"), F.col("count").alias("n"), "pct",
                                 "weight", F.lit(r).cast("double").alias("imbalance_ratio"))


# What a flow feature measures (synthesis annotations).
FEATURE_MEANINGS = {
    "Flow Duration":
        "Total time of the connection. DoS attacks often have very short or very long flows.",
    "Bwd Packet Length Max":
        "Largest packet sent backward. Large payloads indicate data exfiltration or scanning responses.",
    "Flow Bytes/s":
        "Byte rate of the flow. Anomalously high rates signal flooding or bulk exfiltration.",
    "Flow IAT Mean":
        "Average inter-arrival time between packets. Bots send packets at machine-regular intervals.",
    "Fwd PSH Flags":
        "Push flag usage in forward direction. Elevated counts reveal certain port-scanning patterns.",
    "Fwd Packet Length Max":
        "Largest forward packet. Oversized payloads may indicate buffer-overflow attempts.",
    "Packet Length Variance":
        "Variability of packet sizes. High variance is typical of mixed attack traffic.",
    "Init_Win_bytes_backward":
        "TCP window advertised in backward SYN-ACK. Unusual values reveal OS fingerprinting.",
    "Init_Win_bytes_forward":
        "TCP window in forward SYN. Scanning tools use non-standard values.",
    "min_seg_size_forward":
        "Smallest segment forward. Very small segments are a hallmark of slowloris-type attacks.",
    "Active Mean":
        "Mean time the flow was active before going idle. Helps distinguish bursty vs. steady attacks.",
    "Idle Mean":
        "Mean idle time between activity. Long idles distinguish low-and-slow attacks.",
    "Average Packet Size":
        "Mean packet size across flow. Combined with rate separates many attack classes from BENIGN.",
    "Subflow Fwd Bytes":
        "Bytes in forward sub-flows. Useful for detecting encrypted channel tunnelling.",
    "Total Length of Fwd Packets":
        "Total payload sent forward. Key discriminator for exfiltration vs. normal use.",
}
# Fixed value: meaning of a feature without a note.
DEFAULT_MEANING = "Network flow characteristic."

# Agreement of a feature with the published study.
LITERATURE_MATCH = {
    "Flow Duration": "CONSISTENT — Sharafaldin et al. Table III lists it as top-5.",
    "Bwd Packet Length Max": "CONSISTENT — highlighted in Sharafaldin et al. for PortScan detection.",
    "Flow Bytes/s": "CONSISTENT — DDoS/DoS indicator in multiple CICIDS papers.",
    "Flow IAT Mean": "CONSISTENT — bot traffic regularity noted in the original paper.",
    "Fwd PSH Flags": "CONSISTENT — port-scan signature feature per Sharafaldin et al.",
    "Fwd Packet Length Max": "CONSISTENT — exploit payload size noted for Web Attacks.",
    "Packet Length Variance": "CONSISTENT — variance features cited for mixed-class separability.",
    "Init_Win_bytes_backward": "CONSISTENT — TCP handshake features flagged in Sharafaldin et al.",
    "Init_Win_bytes_forward": "CONSISTENT — same family as above, strong SYN-based discriminator.",
    "min_seg_size_forward": "CONSISTENT — slowloris/Heartbleed discriminator per literature.",
    "Active Mean": "PARTIAL — mentioned but ranked lower in Sharafaldin et al.",
    "Idle Mean": "PARTIAL — present in dataset but not consistently ranked top.",
    "Average Packet Size": "CONSISTENT — cited as a reliable aggregate feature.",
    "Subflow Fwd Bytes": "CONSISTENT — sub-flow features validated in follow-up CICIDS work.",
    "Total Length of Fwd Packets": "CONSISTENT — strong discriminator in Sharafaldin et al. Table III.",
}
# Fixed value: agreement of a feature without an entry.
DEFAULT_LITERATURE = "Not specifically cited in Sharafaldin et al."


def feature_dictionary(spark: SparkSession) -> DataFrame:
    """The dictionary above as a table: feature, meaning, literature."""
    return spark.createDataFrame([(k, FEATURE_MEANINGS.get(k), LITERATURE_MATCH.get(k)) for k in sorted(set(FEATURE_MEANINGS) | set(LITERATURE_MATCH))],
                                 "feature string, meaning string, literature string")


#: Texts of a feature that the dictionary above lacks.
DEFAULTS = {"meaning": DEFAULT_MEANING, "literature": DEFAULT_LITERATURE}


def annotate(df: DataFrame, dictionary: DataFrame | None = None, defaults: dict[str, str] = DEFAULTS, feature: str = "feature") -> DataFrame:
    """Attach the texts of a dictionary: one row per ``feature`` and a column per kind of text; ``defaults`` gives the
    text of a kind where a feature has none.  Without a dictionary that of ``feature_dictionary``."""
    texts = feature_dictionary(df.sparkSession) if dictionary is None else dictionary
    texts, _ = small_table(texts.withColumnRenamed("feature", feature))
    kinds = [c for c in texts.columns if c != feature]
    out = df.join(texts, feature, "left")
    return out.withColumns({k: F.coalesce(k, F.lit(defaults[k])) for k in kinds if k in defaults})


def synthesis_classes(counts: DataFrame, per_class_top: DataFrame) -> DataFrame:
    """Per class (count-descending): count, share, top features with annotations."""
    top = annotate(per_class_top.withColumnRenamed("scope_class", "label"))
    return counts.join(top, "label", "left").select(
        F.col("label").alias("class"), "count", "pct", "rank", "feature", "importance",
        "meaning", "literature", "fallback").orderBy(F.desc("count"), "class", "rank")


def synthesis_features(global_top: DataFrame, removed: DataFrame, k: int = 10) -> DataFrame:
    """Top-k global features with score and annotations, then the removed-feature log."""
    top = annotate(global_top.filter(F.col("rank") <= k)).select(
        F.lit("top_feature").alias("kind"), "rank", "feature", "importance", "meaning", "literature")
    rem = removed.select(F.lit("removed").alias("kind"), F.lit(None).cast("int").alias("rank"),
                         "feature", F.lit(None).cast("double").alias("importance"),
                         F.col("reason").alias("meaning"), F.lit(None).cast("string").alias("literature"))
    return top.unionByName(rem)
