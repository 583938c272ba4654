"""Catalog: streaming queries (I1, I2) — run with availableNow into Parquet, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowguard.plans import oracle as O
from flowguard.plans.catalog import SQL, register
from flowguard.plans.catalog_models import load_artifacts, save_artifacts
from flowguard.plans.fixtures import KEY, LABEL, flows_from_events
from flowguard.plans.flows import Workflow
from flowguard.session import scratch_path
from flowguard.streaming import quarantine
from flowguard.streaming import score as S


@register("stream_unknown_labels")
def stream_unknown_labels(spark, sf):
    """Stream of flows (from ``events``) -> rows with labels the encoder never saw."""
    w = Workflow(spark, sf)
    flows = flows_from_events(S.event_stream(spark, sf))
    path = S.run_to_parquet(S.flag_unknown(flows, w.mapping).select(LABEL), "unknown")
    return spark.read.parquet(path).groupBy(F.col(LABEL).alias("label")) \
                .agg(F.count(F.lit(1)).alias("rows"))


SQL["stream_unknown_labels"] = SQL["encode_unknown_labels"]  # same answer as the batch operator


@register("stream_score")
def stream_score(spark, sf):
    """Stream of flows, scored from saved artifacts: validated, contract checked, imputed,
    scaled, predicted class and alert flag."""
    a = load_artifacts(spark, save_artifacts(Workflow(spark, sf)))
    flows = flows_from_events(S.event_stream(spark, sf))
    scored = S.score(flows, a.medians, a.params, a.model, a.features, a.mapping, keep=[KEY], contract=a.contract)
    return spark.read.parquet(S.run_to_parquet(scored, "score"))


@register("stream_score_checks", O.with_(O.FLOWS, """
SELECT count(*) AS rows, count(DISTINCT row_key) AS keys, CAST(0 AS BIGINT) AS unknown_classes,
       CAST(0 AS BIGINT) AS wrong_alerts
FROM flows_raw"""))
def stream_score_checks(spark, sf):
    """Every row of the stream is scored once, with a known class and the alert that follows from it."""
    got = stream_score(spark, sf)
    alert = (F.lower("predicted_class") != "benign").cast("int")
    return got.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(KEY).alias("keys"),
                   F.count_if(F.col("predicted_class").isNull()).alias("unknown_classes"),
                   F.count_if(~F.col("alert").eqNullSafe(alert)).alias("wrong_alerts"))


@register("stream_quarantine", O.with_(O.FLOWS, """
SELECT 'rejected' AS kind, row_key, 'Total Fwd Packets' AS reasons, count(*) AS copies FROM flows_raw
WHERE "Total Fwd Packets" IS NOT NULL AND TRY_CAST("Total Fwd Packets" AS DOUBLE) IS NULL GROUP BY row_key
UNION ALL SELECT 'scored', row_key, NULL, count(*) FROM flows_raw
WHERE "Total Fwd Packets" IS NULL OR TRY_CAST("Total Fwd Packets" AS DOUBLE) IS NOT NULL GROUP BY row_key"""))
def stream_quarantine(spark, sf):
    """The scoring stream with a quarantine: every row is scored once, or rejected once with the columns that it cannot
    give as numbers."""
    a = load_artifacts(spark, save_artifacts(Workflow(spark, sf)))
    flows = flows_from_events(S.event_stream(spark, sf))
    out = scratch_path(spark, "stream-quarantine")
    quarantine.run_quarantined(flows, lambda good: S.score(good, a.medians, a.params, a.model, a.features, a.mapping, keep=[KEY]), out)
    scored = spark.read.parquet(f"{out}/{quarantine.SCORED}").select(F.lit("scored").alias("kind"), KEY, F.lit(None).cast("string").alias("reasons"))
    rejected = spark.read.parquet(f"{out}/{quarantine.REJECTED}").select(F.lit("rejected").alias("kind"), KEY, F.array_join("reasons", ", ").alias("reasons"))
    return scored.unionByName(rejected).groupBy("kind", KEY, "reasons").agg(F.count(F.lit(1)).alias("copies"))
