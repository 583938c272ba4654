"""Catalog: profiling and feature selection (D) and the preprocessing step (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowguard.operators import clean, preprocess, profile, report, sampling
from flowguard.plans import oracle as O
from flowguard.plans.catalog import register, rounded
from flowguard.plans.fixtures import FLOW_FEATURES, KEY, SEED
from flowguard.plans.flows import Workflow

qi, rnd = O.qi, O.rnd

# Features whose per-class distribution is profiled, in order.
FEATURES_OF_INTEREST = ("Flow Duration", "Total Fwd Packets", "Destination Port",
                        "SYN Flag Count", "Flow IAT Mean")

# One-line meaning of a flow feature, shown next to its importance.
FEATURE_NOTES = {
    "Flow Duration": "Total time of network flow. Short for automated attacks.",
    "Total Fwd Packets": "Packets from source to destination. Low for brute force.",
    "Destination Port": "Target port. Concentrated for targeted attacks (21, 22, 80).",
    "SYN Flag Count": "TCP SYN flags. High for connection-heavy attacks.",
    "Flow IAT Mean": "Inter-arrival time between packets. Very low for automated tools.",
    "Fwd Packet Length Mean": "Avg byte size of forward packets. Tiny for DoS floods.",
    "Bwd Packet Length Mean": "Avg byte size of reply packets. Low if server rejects quickly.",
    "Packet Length Variance": "Variance in packet sizes. Low for automated uniform attacks.",
    "Flow Bytes/s": "Throughput. Extreme for volumetric DoS.",
    "Flow Packets/s": "Packet rate. Very high for DoS/DDoS.",
    "PSH Flag Count": "Push flags. Reveals data transfer patterns.",
    "ACK Flag Count": "Acknowledge flags. High in established sessions.",
    "Init_Win_bytes_forward": "Initial TCP window size forward. Fingerprints OS/tool.",
    "Init_Win_bytes_backward": "Initial TCP window backward. Reveals server response pattern.",
    "min_seg_size_forward": "Min segment size. Low for minimal-payload attacks.",
    "Average Packet Size": "Mean flow packet size. Distinguishes bulk vs probe traffic.",
    "Subflow Fwd Bytes": "Bytes per subflow forward. Reflects attack payload volume.",
    "Subflow Bwd Bytes": "Bytes per subflow backward. Reflects server response volume.",
}
# Fixed value: note of a feature without one.
DEFAULT_NOTE = "Network flow metric used by CICFlowMeter."


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NOTES_SQL = ", ".join(f"({_sql_str(k)}, {_sql_str(v)})" for k, v in FEATURE_NOTES.items())
_PUB_SQL = ", ".join(f"({_sql_str(p)})" for p in profile.PUBLISHED_TOP_FEATURES)


@register("profile_medians", O.with_(O.PREP, " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {rnd(f'median({qi(f)})')} AS median, {i} AS position FROM train"
    for i, f in enumerate(FLOW_FEATURES))))
def profile_medians(spark, sf):
    w = Workflow(spark, sf)
    return rounded(w.medians)


@register("profile_filled", O.with_(O.PREP, f"""
SELECT 'train' AS split, * FROM train_f UNION ALL SELECT 'test' AS split, * FROM test_f"""))
def profile_filled(spark, sf):
    w = Workflow(spark, sf)
    tr = w.train_filled.select(F.lit("train").alias("split"), "*")
    te = w.test_filled.select(F.lit("test").alias("split"), "*")
    return rounded(tr.unionByName(te))


@register("profile_zero_variance", O.with_(O.PREP, "SELECT feature, reason, position FROM zv"))
def profile_zero_variance(spark, sf):
    return Workflow(spark, sf).zero_var


@register("profile_corr", O.with_(O.PREP, f"SELECT feature_a, feature_b, {rnd('r')} AS r FROM pairs"))
def profile_corr(spark, sf):
    return rounded(Workflow(spark, sf).pairs.select("feature_a", "feature_b", "r"))


@register("profile_corr_wide", f"""
WITH v AS (SELECT vec_id, i - 1 AS i, CASE WHEN (vec_id + i - 1) % 7 <> 0 THEN CAST(embedding[i] AS DOUBLE) END AS x
           FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS i) g)
SELECT 'e' || a.i AS feature_a, 'e' || b.i AS feature_b, {rnd('corr(a.x, b.x)')} AS r
FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""")
def profile_corr_wide(spark, sf):
    """Pairwise-complete correlations of 64 features (2,016 pairs) with NULLs in all of them."""
    from flowguard.plans.fixtures import WIDE, wide_features
    t = wide_features(spark, sf, gaps=True)
    return rounded(profile.corr_pairs(t, [f"e{i}" for i in range(WIDE)]).select("feature_a", "feature_b", "r"))


@register("profile_high_corr", O.with_(O.PREP, f"SELECT feature_a, feature_b, {rnd('r')} AS r FROM high"))
def profile_high_corr(spark, sf):
    return rounded(Workflow(spark, sf).high.select("feature_a", "feature_b", "r"))


@register("profile_top_corr", O.with_(O.PREP + """,
top AS (SELECT feature_a, feature_b, row_number() OVER (ORDER BY r DESC, pos_a, pos_b) AS rk FROM high),
top30 AS (SELECT * FROM top WHERE rk <= 30),
tf AS (SELECT feature FROM (
         SELECT feature, min(rk) AS first FROM (SELECT feature_a AS feature, rk FROM top30
                                                UNION ALL SELECT feature_b, rk FROM top30) GROUP BY feature)
       QUALIFY row_number() OVER (ORDER BY first, feature) <= 30)""", f"""
SELECT feature_a, feature_b, {rnd('r')} AS r FROM pairs
WHERE feature_a IN (SELECT feature FROM tf) AND feature_b IN (SELECT feature FROM tf)"""))
def profile_top_corr(spark, sf):
    w = Workflow(spark, sf)
    return rounded(profile.top_corr_features(w.high, w.pairs, 30, 30))


@register("profile_redundant", O.with_(O.PREP, "SELECT feature, reason FROM red"))
def profile_redundant(spark, sf):
    return Workflow(spark, sf).redundant


_SMP = O.PREP
_FOI = [f for f in FEATURES_OF_INTEREST if f in FLOW_FEATURES]
_SMP_LONG = (f"(UNPIVOT (SELECT label_id, {', '.join(qi(f) for f in _FOI)} FROM train) "
             f"ON {', '.join(qi(f) for f in _FOI)} INTO NAME feature VALUE value)")


@register("profile_class_means", O.with_(_SMP, f"""
SELECT label_id, feature, {rnd('avg(value)')} AS mean FROM {_SMP_LONG} GROUP BY 1, 2"""))
def profile_class_means(spark, sf):
    w = Workflow(spark, sf)
    return rounded(profile.class_means(w.train, FEATURES_OF_INTEREST))


@register("profile_box_stats", O.with_(_SMP + f""",
bl AS (SELECT * FROM {_SMP_LONG}),
bq AS (SELECT label_id, feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
              quantile_cont(value, 0.75) AS q3 FROM bl GROUP BY 1, 2)""", f"""
SELECT label_id, feature, {rnd('q1')} AS q1, {rnd('median')} AS median, {rnd('q3')} AS q3, count(*) AS n,
  {rnd('min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))')} AS whisker_lo,
  {rnd('max(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))')} AS whisker_hi,
  CAST(count_if(NOT (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))) AS BIGINT) AS outliers
FROM bl JOIN bq USING (label_id, feature) GROUP BY label_id, feature, q1, median, q3"""))
def profile_box_stats(spark, sf):
    w = Workflow(spark, sf)
    return rounded(profile.class_box_stats(w.train, FEATURES_OF_INTEREST))


@register("profile_funnel", O.with_(O.PREP, f"""
SELECT 'initial' AS step, CAST({len(FLOW_FEATURES)} AS BIGINT) AS remaining, CAST(0 AS BIGINT) AS removed
UNION ALL SELECT 'zero_variance', {len(FLOW_FEATURES)} - (SELECT count(*) FROM zv), (SELECT count(*) FROM zv)
UNION ALL SELECT 'correlated', (SELECT count(*) FROM final_feat),
                 (SELECT count(*) FROM red WHERE feature NOT IN (SELECT feature FROM zv))
UNION ALL SELECT 'final', (SELECT count(*) FROM final_feat), {len(FLOW_FEATURES)} - (SELECT count(*) FROM final_feat)"""))
def profile_funnel(spark, sf):
    w = Workflow(spark, sf)
    return profile.feature_funnel(w.features, w.zero_var, w.redundant)


@register("profile_importance_topk", O.with_(O.PREP, f"""
SELECT feature, {rnd('importance')} AS importance, CAST(rank AS INTEGER) AS rank FROM imp_rank WHERE rank <= 20"""))
def profile_importance_topk(spark, sf):
    """Top 20 features by |r| with the attack flag (SQL-checkable importance)."""
    w = Workflow(spark, sf)
    return rounded(profile.top_k(w.importance, 20))


@register("profile_literature_overlap", O.with_(O.PREP + f""",
pub AS (SELECT * FROM (VALUES {_PUB_SQL}) v(feature))""", f"""
SELECT 8 AS k, count(*) AS overlap, {rnd('count(*) * 100.0 / 8')} AS pct,
       coalesce(string_agg(feature, ', ' ORDER BY feature), '') AS features
FROM imp_rank WHERE rank <= 8 AND feature IN (SELECT feature FROM pub)"""))
def profile_literature_overlap(spark, sf):
    w = Workflow(spark, sf)
    return rounded(profile.literature_overlap(w.importance, 8))


@register("profile_annotate", O.with_(O.PREP + f""",
notes AS (SELECT * FROM (VALUES {_NOTES_SQL}) v(feature, meaning)),
pub AS (SELECT * FROM (VALUES {_PUB_SQL}) v(feature))""", f"""
SELECT CAST(r.rank AS INTEGER) AS rank, r.feature, {rnd('r.importance')} AS importance,
       coalesce(n.meaning, '{DEFAULT_NOTE}') AS meaning,
       CASE WHEN r.feature IN (SELECT feature FROM pub) THEN 'YES' ELSE 'PARTIAL' END AS matches_literature
FROM imp_rank r LEFT JOIN notes n USING (feature) WHERE r.rank <= 5"""))
def profile_annotate(spark, sf):
    w = Workflow(spark, sf)
    top = profile.top_k(w.importance, 5)
    names = sorted(set(FEATURE_NOTES) | set(profile.PUBLISHED_TOP_FEATURES))
    notes = spark.createDataFrame([(n, FEATURE_NOTES.get(n), "YES" if n in profile.PUBLISHED_TOP_FEATURES else None) for n in names],
                                  "feature string, meaning string, matches_literature string")
    return rounded(report.annotate(top, notes, {"meaning": DEFAULT_NOTE, "matches_literature": "PARTIAL"}).select(
        "rank", "feature", "importance", "meaning", "matches_literature"))


@register("profile_null_totals", O.with_(O.PREP, "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS \"column\", (SELECT count_if({qi(f)} IS NULL) FROM train)::BIGINT AS nulls_before, (SELECT count_if({qi(f)} IS NULL) FROM train_f)::BIGINT AS nulls_after"
    for f in FLOW_FEATURES) + ") UNION ALL SELECT 'total', (SELECT " + " + ".join(f"count_if({qi(f)} IS NULL)" for f in FLOW_FEATURES) + " FROM train)::BIGINT, (SELECT "
    + " + ".join(f"count_if({qi(f)} IS NULL)" for f in FLOW_FEATURES) + " FROM train_f)::BIGINT"))
def profile_null_totals(spark, sf):
    """Missing values of train by feature and in total, before and after the median fill."""
    w = Workflow(spark, sf)
    cols = [F.col(clean.q(c)) for c in w.features]
    return clean.null_totals(w.train.select(*cols), w.train_filled.select(*cols))


# ── E: preprocessing ────────────────────────────────────────────────────────

_PARAMS = O.PREP + """,
params AS (SELECT feature, median(value) AS median, fsum(value) / count(value) AS mean, stddev_pop(value) AS std
           FROM train_long GROUP BY feature)"""


@register("preprocess_params", O.with_(_PARAMS, f"""
SELECT feature, {rnd('median')} AS median, {rnd('mean')} AS mean, {rnd('std')} AS std FROM params"""))
def preprocess_params(spark, sf):
    w = Workflow(spark, sf)
    p = preprocess.fit_preprocess(w.train_filled, w.final_features, w.medians)
    return rounded(p.select("feature", "median", "mean", "std"))


@register("preprocess_scaled", O.with_(_PARAMS, f"""
SELECT 'train' AS split, row_key, feature,
       {rnd("(coalesce(value, p.median) - p.mean) / CASE WHEN p.std = 0 THEN 1 ELSE p.std END")} AS value
FROM train_long JOIN params p USING (feature)
UNION ALL
SELECT 'test' AS split, row_key, feature,
       {rnd("(coalesce(value, p.median) - p.mean) / CASE WHEN p.std = 0 THEN 1 ELSE p.std END")} AS value
FROM test_long JOIN params p USING (feature)"""))
def preprocess_scaled(spark, sf):
    """Scaled train and test (fitted on train), as (split, row_key, feature, value)."""
    w = Workflow(spark, sf)
    feats = w.final_features
    p = preprocess.fit_preprocess(w.train_filled, feats, w.medians)
    out = None
    for name, df in (("train", w.train_filled), ("test", w.test_filled)):
        s = preprocess.apply_preprocess(df, p, keep=[KEY])
        long_ = profile.to_long(s, feats, ids=[KEY]).select(F.lit(name).alias("split"), "*")
        out = long_ if out is None else out.unionByName(long_)
    return rounded(out)
