"""Catalog: class weights and resampling (F), evaluation (G) and synthesis (H)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.operators import clean, encode, evaluate, imbalance, profile, report, sampling
from flowguard.operators.smote import smote
from flowguard.plans import flows as P
from flowguard.plans import oracle as O
from flowguard.plans.catalog import register, rounded
from flowguard.plans.catalog_ingest import EVEN_DAY, latin1_files, load_faulty
from flowguard.plans.fixtures import KEY, SEED
from flowguard.plans.flows import Workflow
from flowguard.session import small_table

qi, rnd = O.qi, O.rnd

# ── F: weights and resampling ───────────────────────────────────────────────

_W = O.PREP + """,
tc AS (SELECT label_id, count(*) AS count FROM train GROUP BY 1),
cw AS (SELECT t.label_id, m.label, t.count, sum(t.count) OVER () / (count(*) OVER () * t.count) AS weight
       FROM tc t JOIN mapping m USING (label_id)),
cwr AS (SELECT *, count * 100.0 / sum(count) OVER () AS pct,
               weight / max(weight) FILTER (WHERE lower(label) = 'benign') OVER () AS weight_vs_benign FROM cw),
imb AS (SELECT max(count) / min(count) AS ratio FROM (
          SELECT m.label_id, count(t.row_key) AS count FROM mapping m LEFT JOIN train t USING (label_id) GROUP BY 1))"""


@register("imbalance_class_weights", O.with_(_W, f"SELECT label_id, label, count, {rnd('weight')} AS weight FROM cw"))
def imbalance_class_weights(spark, sf):
    w = Workflow(spark, sf)
    return rounded(imbalance.class_weights(w.train, w.mapping))


@register("imbalance_weights_report", O.with_(_W, f"""
SELECT label_id, label, count, {rnd('pct')} AS pct, {rnd('weight')} AS weight,
       {rnd('weight_vs_benign')} AS weight_vs_benign FROM cwr"""))
def imbalance_weights_report(spark, sf):
    w = Workflow(spark, sf)
    return rounded(imbalance.weights_report(imbalance.class_weights(w.train, w.mapping)))


_US = O.PREP + f""",
us_c AS (SELECT label_id, count(*) AS n FROM train GROUP BY 1),
us AS (SELECT row_key, label_id FROM (
         SELECT t.*, row_number() OVER (PARTITION BY label_id ORDER BY {O.h('under')}, row_key) AS rn FROM train t)
       WHERE rn <= (SELECT min(n) FROM us_c))"""

_OV = O.PREP + f""",
ov_c AS (SELECT label_id, count(*) AS n FROM train GROUP BY 1),
ov_d AS (SELECT label_id, n, max(n) OVER () - n AS d FROM ov_c),
ov_num AS (SELECT t.row_key, t.label_id,
                  row_number() OVER (PARTITION BY t.label_id ORDER BY {O.h('over', 't.row_key')}, t.row_key) AS rn
           FROM train t WHERE t.label_id IN (SELECT label_id FROM ov_d WHERE d > 0)),
ov_slots AS (SELECT label_id, n, unnest(generate_series(1, d)) AS copy_id FROM ov_d WHERE d > 0),
ov_pick AS (SELECT label_id, copy_id,
                   CAST(('0x' || substr(md5('{SEED}|over-pick|' || CAST(label_id AS VARCHAR) || '|' || CAST(copy_id AS VARCHAR)), 1, 15)) AS BIGINT) % n + 1 AS rn
            FROM ov_slots),
ov AS (SELECT label_id, row_key, CAST(0 AS BIGINT) AS copy_id FROM train
       UNION ALL SELECT p.label_id, o.row_key, CAST(p.copy_id AS BIGINT) FROM ov_pick p JOIN ov_num o USING (label_id, rn))"""


def _under(w: Workflow) -> DataFrame:
    return sampling.undersample(w.train, "label_id", SEED, key=[KEY])


def _over(w: Workflow) -> DataFrame:
    return sampling.oversample(w.train, "label_id", SEED, key=[KEY])


@register("imbalance_undersample", O.with_(_US, "SELECT row_key, label_id FROM us"))
def imbalance_undersample(spark, sf):
    return _under(Workflow(spark, sf)).select(KEY, "label_id")


@register("imbalance_oversample", O.with_(_OV, "SELECT label_id, row_key, copy_id FROM ov"))
def imbalance_oversample(spark, sf):
    return _over(Workflow(spark, sf)).select("label_id", KEY, "copy_id")


@register("imbalance_resample_counts", O.with_(_US + "," + _OV.split(O.PREP + ",", 1)[1], """
SELECT 'undersample' AS strategy, b.label_id, b.n AS before, coalesce(a.n, 0) AS after
FROM (SELECT label_id, count(*) AS n FROM train GROUP BY 1) b
LEFT JOIN (SELECT label_id, count(*) AS n FROM us GROUP BY 1) a USING (label_id)
UNION ALL
SELECT 'oversample', b.label_id, b.n, coalesce(a.n, 0)
FROM (SELECT label_id, count(*) AS n FROM train GROUP BY 1) b
LEFT JOIN (SELECT label_id, count(*) AS n FROM ov GROUP BY 1) a USING (label_id)
UNION ALL
SELECT 'smote', label_id, n, max(n) OVER () FROM (SELECT label_id, count(*) AS n FROM train GROUP BY 1)"""))
def imbalance_resample_counts(spark, sf):
    """Class counts before and after under- and oversampling and SMOTE of train."""
    w = Workflow(spark, sf)
    feats = w.final_features
    train = w.train_filled.select(KEY, "label_id", *[F.col(clean.q(c)) for c in feats])
    synthetic = smote(train, "label_id", feats, KEY, k=5, seed=SEED)
    both = train.select("label_id").unionByName(synthetic.select("label_id"))
    return (imbalance.resample_counts(w.train, _under(w), "undersample")
            .unionByName(imbalance.resample_counts(w.train, _over(w), "oversample"))
            .unionByName(imbalance.resample_counts(train, both, "smote")))


# ── G: evaluation over deterministic predictions ────────────────────────────

def rule_predictions(w: Workflow) -> DataFrame:
    """Rule predictor on the filled test split (a deterministic stand-in model)."""
    t = w.test_filled
    name = (F.when(F.col("`Flow Bytes/s`") > 5000, "Dos Hulk")
            .when(F.col("`Destination Port`") % 10 == 0, "Ftp Patator").otherwise("Benign"))
    m, _ = small_table(w.mapping.select(F.col("label").alias("_pl"), F.col("label_id").alias("prediction")))
    return t.withColumn("_pl", name).join(m, "_pl", "left").drop("_pl")


def majority_predictions(w: Workflow) -> DataFrame:
    return evaluate.majority_predict(w.train, w.test_filled)


def report_sql(pred: str, p: str) -> str:
    return f""",
{p}cm AS (SELECT label_id AS y, prediction AS p, count(*) AS n FROM {pred} GROUP BY 1, 2),
{p}cls AS (SELECT y AS label_id FROM {p}cm UNION SELECT p FROM {p}cm),
{p}sup AS (SELECT y AS label_id, sum(n) AS support FROM {p}cm GROUP BY 1),
{p}prd AS (SELECT p AS label_id, sum(n) AS npred FROM {p}cm GROUP BY 1),
{p}tp AS (SELECT y AS label_id, n AS tp FROM {p}cm WHERE y = p),
{p}per0 AS (SELECT c.label_id, coalesce(s.support, 0) AS support, coalesce(r.npred, 0) AS npred, coalesce(t.tp, 0) AS tp
            FROM {p}cls c LEFT JOIN {p}sup s USING (label_id) LEFT JOIN {p}prd r USING (label_id)
            LEFT JOIN {p}tp t USING (label_id)),
{p}per1 AS (SELECT label_id, support, CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS precision,
                   CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM {p}per0),
{p}per AS (SELECT m.label AS class, x.label_id, precision, recall,
                  CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1,
                  CAST(support AS BIGINT) AS support
           FROM {p}per1 x LEFT JOIN mapping m USING (label_id)),
{p}report AS (
  SELECT * FROM {p}per
  UNION ALL SELECT 'accuracy', -1, NULL, NULL, (SELECT sum(n) FILTER (WHERE y = p) / sum(n) FROM {p}cm),
                   (SELECT CAST(sum(n) AS BIGINT) FROM {p}cm)
  UNION ALL SELECT 'macro avg', -1, avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM {p}per
  UNION ALL SELECT 'weighted avg', -1, sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM {p}per)"""


_PRED = O.PREP + """,
rule_pred AS (SELECT t.row_key, t.label_id, m.label_id AS prediction FROM test_f t LEFT JOIN mapping m
              ON m.label = CASE WHEN t."Flow Bytes/s" > 5000 THEN 'Dos Hulk'
                                WHEN t."Destination Port" % 10 = 0 THEN 'Ftp Patator' ELSE 'Benign' END),
maj AS (SELECT label_id FROM train GROUP BY label_id ORDER BY count(*) DESC, label_id LIMIT 1),
maj_pred AS (SELECT t.row_key, t.label_id, (SELECT label_id FROM maj) AS prediction FROM test_f t),
rare AS (SELECT m.label FROM mapping m LEFT JOIN (SELECT label_id, count(*) AS n FROM train GROUP BY 1) c
         USING (label_id) ORDER BY coalesce(n, 0), label_id LIMIT 1)""" + report_sql("rule_pred", "r_") \
    + report_sql("maj_pred", "m_")

_REPORT_COLS = ("class, label_id, " + rnd("precision") + " AS precision, " + rnd("recall") + " AS recall, "
                + rnd("f1") + " AS f1, support")


@register("eval_majority_baseline", O.with_(_PRED, f"""
SELECT m.label_id, m.label, {rnd('(SELECT f1 FROM m_report WHERE class = ' + "'accuracy'" + ')')} AS accuracy
FROM mapping m WHERE m.label_id = (SELECT label_id FROM maj)"""))
def eval_majority_baseline(spark, sf):
    w = Workflow(spark, sf)
    pred = majority_predictions(w)
    acc = evaluate.accuracy(pred).first()["accuracy"]  # one value
    maj = evaluate.majority_class(w.train)
    return rounded(w.mapping.filter(F.col("label_id") == maj).withColumn("accuracy", F.lit(acc)))


@register("eval_accuracy", O.with_(_PRED, f"""
SELECT {rnd('avg(CAST(label_id = prediction AS DOUBLE))')} AS accuracy FROM rule_pred"""))
def eval_accuracy(spark, sf):
    return rounded(evaluate.accuracy(rule_predictions(Workflow(spark, sf))))


@register("eval_classification_report", O.with_(_PRED, f"SELECT {_REPORT_COLS} FROM r_report"))
def eval_classification_report(spark, sf):
    w = Workflow(spark, sf)
    return rounded(evaluate.classification_report(rule_predictions(w), w.mapping))


@register("eval_attack_f1", O.with_(_PRED, f"""
SELECT class, label_id, {rnd('f1')} AS f1 FROM r_report WHERE label_id >= 0 AND lower(class) <> 'benign'"""))
def eval_attack_f1(spark, sf):
    w = Workflow(spark, sf)
    return rounded(evaluate.attack_f1(evaluate.classification_report(rule_predictions(w), w.mapping)))


@register("eval_strategy_comparison", O.with_(_PRED + """,
reports AS (SELECT 'rule' AS strategy, * FROM r_report UNION ALL SELECT 'majority', * FROM m_report)""", f"""
SELECT strategy,
       {rnd("coalesce(max(f1) FILTER (WHERE lower(class) = 'benign'), 0.0)")} AS benign_f1,
       {rnd("coalesce(avg(f1) FILTER (WHERE lower(class) <> 'benign'), 0.0)")} AS attack_avg_f1,
       {rnd("coalesce(max(recall) FILTER (WHERE class = (SELECT label FROM rare)), 0.0)")} AS rarest_recall
FROM reports WHERE label_id >= 0 GROUP BY strategy"""))
def eval_strategy_comparison(spark, sf):
    w = Workflow(spark, sf)
    rep = evaluate.classification_report(rule_predictions(w), w.mapping).select(F.lit("rule").alias("strategy"), "*") \
        .unionByName(evaluate.classification_report(majority_predictions(w), w.mapping)
                     .select(F.lit("majority").alias("strategy"), "*"))
    rarest = encode.imbalance(encode.class_counts(w.train, w.mapping)).first()["rarest"]
    return rounded(evaluate.strategy_comparison(rep, rarest))


# ── H: synthesis ────────────────────────────────────────────────────────────


@register("report_profile", O.with_(O.PREP, f"""
SELECT 'profile' AS section, 'rows_after_cleaning' AS key, CAST((SELECT count(*) FROM flows_dedup) AS DOUBLE) AS value
UNION ALL SELECT 'profile', 'source_files', CAST((SELECT count(DISTINCT "Day") FROM flows_dedup) AS DOUBLE)
UNION ALL SELECT 'quality', 'duplicates_removed', CAST((SELECT count(*) FROM flows_norm) - (SELECT count(*) FROM flows_dedup) AS DOUBLE)
UNION ALL SELECT 'quality', 'duplicate_pct', {rnd('((SELECT count(*) FROM flows_norm) - (SELECT count(*) FROM flows_dedup)) * 100.0 / (SELECT count(*) FROM flows_norm)')}
UNION ALL SELECT 'quality', 'negatives_fixed', CAST((SELECT {' + '.join(f'count_if({qi(f)} < 0)' for f in O.NAMED)} FROM flows_coerced) AS DOUBLE)
UNION ALL SELECT 'quality', 'infinities_fixed', CAST((SELECT {' + '.join(f'count_if(isinf({qi(f)}))' for f in O._F)} FROM flows_nonneg) AS DOUBLE)
UNION ALL SELECT 'quality', 'encoding_issues', CAST((SELECT count(*) FROM (
    SELECT "Day" FROM flows_raw WHERE {EVEN_DAY} GROUP BY 1 HAVING count_if(row_key % 7 = 0) > 0)) AS DOUBLE)
UNION ALL SELECT 'features', 'after_initial', CAST({len(O._F)} AS DOUBLE)
UNION ALL SELECT 'features', 'after_zero_variance', CAST({len(O._F)} - (SELECT count(*) FROM zv) AS DOUBLE)
UNION ALL SELECT 'features', 'after_correlated', CAST((SELECT count(*) FROM final_feat) AS DOUBLE)
UNION ALL SELECT 'features', 'after_final', CAST((SELECT count(*) FROM final_feat) AS DOUBLE)"""))
def report_profile(spark, sf):
    """The dataset's profile; encoding issues are those of the load log of its day files."""
    w = Workflow(spark, sf)
    funnel = profile.feature_funnel(w.features, w.zero_var, w.redundant)
    _, log = load_faulty(spark, sf)
    return rounded(report.synthesis_profile(clean.quality_facts(P.normalized(spark, sf)), funnel, latin1_files(log)))


@register("report_imbalance", O.with_(_W, f"""
SELECT label AS class, count AS n, {rnd('pct')} AS pct, {rnd('weight')} AS weight,
       {rnd('(SELECT ratio FROM imb)')} AS imbalance_ratio FROM cwr"""))
def report_imbalance(spark, sf):
    w = Workflow(spark, sf)
    wr = imbalance.weights_report(imbalance.class_weights(w.train, w.mapping))
    imb = encode.imbalance(encode.class_counts(w.train, w.mapping))
    return rounded(report.synthesis_imbalance(wr, imb))


# ── F5: SMOTE on the rare-class fixture ─────────────────────────────────────

_RC = f"""
rc AS (SELECT l.doc_id AS row_key, CAST(l.quality AS VARCHAR) || '-' || CAST(l.toxic AS VARCHAR) AS "Label",
              CAST(d.n_chars AS DOUBLE) AS n_chars, CAST(len(string_split(d.text, ' ')) AS DOUBLE) AS n_words
       FROM labels l JOIN documents d USING (doc_id)),
sc AS (SELECT "Label", count(*) AS n FROM rc GROUP BY 1),
sk AS (SELECT "Label", n, max(n) OVER () - n AS d,
              least(greatest(1, least(5, (SELECT min(n) FROM sc) - 1)), n - 1) AS k FROM sc),
snum AS (SELECT r.*, row_number() OVER (PARTITION BY "Label" ORDER BY {O.h('smote')}, row_key) AS rn FROM rc r),
knn AS (SELECT x.* FROM (
          SELECT a."Label", a.row_key AS base_key, b.row_key AS nn_key,
                 row_number() OVER (PARTITION BY a."Label", a.row_key
                   ORDER BY (a.n_chars - b.n_chars) * (a.n_chars - b.n_chars) + (a.n_words - b.n_words) * (a.n_words - b.n_words),
                            b.row_key) AS nn_rank
          FROM rc a JOIN rc b ON a."Label" = b."Label" AND a.row_key <> b.row_key) x
        JOIN sk USING ("Label") WHERE x.nn_rank <= sk.k),
slots AS (SELECT "Label", n, k, unnest(generate_series(1, d)) AS syn_id FROM sk WHERE d > 0),
picks AS (SELECT "Label", syn_id, k,
   CAST(('0x' || substr(md5('{SEED}|smote-base|' || "Label" || '|' || CAST(syn_id AS VARCHAR)), 1, 15)) AS BIGINT) % n + 1 AS rn,
   CASE WHEN k > 0 THEN CAST(('0x' || substr(md5('{SEED}|smote-nn|' || "Label" || '|' || CAST(syn_id AS VARCHAR)), 1, 15)) AS BIGINT) % k + 1 END AS nn_rank,
   CAST(('0x' || substr(md5('{SEED}|smote-gap|' || "Label" || '|' || CAST(syn_id AS VARCHAR)), 1, 8)) AS BIGINT)
     / CAST(4294967296.0 AS DOUBLE) AS u
   FROM slots)"""


@register("imbalance_smote", O.with_(_RC, f"""
SELECT p."Label", CAST(p.syn_id AS BIGINT) AS syn_id, s.row_key AS base_key, coalesce(kn.nn_key, s.row_key) AS nn_key,
       CASE WHEN kn.nn_key IS NULL THEN 'copy' ELSE 'smote' END AS method,
       {rnd('CASE WHEN kn.nn_key IS NULL THEN s.n_chars ELSE s.n_chars + p.u * (nb.n_chars - s.n_chars) END')} AS n_chars,
       {rnd('CASE WHEN kn.nn_key IS NULL THEN s.n_words ELSE s.n_words + p.u * (nb.n_words - s.n_words) END')} AS n_words
FROM picks p JOIN snum s ON s."Label" = p."Label" AND s.rn = p.rn
LEFT JOIN knn kn ON kn."Label" = p."Label" AND kn.base_key = s.row_key AND kn.nn_rank = p.nn_rank
LEFT JOIN rc nb ON nb.row_key = kn.nn_key"""))
def imbalance_smote(spark, sf):
    """Synthetic rows that bring every (quality, toxic) class to the largest class size."""
    from flowguard.operators.smote import smote
    from flowguard.plans.fixtures import rare_classes
    rc = rare_classes(spark, sf)
    return rounded(smote(rc, "Label", ["n_chars", "n_words"], KEY, k=5, seed=SEED))


@register("imbalance_smote_neighbours", O.with_(_RC, f"""
SELECT "Label", base_key, CAST(nn_rank AS INTEGER) AS nn_rank, nn_key FROM knn"""))
def imbalance_smote_neighbours(spark, sf):
    """The exact k nearest same-class neighbours behind the SMOTE draws."""
    from flowguard.operators.smote import nearest_neighbours, smote_k
    from flowguard.plans.fixtures import rare_classes
    rc = rare_classes(spark, sf)
    counts = rc.groupBy("Label").agg(F.count(F.lit(1)).alias("n"))
    kk = smote_k(counts, 5)
    kt = counts.select("Label", F.least(F.lit(kk), F.col("n") - 1).alias("k"))
    nn = nearest_neighbours(rc, "Label", ["n_chars", "n_words"], KEY, kt)
    return nn.select("Label", "base_key", F.col("nn_rank").cast("int"), "nn_key")


@register("imbalance_smote_neighbours_wide", """
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
c AS (SELECT label, count(*) AS n FROM v GROUP BY 1),
k AS (SELECT label, least((SELECT greatest(1, least(5, min(n) - 1)) FROM c), n - 1) AS k FROM c),
d AS (SELECT a.label, a.vec_id AS base_key, b.vec_id AS nn_key,
             list_sum([z[1] * z[1] for z in [[x[1] - x[2]] for x in list_zip(a.e, b.e)]]) AS dist2
      FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY label, base_key ORDER BY dist2, nn_key) AS nn_rank FROM d)
SELECT r.label AS "Label", base_key, CAST(nn_rank AS INTEGER) AS nn_rank, nn_key, round(dist2, 6) AS dist2
FROM r JOIN k USING (label) WHERE nn_rank <= k.k""")
def imbalance_smote_neighbours_wide(spark, sf):
    """The exact k nearest same-class neighbours over 64 features (embeddings by label)."""
    from flowguard.operators.smote import nearest_neighbours, smote_k
    from flowguard.plans.fixtures import WIDE, wide_features
    t = wide_features(spark, sf).filter("Label IS NOT NULL")
    counts = t.groupBy("Label").agg(F.count(F.lit(1)).alias("n"))
    kk = smote_k(counts, 5)
    kt = counts.select("Label", F.least(F.lit(kk), F.col("n") - 1).alias("k"))
    return rounded(nearest_neighbours(t, "Label", [f"e{i}" for i in range(WIDE)], KEY, kt)
                   .select("Label", "base_key", F.col("nn_rank").cast("int"), "nn_key", "dist2"))


@register("imbalance_smote_neighbours_lsh", """
WITH v AS (SELECT label, count(*) AS n FROM embeddings WHERE label IS NOT NULL GROUP BY 1),
k AS (SELECT label, n, least((SELECT greatest(1, least(5, min(n) - 1)) FROM v), n - 1) AS k FROM v)
SELECT label AS "Label", n * k AS wanted, true AS recall_90, CAST(0 AS BIGINT) AS nearer_than_exact, true AS near_linear FROM k WHERE k > 0""")
def imbalance_smote_neighbours_lsh(spark, sf):
    """Approximate neighbours over 64 features beside the exact ones: per class how many are wanted, whether nine
    tenths are found, that none is nearer than the exact one of its rank, and that the vectors compared are at most
    rows x tables x probes x twice the bucket."""
    from flowguard.operators import lsh
    from flowguard.operators.smote import nearest_neighbours, smote_k
    from flowguard.plans.fixtures import WIDE, wide_features
    t = wide_features(spark, sf).filter("Label IS NOT NULL")
    counts = t.groupBy("Label").agg(F.count(F.lit(1)).alias("n"))
    kk = smote_k(counts, 5)
    kt = counts.select("Label", F.least(F.lit(kk), F.col("n") - 1).alias("k"))
    cols = [f"e{i}" for i in range(WIDE)]
    exact = nearest_neighbours(t, "Label", cols, KEY, kt)
    rough = lsh.lsh_neighbours(t, "Label", cols, KEY, kt).select(
        "Label", "base_key", "nn_rank", F.col("nn_key").alias("_k"), F.col("dist2").alias("_d"))
    at_rank = exact.join(rough, ["Label", "base_key", "nn_rank"], "left").groupBy("Label").agg(
        F.count(F.lit(1)).alias("wanted"), F.count_if(F.col("_d") < F.col("dist2") - 1e-9).alias("nearer_than_exact"))
    hits = exact.join(rough.select("Label", "base_key", F.col("_k").alias("nn_key")), ["Label", "base_key", "nn_key"]).groupBy("Label").agg(
        F.count(F.lit(1)).alias("_hits"))
    pairs = lsh.lsh_pairs(t, "Label", cols, KEY, kt).join(counts, "Label")
    bound = F.col("n") * lsh.TABLES * lsh.PROBES * 2 * lsh.BUCKET
    return (at_rank.join(hits, "Label", "left").join(pairs, "Label")
            .select("Label", "wanted", (F.coalesce("_hits", F.lit(0)) >= 0.9 * F.col("wanted")).alias("recall_90"), "nearer_than_exact",
                    (F.col("pairs") <= bound).alias("near_linear")))
