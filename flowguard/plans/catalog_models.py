"""Catalog: MLlib models (G5–G9), their comparison, model-based synthesis (H2, H3),
preprocessing round trip (E3) and batch scoring (E5).  Rows-only checks: tree
learners differ from any SQL engine, so no oracle SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.operators import encode, evaluate, imbalance, models, preprocess, report, sampling
from flowguard.operators.grow import grown_predictions
from flowguard.operators.smote import smote
from flowguard.plans import oracle as O
from flowguard.plans.catalog import register, rounded
from flowguard.plans.fixtures import KEY, SEED
from flowguard.plans.flows import Workflow
from flowguard.session import scratch_path, small_table
from flowguard.sources.contract import contract_of, contract_violations, load_contract, save_contract
from flowguard.sources.csv_flows import path_exists
from flowguard.sources.stage import read_stage


def _scaled(w: Workflow):
    def build():
        feats = w.final_features
        params = preprocess.fit_preprocess(w.train_filled, feats, w.medians)
        tr = preprocess.apply_preprocess(w.train_filled, params, keep=[KEY, "label_id"])
        te = preprocess.apply_preprocess(w.test_filled, params, keep=[KEY, "label_id"])
        return feats, params, tr, te
    return w._get("scaled", build)


#: Share of train that the trees of ``model_tree_weighted`` and ``model_tree_undersampled`` and of saved artifacts are fitted on.
FIT_FRAC = 0.1
#: Share and row bound of the sample that the forests are fitted on.
FOREST_FRAC, FOREST_ROWS = 0.2, 200_000
#: Rows that the sample of the global and per-class forests keeps of every class at least.
FOREST_FLOOR = 100


def _demo(tr: DataFrame, fit_frac: float = FIT_FRAC) -> DataFrame:
    return sampling.stratified_sample(tr, "label_id", fit_frac, SEED, key=[KEY], salt="demo")


def _weighted(w: Workflow, rows: DataFrame) -> DataFrame:
    cw, _ = small_table(imbalance.class_weights(w.train, w.mapping).select("label_id", "weight"))
    return rows.join(cw, "label_id")


def _undersampled(w: Workflow, rows: DataFrame) -> DataFrame:
    return sampling.undersample(rows, "label_id", SEED, key=[KEY])


def _with_smote(w: Workflow, rows: DataFrame) -> DataFrame:
    feats = w.final_features
    syn = smote(rows, "label_id", feats, KEY, k=5, seed=SEED)
    syn = syn.select("label_id", (-F.col("syn_id")).alias(KEY), *[F.col(f"`{c}`") for c in feats])
    return rows.select("label_id", KEY, *[F.col(f"`{c}`") for c in feats]).unionByName(syn)


def _report(w: Workflow, strategy, weight: str | None = None) -> DataFrame:
    """Report on test of a tree fitted on all of train, rebalanced by the ``strategy``."""
    feats, _, tr, te = _scaled(w)
    pred = grown_predictions(strategy(w, tr), te, feats, "label_id", KEY, max_depth=models.MAX_DEPTH, seed=SEED, weight=weight)
    return evaluate.classification_report(pred, w.mapping)


def _demo_report(w: Workflow, strategy, weight: str | None = None) -> DataFrame:
    """Report on test of a tree fitted on the demo sample, rebalanced by the ``strategy``."""
    feats, _, tr, te = _scaled(w)
    m = models.fit_tree(strategy(w, _demo(tr)), feats, "label_id", KEY, weight=weight, seed=SEED)
    return evaluate.classification_report(models.predict(m, te, feats, keep=[KEY, "label_id"]), w.mapping)


#: The compared strategies: name in the comparison, name in the checks, training rows, weight column.
STRATEGIES = (("Class Weights", "weights", _weighted, "weight"), ("Undersampling", "under", _undersampled, None), ("SMOTE (sample)", "smote", _with_smote, None))


@register("model_tree_weighted")
def model_tree_weighted(spark, sf):
    """Class-weighted decision tree on a 10 % stratified demo sample; report on test."""
    return rounded(_demo_report(Workflow(spark, sf), _weighted, "weight"))


@register("model_tree_undersampled")
def model_tree_undersampled(spark, sf):
    """Decision tree on the undersampled 10 % stratified demo sample; report on test."""
    return rounded(_demo_report(Workflow(spark, sf), _undersampled))


@register("model_tree_smote")
def model_tree_smote(spark, sf):
    """Decision tree on all of train, brought to equal classes by SMOTE; report on test."""
    return rounded(_report(Workflow(spark, sf), _with_smote))


@register("model_strategy_comparison")
def model_strategy_comparison(spark, sf):
    """The three strategies, each by a tree fitted on all of train."""
    w = Workflow(spark, sf)
    reps = [_report(w, strategy, weight).select(F.lit(name).alias("strategy"), "*") for name, _, strategy, weight in STRATEGIES]
    rarest = encode.imbalance(encode.class_counts(w.train, w.mapping)).first()["rarest"]
    return rounded(evaluate.strategy_comparison(reps[0].unionByName(reps[1]).unionByName(reps[2]), rarest))


def _rf_preview(rows: DataFrame, feats: list[str], top: int = 20) -> DataFrame:
    return models.rf_importance(rows, feats, "label_id", KEY, trees=50, top=top, seed=SEED)


@register("model_rf_importance")
def model_rf_importance(spark, sf):
    """Forest of 50 trees on a 20 % stratified sample of train; top 20 importances."""
    w = Workflow(spark, sf)
    s20 = sampling.stratified_sample(w.train_filled, "label_id", FOREST_FRAC, SEED, key=[KEY], salt="rf20")
    return rounded(_rf_preview(s20, w.final_features))


def _global_sample(w: Workflow) -> tuple[list[str], DataFrame]:
    feats, _, tr, _ = _scaled(w)
    return feats, sampling.floored_sample(tr, "label_id", FOREST_FRAC, FOREST_ROWS, FOREST_FLOOR, SEED, key=[KEY]).persist()


def _global_forest(rows: DataFrame, feats: list[str], top: int = 15, weight: str | None = "sample_weight") -> DataFrame:
    return models.rf_importance(rows, feats, "label_id", KEY, trees=50, max_depth=12, top=top, seed=SEED, weight=weight)


@register("model_rf_global")
def model_rf_global(spark, sf):
    """Forest 50 trees depth 12 on the bounded sample; top 15."""
    feats, smp = _global_sample(Workflow(spark, sf))
    return rounded(_global_forest(smp, feats))


def _per_class(w: Workflow) -> DataFrame:
    feats, smp = _global_sample(w)
    counts = w.train.groupBy("label_id").agg(F.count(F.lit(1)).alias("count"))
    return models.rf_per_class(smp, feats, w.mapping, "label_id", KEY, trees=30, max_depth=8, top=3,
                               global_top=_global_forest(smp, feats), seed=SEED, counts=counts, weight="sample_weight")


@register("model_rf_per_class")
def model_rf_per_class(spark, sf):
    """One-vs-rest forests (30 trees, depth 8) per class, top 3; classes of < 5 train rows -> global top 3."""
    return rounded(_per_class(Workflow(spark, sf)))


@register("report_classes")
def report_classes(spark, sf):
    w = Workflow(spark, sf)
    counts = encode.class_counts(w.train, w.mapping)
    return rounded(report.synthesis_classes(counts, _per_class(w)))


@register("report_features")
def report_features(spark, sf):
    w = Workflow(spark, sf)
    feats, smp = _global_sample(w)
    removed = w.zero_var.select("feature", "reason").unionByName(w.redundant)
    return rounded(report.synthesis_features(_global_forest(smp, feats), removed, 10))


_CLASSES = O.PREP + """,
tc AS (SELECT m.label, count(t.row_key) AS n FROM mapping m LEFT JOIN train t USING (label_id) GROUP BY 1),
nf AS (SELECT count(*) AS features FROM final_feat)"""


def _falls(by: str):
    before = F.lag("importance").over(Window.partitionBy(by).orderBy("rank"))
    return F.coalesce(before >= F.col("importance"), F.lit(True))


@register("model_per_class_checks", O.with_(_CLASSES, """
SELECT label AS class, n AS train_rows, least(3, features) AS features, least(3, features) AS last_rank, true AS falls, true AS shares,
       n < 5 AS fallback FROM tc, nf"""))
def model_per_class_checks(spark, sf):
    """Per class: three different features ranked by falling importance, shares of one, its own model from 5 train rows on."""
    w = Workflow(spark, sf)
    counts = encode.class_counts(w.train, w.mapping).select(F.col("label").alias("scope_class"), F.col("count").alias("train_rows"))
    top = _per_class(w).withColumn("_falls", _falls("scope_class"))
    return top.join(counts, "scope_class").groupBy(F.col("scope_class").alias("class"), "train_rows").agg(
        F.count_distinct("feature").alias("features"), F.max("rank").cast("bigint").alias("last_rank"), F.bool_and("_falls").alias("falls"),
        F.bool_and(F.col("importance").between(0, 1)).alias("shares"), F.bool_or("fallback").alias("fallback"))


_MEANINGS = ", ".join("('" + k.replace("'", "''") + "', '" + v.replace("'", "''") + "')" for k, v in report.FEATURE_MEANINGS.items())


@register("report_classes_checks", O.with_(_CLASSES, f"""
SELECT label AS class, n AS count, {O.rnd('n * 100.0 / sum(n) OVER ()')} AS pct, least(3, features) AS features, true AS annotated FROM tc, nf"""))
def report_classes_checks(spark, sf):
    """The class table: rows and share of each class, its three features, each with the dictionary's text."""
    texts = spark.createDataFrame([(k, v) for k, v in report.FEATURE_MEANINGS.items()], "feature string, _text string")
    r = report_classes(spark, sf).join(F.broadcast(texts), "feature", "left")
    right = (F.col("meaning") == F.coalesce("_text", F.lit(report.DEFAULT_MEANING))) & F.col("literature").isNotNull()
    return rounded(r.groupBy("class", "count", "pct").agg(F.count_distinct("feature").alias("features"), F.bool_and(right).alias("annotated")))


@register("report_features_checks", O.with_(_CLASSES, """
SELECT 'top_feature' AS kind, feature, CAST(NULL AS VARCHAR) AS reason, true AS ranked FROM final_feat
UNION ALL SELECT 'removed', feature, reason, true FROM zv UNION ALL SELECT 'removed', feature, reason, true FROM red"""))
def report_features_checks(spark, sf):
    """The feature table: all features left (ten at most) with falling importance, and each removed one with its reason."""
    r = report_features(spark, sf).withColumn("_falls", _falls("kind"))
    top = F.col("kind") == "top_feature"
    return r.select("kind", "feature", F.when(~top, F.col("meaning")).alias("reason"),
                    F.when(top, F.col("_falls") & F.col("rank").between(1, 10)).otherwise(F.col("rank").isNull()).alias("ranked"))


@register("preprocess_roundtrip", O.with_(O.PREP, """
SELECT count(*) AS rows, (SELECT count(*) FROM final_feat) AS cols, true AS equal FROM train_f"""))
def preprocess_roundtrip(spark, sf):
    """Save the fitted parameters, reload, transform all of train; shape and values must match."""
    w = Workflow(spark, sf)
    feats, params, _, _ = _scaled(w)
    path = scratch_path(spark, "preprocess-params")
    preprocess.save_params(params, path)
    back = preprocess.load_params(spark, path)
    a = preprocess.apply_preprocess(w.train_filled, params, keep=[KEY])
    b = preprocess.apply_preprocess(w.train_filled, back, keep=[KEY])
    diff = a.join(b.select(KEY, *[F.col(f"`{c}`").alias("b_" + str(i)) for i, c in enumerate(feats)]), KEY)
    same = F.lit(True)
    for i, c in enumerate(feats):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col("b_" + str(i)))
    return diff.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(feats)).cast("bigint").alias("cols"),
                    F.bool_and(same).alias("equal"))


@dataclass
class Artifacts:
    """What scoring needs, as saved by ``save_artifacts``."""
    features: list[str]
    params: DataFrame
    contract: DataFrame
    mapping: DataFrame
    medians: dict[str, float]
    model: object


def save_artifacts(w: Workflow) -> str:
    """Fit on train (a tree on ``FIT_FRAC`` of it) and save parameters, contract, mapping, medians
    and model below a fresh folder; returns it."""
    feats, params, tr, _ = _scaled(w)
    base = scratch_path(w.spark, "artifacts")
    preprocess.save_params(params, f"{base}/params")
    save_contract(contract_of(w.train_filled.select(*[F.col(f"`{c}`") for c in feats])), f"{base}/contract")
    w.mapping.write.parquet(f"{base}/class_mapping")
    w.medians.write.parquet(f"{base}/medians")
    models.save_model(models.fit_tree(_demo(tr), feats, "label_id", KEY, seed=SEED), f"{base}/model")
    return base


def load_artifacts(spark, base: str) -> Artifacts:
    """Read saved artifacts; a missing one is an error that names it."""
    for name in ("params", "contract", "class_mapping", "medians"):
        read_stage(spark, f"{base}/{name}", name)
    if not path_exists(spark, f"{base}/model"):
        raise FileNotFoundError(f"MISSING: model ({base}/model); rerun the stage that writes it")
    contract = load_contract(spark, f"{base}/contract")
    medians = read_stage(spark, f"{base}/medians", "medians")
    return Artifacts([r["feature"] for r in contract.orderBy("position").collect()],
                     preprocess.load_params(spark, f"{base}/params"), contract,
                     read_stage(spark, f"{base}/class_mapping", "class_mapping"),
                     {r["feature"]: r["median"] for r in medians.collect() if r["median"] is not None},
                     models.load_model(f"{base}/model"))


@register("score_batch")
def score_batch(spark, sf):
    """Production path from saved artifacts: contract check -> preprocess -> tree -> class name (test split)."""
    w = Workflow(spark, sf)
    a = load_artifacts(spark, save_artifacts(w))
    bad = contract_violations(w.test_filled, a.contract).filter(~F.col("ok")).count()
    if bad:
        raise ValueError(f"{bad} contract violations")
    te = preprocess.apply_preprocess(w.test_filled, a.params, keep=[KEY, "label_id"])
    pred = models.predict(a.model, te, a.features, keep=[KEY, "label_id"])
    m, _ = small_table(a.mapping.select(F.col("label_id").alias("prediction"), F.col("label").alias("predicted_class")))
    return pred.join(m, "prediction", "left")


@register("score_batch_checks", O.with_(O.SPLIT, """
SELECT t.label_id, count(*) AS rows, count(DISTINCT t.row_key) AS keys, CAST(0 AS BIGINT) AS unknown_classes
FROM test t GROUP BY 1"""))
def score_batch_checks(spark, sf):
    """Per true class: every test row is scored once, with a known class."""
    return score_batch(spark, sf).groupBy("label_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(KEY).alias("keys"),
        F.count_if(F.col("predicted_class").isNull()).alias("unknown_classes"))


@register("model_report_checks", O.with_(O.SPLIT, """
SELECT s.strategy, m.label AS "class", count(*) AS support
FROM test t JOIN mapping m USING (label_id) CROSS JOIN (VALUES ('weights'), ('under'), ('smote')) s(strategy) GROUP BY 1, 2
UNION ALL
SELECT s.strategy, a.name, (SELECT count(*) FROM test)
FROM (VALUES ('weights'), ('under'), ('smote')) s(strategy)
CROSS JOIN (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) a(name)"""))
def model_report_checks(spark, sf):
    """Reports of the three trees, each fitted on all of train: every class of the test rows with its number of rows, and the summary rows."""
    w = Workflow(spark, sf)
    reps = [_report(w, strategy, weight).filter("support > 0").select(F.lit(name).alias("strategy"), "class", "support")
            for _, name, strategy, weight in STRATEGIES]
    return reps[0].unionByName(reps[1]).unionByName(reps[2])


@register("model_importance_checks", O.with_(O.PREP, """
SELECT scope, (SELECT count(*) FROM final_feat) AS features, (SELECT count(*) FROM final_feat) AS ranks,
       CAST(1.0 AS DOUBLE) AS total, true AS in_order
FROM (SELECT 'preview' AS scope UNION ALL SELECT 'global')"""))
def model_importance_checks(spark, sf):
    """Importances of the two forests, each on all of train: one per feature, sum 1, ranked by falling importance."""
    w = Workflow(spark, sf)
    feats, _, tr, _ = _scaled(w)
    glob = _global_forest(tr, feats, top=len(feats), weight=None)
    both = (_rf_preview(w.train_filled, feats, top=len(feats)).withColumn("scope", F.lit("preview"))
            .unionByName(glob.withColumn("scope", F.lit("global"))))
    before = F.lag("importance").over(Window.partitionBy("scope").orderBy("rank"))
    both = both.withColumn("falls", F.coalesce(before >= F.col("importance"), F.lit(True)))
    return rounded(both.groupBy("scope").agg(
        F.count_distinct("feature").alias("features"), F.max("rank").cast("bigint").alias("ranks"),
        F.sum("importance").alias("total"), F.bool_and("falls").alias("in_order")))
