"""Tree models with MLlib: weighted / resampled decision trees, forest
importances (global and one-vs-rest per class).

Training rows are dealt to partitions by a hash of their key, as many as the number
of rows asks for, and sorted by key in each, so the same data and seed give the same
model on any cluster and with any upstream partitioning; the layout is kept with a
saved model.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.operators.clean import q
from flowguard.operators.grow import grown_importances
from flowguard.session import bounded_rows

MAX_DEPTH = 30  # MLlib's limit; stands for "unlimited"
FIT_CHUNK = 1_000_000  #: training rows of a partition on average: trees depend on the rows, not on the cluster's size
#: Smaller tables have partitions of this many rows, but no more than so many of them: every partition makes and sends
#: the histograms of all nodes, and nodes grow with the rows too.
FIT_CHUNK_SMALL, FIT_PARTITIONS = 25_000, 12
MLLIB_ROWS = 250_000  #: rows up to which a forest for importances is MLlib's; ``grow`` has no such limit
FOREST_NODES = 1_000_000  #: nodes of the trees that MLlib grows at a time, all held by the driver, about


@dataclass(frozen=True)
class FitLayout:
    """How training rows were dealt: what else than data and seed a model depends on."""
    rows: int
    partitions: int
    seed: int


def fit_layout(rows: int, seed: int = 42) -> FitLayout:
    parts = max(math.ceil(rows / FIT_CHUNK), min(FIT_PARTITIONS, math.ceil(rows / FIT_CHUNK_SMALL)))
    return FitLayout(rows, max(1, parts), seed)


def tree_groups(rows: int, trees: int, max_depth: int) -> list[int]:
    """Trees to grow at a time: a tree has about as many nodes as rows, and no more than its depth allows."""
    nodes = max(1, min(rows, 2 ** (max_depth + 1)))
    size = min(trees, max(1, FOREST_NODES // nodes))
    return [min(size, trees - i) for i in range(0, trees, size)]


def _assembled(df: DataFrame, cols: Sequence[str], label: str, key: str | None,
               weight: str | None, seed: int) -> tuple[DataFrame, FitLayout]:
    sel = [F.col(q(c)).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]
    extra = [F.col(label).cast("double").alias("_y")]
    if weight:
        extra.append(F.col(weight).cast("double").alias("_w"))
    out = df.select(*sel, *extra, *([F.col(key)] if key else [])).persist()
    layout = fit_layout(out.count(), seed)
    dealt = out.repartition(layout.partitions, key).sortWithinPartitions(key) if key else out.repartition(layout.partitions)
    data = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(cols))], outputCol="_v") \
        .transform(dealt).select("_v", "_y", *(["_w"] if weight else [])).persist()
    data.count()
    out.unpersist()
    return data, layout


def _fit(learner, df: DataFrame, cols, label, key, weight, seed):
    data, layout = _assembled(df, cols, label, key, weight, seed)
    try:
        model = (learner.setWeightCol("_w") if weight else learner).fit(data)
    finally:
        data.unpersist()
    model.layout = layout
    return model


def fit_tree(df: DataFrame, cols: Sequence[str], label: str = "label_id", key: str | None = None,
             weight: str | None = None, seed: int = 42, max_depth: int = MAX_DEPTH):
    dt = DecisionTreeClassifier(featuresCol="_v", labelCol="_y", seed=seed, maxDepth=max_depth,
                                maxBins=64, maxMemoryInMB=1024, cacheNodeIds=True)
    return _fit(dt, df, cols, label, key, weight, seed)


def _forest(trees: int, max_depth: int, seed: int) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="_v", labelCol="_y", seed=seed, numTrees=trees,
                                  maxDepth=max_depth, maxBins=64, maxMemoryInMB=1024,
                                  cacheNodeIds=True)


def fit_forest(df: DataFrame, cols: Sequence[str], label: str = "label_id", key: str | None = None,
               trees: int = 50, max_depth: int = MAX_DEPTH, seed: int = 42, weight: str | None = None):
    return _fit(_forest(trees, max_depth, seed), df, cols, label, key, weight, seed)


def predict(model, df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
            out: str = "prediction") -> DataFrame:
    sel = [F.col(q(c)).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]
    data = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(cols))], outputCol="_v") \
        .transform(df.select(*[F.col(q(k)) for k in keep], *sel))
    pred = model.setPredictionCol("_pred").transform(data)
    return pred.select(*[F.col(q(k)) for k in keep], F.col("_pred").cast("int").alias(out))


def forest_importances(df: DataFrame, cols: Sequence[str], label: str = "label_id", key: str | None = None, trees: int = 50,
                       max_depth: int = MAX_DEPTH, seed: int = 42, weight: str | None = None) -> np.ndarray:
    """Importances of a forest whose trees are grown in groups and let go, so the driver never holds all their nodes.

    One group is ``fit_forest``; more groups have seeds of their own and draw rows and features as MLlib's trees do.
    """
    data, layout = _assembled(df, cols, label, key, weight, seed)
    total = np.zeros(len(cols))
    try:
        for i, n in enumerate(groups := tree_groups(layout.rows, trees, max_depth)):
            learner = _forest(n, max_depth, seed + i)
            if len(groups) > 1:
                learner = learner.setFeatureSubsetStrategy("sqrt")  # MLlib's rule for forests, here for a group of one tree too
            model = (learner.setWeightCol("_w") if weight else learner).fit(data)
            if len(groups) == 1:
                return model.featureImportances.toArray()
            total += model.featureImportances.toArray() * sum(t.numNodes > 1 for t in model.trees)  # trees without a split say nothing
            del model
    finally:
        data.unpersist()
    return total / total.sum() if total.sum() else total


def importances(model, cols: Sequence[str], spark, scope: str | None = None) -> DataFrame:
    """(scope_class, feature, importance, rank) — the vector is one value per feature.  ``model``: a fitted one, or its importances."""
    imp = model if isinstance(model, np.ndarray) else model.featureImportances.toArray()
    rows = [(scope, c, float(imp[i])) for i, c in enumerate(cols)]
    df = spark.createDataFrame(rows, "scope_class string, feature string, importance double")
    from pyspark.sql import Window
    w = Window.partitionBy("scope_class").orderBy(F.desc("importance"), "feature")
    return df.withColumn("rank", F.row_number().over(w))


def rf_importance(df: DataFrame, cols: Sequence[str], label: str = "label_id", key: str | None = None,
                  trees: int = 50, max_depth: int = MAX_DEPTH, top: int = 20, seed: int = 42, weight: str | None = None) -> DataFrame:
    """Importances of a forest: MLlib's if it fits the driver at once, else one of the same rules grown in tasks (``grow``)."""
    data = df.select(*[F.col(q(c)) for c in {label: 0, **({key: 0} if key else {}), **({weight: 0} if weight else {}), **dict.fromkeys(cols)}]).persist()
    rows = data.count()
    if key and (rows > MLLIB_ROWS or len(tree_groups(rows, trees, max_depth)) > 1):
        imp = grown_importances(data, cols, label, key, trees, max_depth, seed, weight)
    else:
        imp = forest_importances(data, cols, label, key, trees, max_depth, seed, weight)
    data.unpersist()
    return importances(imp, cols, df.sparkSession).filter(F.col("rank") <= top)


def rf_per_class(df: DataFrame, cols: Sequence[str], mapping: DataFrame, label: str = "label_id",
                 key: str | None = None, trees: int = 30, max_depth: int = 8, top: int = 3,
                 min_pos: int = 5, global_top: DataFrame | None = None, seed: int = 42,
                 threads: int = 4, counts: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """One-vs-rest forest per class; classes with < ``min_pos`` rows take the global top features
    (flag ``fallback``).  Fits run as concurrent jobs.

    ``df`` may be a sample; ``counts`` (label, count) then gives the rows of each class in the whole table, and the
    sample must hold some of every class (``sampling.floored_sample``), with ``weight`` to undo its bias.
    """
    spark = df.sparkSession
    data = df.persist()
    counted = counts.select(F.col(label), F.col("count").alias("n")) if counts is not None else data.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    pos = {r[label]: r["n"] for r in bounded_rows(counted)}
    classes = [(r["label_id"], r["label"]) for r in bounded_rows(mapping)]

    def one(item):
        cid, name = item
        if pos.get(cid, 0) < min_pos:
            return None
        binary = data.withColumn("_ovr", (F.col(label) == F.lit(cid)).cast("int"))
        m = fit_forest(binary, cols, "_ovr", key, trees, max_depth, seed, weight)
        return importances(m, cols, spark, name).filter(F.col("rank") <= top) \
            .withColumn("fallback", F.lit(False))

    with ThreadPoolExecutor(max_workers=threads) as ex:
        parts = list(ex.map(one, classes))  # tables of one row a feature, made on the driver
    data.unpersist()
    out = None
    for (cid, name), part in zip(classes, parts):
        if part is None:
            if global_top is None:
                global_top = rf_importance(df, cols, label, key, seed=seed, weight=weight)
            part = global_top.filter(F.col("rank") <= top).select(
                F.lit(name).alias("scope_class"), "feature", "importance", "rank") \
                .withColumn("fallback", F.lit(True))
        out = part if out is None else out.unionByName(part)
    return out


def save_model(model, path: str) -> None:
    """The model and, where it was fitted here, its layout."""
    PipelineModel(stages=[model]).write().overwrite().save(path)
    layout = getattr(model, "layout", None)
    if layout is not None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(layout.rows, layout.partitions, layout.seed)], "rows bigint, partitions int, seed bigint") \
            .coalesce(1).write.mode("overwrite").parquet(path.rstrip("/") + "-layout")


def load_model(path: str):
    model = PipelineModel.load(path).stages[0]
    from flowguard.sources.csv_flows import path_exists
    spark = SparkSession.getActiveSession()
    where = path.rstrip("/") + "-layout"
    if path_exists(spark, where):
        model.layout = FitLayout(*spark.read.parquet(where).select("rows", "partitions", "seed").first())
    return model
