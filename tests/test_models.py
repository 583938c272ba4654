import json
import os
import subprocess
import sys

import numpy as np
from pyspark.sql import functions as F

from flowguard.operators import evaluate, models, sampling

_FIT = """
import json, sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from flowguard.operators import models
models.FIT_CHUNK = 300
s = (SparkSession.builder.master(sys.argv[1]).config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", sys.argv[2])
     .config("spark.ui.showConsoleProgress", "false").getOrCreate())
s.sparkContext.setLogLevel("ERROR")
k = F.col("id")
df = s.range(0, 2000, 1, int(sys.argv[3])).select(k.alias("key"), *[(F.xxhash64(k, F.lit(i)) % 1000).cast("double").alias(f"x{i}") for i in range(5)])
df = df.withColumn("y", ((F.col("x1") + F.col("x3") / 3 + F.xxhash64("key") % 200) > 0).cast("int"))
m = models.fit_forest(df, [f"x{i}" for i in range(5)], "y", "key", trees=7, max_depth=6)
print("RESULT" + json.dumps([m.layout.partitions, m.featureImportances.toArray().tolist()]))
s.stop()
"""


def _fitted(master, shuffles, parts):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", _FIT, master, shuffles, parts], capture_output=True, text=True, timeout=300,
                         env={**os.environ, "PYTHONPATH": root}).stdout
    return json.loads(next(x for x in out.splitlines() if x.startswith("RESULT"))[6:])


def test_same_forest_on_clusters_of_any_size():
    """Equal importances on two and on four threads, with other shuffle and input partitions; tasks grow with rows."""
    small, large = _fitted("local[2]", "3", "2"), _fitted("local[4]", "11", "9")
    assert small == large and small[0] == 7
    assert models.fit_layout(10).partitions == 1 and models.fit_layout(10 ** 9).partitions == 10 ** 9 // models.FIT_CHUNK


def _planted(spark, n=3000):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, 5))
    y = np.where(x[:, 2] > 1.2, 1, 0)
    y[rng.choice(n, 12, replace=False)] = 2
    x[y == 2, 4] = 9.0
    rows = [(i, int(c), *map(float, v)) for i, (c, v) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "k bigint, label_id int, f0 double, f1 double, f2 double, f3 double, f4 double"), [f"f{i}" for i in range(5)]


def test_planted_signals_rank_first(spark):
    df, cols = _planted(spark)
    weighted = df.withColumn("w", F.when(F.col("label_id") == 2, 50.0).otherwise(1.0))
    plain, heavy = (models.importances(models.fit_tree(weighted, cols, "label_id", "k", w), cols, spark).orderBy("rank").collect() for w in (None, "w"))
    # twelve rows of three thousand lie within one bin of a feature; their weight makes them bins of their own
    assert plain[0]["feature"] == "f2" and {r["feature"] for r in heavy[:2]} == {"f2", "f4"}
    mapping = spark.createDataFrame([(0, "Benign"), (1, "Flood"), (2, "Rare")], "label_id int, label string")
    smp = sampling.floored_sample(df, "label_id", frac=0.1, floor=12, key=["k"])
    got = models.rf_per_class(smp, cols, mapping, "label_id", "k", trees=10, max_depth=5, counts=df.groupBy("label_id").count(), weight="sample_weight")
    first = {r["scope_class"]: (r["feature"], r["fallback"]) for r in got.filter("rank = 1").collect()}
    assert first == {"Benign": ("f2", False), "Flood": ("f2", False), "Rare": ("f4", False)}


def test_floored_sample_keeps_every_class(spark):
    rows = [(i, 0 if i < 9000 else 1 if i < 9960 else 2 if i < 9996 else 3) for i in range(10000)]
    df = spark.createDataFrame(rows, "k bigint, y int")
    smp = sampling.floored_sample(df, "y", frac=0.2, cap=500, floor=20, key=["k"]).persist()
    got = {r["y"]: (r["n"], r["w"]) for r in smp.groupBy("y").agg(F.count("*").alias("n"), F.sum("sample_weight").alias("w")).collect()}
    assert {y: n for y, (n, _) in got.items()} == {0: 450, 1: 48, 2: 20, 3: 4}
    assert all(abs(w - n) < 1e-6 for (_, w), n in zip((got[y] for y in range(4)), (9000, 960, 36, 4)))
    again = sampling.floored_sample(df.repartition(7), "y", frac=0.2, cap=500, floor=20, key=["k"])
    assert {r["k"] for r in again.collect()} == {r["k"] for r in smp.collect()}


def test_class_with_five_rows_has_its_own_forest(spark):
    rows = [(i, 0, float(i % 7), 0.0) for i in range(400)] + [(1000 + i, 1, 1.0, 5.0) for i in range(5)] + [(2000 + i, 2, 2.0, 1.0) for i in range(4)]
    df = spark.createDataFrame(rows, "k bigint, label_id int, a double, b double")
    mapping = spark.createDataFrame([(0, "x"), (1, "five"), (2, "four")], "label_id int, label string")
    smp = sampling.floored_sample(df, "label_id", frac=0.05, floor=5, key=["k"])
    got = models.rf_per_class(smp, ["a", "b"], mapping, "label_id", "k", trees=5, counts=df.groupBy("label_id").count(), weight="sample_weight")
    assert {(r["scope_class"], r["fallback"]) for r in got.collect()} == {("x", False), ("five", False), ("four", True)}


def test_reports_equal_sql_over_saved_predictions(spark, tmpdir_path):
    """The report of a fitted tree, rebuilt by SQL from the predictions it wrote."""
    import duckdb

    from flowguard.plans.catalog_balance import report_sql
    df, cols = _planted(spark)
    tree = models.fit_tree(df.filter("k % 3 = 0"), cols, "label_id", "k")
    path = os.path.join(tmpdir_path, "model")
    models.save_model(tree, path)
    back = models.load_model(path)
    assert back.layout == tree.layout and back.layout.rows == 1000
    pred = models.predict(back, df.filter("k % 3 = 1"), cols, keep=["k", "label_id"])
    pred.write.parquet(os.path.join(tmpdir_path, "pred"))
    mapping = spark.createDataFrame([(0, "Benign"), (1, "Flood"), (2, "Rare")], "label_id int, label string")
    got = {r["class"]: r for r in evaluate.classification_report(pred, mapping).collect()}
    con = duckdb.connect()
    sql = f"""WITH pred AS (SELECT * FROM '{tmpdir_path}/pred/*.parquet'), mapping(label_id, label) AS (VALUES (0, 'Benign'), (1, 'Flood'), (2, 'Rare'))
              {report_sql('pred', 'x_')} SELECT class, precision, recall, f1, support FROM x_report"""
    want = con.execute(sql).fetchall()
    assert len(want) == len(got) == 6
    for name, *values, support in want:
        r = got[name]
        assert r["support"] == support
        assert all(a == b or abs(a - b) < 1e-9 for a, b in zip((r["precision"], r["recall"], r["f1"]), values)), name


def test_partitions_stay_few_while_rows_grow():
    assert [models.fit_layout(n).partitions for n in (20_000, 200_000, 1_400_000, 8_400_000)] == [1, 8, 12, 12]


def test_forest_in_groups_of_trees(spark, monkeypatch):
    """Groups bounded by nodes; one group is the forest itself, several give importances that agree with it."""
    assert models.tree_groups(16_000, 50, 30) == [50] and models.tree_groups(10 ** 7, 3, 30) == [1, 1, 1]
    assert models.tree_groups(10 ** 7, 50, 8) == [50] and sum(models.tree_groups(300_000, 50, 30)) == 50
    df = spark.createDataFrame([(int(i), *map(float, r[:4]), int(r[1] + 0.3 * r[3] > 0)) for i, r in
                                enumerate(np.random.default_rng(3).normal(size=(2000, 4)))], "key bigint, a double, b double, c double, d double, y int")
    cols = list("abcd")
    whole = models.fit_forest(df, cols, "y", "key", trees=12, max_depth=6).featureImportances.toArray()
    assert models.forest_importances(df, cols, "y", "key", trees=12, max_depth=6).tolist() == whole.tolist()
    monkeypatch.setattr(models, "FOREST_NODES", 500)
    fitted, fit = [], models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, d: fitted.append(self.getNumTrees()) or fit(self, d))
    parts = models.forest_importances(df, cols, "y", "key", trees=12, max_depth=6)
    assert fitted == [3, 3, 3, 3] and abs(parts.sum() - 1) < 1e-9
    assert np.abs(parts - whole).max() < 0.1 and parts.argmax() == whole.argmax() == 1
