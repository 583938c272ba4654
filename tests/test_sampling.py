import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowguard.functions.hashing import order_hash
from flowguard.operators import sampling


def _micro(spark, sizes):
    rows, k = [], 0
    for cls, n in sizes.items():
        for _ in range(n):
            rows.append((k, cls))
            k += 1
    return spark.createDataFrame(rows, "id bigint, y int")


def test_split_exact_quota_and_plain_form(spark):
    df = _micro(spark, {0: 2, 1: 5, 2: 100, 3: 37})
    s = sampling.stratified_split(df, "y", 0.2, 42, key=["id"])
    rows = s.collect()
    assert len(rows) == 144 and len({r["id"] for r in rows}) == 144
    n_test = sum(r["split"] == "test" for r in rows)
    assert n_test == math.ceil(0.2 * 144)
    for cls, n in {0: 2, 1: 5, 2: 100, 3: 37}.items():
        t = sum(1 for r in rows if r["y"] == cls and r["split"] == "test")
        assert abs(t - 0.2 * n) <= 1
    # bucketed cut == plain row_number definition
    q = {cls: sum(1 for r in rows if r["y"] == cls and r["split"] == "test") for cls in range(4)}
    h = order_hash(42, "split", ["id"])
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("y").orderBy(h, "id")))
    expect = {r["id"] for r in plain.collect() if r["rn"] <= q[r["y"]]}
    assert expect == {r["id"] for r in rows if r["split"] == "test"}


def test_under_and_oversample(spark):
    df = _micro(spark, {0: 3, 1: 10, 2: 25})
    u = sampling.undersample(df, "y", 42, key=["id"])
    assert sorted(r[1] for r in u.groupBy("y").count().collect()) == [3, 3, 3]
    o = sampling.oversample(df, "y", 42, key=["id"])
    cnt = {r["y"]: r["count"] for r in o.groupBy("y").count().collect()}
    assert cnt == {0: 25, 1: 25, 2: 25}
    # drawn rows are real rows of their class
    orig = {(r["id"], r["y"]) for r in df.collect()}
    assert all((r["id"], r["y"]) in orig for r in o.collect())


def test_hash_row_number_is_a_permutation(spark):
    df = _micro(spark, {0: 50, 1: 7})
    rn = sampling.hash_row_number(df, "y", 42, "t", key=["id"])
    got = {}
    for r in rn.collect():
        got.setdefault(r["y"], []).append(r["rn"])
    assert sorted(got[0]) == list(range(1, 51)) and sorted(got[1]) == list(range(1, 8))


def test_capped_sample(spark):
    df = _micro(spark, {0: 100})
    assert sampling.capped_sample(df, 0.2, 15, 42, key=["id"]).count() == 15
    assert sampling.capped_sample(df, 0.2, 1000, 42, key=["id"]).count() == 20


def test_errors_instead_of_silent_results(spark):
    import pytest
    one = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, y string")
    with pytest.raises(ValueError, match="class b has 1"):
        sampling.stratified_split(one, "y", 0.2, 42, key=["id"])
    null = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id int, y string")
    with pytest.raises(ValueError, match="2 rows without a class"):
        sampling.undersample(null, "y", 42, key=["id"])
    with pytest.raises(ValueError, match="key"):
        sampling.capped_sample(one, 0.5, 10, 42)


def test_class_tables_are_bounded(spark):
    import pytest
    from flowguard.session import bounded_rows
    assert len(bounded_rows(spark.range(3), 3)) == 3
    with pytest.raises(ValueError, match="more than 2"):
        bounded_rows(spark.range(3), 2)


def test_draws_are_joined_without_broadcast(spark):
    df = spark.range(400).selectExpr("id", "CASE WHEN id < 5 THEN 0 ELSE 1 END AS y")
    plan = sampling.oversample(df, "y", key=["id"])._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [" in line and "_rn#" in line]
    assert joins and all("SortMergeJoin" in j for j in joins), plan
