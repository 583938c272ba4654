"""Plan properties that matter at scale (checked on the physical plan text)."""

import re

from pyspark.sql import functions as F

from flowguard.operators import sampling

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_columns(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["clean_label_counts"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_split_ranks_only_boundary_bucket(spark, monkeypatch):
    """The split itself ranks and shuffles no row; the rank that gives the cuts sees only rows of boundary buckets."""
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("y"))
    cuts = []
    real = sampling.small_table
    monkeypatch.setattr(sampling, "small_table", lambda t: cuts.append(_plan(t)) or real(t))
    plan = _plan(sampling.stratified_split(df, "y", 0.2, 42, key=["id"]))
    assert "Window" not in plan and not re.search(r"(?<!Broadcast)Exchange", plan)
    ranked = [c for c in cuts if "_cut" in c]
    # the bucket = boundary filter is an inner join on (bucket, class), below the window
    assert len(ranked) == 1
    below = ranked[0][ranked[0].rindex("Window"):]
    assert re.search(r"Join \[[^\]]*_fg_b", below) and "_bb" in below



def test_small_table_broadcast_is_size_checked(spark):
    from flowguard.session import small_table
    df = spark.range(5)
    small, n = small_table(df, max_rows=10)
    big, m = small_table(df, max_rows=1)
    assert n == m == 5
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in big._jdf.queryExecution().logical().toString().lower()


def _hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_small_table_counts_bytes_of_what_values_hold(spark):
    """Few rows of long texts, long arrays or nested values are no small table."""
    from flowguard.session import small_table
    rows = [(k, "x" * 1000, [k] * 100, {"k" * 50: ["v" * 50]}, (k, "y" * 300), None) for k in range(10)]
    df = spark.createDataFrame(rows, "`a.b` int, s string, xs array<long>, m map<string,array<string>>, t struct<i:int,w:string>, z string")
    for part, least in (("`a.b`", 80), ("s", 10000), ("xs", 8000), ("m", 1000), ("t", 3000), ("z", 80)):
        small, n = small_table(df.select(part), max_bytes=2 * least)
        assert n == 10 and _hinted(small), part
        assert not _hinted(small_table(df.select(part), max_bytes=least - 1)[0]), part
    assert _hinted(small_table(df.limit(0))[0])


def test_class_tables_of_callers_are_size_checked(spark, monkeypatch):
    """A mapping that a caller gives is broadcast only where its size allows; results are the same without."""
    from flowguard import session
    from flowguard.operators import evaluate, imbalance
    from flowguard.streaming import score
    mapping = spark.createDataFrame([(0, "Benign"), (1, "Bot"), (2, "Ddos")], "label_id int, label string")
    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 0)], "label_id int, prediction int")
    seen = spark.createDataFrame([("Benign",), (" Bot ",), ("Worm",)], "Label string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def run():
            out = [evaluate.classification_report(pred, mapping), imbalance.class_weights(pred, mapping), score.flag_unknown(seen, mapping)]
            return [_hinted(d) for d in out], [sorted(map(tuple, d.collect()), key=repr) for d in out]
        hinted, small = run()
        monkeypatch.setattr(session.small_table, "__defaults__", (1, 1 << 20))
        plain, large = run()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(hinted) and not any(plain) and small == large and small[2] == [("Worm",)]
