"""Registered queries against their DuckDB SQL at sf0.001 (small, fast)."""

import math

import pytest

SF = "/root/testdata/sf0.001"
FAST = ["clean_label_counts", "clean_validated", "clean_quality_summary", "encode_features",
        "split_stratified", "sample_stratified", "profile_medians", "profile_box_stats",
        "preprocess_scaled", "imbalance_oversample", "imbalance_smote", "eval_classification_report",
        "report_profile", "stream_unknown_labels"]


def _norm(pdf):
    import pandas as pd
    cols = sorted(pdf.columns)

    def v(x):
        if x is None or x is pd.NA:
            return None
        if isinstance(x, float):
            return None if math.isnan(x) else round(x, 6)
        return x.item() if hasattr(x, "item") else x
    return cols, sorted((tuple(v(x) for x in rec) for rec in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    got = _norm(E.queries()[name](spark, SF).toPandas())
    want = _norm(duck.sql(E.oracle_sql()[name]).df())
    assert got == want


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["label", "count", "pct"] and df.count() > 0


def test_every_query_has_callable(spark):
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60
