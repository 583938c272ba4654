"""Streaming scoring gives the same class as batch scoring for the same flow."""

SF = "/root/testdata/sf0.001"


def test_stream_score_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    stream = q["stream_score"](spark, SF).select("row_key", "prediction").distinct()
    batch = q["score_batch"](spark, SF).select("row_key", "prediction")
    j = batch.join(stream.withColumnRenamed("prediction", "s_pred"), "row_key")
    assert j.count() == batch.count() > 0
    assert j.filter("prediction <> s_pred").count() == 0


def test_stream_unknown_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    a = sorted(map(tuple, q["stream_unknown_labels"](spark, SF).collect()))
    b = sorted(map(tuple, q["encode_unknown_labels"](spark, SF).collect()))
    assert a == b and a


def test_missing_artifact_and_contract_are_errors(spark, tmpdir_path):
    import os
    import pytest
    from flowguard.plans.catalog_models import load_artifacts
    from flowguard.sources.contract import check_schema, contract_of
    with pytest.raises(FileNotFoundError, match="params"):
        load_artifacts(spark, os.path.join(tmpdir_path, "none"))
    want = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    check_schema(spark.createDataFrame([(1.0, 2.0, 3)], "b double, a double, extra int"), contract_of(want))
    with pytest.raises(ValueError, match="b: double wanted, missing"):
        check_schema(want.select("a"), contract_of(want))
