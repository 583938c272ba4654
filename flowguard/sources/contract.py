"""Feature contract: names, order and types fixed at training time.

``contract_violations`` is one scan: per contract feature, count the rows whose
value cannot be read as the contract type; absent and extra columns are
reported by a full outer join of the two name lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.operators.clean import q

CONTRACT_SCHEMA = "position int, feature string, dtype string"


def contract_of(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, CONTRACT_SCHEMA)


def save_contract(contract: DataFrame, path: str) -> None:
    contract.coalesce(1).write.mode("overwrite").parquet(path)


def load_contract(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONTRACT_SCHEMA).parquet(path)


def check_schema(df: DataFrame, contract: DataFrame) -> None:
    """Raise unless the table has every contract feature with its type (no data is read)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    bad = [f"{r['feature']}: {r['dtype']} wanted, {have.get(r['feature'], 'missing')}"
           for r in contract.collect() if have.get(r["feature"]) != r["dtype"]]  # one row per feature
    if bad:
        raise ValueError("contract violations: " + "; ".join(sorted(bad)))


def contract_violations(df: DataFrame, contract: DataFrame) -> DataFrame:
    """(feature, position, expected, actual, rows_failing_cast, status, ok) for every
    contract or data column; status is ok / extra / missing / bad_values."""
    spark = df.sparkSession
    exp = [(r["position"], r["feature"], r["dtype"]) for r in contract.collect()]  # one row per feature
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    checks = [(p, n, t) for p, n, t in exp if n in have]
    fails = {}
    if checks:
        row = df.agg(*[F.count_if(F.col(q(n)).isNotNull()
                                  & F.expr(f"try_cast({q(n)} as {t})").isNull()).alias(f"c{i}")
                       for i, (_, n, t) in enumerate(checks)]).first()
        fails = {n: row[f"c{i}"] for i, (_, n, _) in enumerate(checks)}
    actual = spark.createDataFrame([(n, t) for n, t in have.items()], "feature string, actual string")
    expected = spark.createDataFrame([(n, t, p) for p, n, t in exp], "feature string, expected string, position int")
    failing = spark.createDataFrame([(n, int(v)) for n, v in fails.items()] or [], "feature string, rows_failing_cast bigint")
    j = expected.join(actual, "feature", "full").join(failing, "feature", "left")
    status = (F.when(F.col("expected").isNull(), "extra")
              .when(F.col("actual").isNull(), "missing")
              .when(F.coalesce(F.col("rows_failing_cast"), F.lit(0)) > 0, "bad_values")
              .otherwise("ok"))
    # extra columns are dropped by the projection to the contract, not an error
    return j.select("feature", "position", "expected", "actual",
                    F.coalesce("rows_failing_cast", F.lit(0)).alias("rows_failing_cast"),
                    status.alias("status"), status.isin("ok", "extra").alias("ok"))
