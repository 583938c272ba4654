"""Impute + scale step fitted on train, applied to any table (batch or stream).

The fitted state is a small parameter table (feature, median, mean, std),
stored as Parquet; applying it is one projection (no UDF, no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.operators.clean import q
from flowguard.operators.profile import exact_quantiles

PARAMS_SCHEMA = "feature string, position int, median double, mean double, std double"


def fit_preprocess(train: DataFrame, cols: Sequence[str], medians: DataFrame | None = None) -> DataFrame:
    """Median (exact) for imputation; mean and population std of the imputed
    column for scaling.  The state is one row per feature.

    ``medians (feature, median)`` of the table are taken where given: filling
    missing values with a column's median leaves its median as it is."""
    cols = list(cols)
    spark = train.sparkSession
    med = medians.select("feature", "median") if medians is not None else exact_quantiles(
        train, cols, [0.5]).select("feature", F.col("q").alias("median"))
    names = spark.createDataFrame([(c, i) for i, c in enumerate(cols)], "feature string, position int")
    med_rows = {r["feature"]: r["median"] for r in names.join(med, "feature", "left").collect()}
    filled = train.select(*[F.coalesce(F.col(q(c)), F.lit(med_rows[c])).alias(c)
                            if med_rows.get(c) is not None else F.col(q(c)) for c in cols])
    # compensated mean: a first mean, then the mean of the residuals (same pass
    # as the std), so the result does not depend on summation order
    first = filled.agg(*[F.avg(q(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    m1 = [first[f"m{i}"] for i in range(len(cols))]
    aggs = []
    for i, c in enumerate(cols):
        base = F.lit(m1[i] if m1[i] is not None else 0.0)
        aggs += [F.avg(F.col(q(c)) - base).alias(f"d{i}"), F.stddev_pop(q(c)).alias(f"s{i}")]
    row = filled.agg(*aggs).first()
    row = {**{f"m{i}": (None if m1[i] is None else m1[i] + row[f"d{i}"]) for i in range(len(cols))},
           **{f"s{i}": row[f"s{i}"] for i in range(len(cols))}}
    rows = [(c, i, med_rows.get(c), row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, PARAMS_SCHEMA)


def apply_preprocess(df: DataFrame, params: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(x filled with the median - mean) / std, std 0 -> 1; names kept.

    Only features named in ``params`` are emitted, in their fitted order; a
    column the imputer could not fit (all missing) is dropped.
    """
    ps = sorted(params.collect(), key=lambda r: r["position"])
    out = [F.col(q(k)) for k in keep]
    for r in ps:
        if r["median"] is None:
            continue
        scale = r["std"] if r["std"] not in (None, 0.0) else 1.0
        x = F.coalesce(F.col(q(r["feature"])).cast("double"), F.lit(r["median"]))
        out.append(((x - F.lit(r["mean"])) / F.lit(scale)).alias(r["feature"]))
    return df.select(*out)


def save_params(params: DataFrame, path: str) -> None:
    params.coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAMS_SCHEMA).parquet(path)
