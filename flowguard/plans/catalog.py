"""Registered queries: name -> (spark(spark, sf_dir) -> DataFrame, DuckDB SQL or None).

Every query reads the driver tables (through the fixtures) in full.  DOUBLE
results are rounded to 6 decimals in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.operators import clean, encode, sampling
from flowguard.plans import flows as P
from flowguard.plans.flows import Workflow
from flowguard.plans import oracle as O
from flowguard.session import small_table
from flowguard.plans.fixtures import (
    DAY, FLOW_FEATURES, KEY, LABEL, RAW_LABELS_STRIPPED, SEED, flows_raw,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = O.R) -> DataFrame:
    """Round DOUBLE columns; NaN becomes NULL (SQL engines disagree on NaN)."""
    out = []
    for f in df.schema.fields:
        c = F.col(clean.q(f.name))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(F.round(c.cast("double"), digits))
        out.append(c.alias(f.name))
    return df.select(*out)


qi, rnd = O.qi, O.rnd

# ── B: cleaning ─────────────────────────────────────────────────────────────


@register("clean_label_mapping", O.with_(O.FLOWS, f"""
SELECT DISTINCT raw, {O.norm_sql('raw')} AS normalized
FROM (SELECT coalesce(CAST("Label" AS VARCHAR), 'nan') AS raw FROM flows_raw)
WHERE raw <> {O.norm_sql('raw')}"""))
def clean_label_mapping(spark, sf):
    return clean.label_mapping(flows_raw(spark, sf), LABEL)


@register("clean_distinct_labels", O.with_(O.FLOWS, f"""
SELECT DISTINCT 'before' AS stage, "Label" AS label FROM flows_raw
UNION ALL
SELECT DISTINCT 'after' AS stage, {O.norm_sql('"Label"')} AS label FROM flows_raw"""))
def clean_distinct_labels(spark, sf):
    return clean.distinct_labels(flows_raw(spark, sf), LABEL)


LABEL_COUNTS_SQL = O.with_(O.FLOWS, f"""
SELECT label, count, {rnd('count * 100.0 / sum(count) OVER ()')} AS pct
FROM (SELECT "Label" AS label, count(*) AS count FROM flows_norm GROUP BY 1)""")


@register("clean_label_counts", LABEL_COUNTS_SQL)
def clean_label_counts(spark, sf):
    """Flagship: class counts and shares after label normalisation."""
    return rounded(clean.value_counts(P.normalized(spark, sf), LABEL))


@register("clean_duplicate_stats", O.with_(O.FLOWS, f"""
SELECT rows, duplicates, {rnd('duplicates * 100.0 / rows')} AS pct
FROM (SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM flows_dedup) AS duplicates FROM flows_norm)"""))
def clean_duplicate_stats(spark, sf):
    return rounded(clean.duplicate_stats(P.normalized(spark, sf)))


@register("clean_dedup", O.with_(O.FLOWS, "SELECT * FROM flows_dedup"))
def clean_dedup(spark, sf):
    return rounded(P.deduped(spark, sf))


@register("clean_negative_counts", O.with_(O.FLOWS, " UNION ALL ".join(
    f"SELECT '{f}' AS column, CAST(count_if({qi(f)} < 0) AS BIGINT) AS negatives, {i} AS position "
    f"FROM flows_coerced" for i, f in enumerate(O.NAMED))))
def clean_negative_counts(spark, sf):
    return clean.negative_counts(clean.coerce_numeric(P.deduped(spark, sf)))


@register("clean_infinite_counts", O.with_(O.FLOWS, "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS column, CAST(count_if(isinf({qi(f)})) AS BIGINT) AS infinities, {i} AS position "
    f"FROM flows_nonneg" for i, f in enumerate(FLOW_FEATURES)) + ") WHERE infinities > 0"))
def clean_infinite_counts(spark, sf):
    d = P.deduped(spark, sf)
    nonneg = clean.null_if_negative_cols(clean.coerce_numeric(d))
    # positions follow the floating columns of the table (row_key is not floating)
    return clean.infinite_counts(nonneg)


_ALL_COLS = ("row_key", "Day") + FLOW_FEATURES + ("Label",)


@register("clean_null_counts", O.with_(O.FLOWS, " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count_if({qi(c)} IS NULL) AS BIGINT) AS nulls, {i} AS position "
    f"FROM flows_clean" for i, c in enumerate(_ALL_COLS))))
def clean_null_counts(spark, sf):
    return clean.null_counts(P.validated(spark, sf))


@register("clean_validated", O.with_(O.FLOWS, "SELECT * FROM flows_clean"))
def clean_validated(spark, sf):
    return rounded(P.validated(spark, sf))


def _short_day_sql(e: str) -> str:
    return f"replace(replace(replace({e}, '.pcap_ISCX.csv', ''), 'WorkingHours', ''), 'MachineLearningCVE/', '')"


@register("clean_class_by_day", O.with_(O.FLOWS, "SELECT " + _short_day_sql('"Day"') + ' AS "Day", ' + ", ".join(
    f"CAST(count_if({O.strip_sql('\"Label\"')} = '{v}') AS BIGINT) AS {qi(v)}" for v in RAW_LABELS_STRIPPED)
    + " FROM flows_raw GROUP BY 1"))
def clean_class_by_day(spark, sf):
    return clean.class_by_day(flows_raw(spark, sf), DAY, LABEL)


@register("clean_quality_summary", O.with_(O.FLOWS, f"""
SELECT (SELECT count(*) FROM flows_dedup) AS rows,
       (SELECT count(DISTINCT "Label") FROM flows_dedup) AS labels,
       (SELECT count(*) FROM flows_norm) - (SELECT count(*) FROM flows_dedup) AS duplicates,
       {rnd('((SELECT count(*) FROM flows_norm) - (SELECT count(*) FROM flows_dedup)) * 100.0 / (SELECT count(*) FROM flows_norm)')} AS duplicate_pct,
       (SELECT CAST(sum(CASE WHEN {' THEN 1 ELSE 0 END + CASE WHEN '.join(qi(f) + ' < 0' for f in O.NAMED)} THEN 1 ELSE 0 END) AS BIGINT) FROM flows_coerced) AS negatives,
       (SELECT CAST(sum({' + '.join(f'CASE WHEN isinf({qi(f)}) THEN 1 ELSE 0 END' for f in FLOW_FEATURES)}) AS BIGINT) FROM flows_nonneg) AS infinities,
       CAST(0 AS BIGINT) AS encoding_issues,
       CAST(9 AS BIGINT) AS columns"""))
def clean_quality_summary(spark, sf):
    """One row about the table; one shuffle of its rows."""
    return rounded(clean.quality_summary(P.normalized(spark, sf), LABEL, DAY))


# ── C: encoding, split, sampling ────────────────────────────────────────────


@register("encode_class_mapping", O.with_(O.FLOWS, "SELECT * FROM mapping"))
def encode_class_mapping(spark, sf):
    return P.mapping(spark, sf)


@register("encode_unknown_labels", O.with_(O.FLOWS, f"""
SELECT label, count(*) AS rows FROM (SELECT {O.strip_sql('"Label"')} AS label FROM flows_raw) r
WHERE NOT EXISTS (SELECT 1 FROM mapping m WHERE m.label = r.label)
GROUP BY label"""))
def encode_unknown_labels(spark, sf):
    """A feed that skipped label standardisation: stripped raw labels unseen by the encoder."""
    from flowguard.functions.labels import strip_ws
    raw = flows_raw(spark, sf).select(strip_ws(LABEL).alias(LABEL))
    return encode.unknown_labels(raw, P.mapping(spark, sf), LABEL) \
                 .groupBy(F.col(LABEL).alias("label")).agg(F.count(F.lit(1)).alias("rows"))


@register("encode_features", O.with_(O.FLOWS, "SELECT * FROM enc"))
def encode_features(spark, sf):
    return rounded(P.encoded(spark, sf))


@register("split_stratified", O.with_(O.SPLIT, "SELECT row_key, label_id, split FROM split"))
def split_stratified(spark, sf):
    return Workflow(spark, sf).split.select(KEY, "label_id", "split")


@register("split_class_counts", O.with_(O.SPLIT, f"""
SELECT s.split, m.label_id, m.label, coalesce(c.count, 0) AS count,
       {rnd('coalesce(c.count, 0) * 100.0 / sum(coalesce(c.count, 0)) OVER (PARTITION BY s.split)')} AS pct
FROM mapping m CROSS JOIN (VALUES ('train'), ('test')) s(split)
LEFT JOIN (SELECT split, label_id, count(*) AS count FROM split GROUP BY 1, 2) c
  ON c.split = s.split AND c.label_id = m.label_id"""))
def split_class_counts(spark, sf):
    w = Workflow(spark, sf)
    return rounded(encode.class_counts_by(w.split, w.mapping, "split", ["train", "test"]))


@register("sample_stratified", O.with_(O.SPLIT + "," + O.stratified_sample_cte("smp", "train", 0.5, "sample"),
                                       "SELECT row_key, label_id FROM smp"))
def sample_stratified(spark, sf):
    return Workflow(spark, sf).sample50.select(KEY, "label_id")


@register("sample_capped", O.with_(O.SPLIT, f"""
SELECT row_key, label_id FROM train
ORDER BY {O.h('capped')}, row_key
LIMIT (SELECT least(CAST(floor(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT), 200000) FROM train)"""))
def sample_capped(spark, sf):
    train = Workflow(spark, sf).train
    return sampling.capped_sample(train, 0.2, 200_000, SEED, key=[KEY]).select(KEY, "label_id")


@register("split_binary_counts", O.with_(O.SPLIT, f"""
SELECT split, label_binary, count, {rnd('count * 100.0 / sum(count) OVER (PARTITION BY split)')} AS pct
FROM (SELECT s.split, CAST(lower(m.label) <> 'benign' AS INTEGER) AS label_binary, count(*) AS count
      FROM split s JOIN mapping m USING (label_id) GROUP BY 1, 2)"""))
def split_binary_counts(spark, sf):
    w = Workflow(spark, sf)
    classes, _ = small_table(w.mapping)
    b = encode.binary_label(w.split.join(classes, "label_id"), "label")
    g = b.groupBy("split", "label_binary").agg(F.count(F.lit(1)).alias("count"))
    from pyspark.sql import Window
    return rounded(g.withColumn("pct", F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy("split"))))


@register("split_imbalance", O.with_(O.SPLIT, f"""
SELECT max(count) AS max_count, min(count) AS min_count,
       arg_min(label_id, (count, label_id)) AS rarest_id, arg_min(label, (count, label_id)) AS rarest,
       {rnd('max(count) / min(count)')} AS ratio
FROM (SELECT m.label_id, m.label, count(t.row_key) AS count FROM mapping m LEFT JOIN train t USING (label_id)
      GROUP BY 1, 2)"""))
def split_imbalance(spark, sf):
    w = Workflow(spark, sf)
    return rounded(encode.imbalance(encode.class_counts(w.train, w.mapping)))
