"""Cleaning, validation and quality counts (labels, duplicates, impossible values).

Every count is one aggregate over the table (map-side partial aggregation),
followed by an ``unpivot`` of the one-row result into a long table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.functions.labels import normalize_label, short_day, strip_ws
from flowguard.functions.numeric import is_infinite, null_if_infinite, null_if_negative
from flowguard.session import bounded_rows, materialize, small_table

# Flow measurements that can never be negative, in the original order.
NON_NEGATIVE_COLS = (
    "Flow Duration",
    "Total Fwd Packets",
    "Total Backward Packets",
    "Total Length of Fwd Packets",
    "Total Length of Bwd Packets",
    "Fwd Packet Length Max",
    "Fwd Packet Length Min",
    "Fwd Packet Length Mean",
    "Bwd Packet Length Max",
    "Bwd Packet Length Min",
    "Bwd Packet Length Mean",
    "Min Packet Length",
    "Max Packet Length",
    "Packet Length Mean",
)

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_FLOATING = (T.FloatType, T.DoubleType)


def q(name: str) -> str:
    """Backtick-quote a column name for use inside a Spark SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATING)]


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Named columns that exist in the table, in the given order (absent ones skipped)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def _long_counts(df: DataFrame, exprs: dict[str, F.Column], name: str, value: str) -> DataFrame:
    """One aggregate with a count per column, turned into (name, value) rows."""
    spark = df.sparkSession
    if not exprs:
        return spark.createDataFrame([], f"{name} string, {value} bigint, position int")
    keys = list(exprs)
    wide = df.agg(*[exprs[k].alias(f"c{i}") for i, k in enumerate(keys)])
    stack = ", ".join(f"{i}, c{i}" for i in range(len(keys)))
    names = spark.createDataFrame([(i, k) for i, k in enumerate(keys)],
                                  f"position int, {name} string")
    long_ = wide.selectExpr(f"stack({len(keys)}, {stack}) as (position, {value})")
    return (long_.join(F.broadcast(names), "position")
            .select(name, F.col(value).cast("bigint").alias(value), "position"))


# ── B1–B4: labels ───────────────────────────────────────────────────────────

def with_normalized_label(df: DataFrame, label: str = "Label") -> DataFrame:
    return df.withColumn(label, normalize_label(label))


def label_mapping(df: DataFrame, label: str = "Label") -> DataFrame:
    """Distinct (raw, normalized) pairs whose text changes."""
    raw = F.coalesce(F.col(label).cast("string"), F.lit("nan"))
    return (df.select(raw.alias("raw")).distinct()
            .withColumn("normalized", normalize_label("raw"))
            .filter(F.col("raw") != F.col("normalized")))


def distinct_labels(raw_df: DataFrame, label: str = "Label") -> DataFrame:
    """Sorted distinct labels before and after normalisation, as (stage, label)."""
    raw = F.coalesce(F.col(label).cast("string"), F.lit("nan"))
    d = raw_df.select(raw.alias("raw")).distinct()
    before = d.select(F.lit("before").alias("stage"), F.col("raw").alias("label"))
    after = d.select(F.lit("after").alias("stage"),
                     normalize_label("raw").alias("label")).distinct()
    return before.unionByName(after)


def value_counts(df: DataFrame, col: str = "Label", out: str = "label") -> DataFrame:
    """Count and share (%) per value, largest first; share over the aggregated rows."""
    g = df.groupBy(F.col(col).alias(out)).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(_whole())
    return (g.withColumn("pct", F.col("count") * 100.0 / total)
            .orderBy(F.desc("count"), F.asc(out)))


def _whole():
    from pyspark.sql import Window
    return Window.partitionBy()


# ── B5–B6: duplicates ───────────────────────────────────────────────────────

def duplicate_stats(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows, rows equal to an earlier row, and their share (one grouped aggregate)."""
    cols = list(subset) if subset else df.columns
    g = df.groupBy(*[F.col(q(c)) for c in cols]).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum("n").cast("bigint").alias("rows"),
                 F.sum(F.col("n") - 1).cast("bigint").alias("duplicates")) \
            .withColumn("pct", F.try_divide(F.col("duplicates") * 100.0, F.col("rows")))


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep one of each group of equal rows (NULL = NULL, NaN = NaN, -0.0 = 0.0)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


# ── B7–B12: impossible values ───────────────────────────────────────────────

def coerce_numeric(df: DataFrame, cols: Sequence[str] = NON_NEGATIVE_COLS) -> DataFrame:
    """Named columns to DOUBLE; unparseable text becomes NULL (absent names skipped)."""
    todo = set(present(df, cols))
    return df.select(*[
        F.expr(f"try_cast({q(c)} as double)").alias(c) if c in todo else F.col(q(c))
        for c in df.columns])


def negative_counts(df: DataFrame, cols: Sequence[str] = NON_NEGATIVE_COLS) -> DataFrame:
    """(column, negatives) for each named column present; -inf counts as negative."""
    exprs = {c: F.count_if(F.col(q(c)) < 0) for c in present(df, cols)}
    return _long_counts(df, exprs, "column", "negatives")


def null_if_negative_cols(df: DataFrame, cols: Sequence[str] = NON_NEGATIVE_COLS) -> DataFrame:
    todo = set(present(df, cols))
    return df.select(*[null_if_negative(q(c)).alias(c) if c in todo else F.col(q(c))
                       for c in df.columns])


def infinite_counts(df: DataFrame) -> DataFrame:
    """(column, infinities) for floating columns holding at least one +-inf."""
    exprs = {c: F.count_if(is_infinite(q(c))) for c in floating_columns(df)}
    return _long_counts(df, exprs, "column", "infinities").filter("infinities > 0")


def null_if_infinite_cols(df: DataFrame) -> DataFrame:
    fl = set(floating_columns(df))
    return df.select(*[null_if_infinite(q(c)).alias(c) if c in fl else F.col(q(c))
                       for c in df.columns])


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column (NaN counts as missing, as in pandas)."""
    fl = set(floating_columns(df))
    exprs = {}
    for c in df.columns:
        col = F.col(q(c))
        exprs[c] = F.count_if(col.isNull() | F.isnan(col)) if c in fl else F.count_if(col.isNull())
    return _long_counts(df, exprs, "column", "nulls")


def null_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column, nulls_before, nulls_after) for every column of both tables, and their sum as column ``total``."""
    both = (null_counts(before).select("column", F.col("nulls").alias("nulls_before"))
            .join(null_counts(after).select("column", F.col("nulls").alias("nulls_after")), "column"))
    both, _ = small_table(both)  # one row per column
    return both.unionByName(both.agg(F.lit("total").alias("column"), F.sum("nulls_before").cast("bigint").alias("nulls_before"),
                                     F.sum("nulls_after").cast("bigint").alias("nulls_after")))


def validate(df: DataFrame, cols: Sequence[str] = NON_NEGATIVE_COLS) -> DataFrame:
    """Coerce named columns, negatives -> NULL there, then +-inf -> NULL everywhere."""
    return null_if_infinite_cols(null_if_negative_cols(coerce_numeric(df, cols), cols))


# ── B13–B15: per-day view and summary ───────────────────────────────────────

def class_by_day(df: DataFrame, day: str = "Day", label: str = "Label") -> DataFrame:
    """Crosstab short day x stripped label with counts; absent pairs are 0.

    Every label of the data becomes a column, in name order (missing labels: ``nan``).
    The table is counted once; only its (day, label) counts are read again for the pivot.
    """
    name = F.coalesce(strip_ws(F.col(label).cast("string")), F.lit("nan"))
    counts = materialize(df.groupBy(short_day(day).alias("Day"), name.alias("_l")).agg(F.count(F.lit(1)).alias("n")))
    values = sorted(r["_l"] for r in bounded_rows(counts.select("_l").distinct(), what="labels"))
    return counts.groupBy("Day").pivot("_l", values).agg(F.sum("n")).na.fill(0)


def quality_facts(df: DataFrame, label: str = "Label", day: str = "Day", cols: Sequence[str] = NON_NEGATIVE_COLS) -> DataFrame:
    """One row about a table and what is left of it without duplicates: rows (left), labels, files, duplicates and
    their share, negatives and infinities of the rows left, columns.

    One shuffle puts equal rows together; everything else is summed up from there, by label and day first.
    """
    groups = df.groupBy(*[F.col(q(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    coerced = coerce_numeric(groups, cols)
    clean_ = null_if_negative_cols(coerced, cols)
    total = lambda e: sum(e, F.lit(0))
    rows = coerced.withColumns({"_neg": total(F.coalesce((F.col(q(c)) < 0).cast("int"), F.lit(0)) for c in present(df, cols))})
    rows = null_if_negative_cols(rows, cols).withColumn(
        "_inf", total(F.coalesce(is_infinite(q(c)).cast("int"), F.lit(0)) for c in floating_columns(clean_)))
    parts = rows.groupBy(F.col(q(label)).alias("_l"), F.col(q(day)).alias("_d")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_copies").alias("_all"), F.sum("_neg").alias("_neg"), F.sum("_inf").alias("_inf"))
    parts = parts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count_distinct("_l").alias("labels"), F.count_distinct("_d").alias("files"),
                      F.coalesce(F.sum("_all"), F.lit(0)).alias("_all"), F.coalesce(F.sum("_neg"), F.lit(0)).alias("negatives"),
                      F.coalesce(F.sum("_inf"), F.lit(0)).alias("infinities"))
    gone = F.col("_all") - F.col("rows")
    return parts.select("rows", "labels", "files", gone.alias("duplicates"), F.try_divide(gone * 100.0, F.col("_all")).alias("duplicate_pct"),
                        "negatives", "infinities", F.lit(len(df.columns)).cast("bigint").alias("columns"))


def quality_summary(df: DataFrame, label: str = "Label", day: str = "Day", encoding_issues: DataFrame | None = None) -> DataFrame:
    """One row: rows, columns, labels, duplicates (+%), negatives, infinities, and the files of ``encoding_issues``
    (rows of a load log, one per file; none for a table that comes from no file)."""
    issues = encoding_issues.count() if encoding_issues is not None else 0
    return quality_facts(df, label, day).drop("files").withColumn("encoding_issues", F.lit(issues).cast("bigint"))
