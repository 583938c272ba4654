"""Feature profiling and selection: exact medians and quantiles, median fill,
zero variance, correlation, redundant features, per-class statistics,
importance top-k, literature overlap and annotations."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.operators.clean import q
from flowguard.session import materialize, small_table

def to_long(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (),
            feature: str = "feature", value: str = "value") -> DataFrame:
    """Wide -> (ids..., feature, value) as DOUBLE, missing values dropped."""
    wide = df.select(*[F.col(q(i)) for i in ids],
                     *[F.col(q(c)).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(ids) or [], list(cols), feature, value) \
               .filter(F.col(value).isNotNull())


# ── exact quantiles without one task holding a whole group ─────────────────

QUANTILE_BITS = 16  #: bits of a value that one round of the selection fixes
_TOP = np.int64(-(1 << 63))


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned integers of the same order; both zeros are equal, all NaNs are the greatest."""
    x = np.where(np.isnan(x), np.nan, x + 0.0)
    b = x.view(np.int64)
    return (b ^ np.where(b < 0, np.int64(-1), _TOP)).view(np.uint64)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group: str | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (same rule as SQL ``quantile_cont``): (group, feature, p, q).

    A selection over the bits of the values: each round counts, by column, the values that agree with a wanted
    rank's bits so far by their next ``QUANTILE_BITS`` bits, which fixes those bits of the value at that rank.
    A round is one pass over the wide rows and one aggregate; it ends for a rank when all values left are equal,
    after 64 / ``QUANTILE_BITS`` rounds at the latest.  No task sees more than 2 ** ``QUANTILE_BITS`` counts of a
    group and column, whatever the values.  Missing values are skipped; rows of a null group are left out; a
    group without values in a column gives no row for it.
    """
    spark = df.sparkSession
    cols, probs = list(cols), [float(p) for p in probs]
    ranks = 2 * len(probs)  # the rank below and above each quantile
    rows = df.select(F.col(group).alias("_g") if group else F.lit(0).alias("_g"), *[F.col(q(c)).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])
    rows = rows.filter(F.col("_g").isNotNull())
    gtype = rows.schema["_g"].dataType.simpleString()
    known = None
    for at in range(0, 64, QUANTILE_BITS):
        counts = _next_bits(rows, known, len(cols), ranks, at, gtype)
        w = Window.partitionBy("_g", "_f", "_t").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        if known is None:  # one histogram serves all ranks of a column
            total = Window.partitionBy("_g", "_f")
            some = counts.drop("_t").withColumn("_total", F.sum("_n").over(total))
            wanted = F.explode(F.array(*[F.struct(F.lit(2 * i + up).alias("_t"), F.lit(p).alias("p"), F.lit(up).alias("up")) for i, p in enumerate(probs) for up in (0, 1)]))
            some = some.withColumn("_w", wanted).select("_g", "_f", "_b", "_n", "_lo", "_hi", "_total", "_w.*")
            spot = (F.col("_total") - 1) * F.col("p")
            counts = some.withColumn("_rank", F.when(F.col("up") == 1, F.ceil(spot)).otherwise(F.floor(spot)).cast("bigint")).withColumn("_part", spot - F.floor(spot))
            counts = counts.withColumn("_before", F.lit(0).cast("bigint")).withColumn("_prefix", F.lit(0).cast("bigint")).drop("up", "_total")
        else:
            counts = counts.join(known.filter("not _done").select("_g", "_f", "_t", "p", "_rank", "_part", "_before", "_prefix"), ["_g", "_f", "_t"])
        upto = F.col("_before") + F.sum("_n").over(w)
        hit = (counts.withColumn("_upto", upto).filter((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_n") <= F.col("_rank")))
               .select("_g", "_f", "_t", "p", "_rank", "_part", (F.col("_upto") - F.col("_n")).alias("_before"),
                       F.shiftleft("_prefix", QUANTILE_BITS).bitwiseOR(F.col("_b")).alias("_prefix"), F.col("_lo").alias("_value"), (F.col("_lo") == F.col("_hi")).alias("_done")))
        known = materialize(hit if known is None else known.filter("_done").unionByName(hit))
        if not known.filter("not _done").limit(1).count():
            break
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_f") + 1)
    value = known.groupBy("_g", "_f", "p").agg(F.max(F.when(F.col("_t") % 2 == 0, F.col("_value"))).alias("a"),
                                               F.max(F.when(F.col("_t") % 2 == 1, F.col("_value"))).alias("b"), F.max("_part").alias("_part"))
    # equal ends first: infinite ones have no difference
    between = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("_part"))
    out = value.select(F.col("_g"), names.alias("feature"), "p", between.alias("q"))
    return out.withColumnRenamed("_g", group) if group else out.drop("_g")


def _next_bits(rows: DataFrame, known: DataFrame | None, d: int, ranks: int, at: int, gtype: str) -> DataFrame:
    """(_g, _f, _t, _b, _n, _lo, _hi): values by the bits from place ``at`` on, for each open rank (all values in one
    histogram, ``_t`` 0, where no bits are known)."""
    shift = np.uint64(64 - QUANTILE_BITS - at)
    mask = np.uint64((1 << QUANTILE_BITS) - 1)
    later = known is not None
    if later:
        # one row per group: the bits so far of each column's ranks, null where the rank is done
        by_rank = F.map_from_entries(F.collect_list(F.struct((F.col("_f") * ranks + F.col("_t")).alias("k"), F.col("_prefix"))))
        wanted = known.filter("not _done").groupBy("_g").agg(by_rank.alias("_m"))
        wanted, _ = small_table(wanted.select("_g", F.transform(F.sequence(F.lit(0), F.lit(d * ranks - 1)), lambda k: F.try_element_at(F.col("_m"), k)).alias("_m")))
        rows = rows.join(wanted, "_g")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 8192):
                b = whole.slice(start, 8192)
                groups = b.column(0).dictionary_encode()
                code = groups.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                if later:
                    flat = b.column(d + 1).flatten()
                    open_ = flat.is_valid().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                    prefix = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).reshape(b.num_rows, -1)
                out = []
                for f in range(d):
                    col = b.column(f + 1)
                    has = col.is_valid().to_numpy(zero_copy_only=False)
                    x = col.to_numpy(zero_copy_only=False).astype(np.float64)
                    bits = ordered_bits(x)
                    for t in range(ranks if later else 1):
                        use = has if not later else has & open_[:, f * ranks + t] & (bits >> np.uint64(64 - at) == prefix[:, f * ranks + t])
                        i = np.flatnonzero(use)
                        if not len(i):
                            continue
                        i = i[np.lexsort((bits[i], code[i]))]
                        key = code[i] << QUANTILE_BITS | ((bits[i] >> shift) & mask).astype(np.int64)
                        cut = np.flatnonzero(np.diff(key, prepend=-1))
                        last = np.append(cut[1:], len(i)) - 1
                        out.append((code[i][cut], np.full(len(cut), f), np.full(len(cut), t), key[cut] & int(mask), last - cut + 1, x[i][cut] + 0.0, x[i][last] + 0.0))
                if out:
                    g, *cols = (np.concatenate(c) for c in zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [groups.dictionary.take(pa.array(g)), *(pa.array(c.astype(np.int32)) for c in cols[:2]), *(pa.array(c.astype(np.int64)) for c in cols[2:4]),
                         *(pa.array(c) for c in cols[4:])], ["_g", "_f", "_t", "_b", "_n", "_lo", "_hi"])

    parts = rows.mapInArrow(count, f"_g {gtype}, _f int, _t int, _b bigint, _n bigint, _lo double, _hi double")
    return parts.groupBy("_g", "_f", "_t", "_b").agg(F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))


def medians(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """(feature, median) per column, missing values skipped; all-missing -> NULL."""
    names = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)],
                                            "feature string, position int")
    if exact:
        m = exact_quantiles(df, cols, [0.5]).select("feature", F.col("q").alias("median"))
    else:
        m = to_long(df, cols).groupBy("feature").agg(F.percentile_approx("value", 0.5, 10_000).alias("median"))
    out, _ = small_table(names.join(m, "feature", "left").select("feature", "median", "position"))
    return out


def fill_medians(df: DataFrame, med: DataFrame) -> DataFrame:
    """Replace missing values by the given medians (a bounded per-feature table)."""
    values = {r["feature"]: r["median"] for r in med.collect() if r["median"] is not None}
    return df.select(*[F.coalesce(F.col(q(c)), F.lit(values[c])).alias(c) if c in values
                       else F.col(q(c)) for c in df.columns])


# ── zero variance and correlation ───────────────────────────────────────────

def _stats_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, position, n, min, max) from one aggregate."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(q(c)).alias(f"n{i}"), F.min(q(c)).alias(f"a{i}"), F.max(q(c)).alias(f"b{i}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"{i}, n{i}, cast(a{i} as double), cast(b{i} as double)" for i in range(len(cols)))
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)],
                                            "position int, feature string")
    long_ = wide.selectExpr(f"stack({len(cols)}, {stack}) as (position, n, mn, mx)")
    return long_.join(F.broadcast(names), "position")


def zero_variance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, reason): 'zero_variance' when at least two values and all equal
    (a float variance of a constant can be 1e-35, so min = max is the test);
    'all_null' when the column has no value."""
    s = _stats_long(df, cols)
    reason = (F.when(F.col("n") == 0, "all_null")
              .when((F.col("n") >= 2) & (F.col("mn") == F.col("mx")), "zero_variance"))
    return s.select("feature", reason.alias("reason"), "position").filter("reason is not null")


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, pos_a, pos_b, r) for pos_a < pos_b, signed Pearson r;
    NaN when a column is constant (pairwise-complete rows)."""
    spark = df.sparkSession
    cols = list(cols)
    if len(cols) < 2:
        return spark.createDataFrame([], "feature_a string, feature_b string, pos_a int, pos_b int, r double")
    st = {r["feature"]: (r["mn"], r["mx"]) for r in _stats_long(df, cols).collect()}
    const = {c for c, (a, b) in st.items() if a is None or a == b}
    live = [c for c in cols if c not in const]
    vals = {}
    if len(live) > 1:
        vals = {(live[r["i"]], live[r["j"]]): r["r"] for r in _pair_corr(df, live).collect()}  # one row per pair
    rows = [(x, y, i, j, float(v) if (v := vals.get((x, y))) is not None else float("nan"))
            for i, x in enumerate(cols) for j, y in enumerate(cols) if i < j]
    return spark.createDataFrame(rows, "feature_a string, feature_b string, pos_a int, pos_b int, r double")


_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy", "odd")
_RANGE = ("mnx", "mny", "mxx", "mxy")


def _pair_corr(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, r) with i < j: Pearson r over the rows that have both, in one pass at any number of columns.

    Each task adds up products of its centred columns and their masks, one row per pair; Spark merges these.
    r is NULL where either column is constant in the common rows, or holds a NaN or an infinity there.
    """
    p = len(cols)
    x = df.select(*[F.col(q(c)).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    mean = x.agg(*[F.avg(F.when(F.abs(f"c{k}") < float("inf"), F.col(f"c{k}"))) for k in range(p)]).first()
    centre = np.array([m or 0.0 for m in mean])
    i, j = np.triu_indices(p, 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(_MOMENTS), p, p))
        low, high = np.full((p, p), np.inf), np.full((p, p), -np.inf)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                v = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns], 1) - centre
                m = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in part.columns], 1)
                odd = (m & ~np.isfinite(v)).astype(float)
                v[~np.isfinite(v)] = 0
                w = m.astype(float)
                s, s2, bad = v.T @ w, (v * v).T @ w, odd.T @ w  # of the first column, over rows with the second
                total += np.stack([w.T @ w, s, s.T, s2, s2.T, v.T @ v, bad + bad.T])
                for one in np.unique(m, axis=1).T if len(m) else ():  # columns with equal masks share the ranges
                    same = np.flatnonzero((m == one[:, None]).all(0))
                    here = m & one[:, None]
                    low[:, same] = np.minimum(low[:, same], np.where(here, v, np.inf).min(0)[:, None])
                    high[:, same] = np.maximum(high[:, same], np.where(here, v, -np.inf).max(0)[:, None])
        cols_out = [pa.array(a.astype(np.int32)) for a in (i, j)]
        cols_out += [pa.array(t[i, j]) for t in (*total, low, low.T, high, high.T)]
        yield pa.RecordBatch.from_arrays(cols_out, ["i", "j", *_MOMENTS, *_RANGE])

    parts = x.mapInArrow(add, "i int, j int, " + ", ".join(f"{c} double" for c in (*_MOMENTS, *_RANGE)))
    both = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _MOMENTS], F.min("mnx").alias("mnx"), F.min("mny").alias("mny"),
                                       F.max("mxx").alias("mxx"), F.max("mxy").alias("mxy"))
    top = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    spread = F.sqrt(F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) * F.sqrt(F.col("syy") - F.col("sy") * F.col("sy") / F.col("n"))
    known = (F.col("n") > 1) & (F.col("odd") == 0) & (F.col("mnx") < F.col("mxx")) & (F.col("mny") < F.col("mxy"))
    return both.select("i", "j", F.when(known, F.try_divide(top, spread)).alias("r"))


def high_corr_pairs(pairs: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Upper-triangle pairs with |r| > threshold (NaN dropped), largest first."""
    return (pairs.filter(~F.isnan("r") & (F.abs("r") > F.lit(threshold)))
            .select("feature_a", "feature_b", "pos_a", "pos_b", F.abs("r").alias("r"))
            .orderBy(F.desc("r"), "pos_a", "pos_b"))


def redundant_features(high: DataFrame) -> DataFrame:
    """Every second feature of a flagged pair (not greedy)."""
    return high.select(F.col("feature_b").alias("feature")).distinct() \
               .withColumn("reason", F.lit("correlated"))


def top_corr_features(high: DataFrame, pairs: DataFrame, k_pairs: int = 30,
                      max_features: int = 30) -> DataFrame:
    """Features of the top ``k_pairs`` pairs (at most ``max_features``, by first
    pair rank then name) and their signed pairwise correlations."""
    top = high.limit(k_pairs).withColumn(
        "_rank", F.row_number().over(Window.orderBy(F.desc("r"), "pos_a", "pos_b")))
    feats = top.select(F.explode(F.array("feature_a", "feature_b")).alias("feature"), "_rank") \
               .groupBy("feature").agg(F.min("_rank").alias("_first"))
    feats = feats.withColumn("_o", F.row_number().over(Window.orderBy("_first", "feature"))) \
                 .filter(F.col("_o") <= max_features).select("feature")
    fa = feats.select(F.col("feature").alias("feature_a"))
    fb = feats.select(F.col("feature").alias("feature_b"))
    return pairs.join(F.broadcast(fa), "feature_a", "left_semi") \
                .join(F.broadcast(fb), "feature_b", "left_semi") \
                .select("feature_a", "feature_b", "r")


# ── per-class statistics ────────────────────────────────────────────────────

def class_means(df: DataFrame, cols: Sequence[str], label: str = "label_id") -> DataFrame:
    """(label, feature, mean) — one grouped aggregate, then unpivot."""
    have = [c for c in cols if c in df.columns]
    g = df.groupBy(label).agg(*[F.avg(q(c)).alias(c) for c in have])
    return g.unpivot([label], have, "feature", "mean")


def class_box_stats(df: DataFrame, cols: Sequence[str], label: str = "label_id") -> DataFrame:
    """Per class and feature: n, q1, median, q3, whisker ends at 1.5 IQR, outliers.

    The whiskers are one aggregate by class over the wide rows."""
    have = [c for c in cols if c in df.columns]
    qs = exact_quantiles(df, have, [0.25, 0.5, 0.75], label)
    wide = qs.groupBy(label, "feature").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
    wide = wide.toDF(label, "feature", "q1", "median", "q3")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    wide, _ = small_table(wide.withColumn("_lo", F.col("q1") - reach).withColumn("_hi", F.col("q3") + reach))
    ends = F.map_from_entries(F.collect_list(F.struct("feature", F.struct("_lo", "_hi"))))
    by_class, _ = small_table(wide.groupBy(label).agg(ends.alias("_ends")))
    aggs = []
    for i, c in enumerate(have):
        v, end = F.col(q(c)).cast("double"), F.try_element_at(F.col("_ends"), F.lit(c))
        inside = (v >= end["_lo"]) & (v <= end["_hi"])
        aggs += [F.count(v).alias(f"n{i}"), F.min(F.when(inside, v)).alias(f"lo{i}"), F.max(F.when(inside, v)).alias(f"hi{i}"),
                 F.count_if(v.isNotNull() & ~inside).alias(f"out{i}")]
    seen = df.select(F.col(label), *[F.col(q(c)) for c in have]).join(by_class, label).groupBy(label).agg(*aggs)
    each = [F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"lo{i}").alias("whisker_lo"), F.col(f"hi{i}").alias("whisker_hi"),
                     F.col(f"out{i}").alias("outliers")) for i, c in enumerate(have)]
    long_ = seen.select(label, F.inline(F.array(*each)))
    out, _ = small_table(wide.drop("_lo", "_hi").join(long_, [label, "feature"]))
    return out


# ── feature funnel, importance and annotations ──────────────────────────────

def feature_funnel(initial: Sequence[str], zero_var: DataFrame, correlated: DataFrame) -> DataFrame:
    """(step, remaining, removed) for: initial -> zero variance -> correlated -> final.

    The two removal lists are bounded by the number of features; only their
    sizes reach the driver.
    """
    spark = zero_var.sparkSession
    n0 = len(initial)
    k_zv = zero_var.count()
    # a correlated feature counts only if it survived the zero-variance step
    k_cr = correlated.join(zero_var.select("feature"), "feature", "left_anti").count()
    rows = [("initial", n0, 0), ("zero_variance", n0 - k_zv, k_zv),
            ("correlated", n0 - k_zv - k_cr, k_cr), ("final", n0 - k_zv - k_cr, k_zv + k_cr)]
    return spark.createDataFrame(rows, "step string, remaining bigint, removed bigint")


def corr_importance(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(feature, importance = |Pearson r(feature, target)|): a deterministic,
    SQL-checkable importance score (MLlib forest importances: ``models``)."""
    st = {r["feature"]: (r["mn"], r["mx"]) for r in _stats_long(df, list(cols) + [target]).collect()}
    live = [c for c in cols if st[c][0] is not None and st[c][0] != st[c][1]]
    if st[target][0] is None or st[target][0] == st[target][1]:
        live = []
    rows = []
    if live:
        row = df.agg(*[F.corr(q(c), q(target)).alias(f"r{i}") for i, c in enumerate(live)]).first()
        rows = [(c, abs(float(row[f"r{i}"]))) for i, c in enumerate(live)]
    rows += [(c, float("nan")) for c in cols if c not in live]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def top_k(importance: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Largest importances first (ties: feature name), ``rank`` 1..k (per ``by`` group)."""
    w = Window.partitionBy(*by).orderBy(F.desc_nulls_last("importance"), "feature")
    return importance.filter(~F.isnan("importance")).withColumn("rank", F.row_number().over(w)) \
                     .filter(F.col("rank") <= k)


# The eight features a published study ranks highest, in its order.
PUBLISHED_TOP_FEATURES = (
    "Flow Duration", "Total Fwd Packets", "Total Backward Packets",
    "Total Length of Fwd Packets", "Fwd Packet Length Max",
    "Bwd Packet Length Max", "Flow IAT Mean", "SYN Flag Count",
)


def literature_overlap(importance: DataFrame, k: int = 8,
                       published: Sequence[str] = PUBLISHED_TOP_FEATURES) -> DataFrame:
    """(k, overlap, pct, features): our top k ∩ the published list."""
    spark = importance.sparkSession
    pub = spark.createDataFrame([(p,) for p in published], "feature string")
    ours = top_k(importance, k).select("feature")
    inter = ours.join(F.broadcast(pub), "feature")
    return inter.agg(F.count(F.lit(1)).alias("overlap"),
                     F.array_join(F.array_sort(F.collect_list("feature")), ", ").alias("features")) \
                .select(F.lit(k).alias("k"), "overlap",
                        (F.col("overlap") * 100.0 / len(published)).alias("pct"), "features")
