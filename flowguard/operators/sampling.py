"""Exact, reproducible, skew-safe sampling: stratified split/sample, capped sample,
random under- and oversampling.

Rows are ordered inside their class by ``md5(seed|salt|key)``.  Selecting the
first ``q`` rows of a class never sorts a whole class in one task:

1. one aggregate counts rows per (class, hash bucket) — 65,536 buckets per class,
   and this also yields the class sizes;
2. a cumulative sum over that small table finds, per class, the one bucket in
   which the quota falls and how many rows of it are still needed;
3. only the rows of the boundary bucket (about n_class / 65,536) are ranked, by
   their keys alone, which gives the last selected (hash, key) of each class;
4. one projection compares every row with its class's cut: no row is shuffled.

The same rule written as ``row_number() over (partition by class order by
hash, key) <= q`` is the reference definition used by the SQL oracle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.functions.hashing import hash_bucket, hash_long, order_hash
from flowguard.session import materialize, small_table

_H, _B, _G = "_fg_h", "_fg_b", "_fg_g"


def _keyed(df: DataFrame, group: str | None, seed: int, salt: str,
           key: Sequence[str]) -> DataFrame:
    if not key:
        raise ValueError("key: the columns that tell rows apart are needed, or all rows share one hash")
    g = F.col(group) if group else F.lit(0)
    h = order_hash(seed, salt, key)
    return df.withColumn(_G, g).withColumn(_H, h).withColumn(_B, hash_bucket(F.col(_H)))


def bucket_histogram(keyed: DataFrame) -> DataFrame:
    """(group, bucket, n, before): rows per bucket and rows in earlier buckets of the group."""
    w = Window.partitionBy(_G).orderBy(_B).rowsBetween(Window.unboundedPreceding, 0)
    return (keyed.groupBy(_G, _B).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_before", F.sum("_n").over(w) - F.col("_n")))


def largest_remainder(counts: DataFrame, group: str, n_col: str, draws: Column) -> DataFrame:
    """Split ``draws`` over groups in proportion to ``n_col``: floor, then one more
    for the largest remainders (ties: group value ascending).

    ``counts`` has one row per group (small); ``draws`` is an expression over
    the whole-table totals available as column ``_total``.
    """
    w_all = Window.partitionBy()
    c = counts.withColumn("_total", F.sum(n_col).over(w_all))
    c = c.withColumn("_draws", draws.cast("bigint"))
    c = c.withColumn("_cont", F.col(n_col) / F.col("_total") * F.col("_draws"))
    c = c.withColumn("_floor", F.floor("_cont").cast("bigint"))
    c = c.withColumn("_rem", F.col("_cont") - F.col("_floor"))
    c = c.withColumn("_short", F.col("_draws") - F.sum("_floor").over(w_all))
    r = F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc(group)))
    return (c.withColumn("quota", F.col("_floor") + F.when(r <= F.col("_short"), 1).otherwise(0))
            .drop("_total", "_draws", "_cont", "_floor", "_rem", "_short"))


def first_in_hash_order(df: DataFrame, group: str | None, quota,
                        seed: int = 42, salt: str = "", key: Sequence[str] = (),
                        flag: str = "selected", least: int = 1) -> DataFrame:
    """Add boolean ``flag``: row is among the first ``quota`` rows of its group in
    hash order.  ``quota`` is an int for all groups or a function from the group sizes
    ``(group, n)`` to ``(group, quota)``; sizes come from the bucket histogram, counted once.

    Key columns must tell the rows of a group apart: two rows of one key at the cut are an error, as are rows
    without a group and groups below ``least`` rows.
    """
    name = group or _G
    keyed = _keyed(df, group, seed, salt, key)
    hist = materialize(keyed.groupBy(_G, _B).agg(F.count(F.lit(1)).alias("_n")))
    sizes = checked_sizes(hist.groupBy(F.col(_G).alias(name)).agg(F.sum("_n").cast("bigint").alias("n")), name, least)
    quotas = sizes.select(name, F.lit(quota).cast("bigint").alias("quota")) if isinstance(quota, int) else quota(sizes)
    w = Window.partitionBy(_G).orderBy(_B).rowsBetween(Window.unboundedPreceding, 0)
    hq = hist.withColumn("_before", F.sum("_n").over(w) - F.col("_n")).join(quotas.select(F.col(name).alias(_G), "quota"), _G)
    # boundary bucket: before < quota <= before + n
    bnd = (hq.filter((F.col("_before") < F.col("quota"))
                     & (F.col("quota") <= F.col("_before") + F.col("_n")))
           .select(_G, F.col(_B).alias("_bb"), (F.col("quota") - F.col("_before")).alias("_need")))
    bnd, _ = small_table(bnd)
    place = F.struct(F.col(_H), *[F.col(k) for k in key])
    edge = keyed.select(_G, _B, place.alias("_at")).join(bnd, _G).filter(F.col(_B) == F.col("_bb"))
    by_place = Window.partitionBy(_G).orderBy("_at")
    last = (edge.withColumn("_r", F.row_number().over(by_place)).withColumn("_next", F.lead("_at").over(by_place)).filter(F.col("_r") == F.col("_need"))
            .select(_G, F.col("_at").alias("_cut"), (F.col("_next") == F.col("_at")).alias("_tie")))
    last, _ = small_table(last)
    if last.filter("_tie").limit(1).count():
        raise ValueError(f"key {list(key)}: two rows of a group have the same key")
    # groups whose quota is 0 have no cut: nothing is selected
    return (keyed.join(last.select(_G, "_cut"), _G, "left").withColumn(flag, F.coalesce(place <= F.col("_cut"), F.lit(False)))
            .drop(_G, _H, _B, "_cut"))


def hash_row_number(df: DataFrame, group: str | None, seed: int = 42, salt: str = "",
                    key: Sequence[str] = (), out: str = "rn") -> DataFrame:
    """Exact 1-based position of each row inside its group in hash order.

    Offsets come from the bucket histogram; the window is per (group, bucket),
    so no task ranks more than about n_group / 65,536 rows.
    """
    keyed = _keyed(df, group, seed, salt, key)
    hist, _ = small_table(bucket_histogram(keyed).select(_G, _B, "_before"))
    w = Window.partitionBy(_G, _B).orderBy(_H, *key)
    return (keyed.join(hist, [_G, _B])
            .withColumn(out, F.col("_before") + F.row_number().over(w))
            .drop(_G, _H, _B, "_before"))


def checked_sizes(sizes: DataFrame, label: str, least: int = 1) -> DataFrame:
    """(class, n), counted once; an error for rows without a class or a class below ``least`` rows."""
    counts, _ = small_table(sizes)
    bad = counts.filter(F.col(label).isNull() | (F.col("n") < least)).orderBy(label).first()
    if bad is not None:
        raise ValueError(f"{label}: {bad['n']} rows without a class" if bad[label] is None else
                         f"{label}: class {bad[label]} has {bad['n']} rows, {least} are needed")
    return counts


def class_counts_table(df: DataFrame, label: str, least: int = 1) -> DataFrame:
    """``checked_sizes`` of a table's classes."""
    return checked_sizes(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), label, least)


def stratified_split(df: DataFrame, label: str, test_frac: float = 0.2, seed: int = 42,
                     key: Sequence[str] = (), salt: str = "split",
                     out: str = "split") -> DataFrame:
    """Exact stratified train/test split: n_test = ceil(frac*n), class quotas by
    largest remainder on the train size, test = first rows in hash order.

    A class of one row cannot be split and rows without a class have none: both are errors."""
    total = F.col("_total")

    def test_rows(sizes: DataFrame) -> DataFrame:
        train = largest_remainder(sizes, label, "n", total - F.ceil(F.lit(float(test_frac)) * total))
        return train.select(label, (F.col("n") - F.col("quota")).alias("quota"))
    sel = first_in_hash_order(df, label, test_rows, seed, salt, key, flag="_test", least=2)
    return sel.withColumn(out, F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def stratified_sample(df: DataFrame, label: str, frac: float, seed: int = 42,
                      key: Sequence[str] = (), salt: str = "sample") -> DataFrame:
    """Exact stratified subsample keeping n - ceil((1-frac)*n) rows (class quotas
    by largest remainder)."""
    total = F.col("_total")

    def rows(sizes: DataFrame) -> DataFrame:
        return largest_remainder(sizes, label, "n", total - F.ceil(F.lit(float(1.0 - frac)) * total))
    return first_in_hash_order(df, label, rows, seed, salt, key, flag="_keep").filter("_keep").drop("_keep")


def capped_sample(df: DataFrame, frac: float = 0.2, cap: int = 200_000, seed: int = 42,
                  key: Sequence[str] = (), salt: str = "capped") -> DataFrame:
    """Uniform sample without replacement of min(int(frac*n), cap) rows; n comes
    from the same bucket histogram that places the cut (no extra pass)."""
    def size(sizes: DataFrame) -> DataFrame:
        return sizes.withColumn("quota", F.least(F.floor(F.lit(float(frac)) * F.col("n")), F.lit(cap)).cast("bigint"))
    return first_in_hash_order(df, None, size, seed, salt, key, flag="_keep") \
        .filter("_keep").drop("_keep")


def floored_sample(df: DataFrame, label: str, frac: float = 0.2, cap: int = 200_000, floor: int = 100, seed: int = 42,
                   key: Sequence[str] = (), salt: str = "floored", weight: str = "sample_weight") -> DataFrame:
    """A sample of min(int(frac*n), cap) rows shared out over classes by largest remainder, but of every class
    ``floor`` rows at least (all, if it has fewer), so at most cap + floor * classes rows.

    ``weight``: rows of the class for each of its rows in the sample, which undoes the bias toward small classes.
    """
    def rows(sizes: DataFrame) -> DataFrame:
        share = largest_remainder(sizes, label, "n", F.least(F.floor(F.lit(float(frac)) * F.col("_total")), F.lit(cap)))
        return share.withColumn("quota", F.greatest("quota", F.least(F.col("n"), F.lit(floor))))
    kept = first_in_hash_order(df, label, rows, seed, salt, key, flag="_keep").filter("_keep").drop("_keep")
    counts = class_counts_table(df, label)
    weights, _ = small_table(rows(counts).select(label, (F.col("n") / F.col("quota")).alias(weight)))
    return kept.join(weights, label)


def undersample(df: DataFrame, label: str, seed: int = 42, key: Sequence[str] = (),
                salt: str = "under") -> DataFrame:
    """Every class cut to the size of the smallest class, without replacement."""
    def smallest(sizes: DataFrame) -> DataFrame:
        return sizes.withColumn("quota", F.min("n").over(Window.partitionBy()))
    return first_in_hash_order(df, label, smallest, seed, salt, key, flag="_keep").filter("_keep").drop("_keep")


SLOT_CHUNK = 65_536  #: draws of a class that one row of the slot plan makes
SLOTS_PER_TASK = 2_000_000


def draw_slots(sizes: DataFrame, draws: str, out: str) -> DataFrame:
    """The rows of ``sizes`` (one a class) once for each of their ``draws``, numbered from 1 in ``out``.

    A class's draws are cut into chunks of bounded size, and the chunks are dealt over tasks, so neither many
    classes nor one class of many draws meets in one task or in one expression.  The merge hint keeps them from being
    broadcast: a hint on ``sizes`` would go on to them, and Spark takes them for as few as the rows of ``sizes``.
    """
    total = sizes.agg(F.sum(draws)).first()[0] or 0
    parts = max(1, math.ceil(total / SLOTS_PER_TASK))
    chunks = sizes.filter(F.col(draws) > 0).withColumn("_chunk", F.explode(F.expr(f"sequence(0L, ({draws} - 1) div {SLOT_CHUNK})")))
    chunks = chunks.repartition(parts)
    return chunks.withColumn(out, F.explode(F.expr(
        f"sequence(_chunk * {SLOT_CHUNK} + 1, least(cast({draws} as bigint), (_chunk + 1) * {SLOT_CHUNK}))"))).drop("_chunk").hint("merge")


def oversample(df: DataFrame, label: str, seed: int = 42, key: Sequence[str] = (),
               salt: str = "over", copy_col: str = "copy_id") -> DataFrame:
    """Random oversampling with replacement up to the largest class.

    A class of n rows needs d = n_max - n draws, made by ``draw_slots``; slot j of a class picks row
    ``hash(seed, class, j) mod n + 1`` in hash order, fetched by an equi-join on (class, row number).
    Originals are kept with copy_id 0, drawn rows carry their slot number.
    """
    counts = class_counts_table(df, label)
    counts, _ = small_table(counts.withColumn("_d", F.max("n").over(Window.partitionBy()) - F.col("n")).filter("_d > 0"))
    slots = draw_slots(counts, "_d", copy_col).drop("_d")
    slots = slots.withColumn("_rn", F.pmod(hash_long(seed, salt + "-pick", [F.col(label), F.col(copy_col)]),
                                           F.col("n")) + 1).drop("n")
    minority = df.join(counts.select(label), label, "left_semi")
    numbered = hash_row_number(minority, label, seed, salt, key, out="_rn")
    picked = slots.join(numbered, [label, "_rn"]).drop("_rn")
    base = df.withColumn(copy_col, F.lit(0).cast("bigint"))
    return base.unionByName(picked.withColumn(copy_col, F.col(copy_col).cast("bigint")))
