"""Mixing sources to target weights with exact word budgets.

Each source's documents are counted by exact length; an even share of every length fills most of the budget,
a bounded-knapsack dynamic programme over the rest fits it to the word, and documents are chosen by seeded
hash within each length until its count is met.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import bounded_batches, broadcast_if_small, word_count

WEIGHTS = (3, 1, 2)  #: weights of the sources in code-point order, repeating
SHARE = 1.5  #: words of the mix over all words
REPEAT = 2  #: a source is taken this many times at most, and so is a document
RESIDUAL = 1 << 16  #: words that the dynamic programme fits, plus less than the shortest free document
BUCKETS = 4096  #: hash buckets in which documents of one source and length are ranked
ADDED = ("size", "source_size", "target", "taken")


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, residual: int = RESIDUAL) -> np.ndarray:
    """How many documents of each length to take so that their words come as near below ``budget`` as can be.

    At most ``counts`` of each; ``budget`` must not exceed all words.  Exact within the residual.
    """
    order = np.argsort(lengths)
    size, count = lengths[order].astype(object), counts[order].astype(object)
    total = int((size * count).sum())
    if total == 0 or budget <= 0:
        return np.zeros(len(lengths), np.int64)
    take = np.array([int(c) * int(budget) // total for c in count], object)
    rest = int(budget) - int((size * take).sum())
    for i in range(len(size) - 1, -1, -1):
        if size[i] and rest > residual:
            k = min(count[i] - take[i], (rest - residual) // size[i])
            take[i], rest = take[i] + k, rest - int(k * size[i])
    reach, items, mask = 1, [], (1 << (rest + 1)) - 1  # bit w: w words can be made
    for i in range(len(size)):
        if reach >> rest & 1 or size[i] > rest:
            break
        free, k = (min(count[i] - take[i], rest // size[i]) if size[i] else 0), 1
        while free > 0 and not reach >> rest & 1:
            k = min(k, free)
            items.append((i, k, reach))
            reach |= reach << int(size[i] * k) & mask
            free, k = free - k, k * 2
    at = reach.bit_length() - 1
    for i, k, before in reversed(items):
        if not before >> at & 1:
            take[i], at = take[i] + k, at - int(size[i] * k)
    out = np.zeros(len(lengths), np.int64)
    out[order] = take.astype(np.int64)
    return out


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets of ``sizes(source, source_size)``, one row per source.

    The wanted words go to sources by weight; none gets more than REPEAT times its size, and what is left is
    reshared by weight until none is above.  That is a common level per weight, found from running sums over
    the sources in the order of their limits.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (((F.row_number().over(ranked) - 1) % len(WEIGHTS)) + 1).cast("int")).cast("double"))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(REPEAT))).withColumn("full", F.col("cap") / F.col("w"))
    line, everyone = Window.orderBy("full", F.col("source").asc_nulls_last()), Window.partitionBy()
    s = s.withColumn("wanted", F.sum("source_size").over(everyone) * F.lit(SHARE))
    s = (s.withColumn("capped", F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
         .withColumn("left", F.sum("w").over(line.rowsBetween(0, Window.unboundedFollowing))))
    s = s.withColumn("level", (F.col("wanted") - F.col("capped")) / F.col("left"))
    s = s.withColumn("level", F.coalesce(F.max(F.when(F.col("full") >= F.col("level"), F.col("level"))).over(everyone), F.max("full").over(everyone)))
    return s.select("source", "source_size", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    """Copies of all (base) and number of further single copies (extra) for each length of one source."""
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    base = min(REPEAT, int(target // size)) if size else 0
    extra = fit_counts(pdf["size"].to_numpy(), pdf["n"].to_numpy(), min(size, round(target - base * size))) if base < REPEAT else 0
    return pdf.assign(base=base, extra=extra)[["source", "size", "base", "extra", "source_size", "target"]]


def mix(docs: DataFrame, seed: int = 17, text: str = "text", size: Column | None = None) -> DataFrame:
    """Add ``size, source_size, target, taken`` to every row; same-named columns are replaced.

    taken is 0, 1 or 2 times size.  Null text has size 0; a null source is a source; rows without words are
    taken 0 words; repeated rows are documents of their own (equal rows rank in any order, with equal
    results); an empty table gives none.  Reruns agree: documents are chosen by a hash of seed and doc_id.
    Ranks are taken within (source, length, hash bucket), so no group that is all of a source meets.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rest = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(*(F.col(f"`{c}`") for c in rest), (word_count(text) if size is None else size).alias("size"))
    rows = rows.withColumn("__h", F.xxhash64(F.lit(seed), F.col("doc_id"))).withColumn("__b", F.pmod(F.col("__h"), F.lit(BUCKETS)).cast("int"))
    counts = rows.groupBy("source", "size", "__b").agg(F.count("*").alias("n"))
    counts = counts.checkpoint()
    lengths = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    # one row per source
    targets = broadcast_if_small(source_targets(sizes), 64)
    plan = (lengths.join(targets, lengths["source"].eqNullSafe(targets["source"])).drop(targets["source"])
            .groupBy("source").applyInPandas(_plan, "source string, size long, base int, extra long, source_size long, target double"))
    w = Window.partitionBy("source", "size").orderBy("__b")
    upto = counts.withColumn("__before", F.sum("n").over(w) - F.col("n")).drop("n")
    plan = plan.select(F.col("source").alias("__s"), F.col("size").alias("__z"), "base", "extra", "source_size", "target")
    upto = (upto.join(plan, upto["source"].eqNullSafe(plan["__s"]) & (upto["size"] == plan["__z"])).drop("__z", "__s")
            .select(F.col("source").alias("__s"), F.col("size").alias("__z"), F.col("__b").alias("__k"), "__before", "base", "extra",
                    F.col("source_size").alias("__ss"), F.col("target").alias("__t")))
    r = Window.partitionBy("source", "size", "__b").orderBy("__h", "doc_id")
    ranked = rows.withColumn("__r", F.row_number().over(r))
    got = ranked.join(upto, ranked["source"].eqNullSafe(upto["__s"]) & (ranked["size"] == upto["__z"]) & (ranked["__b"] == upto["__k"]))
    copies = F.col("base") + F.when(F.col("__before") + F.col("__r") <= F.col("extra"), 1).otherwise(0)
    return got.select(*(F.col(f"`{c}`") for c in rest), "size", F.col("__ss").alias("source_size"), F.col("__t").alias("target"),
                      (copies * F.col("size")).cast("long").alias("taken"), copies.cast("int").alias("__copies"))
