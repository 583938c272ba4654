"""Quality classifier: document evidence combined with hierarchical empirical-Bayes site posteriors.

A logistic regression on text statistics gives each document's evidence.  Hosts and the paths below them
get posteriors from grouped sums, shrunk towards the level above with a strength estimated from the spread
between sites, so that sparse sites stay near the global prior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import SPACES, arrow_rows, bounded_batches, broadcast_if_small, crc_remainder, materialize, text_of
from flowguard.llm.shingles import Words

FIT_ROWS = 20_000  #: labelled rows that the regression is fitted on at most (by hash of doc_id)
RIDGE = 1.0
LEAST, MOST = 2.0, 10_000.0  #: range of the shrinking strengths, in documents
N_FEATURES = 13
_KIND = np.zeros(256, np.int8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 common sign, 6 other sign, 7 byte above ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 7
for _c in range(33, 127):
    if not chr(_c).isalnum():
        _KIND[_c] = 5 if chr(_c) in ".,;:'\"-?()" else 6
_KIND[list(SPACES)] = 4


def features(texts: list[bytes]) -> np.ndarray:
    """Statistics of whole texts, one row each; a text without words has zeros."""
    w = Words(texts)
    n = len(texts)
    size = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(n), size + 1)
    raw = np.frombuffer(w.raw, np.uint8)
    kinds = np.bincount(owner * 8 + _KIND[raw], minlength=n * 8).reshape(n, 8)
    lines = np.bincount(owner[raw == 10], minlength=n)
    kinds[:, 4] -= 1  # the blank that joins the texts
    words = np.diff(w.first)
    text = np.repeat(np.arange(n), words)
    order = np.lexsort((w.hash, text))
    h, t = w.hash[order], text[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])]) if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(h)))
    distinct = np.bincount(t[at], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, t[at], run)
    twice = np.bincount(text[1:][(w.hash[1:] == w.hash[:-1]) & (text[1:] == text[:-1])], minlength=n) if len(h) else np.zeros(n)
    long = np.bincount(text[(w.end - w.start) > 24], minlength=n)
    letters, seen, many = kinds[:, 1] + kinds[:, 2], np.maximum(kinds.sum(1) - kinds[:, 4], 1), np.maximum(words, 1)
    out = np.stack([np.log1p(words), seen / many, kinds[:, 2] / np.maximum(letters, 1), kinds[:, 3] / seen, kinds[:, 5] / seen, kinds[:, 6] / seen,
                    kinds[:, 7] / seen, letters / seen, distinct / many, most / many, twice / many, lines / many, long / many], 1)
    out[words == 0] = 0
    return out


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps on standardised features; weights and bias for raw features.

    One class only (or no rows) gives zero weights and the smoothed share as bias.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(N_FEATURES), float(np.log(share / (1 - share)))
    mean, sd = x.mean(0), x.std(0)
    sd[sd == 0] = 1
    z = np.concatenate([(x - mean) / sd, np.ones((len(x), 1))], 1)
    w, ridge = np.zeros(z.shape[1]), np.eye(z.shape[1]) * RIDGE
    ridge[-1, -1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / sd, float(w[-1] - (w[:-1] * mean / sd).sum())


def document_features(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """The kept columns (named) and ``f``, an array of statistics of the whole text."""
    bounded_batches(docs.sparkSession)
    given = docs.select(*keep, text_of().cast("binary").alias("__raw"))
    out = given.drop("__raw").withColumn("f", F.array(F.lit(0.0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 512, 1 << 20):
            f = features(b.column(b.num_columns - 1).to_pylist())
            cut = pa.array(np.arange(0, f.size + 1, N_FEATURES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(cut, pa.array(f.ravel()))], [*b.schema.names[:-1], "f"])

    return given.mapInArrow(run, out.schema)


def _strength(groups: DataFrame, above: str) -> float:
    """Shrinking strength of sites ``(s, n)`` towards ``above``, by the method of moments.

    The spread of site means beyond what chance gives a binomial share is the variance between sites.
    """
    m = F.col("s") / F.col("n")
    r = groups.agg(F.sum("n").alias("n"), F.sum(F.col("n") * (m - F.col(above)) ** 2).alias("spread"), F.count("*").alias("k"),
                   F.sum(F.col("n") * F.col(above) * (1 - F.col(above))).alias("v")).first()
    if not r["k"] or not r["n"] or r["v"] <= 0:
        return MOST
    inside = r["v"] / r["n"]
    between = (r["spread"] - inside * r["k"]) / r["n"]
    return MOST if between <= 0 else float(np.clip(inside / between - 1, LEAST, MOST))


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, mod: int = 4, held: int = 2,
             keep: list[Column] | None = None) -> DataFrame:
    """Per document ``doc_id, held_out, host, path, evidence, host_posterior, path_posterior, score, good``, and the
    columns of ``keep`` (named otherwise).

    Labels (quality 0 or 1, others ignored; the largest of repeated ones) of documents whose crc32(doc_id) mod
    ``mod`` is ``held`` are never used.  A site's sums take the label of a training document and the evidence
    of any other; a document's own part is taken out of the sums that it is judged by.  score: sigmoid of
    its evidence's log odds plus those of its path over the global ones; good: score >= 0.5.

    Null text counts as empty and is judged like any other; a null host or path is a site of its own; repeated
    rows count each; without labels every evidence is 0.5; an empty table gives none; extra columns are ignored.
    """
    host = F.substring_index(F.col("source"), "/", 1) if host is None else host
    path = F.concat_ws("/", "source", "lang") if path is None else path
    rows = materialize(document_features(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(host, F.lit("")).alias("host"),
                                                F.coalesce(path, F.lit("")).alias("path"), *(keep or [])])
                       .withColumn("held_out", crc_remainder("doc_id", mod) == held))
    known = (labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("quality").cast("double").alias("label")))
    rows = rows.join(broadcast_if_small(known, 16), "doc_id", "left").withColumn("label", F.when(~F.col("held_out"), F.col("label")))
    got = rows.where("label is not null").orderBy(F.xxhash64("doc_id")).limit(FIT_ROWS).select("f", "label").toArrow()
    x = np.asarray(got["f"].combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(-1, N_FEATURES)
    weights, bias = fit(x, np.asarray(got["label"].to_numpy(), float))
    logit = F.lit(bias)
    for k, w in enumerate(weights):
        logit = logit + F.col("f")[k] * F.lit(float(w))
    odds = F.least(F.greatest(logit, F.lit(-12.0)), F.lit(12.0))
    more = [c for c in rows.columns if c not in ("doc_id", "held_out", "host", "path", "label", "f")]  # the kept ones
    rows = rows.select("doc_id", "held_out", "host", "path", "label", *more, odds.alias("odds")).withColumn("evidence", 1 / (1 + F.exp(-F.col("odds"))))
    rows = materialize(rows.withColumn("y", F.coalesce("label", "evidence")).drop("label"))
    sites = rows.groupBy("host", "path").agg(F.sum("y").alias("s"), F.count("*").alias("n"))
    sites = materialize(sites)
    hosts = sites.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    r = hosts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mu = (r["s"] + 1) / (r["n"] + 2) if r["n"] else 0.5
    hk = _strength(hosts.withColumn("mu", F.lit(mu)), "mu")
    hosts = hosts.withColumn("hp", (F.col("s") + hk * mu) / (F.col("n") + hk))
    pk = _strength(sites.join(hosts.select("host", "hp"), "host"), "hp")
    both = sites.join(hosts.select("host", F.col("s").alias("hs"), F.col("n").alias("hn")), "host")
    both = broadcast_if_small(both, 200)
    got = rows.join(both, ["host", "path"])
    got = got.withColumn("host_posterior", (F.col("hs") - F.col("y") + hk * mu) / (F.col("hn") - 1 + hk))
    got = got.withColumn("path_posterior", (F.col("s") - F.col("y") + pk * F.col("host_posterior")) / (F.col("n") - 1 + pk))
    kept = F.least(F.greatest("path_posterior", F.lit(1e-6)), F.lit(1 - 1e-6))
    total = F.col("odds") + F.log(kept / (1 - kept)) - float(np.log(mu / (1 - mu)))
    got = got.withColumn("score", 1 / (1 + F.exp(-total)))
    return got.select("doc_id", "held_out", "host", "path", "evidence", "host_posterior", "path_posterior", "score", (F.col("score") >= 0.5).alias("good"), *more)
