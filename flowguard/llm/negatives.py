"""Hard negatives by shared lists: anchors in clusters, candidates sorted by angular upper bound once a cluster.

For a cluster with centroid c whose members lie within the angle b of it, no member scores more than its own
length times |x| cos(max(0, angle(x, c) - b)) with a candidate x.  Candidates are sorted by that bound in one
list per cluster, which all members walk: a member stops as soon as the bound can no longer beat what it has.
A list is walked in slices of growing size, each in blocks by many tasks; between slices a member's certified
end moves up, and only members that are not done go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import bounded_batches, broadcast_if_small, materialize
from flowguard.llm.embeddings import kmeans

POSITIVES, NEGATIVES = 5, 10  #: of an anchor, and of each of its positives
LEAST, MOST = 30, 90  #: a negative's score in percent of the positive's
LABELS = 10  #: labels of the rows whose id RELABEL divides go round modulo this
ANCHOR, RELABEL = 100, 7  #: divisors of vec_id
SCALE = 256  #: of a component before it is cut to an integer
MEMBERS = 256  #: anchors of a cluster on average
MAX_CLUSTERS = 256  #: centroids are broadcast; beyond, clusters grow and are dealt in blocks of members
SAMPLE = 20_000  #: anchors that centroids are fitted on at most (by hash)
BUCKETS = 1024  #: of the histogram of a list's bounds
HEAD, GROWTH = 4096, 16  #: candidates of a list's first slice, and how much longer each next one is
BLOCK = 8192  #: candidates of a block on average
SPREAD = 16  #: label classes that positives are searched in
CHUNK = 1024  #: candidates walked at a time
_EXACT = float(1 << 52)  # products up to here are exact in double precision


def prepared(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, label (changed where RELABEL divides the id), x (integers as doubles)`` of the rows that take part."""
    fine = F.expr("vec_id is not null and label is not null and embedding is not null and "
                  "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    rows = vectors.where(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % RELABEL == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(LABELS))).otherwise(F.col("label")).cast("long").alias("label"),
        F.transform("embedding", lambda x: F.expr(f"{SCALE}D") * x.cast("double")).alias("x"))
    # doubles from 2 ** 52 on are whole
    return rows.withColumn("x", F.expr("transform(x, v -> case when abs(v) < 4.5e15 then cast(floor(v) as double) "
                                       "else greatest(least(v, 1e150D), -1e150D) end)")).distinct()


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(a.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(a), -1)


def _lengths(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(1, initial=0)
    safe = np.where(big > 0, big, 1)
    return np.linalg.norm(x / safe[:, None], axis=1) * big


def scores(u: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, exact; beyond the range of a long they stay at its ends."""
    if not len(u) or not len(x) or _lengths(u).max() * _lengths(x).max() < _EXACT:
        return np.rint(u @ x.T).astype(np.int64)
    whole = np.array([[int(v) for v in r] for r in u], object).reshape(u.shape) @ np.array([[int(v) for v in r] for r in x], object).reshape(x.shape).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _angles(x: np.ndarray, size: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Angles between rows and unit centroids; that of a zero row is 0."""
    safe = np.where(size > 0, size, 1)
    return np.where(size[:, None] > 0, np.arccos(np.clip((x / safe[:, None]) @ centroids.T, -1, 1)), 0.0)


def bounds(x: np.ndarray, centroids: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Upper bounds, rows x clusters, of the score with a member of length 1; rounding only raises them."""
    size = _lengths(x)
    b = size[:, None] * np.cos(np.maximum(0.0, _angles(x, size, centroids) - spread[None, :] - 1e-7))
    return b + size[:, None] * 1e-9


class Lists:
    """Centroids, the members' greatest angle to each, and a list's order: buckets of falling bound, cut in slices."""

    def __init__(self, centroids: np.ndarray, spread: np.ndarray, top: float):
        self.centroids, self.spread, self.top = centroids, spread, max(top, 1e-300)
        self.ends = np.zeros((len(centroids), 0), np.int64)

    def bucket(self, b: np.ndarray) -> np.ndarray:
        return np.clip((self.top - b) / (2 * self.top) * BUCKETS, 0, BUCKETS - 1).astype(np.int64)

    def cut(self, counts: np.ndarray) -> None:
        """Slices of HEAD candidates, GROWTH times as many, and so on, in whole buckets."""
        run, ends, at = np.cumsum(counts, 1), [], HEAD
        while True:
            end = np.minimum((run < at).sum(1) + 1, BUCKETS)  # buckets before it are in the slice
            ends.append(end)
            if (end == BUCKETS).all() or (run[np.arange(len(run)), end - 1] == run[:, -1]).all():
                break
            at *= GROWTH
        ends[-1][:] = BUCKETS
        self.ends = np.stack(ends, 1)

    def slice_of(self, bucket: np.ndarray) -> np.ndarray:
        """The slice of each row in each list."""
        return (bucket[:, :, None] >= self.ends[None, :, :]).sum(2)


def _merge(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """The first ``keep`` of each key by score, then vec_id, with their rank."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def _walk(rows: DataFrame, anchors: DataFrame, lists: Lists, same_label: bool, keep: int) -> DataFrame:
    """The first ``keep`` candidates of each want, by score, then vec_id: ``anchor, want, vec_id, score, rank``.

    anchors: ``anchor, anchor_id, label, x, size, cluster, wants`` with wants an array of ``(want, low, high)``:
    the scores that a want takes.  Candidates have the anchor's label (and another id), or another label.
    """
    spark = rows.sparkSession
    kind = "array<double>"
    best = None
    for step in range(lists.ends.shape[1]):
        # what a member still needs: scores above its last kept one (ties included), in the wanted range
        live = anchors.select("anchor", "anchor_id", "label", "x", "size", "cluster", F.explode("wants").alias("w")).select(
            "anchor", "anchor_id", "label", "x", "size", "cluster", "w.want", "w.low", "w.high").where("low <= high")
        if best is not None:
            least = best.groupBy("anchor", "want").agg(F.count("*").alias("__n"), F.min("score").alias("__least")).where(F.col("__n") >= keep)
            live = live.join(least.drop("__n"), ["anchor", "want"], "left").withColumn(
                "low", F.greatest("low", F.coalesce("__least", "low"))).drop("__least")
        need = live.groupBy("anchor").agg(F.first("anchor_id").alias("anchor_id"), F.first("label").alias("label"), F.first("x").alias("x"),
                                          F.first("size").alias("size"), F.first("cluster").alias("cluster"),
                                          F.array_sort(F.collect_list(F.struct("want", "low", "high"))).alias("wants"), F.min("low").alias("least"))
        need = materialize(need)
        # the members that the slice's greatest bound may still serve
        first = lists.ends[:, step - 1] if step else np.zeros(len(lists.ends), np.int64)
        above = lists.top * (1 - 2 * first / BUCKETS) * (1 + 1e-9) + 1e-6
        tops = F.array(*[F.lit(float(v)) for v in above])
        need = need.where((F.col("size") * F.get(tops, F.col("cluster"))) * (1 + 1e-9) + 1e-6 >= F.col("least"))
        state = {r["cluster"]: (r["n"], r["ratio"]) for r in need.groupBy("cluster").agg(
            F.count("*").alias("n"), F.min(F.when(F.col("size") > 0, F.col("least") / F.col("size")).otherwise(F.lit(float("-inf")))).alias("ratio")).collect()}
        if not state:
            break
        shared = spark.sparkContext.broadcast((lists, step, {c: r for c, (_, r) in state.items()}))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, at, floor = shared.value
            live_ = np.array(sorted(floor))
            low = np.array([floor[c] for c in live_])
            for b in batches:
                if not b.num_rows:
                    continue
                x = _matrix(b.column(2))
                bound = bounds(x, index.centroids[live_], index.spread[live_])
                part = Lists(index.centroids[live_], index.spread[live_], index.top)
                part.ends = index.ends[live_]
                i, j = np.nonzero((part.slice_of(part.bucket(bound)) == at) & (bound * (1 + 1e-9) + 1e-6 >= low[None, :]))
                take = pa.array(i)
                yield pa.RecordBatch.from_arrays([c.take(take) for c in b.columns] + [pa.array(live_[j].astype(np.int32)), pa.array(bound[i, j])],
                                                 ["vec_id", "label", "x", "cluster", "bound"])

        items = materialize(rows.select("vec_id", "label", "x").mapInArrow(deal, f"vec_id long, label long, x {kind}, cluster int, bound double"))
        klass = F.pmod(F.xxhash64("label"), F.lit(SPREAD)).cast("int") if same_label else F.lit(0)
        counts = items.withColumn("k", klass).groupBy("cluster", "k").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"))
        counts = broadcast_if_small(counts, 24)
        members = need.withColumn("k", klass).withColumn("mb", F.pmod(F.xxhash64("anchor"), F.lit(1 + max(n for n, _ in state.values()) // (4 * MEMBERS))).cast("int"))
        asked = members.join(counts, ["cluster", "k"]).select(
            "cluster", "k", "mb", F.explode(F.expr("sequence(0, nb - 1)")).alias("ib"), "anchor", F.col("anchor_id").alias("vec_id"), "label", "x",
            "size", "wants", "least", F.lit(None).cast("double").alias("bound"))
        groups = members.select("cluster", "k", "mb").distinct()
        groups = broadcast_if_small(groups, 24)
        given = items.withColumn("k", klass).join(counts, ["cluster", "k"]).withColumn("ib", F.pmod(F.xxhash64("vec_id", "x"), "nb").cast("int")).join(
            groups, ["cluster", "k"]).select(
            "cluster", "k", "mb", "ib", F.lit(None).cast("long").alias("anchor"), "vec_id", "label", "x", F.lit(None).cast("double").alias("size"),
            F.lit(None).cast("array<struct<want:long,low:long,high:long>>").alias("wants"), F.lit(None).cast("long").alias("least"), "bound")

        def work(table: pa.Table) -> pa.Table:
            is_item = np.asarray(table["anchor"].is_null())
            q, c = table.filter(pa.array(~is_item)), table.filter(pa.array(is_item))
            if not q.num_rows or not c.num_rows:
                return pa.table({k: pa.array([], pa.int64()) for k in ("anchor", "want", "vec_id", "score")})
            order = np.argsort(-c["bound"].to_numpy(), kind="stable")  # the shared list
            bound, ids, label, x = c["bound"].to_numpy()[order], c["vec_id"].to_numpy()[order], c["label"].to_numpy()[order], _matrix(c["x"])[order]
            u, size, mine, own, least = _matrix(q["x"]), q["size"].to_numpy(), q["label"].to_numpy(), q["vec_id"].to_numpy(), q["least"].to_numpy().copy()
            wants = q["wants"].to_pylist()
            low = [[w["low"] for w in ws] for ws in wants]
            kept = [[(np.zeros(0, np.int64),) * 2 for _ in ws] for ws in wants]
            for at in range(0, len(ids), CHUNK):
                on = np.flatnonzero(bound[at] * size * (1 + 1e-9) + 1e-6 >= least)  # the others have a certified end
                if not len(on):
                    break
                s = scores(u[on], x[at:at + CHUNK])
                other = label[None, at:at + CHUNK] != mine[on][:, None]
                fit = (~other & (ids[None, at:at + CHUNK] != own[on][:, None])) if same_label else other
                for r, m in enumerate(on):
                    for k, w in enumerate(wants[m]):
                        new = np.flatnonzero(fit[r] & (s[r] >= low[m][k]) & (s[r] <= w["high"]))
                        if not len(new):
                            continue
                        v, i = np.concatenate([kept[m][k][0], s[r, new]]), np.concatenate([kept[m][k][1], ids[at + new]])
                        best_ = np.lexsort((i, ~v))[:keep]  # ~v falls as v rises, at the ends of a long too
                        kept[m][k] = v[best_], i[best_]
                        if len(best_) == keep:
                            low[m][k] = max(low[m][k], int(v[best_[-1]]))
                    least[m] = min(low[m])
            name = q["anchor"].to_numpy()
            flat = [(np.full(len(v), name[m]), np.full(len(v), w["want"]), i, v) for m, ws in enumerate(wants) for w, (v, i) in zip(ws, kept[m])]
            return pa.table({k: pa.array(np.concatenate([f[n] for f in flat]).astype(np.int64)) for n, k in enumerate(("anchor", "want", "vec_id", "score"))})

        new = asked.unionByName(given).groupBy("cluster", "k", "mb", "ib").applyInArrow(work, "anchor long, want long, vec_id long, score long")
        best = materialize(_merge(new if best is None else new.unionByName(best.drop("rank")), ["anchor", "want"], keep))
    return best if best is not None else spark.createDataFrame([], "anchor long, want long, vec_id long, score long, rank int")


def _lists(rows: DataFrame, anchors: DataFrame) -> tuple[Lists, DataFrame]:
    """Lists for the anchors' clusters, and the anchors with ``size`` and ``cluster``."""
    spark = rows.sparkSession
    count = anchors.count()
    sample = _matrix(anchors.orderBy(F.xxhash64("anchor")).limit(SAMPLE).select("x").toArrow()["x"])
    size = _lengths(sample)
    unit = sample[size > 0] / size[size > 0, None]
    if len(unit):
        centroids = kmeans(unit, int(min(MAX_CLUSTERS, max(1, -(-count // MEMBERS)))))
        size = np.linalg.norm(centroids, axis=1)
        centroids = np.where(size[:, None] > 1e-12, centroids / np.where(size > 1e-12, size, 1)[:, None], unit[:1])
    else:
        centroids = np.eye(1, sample.shape[1])
    shared = spark.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(3))
                size = _lengths(x)
                angle = _angles(x, size, shared.value)
                at = angle.argmin(1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(size), pa.array(at.astype(np.int32)), pa.array(angle[np.arange(len(at)), at])],
                                                 ["anchor", "anchor_id", "label", "x", "size", "cluster", "angle"])

    placed = materialize(anchors.select("anchor", "anchor_id", "label", "x").mapInArrow(
        place, "anchor long, anchor_id long, label long, x array<double>, size double, cluster int, angle double"))
    spread = np.zeros(len(centroids))
    for r in placed.groupBy("cluster").agg(F.max("angle").alias("a")).collect():
        spread[r["cluster"]] = r["a"]

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_lengths(_matrix(b.column(0))).max(initial=0.0)])], ["top"])

    top = rows.select("x").mapInArrow(longest, "top double").agg(F.max("top")).first()[0] or 0.0
    lists = Lists(centroids, spread, top * (1 + 1e-8))
    index = spark.sparkContext.broadcast(lists)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(index.value.centroids), BUCKETS), np.int64)
        for b in batches:
            if b.num_rows:
                at = index.value.bucket(bounds(_matrix(b.column(0)), index.value.centroids, index.value.spread))
                total += np.bincount((at + np.arange(len(total))[None, :] * BUCKETS).ravel(), minlength=total.size).reshape(total.shape)
        c, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(k), pa.array(total[c, k])], ["c", "k", "n"])

    counts = np.zeros((len(centroids), BUCKETS), np.int64)
    for r in rows.select("x").mapInArrow(histogram, "c long, k long, n long").groupBy("c", "k").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["c"], r["k"]] = r["n"]  # MAX_CLUSTERS * BUCKETS rows at most
    lists.cut(counts)
    return lists, placed.drop("angle")


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor.

    Rows of null vec_id or label, null vector or a null or non-finite component take no part; neither do rows of
    another dimension than the anchor's.  Repeated rows count once; rows that share a vec_id but differ are rows
    of their own, and none is another's positive.  Empty vectors score 0.  Scores are exact;
    beyond a long they stay at its ends, and components beyond 1e150 at that.
    Ties: smaller vec_id.  No anchor, or an empty table, gives none; other columns are ignored.
    """
    bounded_batches(vectors.sparkSession, 2048)
    spark = vectors.sparkSession
    rows = materialize(prepared(vectors))
    out = None
    dims = rows.where(F.col("vec_id") % ANCHOR == 0).groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d")
    for d in dims.toLocalIterator():  # usually one
        here = rows.where(F.size("x") == d["d"])
        anchors = materialize(here.where(F.col("vec_id") % ANCHOR == 0).select(
            F.monotonically_increasing_id().alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "x"))
        lists, anchors = _lists(here, anchors)
        every = F.array(F.struct(F.lit(0).cast("long").alias("want"), F.lit(-(1 << 63)).cast("long").alias("low"), F.lit((1 << 63) - 1).cast("long").alias("high")))
        positives = _walk(here, anchors.withColumn("wants", every), lists, True, POSITIVES)
        positives = positives.select("anchor", F.col("rank").cast("long").alias("want"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        p = F.col("positive_score").cast("decimal(38,0)")
        # whole scores between LEAST and MOST percent: rounded up, and down
        ranged = positives.withColumns({
            "low": F.ceil(p * LEAST / 100).cast("long"), "high": F.floor(p * MOST / 100).cast("long")})
        wants = ranged.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("want", "low", "high"))).alias("wants"))
        negatives = _walk(here, anchors.join(wants, "anchor"), lists, False, NEGATIVES)
        got = negatives.join(positives, ["anchor", "want"]).join(anchors.select("anchor", "anchor_id"), "anchor").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = got if out is None else out.unionByName(got)
    return out if out is not None else spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
