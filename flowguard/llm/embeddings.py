"""Near duplicates of embeddings: inverted lists with product-quantised residuals, exact cosine rerank.

Coarse centroids and codebooks are fitted on a bounded sample; every vector is indexed.  A vector is stored
in the list of its nearest centroid and probes several.  In a list, asymmetric table lookups give distances
to the coded vectors; as each item's coding error is known, only pairs that cannot reach the threshold are
dropped, and the rest are reranked by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import bounded_batches, connected_components, materialize
from flowguard.llm.shingles import star
from flowguard.session import bounded_rows

COSINE = 0.95  #: least cosine of a link
SAMPLE = 20_000  #: distinct vectors that centroids and codebooks are fitted on at most (by hash)
PROBES = 8  #: lists that a vector probes
SUBSPACES, CODES = 8, 64  #: parts of a residual and codewords of each
MAX_LISTS = 4096  #: centroids at most: they are broadcast (at 1,024 dimensions 33 MB)
BLOCK = 2048  #: vectors of a block on average
MAX_DIMS = 1000  #: different dimensions of the vectors at most: each takes a round of its own


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from k distinct rows (fewer rows give fewer centroids)."""
    rows = np.unique(x, axis=0)
    c = rows[np.random.default_rng(seed).permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, rows of x to rows of c."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :], 0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i:i + 2048], c).argmin(1) for i in range(0, len(x), 2048)]) if len(x) else np.zeros(0, np.int64)


class Index:
    """Coarse centroids and one codebook per subspace, fitted on unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centroids = kmeans(sample, lists)
        residual = sample - self.centroids[nearest(sample, self.centroids)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [kmeans(np.ascontiguousarray(residual[:, p]), CODES) for p in self.parts]

    def probe(self, x: np.ndarray, n: int = PROBES) -> np.ndarray:
        """The n nearest lists of each row, the nearest first."""
        d = distances(x, self.centroids)
        return np.argsort(d, axis=1, kind="stable")[:, :n]

    def encode(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distance between each vector and its coded form."""
        r = x - self.centroids[at]
        codes = np.stack([nearest(r[:, p], b) for p, b in zip(self.parts, self.books)], 1).astype(np.uint8)
        back = np.concatenate([b[codes[:, m]] for m, b in enumerate(self.books)], 1)
        return codes, np.linalg.norm(r[:, np.concatenate(self.parts)] - back, axis=1)

    def lookup(self, queries: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries to coded vectors of list ``at``, by one table per subspace."""
        r = queries - self.centroids[at]
        d = np.zeros((len(queries), len(codes)))
        for m, (p, b) in enumerate(zip(self.parts, self.books)):
            d += distances(r[:, p], b)[:, codes[:, m]]
        return np.sqrt(d)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(a.flatten().to_numpy(zero_copy_only=False), np.float64)
    return x.reshape(len(a), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _links(rows: DataFrame, cosine: float, probes: int) -> tuple[DataFrame, DataFrame]:
    """Links among distinct vectors ``(id, n, embedding)`` of one dimension: counts ``(id, linked)`` and edges."""
    spark = rows.sparkSession
    count = rows.count()
    sample = rows.orderBy(F.xxhash64("embedding")).limit(SAMPLE).select("embedding").toArrow()
    lists = int(min(MAX_LISTS, max(1, round(count ** 0.5))))
    shared = spark.sparkContext.broadcast(Index(_unit(_matrix(sample["embedding"])), lists))
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            x = _unit(_matrix(b.column(2)))
            to = index.probe(x, probes)
            codes, error = index.encode(x, to[:, 0])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(list(to.astype(np.int32)), pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                ["id", "n", "embedding", "probes", "codes", "error"])

    kind = rows.schema["embedding"].dataType.simpleString()
    placed = materialize(rows.select("id", "n", "embedding").mapInArrow(
        place, f"id long, n long, embedding {kind}, probes array<int>, codes binary, error double"))
    sizes = (placed.select(F.expr("probes[0]").alias("list"), F.lit(1).alias("i"), F.lit(0).alias("q"))
             .unionAll(placed.select(F.explode("probes"), F.lit(0), F.lit(1))).groupBy("list")
             .agg(F.ceil(F.sum("i") / BLOCK).cast("int").alias("ni"), F.ceil(F.sum("q") / BLOCK).cast("int").alias("nq")))
    sizes = F.broadcast(sizes.where("ni > 0"))  # one row per list, MAX_LISTS at most
    cols = ["id", "n", "embedding", "probes", "codes", "error"]
    h = F.xxhash64("id", F.lit(3))
    items = (placed.withColumn("list", F.expr("probes[0]")).join(sizes, "list")
             .select("list", F.pmod(h, "ni").cast("int").alias("ib"), F.explode(F.expr("sequence(0, nq - 1)")).alias("qb"), F.lit(True).alias("item"), *cols))
    asks = (placed.withColumn("list", F.explode("probes")).join(sizes, "list")
            .select("list", F.explode(F.expr("sequence(0, ni - 1)")).alias("ib"), F.pmod(h, "nq").cast("int").alias("qb"), F.lit(False).alias("item"), *cols))

    def work(table: pa.Table) -> pa.Table:
        index, at = shared.value, table["list"][0].as_py()
        is_item = table["item"].to_numpy()
        i, q = table.filter(pa.array(is_item)), table.filter(pa.array(~is_item))
        counted, weight, tied = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [(np.zeros(0, np.int64),) * 2]
        if i.num_rows and q.num_rows:
            y, iid, qid = _unit(_matrix(i["embedding"])), i["id"].to_numpy(), q["id"].to_numpy()
            codes = np.frombuffer(b"".join(i["codes"].to_pylist()), np.uint8).reshape(i.num_rows, -1)
            reach, iw, qw = radius + i["error"].to_numpy(), i["n"].to_numpy(), q["n"].to_numpy()
            also = np.zeros((i.num_rows, len(index.centroids)), bool)  # the lists that each item probes itself
            also[np.arange(i.num_rows)[:, None], np.array(i["probes"].to_pylist())] = True
            home = np.array([p[0] for p in q["probes"].to_pylist()])
            for lo in range(0, q.num_rows, 256):
                x = _unit(_matrix(q["embedding"].slice(lo, 256)))
                a, b = np.nonzero(index.lookup(x, at, codes) <= reach[None, :])
                good = [np.einsum("ij,ij->i", x[a[k:k + 65536]], y[b[k:k + 65536]]) >= cosine for k in range(0, len(a), 65536)]
                good = np.concatenate([np.zeros(0, bool), *good])
                a, b = a[good] + lo, b[good]
                other = qid[a] != iid[b]
                a, b = a[other], b[other]
                once = ~also[b, home[a]]  # the item's own search does not come upon this pair: it is counted here for both
                counted += [qid[a], iid[b[once]]]
                weight += [iw[b], qw[a[once]]]
                tied.append(star(qid[a], iid[b]))
        who, back = np.unique(np.concatenate(counted), return_inverse=True)
        n = np.bincount(back, np.concatenate(weight), len(who)).astype(np.int64)
        u, v = star(np.concatenate([t[0] for t in tied]), np.concatenate([t[1] for t in tied]))
        return pa.table({"id": np.concatenate([who, u]), "other": np.concatenate([who, v]), "linked": np.concatenate([n, np.zeros(len(u), np.int64)])})

    found = materialize(items.unionByName(asks).groupBy("list", "ib", "qb").applyInArrow(work, "id long, other long, linked long"))
    return found.where("id = other").groupBy("id").agg(F.sum("linked").alias("linked")), found.where("id <> other")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, probes: int = PROBES) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Equal vectors are one class from the start.  Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, and so do rows of null vec_id (their component_id is null); vectors of
    different dimensions never link.  Repeated rows link with each other; different vectors of one vec_id are
    judged each by itself.  An empty table gives none; other
    columns, labels included, are ignored.
    """
    bounded_batches(vectors.sparkSession, 2000)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fine = F.expr("coalesce(vec_id is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) "
                  "and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0), false)")
    rows = rows.withColumn("fine", fine)
    classes = rows.where("fine").groupBy("embedding").agg(F.min("vec_id").alias("lead"), F.count("*").alias("n"))
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()))  # numbers are read back, never made again
    found, ties = None, None
    for r in bounded_rows(classes.select(F.size("embedding").alias("d")).distinct(), MAX_DIMS, "vector dimensions"):  # a round each
        counts, edges = _links(classes.where(F.size("embedding") == r["d"]), cosine, probes)
        found, ties = (counts, edges) if found is None else (found.unionByName(counts), ties.unionByName(edges))
    if found is None:
        found, ties = (classes.select("id", F.col("n").alias("linked")), classes.select("id", F.col("id").alias("other")))
    parts = connected_components(ties.select(F.col("id").alias("a"), F.col("other").alias("b")))
    several = classes.select("id", "lead").join(parts, "id")
    least = several.groupBy("component").agg(F.min("lead").alias("least"))
    several = several.join(least, "component").select("id", "least")
    of = (classes.join(found, "id", "left").join(several, "id", "left")
          .select(F.col("embedding").alias("e"), F.coalesce("least", "lead").alias("component_id"),
                  (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    linked = rows.where("fine").join(of, F.col("embedding") == F.col("e")).select("vec_id", "n_links", "component_id")
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.expr("vec_id <=> component_id"))
