"""Near duplicates: n-gram Jaccard join with Bayesian candidate pruning.

Equal texts are one class from the start.  Classes that share a MinHash band meet in that band's bucket, in blocks
of bounded size, with eight bits of each MinHash value: these are compared in steps, a pair is dropped as soon as
the posterior probability that its similarity reaches the threshold falls below the tolerance, and what is left
ties classes to parts.  So classes that only share a band by chance are never tied.  A part is cut into
blocks of texts, and each pair of blocks is compared in one task: whole MinHash values in steps, then exactly.
No pair leaves a task: it gives back link counts, and a star per connected part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm import shingles as S
from flowguard.llm.common import arrow_rows, bounded_batches, broadcast_if_small, connected_components, materialize, text_of

SHINGLE = 5  #: words of a shingle
THRESHOLD = 0.8  #: Jaccard similarity from which two texts are linked
ROWS, BANDS = 5, 30  #: a pair at the threshold shares a band with probability 1 - 7e-6
STEP = 30  #: MinHash values compared at a time
TOLERANCE = 1e-6  #: posterior probability below which a candidate is dropped
BLOCK, BLOCK_BYTES = 512, 4 << 20  #: texts, and bytes, of a block on average
GROUP_BYTES = 4 << 20  #: bytes of a task's group of block pairs on average
BUCKET_BLOCK = 4096  #: classes of a block of a band's bucket on average
FIRST = 6  #: bands that are looked at first: they tie nine tenths of the pairs at the threshold


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float, perms: int, step: int) -> tuple[tuple[int, int], ...]:
    """For each number of compared values, the least matches that keep a pair.

    With a uniform prior the similarity's posterior after m of n matches is Beta(m + 1, n - m + 1).
    """
    x = (np.arange(4_000) + 0.5) / 4_000  # small: every worker makes this table
    out = []
    for n in range(step, perms + 1, step):
        m = np.arange(n + 1)
        log = m[:, None] * np.log(x) + (n - m)[:, None] * np.log1p(-x)
        p = np.exp(log - log.max(1, keepdims=True))
        tail = p[:, x >= threshold].sum(1) / p.sum(1)
        out.append((n, int(np.argmax(tail >= tolerance))))
    return tuple(out)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, key (digest of the text), n_bytes, bands, sig`` of documents with a word; whole texts.

    sig: eight bits of each MinHash value.  Different values agree in them by chance (1 in 256), which only keeps
    more pairs.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.md5(text_of().cast("binary")).alias("key"), text_of().cast("binary").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 512, 2 << 20):
            raw = b.column(2).to_pylist()
            h, begin = S.Words(raw).shingles(SHINGLE)
            least = S.minhash(h, begin, ROWS * BANDS)
            keys = S.band_keys(least, ROWS)
            has = np.diff(begin) > 0
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (has.sum() + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys[has].ravel()))
            mask = pa.array(has)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask),
                                              pa.array([len(x) for x, k in zip(raw, has) if k], pa.int64()), bands,
                                              pa.array([x.tobytes() for x in (least[has] & 0xFF).astype(np.uint8)], pa.binary())],
                                             ["doc_id", "key", "n_bytes", "bands", "sig"])

    return rows.mapInArrow(run, "doc_id long, key string, n_bytes long, bands array<long>, sig binary")


def alike(a: np.ndarray, b: np.ndarray, steps: tuple[tuple[int, int], ...]) -> np.ndarray:
    """Which rows of b stay a candidate with any row of a, by the values of their signatures compared in steps."""
    out = np.zeros(len(b), bool)
    n, least = steps[0]
    wide = max(1, (1 << 22) // (len(b) * n + 1))
    for at in range(0, len(a), wide):
        hits = np.zeros((len(a[at:at + wide]), len(b)), np.uint8)
        for k in range(n):
            hits += a[at:at + wide, k][:, None] == b[None, :, k]
        i, j = np.nonzero((hits >= least) & ~out[None, :])
        m, done = hits[i, j].astype(np.int32), n
        for upto, few in steps[1:]:
            for part in range(0, len(i), 1 << 16):
                p = slice(part, part + (1 << 16))
                m[p] += (a[at + i[p], done:upto] == b[j[p], done:upto]).sum(1, dtype=np.int32)
            good = m >= few
            i, j, m, done = i[good], j[good], m[good], upto
        out[j] = True
    return out


def tied(ids: np.ndarray, sig: np.ndarray, steps: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
    """The connected parts of the candidates among rows, as a star each: every other id, and the part's smallest.

    A search in breadth: those alike to the rows reached last are reached next, and only rows not reached
    yet are compared, so a bucket of near copies takes one comparison a row.
    """
    order = np.argsort(ids, kind="stable")
    ids, sig = ids[order], sig[order]
    rest = np.arange(len(ids))
    out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
    while len(rest) > 1:
        first, front, rest = rest[0], rest[:1], rest[1:]
        while len(front) and len(rest):
            hit = alike(sig[front], sig[rest], steps)
            front, rest = rest[hit], rest[~hit]
            out.append((ids[front], np.full(len(front), ids[first])))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def candidate_parts(classes: DataFrame, threshold: float) -> DataFrame:
    """``id, component`` of classes ``id, bands, sig`` that stay a candidate with another that shares a band.

    The first bands tie most of what there is to tie; of the others only those buckets meet that still hold
    several parts, so a signature does not travel to every bucket of a part that is known.
    """
    known = _met(classes.select("id", "sig", F.slice("bands", 1, FIRST).alias("bands"), F.col("id").alias("part")), threshold)
    known = connected_components(known)
    known = broadcast_if_small(known, 16)
    rest = classes.select("id", "sig", F.expr(f"slice(bands, {FIRST + 1}, {BANDS})").alias("bands")).where(F.size("bands") > 0)
    rest = rest.join(known, "id", "left").select("id", "sig", "bands", F.coalesce("component", "id").alias("part"))
    both = _met(rest, threshold).unionByName(known.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b")))
    return connected_components(both)


def _met(classes: DataFrame, threshold: float) -> DataFrame:
    """Stars ``a, b`` of the candidates among classes ``id, bands, sig, part`` in the buckets of several parts."""
    steps = least_matches(threshold, TOLERANCE, ROWS * BANDS, STEP)
    bands = classes.select("id", "part", F.explode("bands").alias("band"))
    sizes = bands.groupBy("band").agg(F.count("*").alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    sizes = materialize(sizes.select("band", "n", F.ceil(F.col("n") / BUCKET_BLOCK).cast("int").alias("nb")))
    total = sizes.agg(F.sum(F.col("n") * F.col("nb"))).first()[0] or 0
    groups = max(1, -(-int(total) * (ROWS * BANDS + 32) // GROUP_BYTES))
    # ids alone meet the buckets; a signature travels only to those that there are
    met = bands.select("id", "band").join(sizes, "band").join(classes.select("id", "sig"), "id")
    met = met.withColumn("block", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, nb - 1)")))
    met = met.select("id", "sig", "band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    met = met.withColumn("g", F.pmod(F.xxhash64("band", "lo", "hi"), F.lit(groups)))

    def compare(table: pa.Table) -> pa.Table:
        what = np.stack([table[c].to_numpy().astype(np.int64) for c in ("band", "lo", "hi")], 1)
        ids, sig = table["id"].to_numpy(), np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
        order = np.lexsort(what.T)
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(what[order], axis=0) != 0).any(1)]))
        out = [tied(ids[rows], sig[rows], steps) for rows in np.split(order, cut[1:]) if len(rows) > 1]
        u, v = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(2))
        u, v = S.star(u, v) if len(u) else (u, v)  # buckets of a group tie the same classes again
        return pa.table({"a": pa.array(u, pa.int64()), "b": pa.array(v, pa.int64())})

    return met.groupBy("g").applyInArrow(compare, "a long, b long")


class Texts:
    """Signatures and distinct shingles of one block's texts."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, raw: list[bytes]):
        h, begin = S.Words(raw).shingles(SHINGLE)
        self.ids, self.weights = ids, weights
        self.signature = S.minhash(h, begin, ROWS * BANDS)
        self.sets = [np.unique(h[begin[i]:begin[i + 1]]) for i in range(len(raw))]
        self.sizes = np.array([len(x) for x in self.sets], np.int64)


def candidates(a: Texts, b: Texts, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose posterior never falls below the tolerance."""
    steps = least_matches(threshold, TOLERANCE, ROWS * BANDS, STEP)
    n, least = steps[0]
    hits = np.zeros((len(a.ids), len(b.ids)), np.uint8)
    for k in range(n):
        hits += a.signature[:, k][:, None] == b.signature[:, k][None, :]
    i, j = np.nonzero(hits >= least)
    if same:
        i, j = i[i < j], j[i < j]
    other = a.ids[i] != b.ids[j]
    i, j = i[other], j[other]
    m = hits[i, j].astype(np.int32)
    for k, least in steps[1:]:
        for at in range(0, len(i), 1 << 16):
            part = slice(at, at + (1 << 16))
            m[part] += (a.signature[i[part], n:k] == b.signature[j[part], n:k]).sum(1, dtype=np.int32)
        good = m >= least
        i, j, m, n = i[good], j[good], m[good], k
    return i, j


def shared(a: Texts, b: Texts, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of shingles that the texts of each pair share."""
    if len(i) < 512:
        return np.array([np.intersect1d(a.sets[x], b.sets[y], assume_unique=True).size for x, y in zip(i, j)], np.int64)
    u, v = np.unique(i), np.unique(j)
    left, right = np.concatenate([a.sets[x] for x in u]), np.concatenate([b.sets[y] for y in v])
    both = np.intersect1d(left, right)  # only these can be shared
    out, width = np.zeros((len(u), len(v)), np.float32), 2048
    at = [(np.repeat(np.arange(len(s)), [len(t.sets[x]) for x in s]), np.searchsorted(both, h), h) for t, s, h in ((a, u, left), (b, v, right))]
    at = [(r, c, (c < len(both)) & (both[np.minimum(c, len(both) - 1)] == h)) if len(both) else (r, c, np.zeros(len(c), bool)) for r, c, h in at]
    for lo in range(0, len(both), width):
        sides = []
        for (r, c, ok), s in zip(at, (u, v)):
            here = ok & (c >= lo) & (c < lo + width)
            m = np.zeros((len(s), width), np.float32)
            m[r[here], c[here] - lo] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return np.rint(out[np.searchsorted(u, i), np.searchsorted(v, j)]).astype(np.int64)


def links(a: Texts, b: Texts, same: bool, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the blocks whose Jaccard similarity reaches the threshold, verified exactly."""
    i, j = candidates(a, b, same, threshold)
    common = shared(a, b, i, j)
    good = common >= threshold * (a.sizes[i] + b.sizes[j] - common) - 1e-9
    return i[good], j[good]


def linked(docs: DataFrame, classes: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links between classes ``key, id, n, n_bytes, bands, sig`` of equal texts, and how many documents each links.

    Returns ``id, other, n, link``: counts (not link), and stars over the linked ids.  The text of a class is
    that of the document ``id``, or of ``lead`` (null for a row without an id) where classes have that column.
    """
    members = materialize(classes.drop("bands", "sig").join(candidate_parts(classes, threshold), "id"))
    blocks = members.groupBy("component").agg(
        F.greatest(F.lit(1), F.ceil(F.count("*") / block), F.ceil(F.sum("n_bytes") / BLOCK_BYTES)).cast("int").alias("nb"))
    members = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("key"), F.col("nb")).cast("int"))
    # a block meets itself and every other once: (least, greatest); side 0 is the lesser block
    members = broadcast_if_small(members, 120)
    total = members.agg(F.sum(F.col("n_bytes") * F.col("nb"))).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().cast("binary").alias("raw")).withColumn("key", F.md5("raw"))
    if "lead" in classes.columns:
        texts = texts.select(F.col("id").alias("of"), "raw", F.col("key").alias("sum"))
        texts = texts.join(members, (F.col("sum") == F.col("key")) & F.col("of").eqNullSafe(F.col("lead")))
    else:
        texts = texts.join(members, ["id", "key"])
    texts = texts.dropDuplicates(["id", "key"])
    pairs = texts.select("id", "n", "raw", "component", "block", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
    pairs = pairs.select("id", "n", "raw", "component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                         F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"))
    pairs = pairs.withColumn("g", F.pmod(F.xxhash64("component", "lo", "hi"), F.lit(groups)))

    def compare(table: pa.Table) -> pa.Table:
        what = np.stack([table[c].to_numpy() for c in ("component", "lo", "hi")], 1)
        side, ids, weight, raw = table["side"].to_numpy(), table["id"].to_numpy(), table["n"].to_numpy(), table["raw"]
        order = np.lexsort(what.T)
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(what[order], axis=0) != 0).any(1)]))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for rows in np.split(order, cut[1:]):
            same = what[rows[0], 1] == what[rows[0], 2]
            here = [rows] if same else [rows[side[rows] == 0], rows[side[rows] == 1]]
            if min(map(len, here)) == 0 or len(rows) < 2:
                continue
            t = [Texts(ids[r], weight[r], [raw[int(x)].as_py() for x in r]) for r in here]
            a, b = t[0], t[-1]
            i, j = links(a, b, same, threshold)
            if not len(i):
                continue
            x, y = a.ids[i], b.ids[j]
            who, at = np.unique(np.concatenate([x, y]), return_inverse=True)
            n = np.bincount(at, np.concatenate([b.weights[j], a.weights[i]])).astype(np.int64)
            out.append((who, who, n))
            u, v = S.star(x, y)
            out.append((u, v, np.zeros(len(u), np.int64)))
        who, other, n = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3))
        # a count has no other end, a link no count
        return pa.table({"id": pa.array(who, pa.int64()), "other": pa.array(other, pa.int64()), "n": pa.array(n, pa.int64()),
                         "link": pa.array(n == 0, pa.bool_())})

    return materialize(pairs.groupBy("g").applyInArrow(compare, "id long, other long, n long, link boolean"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, kept``.

    n_links: other documents whose shingles have a Jaccard similarity of ``threshold`` or more (equal texts
    included); class_id: the smallest doc_id reachable by links; kept: doc_id = class_id.  Null, empty and
    wordless texts link with nothing; fewer than five words make one shingle.  Repeated rows link with each
    other; rows that share a doc_id count as one document in class_id, and each of its texts counts in
    n_links.  A null doc_id links with nothing, its class_id is null and it is kept.  An empty table gives
    none; other columns are ignored.
    """
    known = materialize(sketches(docs.where(F.col("doc_id").isNotNull())))
    classes = materialize(known.groupBy("key").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"),
                                                   F.max("n_bytes").alias("n_bytes"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig")))
    found = linked(docs, classes, threshold, block)
    counts = found.where("not link").groupBy("id").agg(F.sum("n").alias("linked"))
    joined = connected_components(found.where("link").select(F.col("id").alias("a"), F.col("other").alias("b")))
    of_class = (classes.select("key", "id", "n").join(counts, "id", "left").join(joined, "id", "left")
                .select("key", F.coalesce("component", "id").alias("class_id"), (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    inside = known.select("doc_id", "key").join(of_class, "key").select("doc_id", "class_id", "n_links")
    # texts without words, and rows without an id
    rest = (docs.where(F.col("doc_id").isNull() | ~text_of().rlike(r"[^\x20\x09-\x0D]"))
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("doc_id").cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
    return inside.unionByName(rest).withColumn("kept", F.expr("doc_id <=> class_id"))


def distinct_texts(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per distinct pair of doc_id and text: ``doc_id, key (md5 of the text), n (its rows), kept``.

    Texts are linked as by near_duplicates, but every distinct text is a node of its own, so texts that share a
    doc_id are one class only if links join them, and rows of null doc_id take part.  kept: the pair of the
    class's smallest doc_id (null last) and key; texts without words link with nothing, and each pair is kept.
    """
    known = materialize(sketches(docs))
    classes = known.groupBy("key").agg(F.min("doc_id").alias("lead"), F.count("*").alias("n"), F.max("n_bytes").alias("n_bytes"),
                                       F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"))
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()))  # numbers are read back, never made again
    found = linked(docs, classes, threshold, block)
    joined = connected_components(found.where("link").select(F.col("id").alias("a"), F.col("other").alias("b")))
    several = classes.select("id", "lead", "key").join(joined, "id")
    best = several.groupBy("component").agg(F.min(F.struct(F.col("lead").isNull().alias("none"), "lead", "key")).alias("best"))
    several = several.join(best, "component").select("id", F.col("best.key").alias("best"))
    of_class = classes.select("id", "key", "lead").join(several, "id", "left").select(
        "key", "lead", F.coalesce(F.col("best") == F.col("key"), F.lit(True)).alias("best"))
    pairs = known.groupBy("doc_id", "key").agg(F.count("*").alias("n")).join(of_class, "key").select(
        "doc_id", "key", "n", (F.col("best") & F.col("doc_id").eqNullSafe(F.col("lead"))).alias("kept"))
    rest = (docs.where(~text_of().rlike(r"[^\x20\x09-\x0D]"))
            .groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text_of().cast("binary")).alias("key"))
            .agg(F.count("*").alias("n")).withColumn("kept", F.lit(True)))
    return pairs.unionByName(rest)
