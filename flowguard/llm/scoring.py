"""LM scoring by context-tree weighting over bytes, beside a unigram word base.

The next byte is decomposed into eight binary decisions.  Each decision has, for every context of 0 to
DEPTH preceding bytes, a Krichevsky-Trofimov estimate; the tree mixes all depths by Bayesian weights, and
a text's code length is the sum over its bytes and a final end byte.

Nothing that grows with the corpus is broadcast or collected.  Texts belong to blocks of bounded size.  A
block's distinct byte n-grams and words, with their training counts, are packed and dealt by key: n-grams by
the last two context bytes, so that a bucket holds whole subtrees below depth 2, words by hash.  Buckets send
the values of just these keys back to each block, where the texts are scored.  Only the top of the tree (at
most 256 x 255 nodes) passes through the driver.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import arrow_rows, bounded_batches, crc_remainder, materialize, scratch_path, text_of
from flowguard.llm.shingles import Words

DEPTH = 5  #: bytes of the deepest context
TOP = 2  #: contexts of fewer bytes are mixed from the broadcast top of the tree
END = 0xFF  #: not a byte of UTF-8: ends a text, and stands before it as context
BLOCK_BYTES = 24 << 20  #: text of a block on average
BUCKET_BYTES = 32 << 20  #: text for each bucket of keys
CHUNK = 2 << 20  #: bytes scored or counted at a time
GRAM, WORD, NODE, VOCABULARY = 0, 1, 2, 3  #: kinds of rows
_LOG_PI = float(np.log(np.pi))


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5 by Stirling's series after a shift by eight."""
    y = x + 8
    shift = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    a, b = zeros.astype(np.float64), ones.astype(np.float64)
    return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - _LOG_PI


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all bytes after their contexts, and where each text's begin (one more place than texts).

    A code holds the nearest context byte in its highest place, and the byte itself in its lowest.
    """
    pad, end = bytes([END]) * DEPTH, bytes([END])
    a = np.frombuffer(b"".join(x for t in texts for x in (pad, t, end)), np.uint8)
    size = np.array([len(t) + 1 for t in texts], np.int64)
    code = a[DEPTH:].astype(np.uint64)
    for k in range(1, DEPTH + 1):
        code |= a[DEPTH - k:len(a) - k].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - k))
    keep = np.ones(len(code), bool)
    at = np.cumsum(size + DEPTH)[:-1] - DEPTH  # the contexts of all texts but the first
    for k in range(DEPTH):
        keep[at + k] = False
    return code[keep], np.concatenate([[0], np.cumsum(size)])


def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts (one each if none are given)."""
    if counts is None:
        keys = np.sort(keys)
        cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[cut], np.diff(np.append(cut, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[cut], np.add.reduceat(counts, cut) if len(cut) else counts


def squeezed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Values compressed by byte planes; ascending ones as differences."""
    if ascending:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return struct.pack("<I", len(values)) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def spread(data: bytes, dtype: type, ascending: bool = False) -> np.ndarray:
    """What ``squeezed`` made."""
    n, width = struct.unpack_from("<I", data)[0], np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data[4:], n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
    values = np.ascontiguousarray(planes.T).view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if ascending else values


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


class Level:
    """All nodes of one depth: keys (context, decision), training counts and estimates."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """keys: sorted (context << 8 | byte) with positive counts."""
        context, byte = keys >> np.uint64(8), keys & np.uint64(255)
        node, zeros, ones = [], [], []
        for j in range(8):
            z = np.uint64(1 << j) | (byte >> np.uint64(8 - j))
            k = context << np.uint64(8) | z
            cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
            bit = (byte >> np.uint64(7 - j)) & np.uint64(1)
            one = counts * bit.astype(np.int64)
            node.append(k[cut])
            ones.append(np.add.reduceat(one, cut) if len(cut) else one)
            zeros.append(np.add.reduceat(counts - one, cut) if len(cut) else one)
        node, zeros, ones = np.concatenate(node), np.concatenate(zeros), np.concatenate(ones)
        order = np.argsort(node, kind="stable")
        self.node, self.zeros, self.ones = node[order], zeros[order], ones[order]
        self.kt = log_kt(self.zeros, self.ones)
        self.one = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        self.mixed, self.weight = self.kt, np.ones(len(self.kt))  # without children: the estimate alone

    def parents(self) -> np.ndarray:
        """Keys of the nodes one byte nearer, for each node."""
        return (self.node >> np.uint64(16)) << np.uint64(8) | (self.node & np.uint64(255))

    def mix(self, children: np.ndarray) -> None:
        """Half the estimate, half the product over the children, given as a log per node."""
        self.mixed = np.logaddexp(self.kt, children) - np.log(2)
        self.weight = np.exp(self.kt - np.log(2) - self.mixed)

    def above(self, context: np.ndarray, byte: np.ndarray, j: int, below: np.ndarray) -> np.ndarray:
        """Probability of decision j of each byte: the estimate mixed with that of the deeper contexts.

        A node without training counts predicts a half, whatever lies below.
        """
        if not len(self.node):
            return below
        k = context << np.uint64(8) | np.uint64(1 << j) | (byte >> np.uint64(8 - j))
        at = np.minimum(np.searchsorted(self.node, k), len(self.node) - 1)
        bit = (byte >> np.uint64(7 - j)) & np.uint64(1)
        p = np.where(bit == 1, self.one[at], 1 - self.one[at])
        return np.where(self.node[at] == k, self.weight[at] * p + (1 - self.weight[at]) * below, below)


def tree(keys: np.ndarray, counts: np.ndarray, least: int) -> dict[int, Level]:
    """Levels DEPTH to ``least`` of the codes with positive counts, mixed upwards."""
    good = counts > 0
    keys, counts, levels = keys[good], counts[good], {}
    for d in range(DEPTH, least - 1, -1):
        if d < DEPTH:
            keys, counts = tally((keys >> np.uint64(16)) << np.uint64(8) | (keys & np.uint64(255)), counts)
        levels[d] = Level(keys, counts)
        if d < DEPTH and len(keys):
            below, here = levels[d + 1], levels[d]
            at = np.searchsorted(here.node, below.parents())
            here.mix(np.bincount(at, below.mixed, len(here.node)))
    return levels


def log10_probability(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of each code's byte in its context; levels from depth 0 to DEPTH."""
    byte, out = keys & np.uint64(255), np.zeros(len(keys))
    for j in range(8):
        p = np.full(len(keys), 0.5)
        for d in range(DEPTH, -1, -1):
            p = levels[d].above(keys >> np.uint64(8 * (DEPTH - d + 1)), byte, j, p)
        out += np.log10(p)
    return out


class Lookup:
    """Values of sorted distinct 64-bit keys: a direct table, and a binary search for keys that lost their place."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.bits = max(8, int(len(keys) * 3).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        self.table[self.place(keys)] = np.arange(len(keys), dtype=np.int32)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[self.place(keys)]
        lost = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(lost):
            k = np.searchsorted(self.keys, keys[lost])
            if (k >= len(self.keys)).any() or (self.keys[k] != keys[lost]).any():
                raise ValueError("a block was scored with texts that it was not counted with")
            at[lost] = k
        return self.values[at]


def placed(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int]:
    """``doc_id, raw, block`` and the bytes of all texts: rows near each other in their files share a block.

    The block follows from the row's file and place, so every reading gives the same; a table that is not
    read from files is written to the shared folder first.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text"))
    try:
        where = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text"),
                            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        path = scratch_path(spark, "blocks")
        slim.write.parquet(path)
        where = spark.read.parquet(path).select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    r = where.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    rows = max(1, int(BLOCK_BYTES * r["n"] / max(1, r["size"] or 0))) if r["n"] else 1
    out = where.select("doc_id", F.col("text").cast("binary").alias("raw"), F.xxhash64("file", F.floor(F.col("row") / rows)).alias("block"))
    return out, int(r["size"] or 0)


def score(docs: DataFrame, mod: int = 7, held: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every whole text with models learnt off the rows whose crc32(key as text) mod ``mod`` is not ``held``.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.  A-Z are
    lower-cased.  base_score: sum over words and one end of log10((c + 1) / (N + V + 1)); score: log10
    probability of the text's bytes and an end byte under the context tree.  Words are counted by 64-bit hash.

    Null text counts as empty: one end token, one end byte.  Without training rows every decision has
    probability 1/2 and every count is 0.  Repeated rows count, and are scored, each; a null id hashes as
    the empty text; an empty table gives none; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows, total = placed(docs, key, text)
    rows = rows.withColumn("held_out", crc_remainder("doc_id", mod) == held)
    buckets = max(12, -(-total // BUCKET_BYTES))
    deal = np.random.default_rng(3).permutation(1 << 16) % buckets  # of the two nearest context bytes

    def pack(block: int, kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[tuple]:
        to = deal[(keys >> np.uint64(8 * (DEPTH - 1))).astype(np.int64)] if kind == GRAM else (keys >> np.uint64(32)).astype(np.int64) % buckets
        order = np.argsort(to, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(order) else []:
            yield kind, int(to[part[0]]), block, squeezed(keys[part], True), squeezed(n[part].astype(np.uint32))

    names = ["kind", "bucket", "block", "keys", "counts"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_back: dict[int, list[list]] = {}

        def flush(blocks) -> Iterator[pa.RecordBatch]:
            for b in blocks:
                parts = held_back.pop(b)
                for kind in (GRAM, WORD):
                    cols = list(zip(*pack(b, kind, *merged(parts[kind])))) if parts[kind] else []
                    if cols:
                        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                                                          pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())], names)

        for b in arrow_rows(batches, 4096, CHUNK):
            block, test = b.column("block").to_numpy(), b.column("held_out").to_numpy(zero_copy_only=False)
            raw = [x.lower() for x in b.column("raw").to_pylist()]
            for k in np.unique(block):
                parts = held_back.setdefault(int(k), [[], []])
                for out in (False, True):
                    texts = [raw[i] for i in np.flatnonzero((block == k) & (test == out))]
                    if texts:
                        for kind, keys in ((GRAM, grams(texts)[0]), (WORD, Words(texts).hash)):
                            u, n = tally(keys)
                            parts[kind].append((u, n * (not out)))
                for kind in (GRAM, WORD):
                    if len(parts[kind]) > 8:
                        parts[kind] = [merged(parts[kind])]
            if len(held_back) > 2:  # rows come in the order of their files
                yield from flush([k for k in held_back if k != int(block[-1])])
        yield from flush(list(held_back))

    packs = materialize(rows.select("raw", "block", "held_out").mapInArrow(count, "kind int, bucket int, block long, keys binary, counts binary"))

    def unpacked(table: pa.Table) -> tuple[int, list[np.ndarray], np.ndarray, np.ndarray]:
        ks = [spread(x, np.uint64, True) for x in table["keys"].to_pylist()]
        ns = [spread(x, np.uint32).astype(np.int64) for x in table["counts"].to_pylist()]
        return table["kind"][0].as_py(), ks, *tally(np.concatenate(ks), np.concatenate(ns))

    def top(table: pa.Table) -> pa.Table:
        """Counts and summed child logs of the nodes of depth 1, or the number of known words."""
        kind, _, keys, n = unpacked(table)
        if kind == WORD:
            cols = [np.array([x]) for x in (VOCABULARY, 0, (n > 0).sum(), n.sum())] + [np.zeros(1)]
        else:
            below = tree(keys, n, TOP)[TOP]
            at, back = np.unique(below.parents(), return_inverse=True)
            cols = [np.full(len(at), NODE), at.astype(np.int64), *(np.bincount(back, x, len(at)).astype(np.int64) for x in (below.zeros, below.ones)),
                    np.bincount(back, below.mixed, len(at))]
        return pa.table({"kind": pa.array(cols[0], pa.int32()), "node": pa.array(cols[1], pa.int64()), "a": pa.array(cols[2], pa.int64()),
                         "b": pa.array(cols[3], pa.int64()), "log": pa.array(cols[4], pa.float64())})

    tops = packs.groupBy("kind", "bucket").applyInArrow(top, "kind int, node long, a long, b long, log double")
    tops = tops.groupBy("kind", "node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("log").alias("log"))
    got = tops.toArrow()  # at most 256 x 255 + 1 rows
    is_node = got["kind"].to_numpy() == NODE
    node, a, b, log = (got[c].to_numpy()[is_node] for c in ("node", "a", "b", "log"))
    order = np.argsort(node)
    levels = [_top_level(node[order].astype(np.uint64), a[order], b[order])]
    levels[0].mix(log[order])
    at, back = np.unique(levels[0].parents(), return_inverse=True)
    root = _top_level(at, *(np.bincount(back, x, len(at)).astype(np.int64) for x in (levels[0].zeros, levels[0].ones)))
    root.mix(np.bincount(back, levels[0].mixed, len(at)))
    crown = docs.sparkSession.sparkContext.broadcast([root, levels[0]])
    known = [(int(x), int(y)) for x, y in zip(got["a"].to_numpy()[~is_node], got["b"].to_numpy()[~is_node])]
    vocabulary, words = known[0] if known else (0, 0)
    ends = rows.where("not held_out").count()
    n_train, v_train = words + ends, vocabulary + (ends > 0)

    def answer(table: pa.Table) -> pa.Table:
        """The value of every key that a block has, to be sent back to it."""
        kind, ks, keys, n = unpacked(table)
        if kind == GRAM:
            below = tree(keys, n, TOP)
            value = log10_probability(keys, [*crown.value, *(below[d] for d in range(TOP, DEPTH + 1))]).astype(np.float32)
        else:
            value = n.astype(np.uint32)
        back = [squeezed(value[np.searchsorted(keys, k)]) for k in ks]
        return pa.table({"kind": table["kind"], "block": table["block"], "keys": table["keys"], "vals": pa.array(back, pa.binary())})

    answers = packs.groupBy("kind", "bucket").applyInArrow(answer, "kind int, block long, keys binary, vals binary")
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("logs", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())])

    def work(texts: pa.Table, values: pa.Table) -> pa.Table:
        finds = []
        for kind, dtype in ((GRAM, np.float32), (WORD, np.uint32)):
            part = values.filter(pa.array(values["kind"].to_numpy() == kind))
            k = np.concatenate([np.zeros(0, np.uint64), *(spread(x, np.uint64, True) for x in part["keys"].to_pylist())])
            v = np.concatenate([np.zeros(0, dtype), *(spread(x, dtype) for x in part["vals"].to_pylist())])
            u, first = np.unique(k, return_index=True)
            finds.append(Lookup(u, v[first]))
        out = []
        for b in arrow_rows(texts.to_batches(), 4096, CHUNK):
            raw = [x.lower() for x in b.column("raw").to_pylist()]
            code, begin = grams(raw)
            total = np.add.reduceat(finds[0](code).astype(np.float64), begin[:-1])
            w = Words(raw)
            c = finds[1](w.hash).astype(np.int64)
            run = np.concatenate([[0.0], np.cumsum(np.log10(c + 1.0))])
            seen = np.concatenate([[0], np.cumsum(c > 0)])
            n = np.diff(w.first)
            out.append(pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(n + 1), pa.array(seen[w.first[1:]] - seen[w.first[:-1]] + (ends > 0)),
                 pa.array(run[w.first[1:]] - run[w.first[:-1]] + np.log10(ends + 1.0)), pa.array(total), pa.array(np.array([len(x) + 1 for x in raw], np.int64))],
                schema=schema))
        return pa.Table.from_batches(out, schema)

    got = rows.select("block", "doc_id", "raw", "held_out").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        work, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, n_bytes long")
    base = F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(n_train + v_train + 1)))
    return got.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
                      (-F.col("score") / float(np.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"))


def _top_level(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> Level:
    """A level from its nodes' counts."""
    level = Level(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    level.node, level.zeros, level.ones = node, zeros, ones
    level.kt = log_kt(zeros, ones)
    level.one = (ones + 0.5) / (zeros + ones + 1)
    level.mixed, level.weight = level.kt, np.ones(len(node))
    return level
