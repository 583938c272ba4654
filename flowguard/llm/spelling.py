"""Spelling variants: k-d trees over letter-count vectors, box-pruned range searches per length pair.

One inserted, deleted or replaced letter changes a word's letter counts by an L1 distance of at most two, and
its length by at most one.  Words of each length are dealt to the leaves of a k-d tree; a word is sent only to
those leaves of its own and the two neighbouring lengths whose box lies within that distance.  A leaf's words
are cut into smaller boxes in the task, pruned again, and letter order decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import arrow_rows, bounded_batches, broadcast_if_small, materialize, text_of

RUN = r"[A-Za-zÀ-ÿ]+"  #: a word before case folding
LEAST_CHARS, LEAST_COUNT = 7, 2  #: of a word that takes part
DROP = 31  #: one of so many (document, word) pairs loses a letter
FACTOR = 10  #: a form is so many times as frequent as its variant
DIMS = 32  #: letter counts: a to z, and the other letters in six classes (folding never adds distance)
LEAF = 8192  #: words of a tree's leaf on average
MAX_LEAVES = 16384  #: leaves of all trees: their boxes are broadcast (1 MB); beyond, leaves grow and are compared in blocks
SAMPLE = 200_000  #: words that the trees are built on at most (by hash); every word is indexed
BUCKET = 16  #: words of a box inside a task
FAN = 8  #: boxes of a box, where there are many
BLOCK_BYTES = 1 << 20  #: letters of a block of words that meet
GROUP_BYTES = 1 << 20  #: letters of a task's group of blocks
SLICE = 4 << 20  #: characters of a text taken at a time

_UPPER = bytes(range(65, 91))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def runs(text: str) -> Iterator[str]:
    """The maximal runs of a text, A to Z lower-cased; a long text goes in slices that end between runs."""
    word, at = re.compile(RUN), 0
    while at < len(text):
        end = at + SLICE
        if end < len(text) and (m := word.match(text, end - 1)):  # a run that crosses the cut belongs to this slice
            end = m.end()
        yield from word.findall(text[at:end].encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass"))
        at = end


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of all texts after deletions, with their occurrences.

    Each batch is counted before the shuffle, so a frequent word is one row per batch.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), text_of().alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for b in arrow_rows(batches):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                start = zlib.crc32(f"{i}:".encode())
                for w, n in Counter(runs(t)).items():
                    if len(w) < LEAST_CHARS:
                        continue
                    h = zlib.crc32(w.encode(), start)
                    if h % DROP == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1:]
                        if len(w) < LEAST_CHARS:
                            continue
                    total[w] += n
            if len(total) > 200_000:
                yield pa.RecordBatch.from_pydict({"word": list(total), "n": list(total.values())})
                total.clear()
        if total:
            yield pa.RecordBatch.from_pydict({"word": list(total), "n": list(total.values())})

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters of the words in a row, and where each word begins (one more place than words)."""
    begin = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32), begin


def vectors(words: list[str]) -> np.ndarray:
    """Letter counts, words x DIMS; a count stops at 255, which never adds distance."""
    at, begin = letters(words)
    low = (at >= 97) & (at <= 122)
    dim = np.where(low, at.astype(np.int64) - 97, 26 + at.astype(np.int64) % (DIMS - 26))
    who = np.repeat(np.arange(len(words)), np.diff(begin))
    return np.minimum(np.bincount(who * DIMS + dim, minlength=len(words) * DIMS), 255).reshape(len(words), DIMS).astype(np.uint8)


class Tree:
    """A k-d tree over letter counts: inner nodes cut one dimension, leaves are numbered."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.dim, self.cut, self.child, self.leaves = [], [], [], 0
        self._grow(sample, max(1, leaves))
        self.dim, self.cut, self.child = np.array(self.dim), np.array(self.cut), np.array(self.child).reshape(-1, 2)

    def _grow(self, x: np.ndarray, leaves: int) -> int:
        """The node's number, or -1 - the leaf's."""
        d, c = median_cut(x) if leaves > 1 else (-1, 0)
        if d < 0:
            self.leaves += 1
            return -self.leaves
        node = len(self.dim)
        self.dim.append(d), self.cut.append(c), self.child.append([0, 0])
        low = x[:, d] <= c
        here = min(leaves - 1, max(1, round(leaves * low.mean())))
        self.child[node] = [self._grow(x[low], here), self._grow(x[~low], leaves - here)]
        return node

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.full(len(x), 0 if len(self.dim) else -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            at[inner] = self.child[node, (x[inner, self.dim[node]] > self.cut[node]).astype(int)]
        return -1 - at


def median_cut(x: np.ndarray) -> tuple[int, int]:
    """The dimension and value that cut the rows best in half (greater values go right); -1 if all rows are equal."""
    if not len(x) or (x == x[0]).all():
        return -1, 0
    best = (-1.0, -1, 0)
    for d in np.argsort(-x.astype(np.float32).var(0), kind="stable")[:4]:  # the most spread ones
        n = np.cumsum(np.bincount(x[:, d], minlength=2))
        c = int(np.abs(n[:-1] * 2 - len(x)).argmin())
        best = max(best, (float(min(n[c], len(x) - n[c])), int(d), c))
    return best[1], best[2]


def codes(x: np.ndarray) -> np.ndarray:
    """Letter counts as 64 bits: for each letter whether it occurs, and whether twice or more.

    The bits in which two codes differ are the L1 distance of the counts cut at two, which is at most that of
    the counts; ``and`` and ``or`` of codes are the corners of their box.
    """
    return np.packbits(np.concatenate([x > 0, x > 1], 1), axis=1).view(np.uint64).ravel()


def reached(x: np.ndarray, low: np.ndarray, high: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (vector, box) of codes whose L1 distance is at most the radius; boxes lie in a tree's order.

    Many boxes are first met as boxes around FAN neighbours, level by level.
    """
    found = []
    if len(low) > 4 * FAN:
        cut = np.arange(0, len(low), FAN)
        i, j = reached(x, np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut), radius)
        for at in range(0, len(i), 1 << 13):  # bounded pieces
            u, v = i[at:at + (1 << 13), None], j[at:at + (1 << 13), None] * FAN + np.arange(FAN)
            there = np.minimum(v, len(low) - 1)
            near_ = (np.bitwise_count((low[there] & ~x[u]) | (x[u] & ~high[there])) <= radius) & (v < len(low))
            k, box = np.nonzero(near_)
            found.append((u[k, 0], v[k, box]))
    else:
        step = max(1, (1 << 16) // max(1, len(low)))
        for at in range(0, len(x), step):
            v = x[at:at + step, None]
            k, box = np.nonzero(np.bitwise_count((low & ~v) | (v & ~high)) <= radius)
            found.append((k + at, box))
    return tuple(np.concatenate([np.zeros(0, int), *c]) for c in zip(*found)) if found else (np.zeros(0, int),) * 2


def grid(words: list[str]) -> np.ndarray:
    """The letters of words of one length, a row per word."""
    return letters(words)[0].reshape(len(words), -1)


def one_edit(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows (x[i], y[j]) differ by exactly one inserted, deleted or replaced letter.

    The words of x have one length, those of y one that differs by at most one.
    """
    if x.shape[1] > y.shape[1]:
        return one_edit(y, x, j, i)
    n, out = x.shape[1], np.zeros(len(i), bool)
    step = max(1, (1 << 22) // n)
    for at in range(0, len(i), step):
        p, q = x[i[at:at + step]], y[j[at:at + step]]
        straight = p == q[:, :n]
        if q.shape[1] == n:
            out[at:at + step] = (~straight).sum(1) == 1
        else:  # equal up to some place, and from there on shifted by one
            first = np.where(straight.all(1), n, straight.argmin(1))
            shifted = p != q[:, 1:]
            last = np.where(shifted.any(1), n - shifted[:, ::-1].argmax(1), 0)
            out[at:at + step] = last <= first
    return out


class Boxes:
    """Words of one length in the boxes of a k-d tree, BUCKET words a box."""

    def __init__(self, words: list[str]):
        y = vectors(words)
        order, cuts = [], []

        def split(rows: np.ndarray) -> None:  # a tree's leaves, in order
            d, c = median_cut(y[rows]) if len(rows) > BUCKET else (-1, 0)
            if d < 0:
                cuts.append(sum(map(len, order[-1:])) + (cuts[-1] if cuts else 0))
                order.append(rows)
            else:
                split(rows[y[rows, d] <= c])
                split(rows[y[rows, d] > c])

        split(np.arange(len(words)))
        self.row, self.cut, self.letters = np.concatenate(order), np.array(cuts), grid(words)
        self.codes = codes(y[self.row])
        self.low, self.high = np.bitwise_and.reduceat(self.codes, self.cut), np.bitwise_or.reduceat(self.codes, self.cut)
        self.size = np.diff(np.concatenate([self.cut, [len(words)]]))


def near(words: list[str], boxes: Boxes) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words, all of one length, and words of the boxes that are one edit apart."""
    left = grid(words)
    radius = 2 if left.shape[1] == boxes.letters.shape[1] else 1
    x = codes(vectors(words))
    i, box = reached(x, boxes.low, boxes.high, radius)
    size = boxes.size[box]
    found = [(np.zeros(0, int),) * 2]
    for at in np.array_split(np.arange(len(i)), max(1, int(size.sum()) >> 18)):  # bounded pieces
        n = size[at]
        u = np.repeat(i[at], n)
        v = np.repeat(boxes.cut[box[at]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        close = np.bitwise_count(x[u] ^ boxes.codes[v]) <= radius
        u, v = u[close], boxes.row[v[close]]
        good = one_edit(left, boxes.letters, u, v)
        found.append((u[good], v[good]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _trees(words: DataFrame) -> dict[int, Tree]:
    """A tree per length of more words than a leaf has, built on a bounded sample on the driver."""
    sizes = words.groupBy(F.char_length("word").alias("len")).agg(F.count("*").alias("n")).where(F.col("n") > LEAF)
    rows = sizes.orderBy(F.desc("n"), "len").limit(MAX_LEAVES).collect()  # each of these has two leaves or more
    wanted = {r["len"]: -(-r["n"] // LEAF) for r in rows}
    share = min(1.0, MAX_LEAVES / max(1, sum(wanted.values())))
    kept = words.where(F.char_length("word").isin(list(wanted)[:200])) if wanted else words.limit(0)  # longer tails: one leaf each
    sample = kept.orderBy(F.xxhash64("word")).limit(SAMPLE).select("word").toArrow()["word"].to_pylist()
    by: dict[int, list[str]] = {}
    for w in sample:
        by.setdefault(len(w), []).append(w)
    return {n: Tree(vectors(w), max(1, int(wanted[n] * share))) for n, w in by.items()}


def _leaves(words: list[str], x: np.ndarray, trees: dict[int, Tree]) -> np.ndarray:
    """The home leaf of each word."""
    out, size = np.zeros(len(words), np.int32), np.array([len(w) for w in words])
    for n in np.unique(size):
        if int(n) in trees:
            at = np.flatnonzero(size == n)
            out[at] = trees[int(n)].place(x[at])
    return out


def near_words(words: DataFrame) -> DataFrame:
    """For ``word, n`` of distinct words: ``word, n_near, best_n, best`` of those with a near word.

    best is the near word of largest n (ties: smallest in code-point order).  No pair leaves its task.
    """
    spark = words.sparkSession
    bounded_batches(spark, 8192)
    shared = spark.sparkContext.broadcast(_trees(words))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                w = b.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(t) for t in w], pa.int32()),
                                                  pa.array(_leaves(w, vectors(w), shared.value))], ["word", "n", "len", "leaf"])

    homes = materialize(words.select("word", "n").mapInArrow(place, "word string, n long, len int, leaf int"))

    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = codes(vectors(b.column(0).to_pylist()))
            key = b.column(1).to_numpy().astype(np.int64) << 32 | b.column(2).to_numpy()
            order = np.argsort(key, kind="stable")
            cut = np.flatnonzero(np.diff(key[order], prepend=-1))
            x, key = x[order], key[order][cut]
            ends = [f.reduceat(x, cut).view(np.int64) for f in (np.bitwise_and, np.bitwise_or)]
            n = np.diff(np.concatenate([cut, [len(order)]]))
            yield pa.RecordBatch.from_arrays([pa.array((key >> 32).astype(np.int32)), pa.array(key.astype(np.int32)), pa.array(n), *map(pa.array, ends)],
                                             ["len", "leaf", "n", "low", "high"])

    parts = homes.select("word", "len", "leaf").mapInArrow(box, "len int, leaf int, n long, low long, high long")
    boxes = materialize(parts.groupBy("len", "leaf").agg(F.sum("n").alias("n"), F.bit_and("low").alias("low"), F.bit_or("high").alias("high")))
    # leaves of trees are at most MAX_LEAVES; a length without a tree is one leaf, known by its length alone
    treed = boxes.where(F.col("leaf") > 0).select("len").distinct()
    table = boxes.join(treed, "len", "left_semi").toPandas()
    wide: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for n, rows in table.groupby("len"):
        rows = rows.sort_values("leaf")  # leaves are numbered in a tree's order
        wide[int(n)] = (rows["leaf"].to_numpy(np.int32), *(rows[c].to_numpy(np.int64).view(np.uint64) for c in ("low", "high")))
    known = spark.sparkContext.broadcast(wide)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            w = b.column(0).to_pylist()
            x, size = codes(vectors(w)), b.column(2).to_numpy()
            leaves, parts = b.column(3).to_numpy(), []
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                for m in (int(n), int(n) + 1):  # the shorter word of a pair asks, of equal lengths that of the lesser leaf
                    if m in known.value:
                        number, low, high = known.value[m]
                        i, j = reached(x[at], low, high, 2 if m == n else 1)
                        i, leaf = at[i], number[j]
                    else:
                        i, leaf = at, np.zeros(len(at), np.int32)
                    if m == n:
                        i, leaf = i[leaf >= leaves[i]], leaf[leaf >= leaves[i]]
                    parts.append((i, np.full(len(i), m, np.int32), leaf, (leaf == leaves[i]) & (m == n)))
            who, length, leaf, home = (np.concatenate(c) for c in zip(*parts))
            asks = pa.RecordBatch.from_arrays([b.column(0).take(pa.array(who)), b.column(1).take(pa.array(who)), pa.array(length),
                                               pa.array(leaf), pa.array(home)], ["word", "n", "len", "leaf", "home"])
            yield from (asks.slice(k, 8192) for k in range(0, asks.num_rows, 8192))

    # only leaves that exist are asked
    there = broadcast_if_small(boxes.select("len", "leaf"), 24)
    asks = materialize(homes.mapInArrow(ask, "word string, n long, len int, leaf int, home boolean").join(there, ["len", "leaf"], "left_semi"))
    blocks = lambda df, name: df.groupBy("len", "leaf").agg(
        F.greatest(F.lit(1), F.ceil(F.sum(F.char_length("word") + 16) / BLOCK_BYTES)).cast("int").alias(name), F.sum(F.char_length("word")).alias(name + "_b"))
    sizes = broadcast_if_small(blocks(homes, "ni").join(blocks(asks, "nq"), ["len", "leaf"]), 48)
    total = sizes.agg(F.sum(F.col("ni_b") * F.col("nq") + F.col("nq_b") * F.col("ni"))).first()[0] or 0
    groups = max(1, -(-int(total) // GROUP_BYTES))
    h = F.xxhash64("word")
    items = (homes.join(sizes, ["len", "leaf"]).select("word", "n", "len", "leaf", F.pmod(h, "ni").cast("int").alias("ib"),
                                                       F.explode(F.expr("sequence(0, nq - 1)")).alias("qb"), F.lit(False).alias("home"), F.lit(True).alias("item")))
    asked = (asks.join(sizes, ["len", "leaf"]).select("word", "n", "len", "leaf", F.explode(F.expr("sequence(0, ni - 1)")).alias("ib"),
                                                      F.pmod(h, "nq").cast("int").alias("qb"), "home", F.lit(False).alias("item")))
    both = items.unionByName(asked).withColumn("g", F.pmod(F.xxhash64("len", "leaf", "ib", "qb"), F.lit(groups)))

    def work(table: pa.Table) -> pa.Table:
        word, n, item, home = (table[c].to_numpy(zero_copy_only=False) for c in ("word", "n", "item", "home"))
        what = np.stack([table[c].to_numpy() for c in ("len", "leaf", "ib", "qb")], 1)
        size = np.array([len(w) for w in word])
        order = np.lexsort(what.T)
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(what[order], axis=0) != 0).any(1)]))
        best: dict[str, list] = {}  # word: number of near words, the best one

        def meet(mine: str, count: int, other: str) -> None:
            new = (-count, other)
            if (old := best.get(mine)) is None:
                best[mine] = [1, new]
            else:
                old[0] += 1
                old[1] = min(old[1], new)

        for rows in np.split(order, cut[1:]):
            i, asking = rows[item[rows]], rows[~item[rows]]
            if not len(i):
                continue
            others = word[i].tolist()
            boxes = Boxes(others)
            for m in np.unique(size[asking]):
                q = asking[size[asking] == m]
                words = word[q].tolist()
                u, v = near(words, boxes)
                nq, ni, once = n[q], n[i], home[q]
                for a, c in zip(u.tolist(), v.tolist()):
                    if not once[a] or words[a] < others[c]:  # within its own leaf a pair is met from both ends
                        meet(words[a], int(ni[c]), others[c])
                        meet(others[c], int(nq[a]), words[a])
        out = [(w, k, -m, form) for w, (k, (m, form)) in best.items()]
        out = dict(zip(("word", "n_near", "best_n", "best"), zip(*out))) if out else dict.fromkeys(("word", "n_near", "best_n", "best"), ())
        return pa.table({"word": pa.array(out["word"], pa.string()), "n_near": pa.array(out["n_near"], pa.int64()),
                         "best_n": pa.array(out["best_n"], pa.int64()), "best": pa.array(out["best"], pa.string())})

    found = both.groupBy("g").applyInArrow(work, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: forms followed to the last, by doubling the steps.

    Counts grow by a factor along a chain, so it has no cycle and few rounds suffice.
    """
    steps = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        more = steps.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        after = materialize(steps.join(more, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")))
        steps = after.drop("moved")
        if not after.where("moved").limit(1).count():
            return steps


def variants(docs: DataFrame) -> DataFrame:
    """Words of all documents with their spelling variants: ``word, form, root, n, n_near, form_n``.

    A word has LEAST_CHARS letters and LEAST_COUNT occurrences at least.  Null texts count as empty, a null doc_id
    as an empty text in the deletion rule; repeated rows count each time; texts of any length are taken whole; an
    empty table, or one without such words, gives none; other columns are ignored.  Ties for the form: the
    smallest word in code-point order.
    """
    words = materialize(word_counts(docs).where(F.col("n") >= LEAST_COUNT))
    found = near_words(words)
    all_ = materialize(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.expr(f"if(best_n >= {FACTOR} * n, best, null)").alias("form"), F.expr(f"if(best_n >= {FACTOR} * n, best_n, null)").alias("form_n")))
    last = roots(all_.where("form is not null").select("word", "form"))
    return all_.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
