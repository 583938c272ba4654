"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts cover every labelled text; the log-probability matrix (buckets x languages) is broadcast in
groups of a bounded number of languages, and whole batches of texts are scored with numpy gathers and segment
sums; what the groups find is merged by best score and log-sum.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import arrow_rows, bounded_batches, crc_remainder, materialize, text_of
from flowguard.session import bounded_rows

BITS = 16  #: n-grams hash into 2 ** BITS buckets
ORDERS = (1, 2, 3)  #: code points of an n-gram
ALPHA = 0.5  #: added to every count
GROUP_LANGS = 100  #: languages of a group: its matrix is broadcast (2 ** 16 x 100 floats are 26 MB)
CHAINED = 4  #: groups scored in one stage
ALL_LANGS = 100_000  #: names of languages on the driver at most
UNKNOWN = "und"
_LETTERLIKE = re.compile(r"[^\W\d_]")  # letters, and numerals that are no digits
_SLICE = 1 << 20


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, one row per order, and where each text begins.

    Each lower-cased text stands after two NULs, so that no n-gram holds characters of two texts.
    """
    parts = [np.frombuffer(("\0\0" + t.lower()).encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]]).astype(np.int64)
    a = np.concatenate([*parts, np.zeros(max(ORDERS) - 1, np.uint32)])
    n = len(a) - max(ORDERS) + 1
    out, h = np.empty((len(ORDERS), n), np.uint16 if BITS <= 16 else np.uint32), np.zeros(n, np.uint32)
    for k in range(max(ORDERS)):
        h = (h ^ a[k:k + n]) * np.uint32(0x9E3779B1) + np.uint32(k + 1)
        h ^= h >> np.uint32(15)
        if k + 1 in ORDERS:
            out[ORDERS.index(k + 1)] = (h * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)
    return out, starts


def has_letter(text: str | None) -> bool:
    """Whether a text has a character of a letter category (L), which numerals such as the Roman ones are not."""
    return bool(text) and any(m.group().isalpha() for m in _LETTERLIKE.finditer(text))


class Model:
    """A group of languages in code-point order and the matrix of log probabilities, buckets x languages."""

    def __init__(self, langs: list[str], counts: np.ndarray, docs: np.ndarray, total: float | None = None):
        self.langs = langs
        p = counts.T.astype(np.float64) + ALPHA
        self.matrix = np.ascontiguousarray(np.log(p / p.sum(0)), dtype=np.float32)
        self.prior = np.log(docs / (docs.sum() if total is None else total))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log probabilities (up to a constant of the text), texts x languages."""
        if not texts:
            return np.zeros((0, len(self.langs)))
        grams, starts = ngram_buckets(texts)
        out = np.tile(self.prior, (len(texts), 1))
        step = max(1, _SLICE * 4 // max(1, len(self.langs)))
        for at in range(0, grams.shape[1], step):
            end = min(at + step, grams.shape[1])
            first = int(np.searchsorted(starts, at, "right")) - 1
            last = int(np.searchsorted(starts, end, "left"))
            cut = np.maximum(starts[first:last], at) - at
            for row in grams:
                out[first:last] += np.add.reduceat(self.matrix[row[at:end]], cut, axis=0, dtype=np.float64)
        return out

    def best(self, texts: list[str | None]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """The best language of the group, its log probability and the log of the sum of all; null for null texts and
        texts without a letter."""
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        lang, top, total = [None] * len(texts), np.full(len(texts), -np.inf), np.full(len(texts), -np.inf)
        if known:
            s = self.scores([texts[i] for i in known])
            most = s.max(1)
            top[known], total[known] = most, most + np.log(np.exp(s - most[:, None]).sum(1))
            for i, k in zip(known, s.argmax(1)):
                lang[i] = self.langs[k]
        return lang, top, total


class Models:
    """All languages, in groups in code-point order."""

    def __init__(self, groups: list[Model]):
        self.groups = groups
        self.langs = [k for g in groups for k in g.langs]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", group: int = GROUP_LANGS) -> Models:
    """Learn from all rows with a language; null texts count as empty.  No labelled row gives an empty model."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flush():
            for k, v in sums.items():
                at = np.flatnonzero(v)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(v[at])],
                                                 ["lang", "bucket", "n"])
            sums.clear()

        for b in arrow_rows(batches, 512, 1 << 20):
            by: dict[str, list[str]] = {}
            for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(k, []).append(t)
            for k, texts in by.items():
                grams, _ = ngram_buckets(texts)
                v = sums.setdefault(k, np.zeros((1 << BITS) + 1, np.int64))
                for row in grams:
                    v[:-1] += np.bincount(row, minlength=1 << BITS)
                v[-1] += len(texts)  # the last place counts documents
            if len(sums) > 64:
                yield from flush()
        yield from flush()

    rows = docs.where(F.col(lang).isNotNull()).select(text_of(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    parts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    spark = docs.sparkSession
    parts = parts.checkpoint()
    sizes = {r["lang"]: r["n"] for r in bounded_rows(parts.where(F.col("bucket") == 1 << BITS).select("lang", "n"), ALL_LANGS, "languages")}
    langs, total, groups = sorted(sizes), max(1e-9, sum(sizes.values())), []
    for at in range(0, len(langs), group):
        here = langs[at:at + group]
        counts = np.zeros((len(here), (1 << BITS) + 1), np.int64)
        place = {k: i for i, k in enumerate(here)}
        got = parts.where(F.col("lang").between(here[0], here[-1])).toArrow()  # at most group x 2 ** BITS rows
        names = got["lang"].combine_chunks().dictionary_encode()
        codes = np.array([place[x] for x in names.dictionary.to_pylist()], np.int64)
        counts[codes[names.indices.to_numpy()], got["bucket"].to_numpy()] = got["n"].to_numpy()
        groups.append(Model(here, counts[:, :-1], np.maximum(counts[:, -1], 1e-9), total))
    return Models(groups)


def predict(docs: DataFrame, models: Models, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred, score`` to the kept columns (all by default); same-named columns are replaced.

    Null, empty and letterless texts give ``und`` and 0, and so do all without a learnt language; ties go to the first
    language in code-point order; repeated rows stay; an empty table gives none.
    """
    bounded_batches(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    out = docs.select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)), F.col(text).alias("__text"),
                      F.lit(None).cast("string").alias("__lang"), F.lit(float("-inf")).alias("__top"), F.lit(float("-inf")).alias("__all"))

    def better(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in arrow_rows(batches, 512, 1 << 20):
                n = b.num_columns
                lang, top, every = model.value.best(b.column(n - 4).to_pylist())
                old, best, total = (b.column(n - k).to_pylist() if k == 3 else b.column(n - k).to_numpy() for k in (3, 2, 1))
                first = best >= top  # earlier groups have the smaller names
                lang = [o if f else new for o, f, new in zip(old, first, lang)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-3], pa.array(lang, pa.string()), pa.array(np.maximum(best, top)),
                                                  pa.array(np.logaddexp(total, every))], b.schema.names)
        return run

    for i, model in enumerate(models.groups):
        if i and i % CHAINED == 0:  # not too many Python workers in one task
            out = materialize(out)
        out = out.mapInArrow(better(docs.sparkSession.sparkContext.broadcast(model)), out.schema)
    sure = F.least(F.lit(1.0), F.exp(F.col("__top") - F.col("__all")))
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), F.coalesce("__lang", F.lit(UNKNOWN)).alias("lang_pred"),
                      F.when(F.col("__lang").isNull(), 0.0).otherwise(sure).alias("score"))


def identify(docs: DataFrame, mod: int = 4, held: int = 2) -> DataFrame:
    """Predict every document's language from a model learnt off the rows whose crc32(doc_id) mod ``mod`` is not ``held``."""
    rows = docs.select("doc_id", "text", "lang", (crc_remainder("doc_id", mod) == held).alias("held_out"))
    model = train(rows.where("not held_out"))
    return predict(rows, model, keep=["doc_id", "held_out"])
