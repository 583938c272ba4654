"""Document fingerprints: threshold-scaled sketches of word shingles (DataFrame functions only).

A sketch retains every distinct shingle hash below a fixed fraction of the hash space.  Sketches of parts
merge by union, and the shared hashes of two sketches estimate how far one document contains the other,
however unequal their lengths.  The exact values, from all hashes, stand beside the estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import WORD, materialize, text_of

SHINGLE = 5  #: words of a shingle
SCALE = 2  #: one of so many hashes is retained


def shingles(text: Column, shingle: int = SHINGLE) -> Column:
    """Distinct shingle hashes of a text.  Fewer words than a shingle make one; no words none."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def of(ws: Column) -> Column:
        several = F.transform(F.sequence(F.lit(0), F.size(ws) - shingle),
                              lambda i: F.xxhash64(*(F.get(ws, i + k) for k in range(shingle))))
        hashes = (F.when(F.size(ws) >= shingle, several)
                  .when(F.size(ws) > 0, F.array(F.xxhash64(F.array_join(ws, " "))))
                  .otherwise(F.array().cast("array<bigint>")))
        return F.array_distinct(hashes)

    # the word list is bound once by the lambda, not evaluated again for each use
    return F.transform(F.array(words), of)[0]


def sketch(hashes: Column, scale: int = SCALE) -> Column:
    """The hashes below the threshold, sorted."""
    top = -(1 << 63) + (1 << 64) // scale - 1
    return F.sort_array(F.filter(hashes, lambda h: h <= F.lit(top)))


def fingerprint_text(hashes: Column, text: Column) -> Column:
    """A digest of the whole text and the retained hashes, as one string."""
    return F.concat(F.md5(text.cast("binary")), F.lit(":"), F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ","))


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Jaccard similarity of two sets of hashes; 1 for equal texts, 0 where either text has no word."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(same, 1.0).when(union > 0, shared / F.greatest(union, F.lit(1))).otherwise(0.0)


def containment(a: Column, b: Column, same: Column) -> Column:
    """The part of a's hashes that b has; 1 for equal texts, 0 where a has no word."""
    return F.when(same, 1.0).when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1))).otherwise(0.0)


def parse(fingerprint: Column) -> Column:
    """The retained hashes (hexadecimal) of a fingerprint as fingerprint_text writes it."""
    return F.filter(F.split(F.substring_index(fingerprint, ":", -1), ","), lambda h: h != "")


def merge(a: Column, b: Column) -> Column:
    """The sketch of two parts together, from their sketches."""
    return F.sort_array(F.array_union(a, b))


def next_ids(ids: DataFrame) -> DataFrame:
    """``doc_id, next_id``: the next distinct id in descending order; after the last the first.

    Ids are dealt in ranges, ordered within each, and the ranges' ends are linked over one row per range.
    """
    parts = max(1, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = materialize(ids.select("doc_id").distinct().repartitionByRange(parts, "doc_id").withColumn("__p", F.spark_partition_id()))
    ends = ranged.groupBy("__p").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    line = Window.orderBy("lo")
    ends = ends.select(F.col("__p"), F.coalesce(F.lag("hi").over(line), F.max("hi").over(Window.partitionBy())).alias("__wrap"))
    w = Window.partitionBy("__p").orderBy("doc_id")
    before = ranged.withColumn("__l", F.lag("doc_id").over(w))
    return before.join(F.broadcast(ends), "__p").select("doc_id", F.coalesce("__l", "__wrap").alias("next_id"))


def fingerprints(docs: DataFrame, scale: int = SCALE, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprint every text and its edited text (its last third replaced by the next document's beginning).

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    in_edited, in_next`` and ``exact_`` forms of the last four.  The near columns are Jaccard similarities, the in
    columns containments, both of the retained hashes; the exact ones of all.  Texts that retain no hash are alike
    only if equal.  Null text counts as empty.  Rows of equal doc_id are kept, and as a next document they count by
    their smallest text; a row of null doc_id has no place in the order and is its own next, as the only document
    is; an empty table gives none; other columns are ignored.
    """
    # a long stays as it is: under a name of its own the plan would shuffle the texts once more
    ident = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    base = docs.select(ident, text_of().alias("text"))
    known, alone = base.where(F.col("doc_id").isNotNull()), base.where(F.col("doc_id").isNull())
    wanted = next_ids(known).select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"))
    # the next text travels, not its hashes: they are more bytes, and no easier to make
    given = known.join(wanted, "doc_id").groupBy("for_id").agg(F.min("text").alias("nx"))
    both = known.join(given, known["doc_id"] == given["for_id"]).drop("for_id").unionByName(alone.withColumn("nx", F.col("text")))
    n = F.char_length("text")
    both = both.withColumn("edited", F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 3) as int))"),
                                              F.expr("left(nx, cast(floor(char_length(text) / 3) as int))")))
    both = both.withColumns({"h": shingles(F.col("text"), shingle), "eh": shingles(F.col("edited"), shingle), "nh": shingles(F.col("nx"), shingle)})
    both = both.withColumns({"s" + c: sketch(F.col(c), scale) for c in ("h", "eh", "nh")})
    text, edited, h = F.col("text"), F.col("edited"), F.col("h")
    pairs = {"edited": (F.col("eh"), text == edited), "next": (F.col("nh"), text == F.col("nx"))}
    kept = {"edited": F.col("seh"), "next": F.col("snh")}
    return both.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("sh"), text).alias("fingerprint"), fingerprint_text(F.col("seh"), edited).alias("edited_fingerprint"),
        *(likeness(F.col("sh"), kept[k], same).alias(f"near_{k}") for k, (_, same) in pairs.items()),
        *(containment(F.col("sh"), kept[k], same).alias(f"in_{k}") for k, (_, same) in pairs.items()),
        *(likeness(h, other, same).alias(f"exact_near_{k}") for k, (other, same) in pairs.items()),
        *(containment(h, other, same).alias(f"exact_in_{k}") for k, (other, same) in pairs.items()))
