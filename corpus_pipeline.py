"""A training corpus from documents: five stages, each calling one operator of flowguard.llm.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of
documents; the last returns token digests.  run() writes each stage as Parquet in the shared folder and
reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm import language, mixing, neardup, pieces, quality
from flowguard.llm.catalog import piece_model
from flowguard.llm.common import (broadcast_if_small, crc_remainder, ensure_checkpoint_dir, materialize, scratch_path, ship_package, table,
                                  text_of)

MIN_LANGUAGE_SCORE = 0.5  #: least posterior probability of the predicted language


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a language: no letter, or no language with a posterior of a half.

    Learns from the documents with a lang whose crc32(doc_id) mod 4 is not 2; with none of these, only null
    texts and texts without a letter go.  Kept rows are unchanged, repeated ones included.
    """
    model = language.train(docs.where(crc_remainder("doc_id", 4) != 2))
    if not model.langs:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))  # the same letters as predict's
    known = language.predict(docs, model).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return known.select(docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject rows that the quality classifier finds bad.

    Each row is judged by its own text, source, language and doc_id (null ones included), whatever the others that
    share its doc_id are; equal rows share a verdict.
    """
    def part(c: str):
        return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    key = F.md5(F.concat_ws("\0", part("source"), part("lang"), part("text")).cast("binary")).alias("__key")
    judged = quality.classify(docs, table(spark, sf_dir, "labels"), keep=[key])
    bad = judged.where("not good").select(F.col("doc_id").alias("__id"), F.col("__key").alias("__sum")).distinct()
    bad = broadcast_if_small(bad, 64)
    left = docs.withColumn("__key", key)
    return left.join(bad, (F.col("__key") == F.col("__sum")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one text of each near-duplicate class, that of the smallest doc_id (null last), and one of equal rows.

    Rows are equal if doc_id (null or not) and text are; different texts of one doc_id are judged each by itself.
    """
    found = materialize(neardup.distinct_texts(docs).where("not kept or n > 1")
                        .select(F.col("doc_id").alias("__id"), F.col("key").alias("__sum"), "kept"))
    same = (F.col("__key") == F.col("__sum")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    gone, again = (broadcast_if_small(found.where(which).drop("kept"), 64) for which in ("not kept", "kept"))
    left = docs.withColumn("__key", F.md5(text_of().cast("binary"))).join(gone, same, "left_anti")
    one = left.join(again, same, "left_semi").groupBy("doc_id", "__key").agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"])).alias("__row")).select("doc_id", "__row.*")
    return left.join(again, same, "left_anti").select(docs.columns).unionByName(one.select(docs.columns))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every document as often as the mix does: rows are left out, kept or doubled."""
    mixed = mixing.mix(docs).where("__copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(docs.columns)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text and decode it again: doc_id, n_tokens and digests."""
    return pieces.encode_decode(docs, piece_model(), keep_ids=False)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing_sources", mixing_sources),
    ("sentencepiece", sentencepiece_encoding),
]

#: Naive Bayes, regression and piece encoding are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
