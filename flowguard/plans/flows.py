"""The flow workflow as lazy DataFrame stages (each a function of the previous).

raw -> normalized labels -> deduplicated -> validated -> encoded -> split ->
filled (train medians) -> selected features -> scaled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.operators import clean, encode, profile, sampling
from flowguard.plans.fixtures import DAY, KEY, LABEL, SEED, flows_raw
from flowguard.session import bounded_rows, materialize, small_table


def normalized(spark: SparkSession, sf: str) -> DataFrame:
    return clean.with_normalized_label(flows_raw(spark, sf), LABEL)


def deduped(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_duplicates(normalized(spark, sf))


def validated(spark: SparkSession, sf: str) -> DataFrame:
    return clean.validate(deduped(spark, sf))


def mapping(spark: SparkSession, sf: str) -> DataFrame:
    return encode.class_mapping(validated(spark, sf), LABEL)


def encoded(spark: SparkSession, sf: str, clean_df: DataFrame | None = None,
            mapping_df: DataFrame | None = None) -> DataFrame:
    v = clean_df if clean_df is not None else validated(spark, sf)
    m = mapping_df if mapping_df is not None else encode.class_mapping(v, LABEL)
    e = encode.encode_labels(v, m, LABEL)
    return encode.features(e, exclude=(LABEL, DAY, KEY, "label_id"), keep=(KEY, "label_id"))


def split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_split(encoded(spark, sf), "label_id", 0.2, SEED, key=[KEY])


@dataclass
class Prepared:
    """Train/test after median fill and feature selection (P2 output)."""
    train: DataFrame
    test: DataFrame
    mapping: DataFrame
    features: list[str]
    removed: DataFrame
    medians: DataFrame


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (KEY, "label_id", "split")]


def filled(spark: SparkSession, sf: str):
    """(split table, medians, filled train, filled test)."""
    s = split(spark, sf)
    feats = feature_names(s)
    train = s.filter(F.col("split") == "train").drop("split")
    test = s.filter(F.col("split") == "test").drop("split")
    med = profile.medians(train, feats)
    return s, med, profile.fill_medians(train, med), profile.fill_medians(test, med)


class Workflow:
    """All stages of one (session, data folder) run, built lazily once.

    Stage boundaries (mapping, split, the 50 % sample, medians) are reliable
    checkpoints in the shared folder: they survive executor loss, are computed
    once, and keep every later plan shallow.
    """

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._c: dict = {}

    def _get(self, key, build):
        if key not in self._c:
            self._c[key] = build()
        return self._c[key]

    @property
    def clean(self) -> DataFrame:
        """The validated rows, deduplicated once for the mapping and the split."""
        return self._get("clean", lambda: materialize(validated(self.spark, self.sf)))

    @property
    def mapping(self) -> DataFrame:
        def build():
            m = materialize(encode.class_mapping(self.clean, LABEL))
            bounded_rows(m)  # everything of one row per class stays within this
            return m
        return self._get("mapping", build)

    @property
    def split(self) -> DataFrame:
        def build():
            e = materialize(encoded(self.spark, self.sf, clean_df=self.clean, mapping_df=self.mapping))  # read several times
            return materialize(sampling.stratified_split(e, "label_id", 0.2, SEED, key=[KEY]))
        return self._get("split", build)

    @property
    def features(self) -> list[str]:
        return feature_names(self.split)

    @property
    def train(self) -> DataFrame:
        return self.split.filter(F.col("split") == "train").drop("split")

    @property
    def test(self) -> DataFrame:
        return self.split.filter(F.col("split") == "test").drop("split")

    @property
    def medians(self) -> DataFrame:
        return self._get("medians", lambda: materialize(profile.medians(self.train, self.features)))

    @property
    def train_filled(self) -> DataFrame:
        return self._get("train_f", lambda: profile.fill_medians(self.train, self.medians))

    @property
    def test_filled(self) -> DataFrame:
        return self._get("test_f", lambda: profile.fill_medians(self.test, self.medians))

    @property
    def sample50(self) -> DataFrame:
        """Stratified 50 % of train, taken before the median fill."""
        return self._get("s50", lambda: materialize(sampling.stratified_sample(
            self.train, "label_id", 0.5, SEED, key=[KEY])))

    @property
    def zero_var(self) -> DataFrame:
        return self._get("zv", lambda: materialize(profile.zero_variance(self.train_filled, self.features)))

    @property
    def after_zv(self) -> list[str]:
        gone = {r["feature"] for r in self.zero_var.collect()}
        return [f for f in self.features if f not in gone]

    @property
    def pairs(self) -> DataFrame:
        return self._get("pairs", lambda: profile.corr_pairs(self.train_filled, self.after_zv))

    @property
    def high(self) -> DataFrame:
        return profile.high_corr_pairs(self.pairs)

    @property
    def redundant(self) -> DataFrame:
        return profile.redundant_features(self.high)

    @property
    def final_features(self) -> list[str]:
        gone = {r["feature"] for r in self.redundant.collect()}
        return [f for f in self.after_zv if f not in gone]

    def with_binary(self, df: DataFrame) -> DataFrame:
        m, _ = small_table(self.mapping.select("label_id", (F.lower("label") != "benign").cast("int").alias("label_binary")))
        return df.join(m, "label_id")

    @property
    def importance(self) -> DataFrame:
        return self._get("imp", lambda: profile.corr_importance(
            self.with_binary(self.train_filled), self.final_features, "label_binary"))
