import math

from pyspark.sql import functions as F

from flowguard.functions.labels import normalize_label, short_day
from flowguard.operators import clean


def py_normalize(s):
    s = "nan" if s is None else str(s)
    return s.strip().replace("  ", " ").replace("-", " ").title()


LABELS = ["  BENIGN", "FTP-Patator", "a - b", "x  y", "o'neil 3abc", "\tDoS Hulk\t",
          "Web Attack \x96 Brute Force", None, "web attack  xss", "ÉCOLE-été"]


def test_normalize_label_matches_python(spark):
    df = spark.createDataFrame([(x,) for x in LABELS], "l string")
    got = [r[0] for r in df.select(normalize_label("l")).collect()]
    assert got == [py_normalize(x) for x in LABELS]
    assert got[2] == "A   B"          # one pass of double-space, then hyphen
    assert got[4] == "O'Neil 3Abc"    # title(), not initcap
    assert got[7] == "Nan"


def test_short_day(spark):
    df = spark.createDataFrame([("Monday-WorkingHours.pcap_ISCX.csv",)], "d string")
    assert df.select(short_day("d")).first()[0] == "Monday-"


def test_duplicates_null_nan_negzero(spark):
    rows = [(1.0, None, "D1"), (1.0, None, "D1"), (float("nan"), 2.0, "D1"), (float("nan"), 2.0, "D1"),
            (0.0, 3.0, "D1"), (-0.0, 3.0, "D1"), (5.0, 5.0, "D1"), (5.0, 5.0, "D2")]
    df = spark.createDataFrame(rows, "a double, b double, Day string")
    st = clean.duplicate_stats(df).first()
    assert (st["rows"], st["duplicates"]) == (8, 3)
    assert clean.drop_duplicates(df).count() == 5
    assert clean.drop_duplicates(df, ["a", "b"]).count() == 4


def test_faults(spark):
    rows = [(-1.0, "1"), (float("-inf"), " 12 "), (float("inf"), "abc"), (None, "Infinity"), (2.0, "-3")]
    df = spark.createDataFrame(rows, "`Flow Duration` double, `Total Fwd Packets` string")
    c = clean.coerce_numeric(df)
    assert [r[0] for r in c.select("`Total Fwd Packets`").collect()] == [1.0, 12.0, None, math.inf, -3.0]
    neg = {r["column"]: r["negatives"] for r in clean.negative_counts(c).collect()}
    assert neg == {"Flow Duration": 2, "Total Fwd Packets": 1}   # -inf counts as negative
    v = clean.null_if_negative_cols(c)
    inf = {r["column"]: r["infinities"] for r in clean.infinite_counts(v).collect()}
    assert inf == {"Flow Duration": 1, "Total Fwd Packets": 1}
    done = clean.null_if_infinite_cols(v)
    nulls = {r["column"]: r["nulls"] for r in clean.null_counts(done).collect()}
    assert nulls == {"Flow Duration": 4, "Total Fwd Packets": 3}


def test_value_counts_and_mapping(spark):
    df = spark.createDataFrame([("BENIGN ",), ("BENIGN ",), ("FTP-Patator",), (" ftp patator",)], "Label string")
    m = {r["raw"]: r["normalized"] for r in clean.label_mapping(df).collect()}
    assert m == {"BENIGN ": "Benign", "FTP-Patator": "Ftp Patator", " ftp patator": "Ftp Patator"}
    vc = clean.value_counts(clean.with_normalized_label(df)).collect()
    assert [(r["label"], r["count"], r["pct"]) for r in vc] == [("Benign", 2, 50.0), ("Ftp Patator", 2, 50.0)]
