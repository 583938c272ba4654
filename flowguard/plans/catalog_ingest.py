"""Catalog: ingestion (A1–A7, A9) over per-day CSV files that Spark writes from
``events`` into the shared folder (padded header names, as real flow exports)."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import functions as F

from flowguard.operators import clean
from flowguard.plans import oracle as O
from flowguard.plans.catalog import SQL, register, rounded
from flowguard.plans.fixtures import DAY, flows_raw
from flowguard.session import scratch_path
from flowguard.sources import csv_flows, stage


def write_day_csvs(spark, sf):
    """flows -> one CSV folder per day (header names padded with a leading space)."""
    f = flows_raw(spark, sf)
    padded = f.select(*[F.col(clean.q(c)).alias(c if c == DAY else " " + c) for c in f.columns])
    out = scratch_path(spark, "flow-csv")
    (padded.hint("rebalance", DAY).write.partitionBy(DAY).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(out))
    return out


def day_folders(spark, base):
    """(folders, day names) of a table written by day."""
    dirs = sorted({p.rsplit("/", 1)[0] for p in csv_flows.glob_files(spark, f"{base}/{DAY}=*/*.csv")})
    return dirs, [unquote(d.rsplit("=", 1)[1]) for d in dirs]


def write_faulty_csvs(spark, sf):
    """Day CSVs as they come from different tools: even days in Latin-1, folder names with a
    space, ``NA`` and ``inf`` tokens, a comment that is not ASCII on every seventh row."""
    f = flows_raw(spark, sf)
    rate, key = F.col("`Flow Bytes/s`"), F.col("row_key")
    f = f.withColumn("Flow Bytes/s", F.when(rate.isNull(), "NA").when(rate == float("inf"), "inf").otherwise(rate.cast("string")))
    f = f.withColumn("Comment", F.when(key % 7 == 0, "d\u00e9j\u00e0 vu").when(key % 7 == 1, "N/A").otherwise("ok"))
    even = F.regexp_extract(DAY, r"(\d+)", 1).cast("int") % 2 == 0
    bases = []
    for name, charset, part in (("even days", "ISO-8859-1", f.filter(even)), ("odd days", "UTF-8", f.filter(~even))):
        base = scratch_path(spark, "flow-csv") + "/" + name
        (part.hint("rebalance", DAY).write.partitionBy(DAY).option("header", True).option("encoding", charset)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(base))
        bases.append(base)
    return bases


def load_faulty(spark, sf):
    """(flows, load log) of the faulty day CSVs and one missing file."""
    dirs, days = [], []
    for base in write_faulty_csvs(spark, sf):
        d, n = day_folders(spark, base)
        dirs, days = dirs + d, days + n
    return csv_flows.load_flows(spark, dirs + [dirs[0] + "-missing"], tag=DAY, tag_values=days + ["missing"])


@register("ingest_load_log", O.with_(O.FLOWS, """
SELECT "Day" AS file, count(*) AS rows, 'utf-8' AS encoding, CAST(NULL AS VARCHAR) AS error
FROM flows_raw GROUP BY 1
UNION ALL SELECT 'Day0-missing.csv', 0, 'none', 'FileNotFoundError'"""))
def ingest_load_log(spark, sf):
    """Per-file load log of the day CSVs, plus one expected file that is missing."""
    base = write_day_csvs(spark, sf)
    dirs, days = day_folders(spark, base)
    _, log = csv_flows.load_flows(spark, dirs + [f"{base}/{DAY}=Day0-missing.csv"],
                                  tag=DAY, tag_values=days + ["Day0-missing.csv"])
    return log


@register("ingest_merged", O.with_(O.FLOWS, "SELECT * FROM flows_raw"))
def ingest_merged(spark, sf):
    """Read back all day CSVs (inferred types, stripped headers, Day tag), union by name."""
    base = write_day_csvs(spark, sf)
    dirs, days = day_folders(spark, base)
    flows, _ = csv_flows.load_flows(spark, dirs, tag=DAY, tag_values=days)
    cols = ["row_key", DAY, "Flow Duration", "Total Fwd Packets", "Flow Bytes/s",
            "Fwd Packet Length Max", "Bwd PSH Flags", "Destination Port", "Label"]
    out = flows.select(*[F.col(clean.q(c)) for c in cols])
    return out.select(F.col("row_key").cast("bigint"), DAY,
                      F.col("`Flow Duration`").cast("double"),
                      F.col("`Total Fwd Packets`").cast("string"),
                      F.col("`Flow Bytes/s`").cast("double"),
                      F.col("`Fwd Packet Length Max`").cast("double"),
                      F.col("`Bwd PSH Flags`").cast("double"),
                      F.col("`Destination Port`").cast("double"), "Label")


EVEN_DAY = """CAST(regexp_extract("Day", '(\\d+)', 1) AS INTEGER) % 2 = 0"""


@register("ingest_faulty", O.with_(O.FLOWS, """
SELECT row_key, "Day", "Flow Bytes/s", "Label",
       CASE row_key % 7 WHEN 0 THEN 'd\u00e9j\u00e0 vu' WHEN 1 THEN NULL ELSE 'ok' END AS "Comment"
FROM flows_raw"""))
def ingest_faulty(spark, sf):
    """Latin-1 and UTF-8 days, NA and inf tokens, folders with a space: every value comes back."""
    flows, _ = load_faulty(spark, sf)
    return flows.select("row_key", DAY, "`Flow Bytes/s`", "Label", "Comment")


@register("ingest_faulty_log", O.with_(O.FLOWS, f"""
SELECT "Day" AS file, count(*) AS rows, CASE WHEN {EVEN_DAY} THEN 'latin-1' ELSE 'utf-8' END AS encoding,
       CAST(NULL AS VARCHAR) AS error
FROM flows_raw GROUP BY 1
HAVING count_if(row_key % 7 = 0) > 0 OR NOT {EVEN_DAY}
UNION ALL SELECT "Day", count(*), 'utf-8', NULL FROM flows_raw GROUP BY 1
HAVING count_if(row_key % 7 = 0) = 0 AND {EVEN_DAY}
UNION ALL SELECT 'missing', 0, 'none', 'FileNotFoundError'"""))
def ingest_faulty_log(spark, sf):
    """Load log of the faulty days: a day is Latin-1 where its bytes are no UTF-8."""
    return load_faulty(spark, sf)[1]


def latin1_files(log):
    """The rows of a load log that are encoding issues."""
    return log.filter(F.col("encoding") == csv_flows.LATIN1)


SQL["ingest_quality_summary"] = (
    SQL["clean_quality_summary"]
    .replace("CAST(0 AS BIGINT) AS encoding_issues", f"""
       (SELECT count(*) FROM (SELECT "Day" FROM flows_raw WHERE {EVEN_DAY} GROUP BY 1
                              HAVING count_if(row_key % 7 = 0) > 0)) AS encoding_issues""")
    .replace("CAST(9 AS BIGINT) AS columns", "CAST(10 AS BIGINT) AS columns"))


@register("ingest_quality_summary")
def ingest_quality_summary(spark, sf):
    """Quality summary of the loaded files; encoding issues are the files that the log has as Latin-1."""
    flows, log = load_faulty(spark, sf)
    return rounded(clean.quality_summary(clean.with_normalized_label(flows), encoding_issues=latin1_files(log)))


@register("ingest_parquet_verified", O.with_(O.FLOWS, """
SELECT count(*) AS rows, CAST(9 AS INTEGER) AS cols, true AS ok FROM flows_raw"""))
def ingest_parquet_verified(spark, sf):
    """Merged table written as Parquet (partitioned by day) and verified by re-reading."""
    path = scratch_path(spark, "merged")
    return stage.write_verified(flows_raw(spark, sf), path, partition_by=[DAY]).drop("path")


@register("ingest_contract_violations", O.with_(O.FLOWS + """,
contract AS (SELECT * FROM (VALUES (0, 'Flow Duration', 'double'), (1, 'Total Fwd Packets', 'double'),
                                   (2, 'Flow Bytes/s', 'double'), (3, 'Fwd Packet Length Max', 'double'),
                                   (4, 'Bwd PSH Flags', 'double'), (5, 'Destination Port', 'double'),
                                   (6, 'SYN Flag Count', 'double')) v(position, feature, expected)),
actual AS (SELECT * FROM (VALUES ('row_key', 'bigint'), ('Day', 'string'), ('Flow Duration', 'double'),
                                 ('Total Fwd Packets', 'string'), ('Flow Bytes/s', 'double'),
                                 ('Fwd Packet Length Max', 'double'), ('Bwd PSH Flags', 'double'),
                                 ('Destination Port', 'double'), ('Label', 'string')) v(feature, actual)),
fails AS (SELECT 'Total Fwd Packets' AS feature,
                 CAST(count_if("Total Fwd Packets" IS NOT NULL AND TRY_CAST("Total Fwd Packets" AS DOUBLE) IS NULL) AS BIGINT) AS n
          FROM flows_raw)""", """
SELECT coalesce(c.feature, a.feature) AS feature, c.position, c.expected, a.actual,
       coalesce(f.n, 0) AS rows_failing_cast,
       CASE WHEN c.expected IS NULL THEN 'extra' WHEN a.actual IS NULL THEN 'missing'
            WHEN coalesce(f.n, 0) > 0 THEN 'bad_values' ELSE 'ok' END AS status,
       (c.expected IS NULL OR (a.actual IS NOT NULL AND coalesce(f.n, 0) = 0)) AS ok
FROM contract c FULL JOIN actual a ON c.feature = a.feature
LEFT JOIN fails f ON f.feature = coalesce(c.feature, a.feature)"""))
def ingest_contract_violations(spark, sf):
    """Raw flows checked against the trained feature contract (all DOUBLE), one scan."""
    from flowguard.sources.contract import contract_violations
    contract = spark.createDataFrame(
        [(0, "Flow Duration", "double"), (1, "Total Fwd Packets", "double"), (2, "Flow Bytes/s", "double"),
         (3, "Fwd Packet Length Max", "double"), (4, "Bwd PSH Flags", "double"),
         (5, "Destination Port", "double"), (6, "SYN Flag Count", "double")],
        "position int, feature string, dtype string")
    return contract_violations(flows_raw(spark, sf), contract)


@register("ingest_stage_saved", O.with_(O.SPLIT, """
SELECT 'train' AS "table", (SELECT count(*) FROM train) AS rows, CAST(8 AS INTEGER) AS cols, true AS ok
UNION ALL SELECT 'test', (SELECT count(*) FROM test), 8, true
UNION ALL SELECT 'class_mapping', (SELECT count(*) FROM mapping), 2, true"""))
def ingest_stage_saved(spark, sf):
    """Train/test/mapping saved as Parquet stage tables and verified by re-reading."""
    from flowguard.plans.flows import Workflow
    w = Workflow(spark, sf)
    return stage.save_stage({"train": w.train, "test": w.test, "class_mapping": w.mapping},
                            scratch_path(spark, "stage"))


def _day_no():
    return F.regexp_extract(DAY, r"(\d+)", 1).cast("int")


_DAY_SQL = """CAST(regexp_extract("Day", '(\\d+)', 1) AS INTEGER)"""


def write_malformed_csvs(spark, sf):
    """Day CSVs as broken tools leave them: every fifth day has a field too many in every second row, the days after
    those hold quotes, separators and line ends inside quoted values."""
    f = flows_raw(spark, sf).select("row_key", DAY, "Label", "`Flow Duration`")
    key = F.col("row_key")
    odd = f.filter(_day_no() % 5 == 0).withColumn("Label", F.when(key % 2 == 0, F.concat("Label", F.lit(",EXTRA"))).otherwise(F.col("Label")))
    note = F.when(key % 11 == 0, 'two\nlines, "quoted"').when(key % 11 == 1, "a,b").otherwise("plain")
    bases = []
    for name, part, options in (("odd", odd, {"quote": ""}), ("even", f.filter(_day_no() % 5 != 0).withColumn(
            "Label", F.when(_day_no() % 5 == 1, note).otherwise(F.col("Label"))), {"escape": '"'})):
        base = scratch_path(spark, "flow-csv") + "/" + name
        (part.hint("rebalance", DAY).write.partitionBy(DAY).option("header", True).options(**options)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(base))
        bases.append(base)
    return bases


def load_days(spark, bases):
    dirs, days = [], []
    for base in bases:
        d, n = day_folders(spark, base)
        dirs, days = dirs + d, days + n
    return csv_flows.load_files(spark, dirs, tag=DAY, tag_values=days)


@register("ingest_malformed", O.with_(O.FLOWS, f"""
SELECT "Day" AS file, CAST(CASE WHEN {_DAY_SQL} % 5 = 0 THEN 0 ELSE count(*) END AS BIGINT) AS rows, {_DAY_SQL} % 5 = 0 AS malformed,
       CAST(CASE WHEN {_DAY_SQL} % 5 = 0 THEN count_if(row_key % 2 = 0) ELSE 0 END AS BIGINT) AS too_long, {_DAY_SQL} % 5 = 1 AS quoted_breaks
FROM flows_raw GROUP BY "Day\""""))
def ingest_malformed(spark, sf):
    """Load log with the records of too many fields: their files are errors and left out; quoted line ends are no records."""
    got = load_days(spark, write_malformed_csvs(spark, sf))
    files = got.files.groupBy("file").agg(F.sum("too_long").alias("too_long"), F.bool_or("quoted_breaks").alias("quoted_breaks"))
    return got.log.join(files, "file").select("file", "rows", F.coalesce(F.col("error").startswith("ParserError"), F.lit(False)).alias("malformed"),
                                              "too_long", "quoted_breaks")


@register("ingest_malformed_rows", O.with_(O.FLOWS, f"""
SELECT row_key, "Day", CASE WHEN {_DAY_SQL} % 5 <> 1 THEN "Label" WHEN row_key % 11 = 0 THEN 'two' || chr(10) || 'lines, "quoted"'
                            WHEN row_key % 11 = 1 THEN 'a,b' ELSE 'plain' END AS "Label", "Flow Duration"
FROM flows_raw WHERE {_DAY_SQL} % 5 <> 0"""))
def ingest_malformed_rows(spark, sf):
    """All rows of the files that are well formed; values with quotes, separators and line ends come back whole."""
    return load_days(spark, write_malformed_csvs(spark, sf)).flows.select("row_key", DAY, "Label", "`Flow Duration`")


@register("ingest_mixed_folder", O.with_(O.FLOWS, """
SELECT row_key, "Day", CASE row_key % 3 WHEN 0 THEN 'déjà vu' WHEN 1 THEN 'über' ELSE 'ok' END AS "Comment" FROM flows_raw"""))
def ingest_mixed_folder(spark, sf):
    """Every day's folder holds UTF-8 and Latin-1 files: each is decoded by itself."""
    f = flows_raw(spark, sf).select("row_key", DAY)
    f = f.withColumn("Comment", F.when(F.col("row_key") % 3 == 0, "déjà vu").when(F.col("row_key") % 3 == 1, "über").otherwise("ok"))
    base = scratch_path(spark, "flow-csv")
    for charset, rest in (("ISO-8859-1", 0), ("UTF-8", 1)):
        (f.filter(F.col("row_key") % 2 == rest).hint("rebalance", DAY).write.mode("append").partitionBy(DAY).option("header", True)
         .option("encoding", charset).csv(base))
    return load_days(spark, [base]).flows.select("row_key", DAY, "Comment")


@register("ingest_types", O.with_(O.FLOWS, f"""
SELECT DISTINCT "Day" AS file, 'Mixed' AS "column", CASE {_DAY_SQL} % 3 WHEN 0 THEN 'bigint' WHEN 1 THEN 'double' ELSE 'string' END AS type FROM flows_raw
UNION ALL SELECT DISTINCT "Day", 'Number', CASE {_DAY_SQL} % 2 WHEN 0 THEN 'bigint' ELSE 'double' END FROM flows_raw
UNION ALL SELECT DISTINCT "Day", 'Sometimes', CASE {_DAY_SQL} % 2 WHEN 0 THEN 'none' ELSE 'bigint' END FROM flows_raw
UNION ALL SELECT 'all', 'Mixed', CASE WHEN bool_or({_DAY_SQL} % 3 = 2) THEN 'string' WHEN bool_or({_DAY_SQL} % 3 = 1) THEN 'double' ELSE 'bigint' END FROM flows_raw
UNION ALL SELECT 'all', 'Number', CASE WHEN bool_or({_DAY_SQL} % 2 = 1) THEN 'double' ELSE 'bigint' END FROM flows_raw
UNION ALL SELECT 'all', 'Sometimes', CASE WHEN bool_or({_DAY_SQL} % 2 = 1) THEN 'bigint' ELSE 'double' END FROM flows_raw"""))
def ingest_types(spark, sf):
    """The types of each day's file, and what they widen to in the merged table."""
    f = flows_raw(spark, sf).select("row_key", DAY)
    key = F.col("row_key").cast("string")
    f = f.withColumns({
        "Mixed": F.when(_day_no() % 3 == 0, key).when(_day_no() % 3 == 1, F.concat(key, F.lit(".5"))).otherwise(F.concat(F.lit("k"), key)),
        "Number": F.when(_day_no() % 2 == 0, key).otherwise(F.concat(key, F.lit("e-1"))),
        "Sometimes": F.when(_day_no() % 2 == 0, "NA").otherwise(key)})
    base = scratch_path(spark, "flow-csv")
    f.hint("rebalance", DAY).write.partitionBy(DAY).option("header", True).csv(base)
    got = load_days(spark, [base])
    merged = spark.createDataFrame([("all", c, t) for c, t in got.flows.dtypes if c in ("Mixed", "Number", "Sometimes")], "file string, column string, type string")
    by_file = got.types.filter(F.col("column") != "row_key").select("file", "column", "type").distinct()
    return by_file.unionByName(merged)


@register("ingest_stage_read", O.with_(O.SPLIT, """
SELECT 'train' AS name, 'second' AS run, 'current' AS status, count(*) AS rows, CAST(8 AS INTEGER) AS cols, true AS unchanged FROM train WHERE row_key % 2 = 0
UNION ALL SELECT 'test', 'first', 'earlier', count(*), 8, true FROM test
UNION ALL SELECT 'class_mapping', 'first', 'earlier', count(*), 2, true FROM mapping
UNION ALL SELECT 'weights', NULL, 'missing', NULL, NULL, NULL"""))
def ingest_stage_read(spark, sf):
    """A stage's tables by run: the second run wrote train anew and broke off while writing test, so test and mapping
    come from the first; no run has weights.  Each table found is read and compared with what the run wrote."""
    from flowguard.plans.flows import Workflow
    from flowguard.sources import runs
    w = Workflow(spark, sf)
    base = scratch_path(spark, "runs")
    runs.save_run(spark, base, "first", {"train": w.train, "test": w.test, "class_mapping": w.mapping})
    runs.save_run(spark, base, "second", {"train": w.train.filter(F.col("row_key") % 2 == 0)})
    w.test.filter(F.col("row_key") % 3 == 0).write.parquet(f"{base}/runs/second/test")  # no entry: broken off
    found = runs.resolve(spark, base, ["train", "test", "class_mapping", "weights"], "second")
    read = runs.read_run(spark, base, ["train", "test", "class_mapping"], "second", verify=True)
    seen = None
    for name, df in read.items():
        one = df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("_rows"), F.lit(len(df.columns)).alias("cols"), runs.content_hash(df).alias("_content"))
        seen = one if seen is None else seen.unionByName(one)
    same = (F.col("rows") == F.col("_rows")) & (F.col("content") == F.col("_content"))
    return found.join(seen, "name", "left").select("name", "run", "status", "rows", "cols", same.alias("unchanged"))
