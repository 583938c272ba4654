"""Flow CSV ingestion: encoding detection, malformed lines, header clean-up, missing-value
tokens, types by file and their widening, source tagging, union by name and a load log.

One distributed pass finds every file's encoding and header, the lines that have more
fields than the header, and whether quoted values run over line ends.  Files of equal
encoding, header and kind are read by one scan; the types of all columns come from one
aggregate by file, and a lattice widens them.  Missing, empty, unreadable and malformed
files are logged and left out, not fatal.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.operators.clean import q
from flowguard.session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, bounded_rows, materialize

UTF8, LATIN1 = "utf-8", "latin-1"
_SPARK_CHARSET = {UTF8: "UTF-8", LATIN1: "ISO-8859-1"}

# Texts that pandas reads as a missing value.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# Texts that pandas reads as a truth value.
BOOLEAN_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf|infinity)\s*$"


def path_exists(spark: SparkSession, path: str) -> bool:
    """File-system check through Hadoop (works for any cluster file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def glob_files(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    st = fs.globStatus(p) or []
    return sorted(s.getPath().toString() for s in st if s.isFile())


MAX_FILES = 1_000_000  #: files of a load at most: the driver holds a row for each


def field_count(record: Column) -> Column:
    """Fields of a record: separators outside quotes, and one."""
    bare = F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, r'"[^"]*"', "")).otherwise(record)
    return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def probe_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, encoding, header, fields, too_long, quoted_breaks) of every file with a line that is not blank.

    encoding: 'utf-8' if every line is valid UTF-8, else 'latin-1'; header: the bytes of the first such line and
    fields its number of fields; too_long: lines of more fields; quoted_breaks: a line has an odd number of quotes,
    so that values run over line ends and lines are no records (too_long then says nothing).

    Spark's text reader keeps the raw bytes, so this is one distributed aggregate
    (no file is read on the driver).  A file without such a line gives no row.
    """
    value = F.col("value")
    t = (spark.read.text(list(paths))
         .select(F.col("_metadata.file_path").alias("file"), value.cast("binary").alias("raw"),
                 F.expr("is_valid_utf8(value)").alias("ok"), F.length(F.trim("value")).alias("n"),
                 field_count(value).alias("fields"),
                 ((F.char_length(value) - F.char_length(F.replace(value, F.lit('"'), F.lit("")))) % 2 == 1).alias("odd"),
                 F.col("_metadata.file_block_start").alias("start"),
                 F.monotonically_increasing_id().alias("id"))
         .filter("n > 0"))
    # lines of a split keep their order; the header is in the split at byte 0
    first = F.when(F.col("start") == 0, F.col("id"))
    by_width = t.groupBy("file", "fields").agg(
        F.count(F.lit(1)).alias("lines"), F.bool_and("ok").alias("ok"), F.bool_or("odd").alias("odd"),
        F.min(first).alias("first"), F.min_by("raw", first).alias("raw"))
    head = F.min_by("fields", "first").over(Window.partitionBy("file"))
    return by_width.withColumn("_head", head).groupBy("file").agg(
        F.when(F.bool_and("ok"), F.lit(UTF8)).otherwise(F.lit(LATIN1)).alias("encoding"),
        F.min_by("raw", "first").alias("header"), F.min("_head").alias("fields"),
        F.sum(F.when(F.col("fields") > F.col("_head"), F.col("lines")).otherwise(0)).alias("too_long"),
        F.bool_or("odd").alias("quoted_breaks"))


def detect_encoding(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, encoding) of every file below the paths."""
    return probe_files(spark, paths).select("file", "encoding")


def pandas_style_names(header: Sequence[str]) -> list[str]:
    """Strip names; repeated names become name, name.1, name.2 (pandas rule,
    applied to the raw header before stripping, as the original reader does)."""
    seen: dict[str, int] = {}
    out = []
    for h in header:
        h = "" if h is None else h
        n = seen.get(h, 0)
        seen[h] = n + 1
        out.append((h if n == 0 else f"{h}.{n}").strip())
    return out


PATH = "_file"  #: the column that tells a row's file while files are read


def _reader(spark: SparkSession, names: int, encoding: str, multi: bool, more: Sequence[T.StructField] = ()):
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(names)] + list(more))
    return (spark.read.schema(schema).option("header", True).option("encoding", _SPARK_CHARSET[encoding])
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("escape", '"').option("multiLine", multi))


def too_long_records(spark: SparkSession, paths: Sequence[str], fields: int, encoding: str) -> DataFrame:
    """(file, too_long, values): records of more fields than the header, in files whose values run over line ends, and
    whether there is any value (which keeps all columns in the scan: Spark parses only what is asked for)."""
    more = [T.StructField("_more", T.StringType()), T.StructField("_bad", T.StringType())]
    df = (_reader(spark, fields, encoding, True, more).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_bad").csv(list(paths)))
    # a record of one field more is whole under this schema; others that differ come with their text
    long = F.when(F.col("_bad").isNull(), F.lit(True)).otherwise(field_count(F.col("_bad")) > fields)
    seen = F.coalesce(*[F.col(c) for c in df.columns[:-1]]).isNotNull()
    return (df.select(F.col("_metadata.file_path").alias("file"), long.alias("long"), seen.alias("seen"))
            .groupBy("file").agg(F.count_if("long").alias("too_long"), F.bool_or("seen").alias("values")))


def read_texts(spark: SparkSession, paths: Sequence[str], names: Sequence[str], encoding: str,
               tags: dict[str, str], tag: str, multi: bool = False) -> DataFrame:
    """One scan of files with equal header and encoding: every column as text, the tag and the file (``PATH``).

    ``tags``: file as Spark names it -> tag value (one entry per file).  ``multi``: quoted values run over
    line ends; such a file is one split.
    """
    df = _reader(spark, len(names), encoding, multi).csv(list(paths)).withColumn(PATH, F.col("_metadata.file_path"))
    cols = [F.col(f"_c{i}").alias(n) for i, n in enumerate(names)]
    values = set(tags.values())
    if len(values) == 1:
        return df.select(*cols, F.lit(values.pop()).alias(tag), PATH)
    files = spark.createDataFrame(list(tags.items()), "_name string, _tag string")
    if len(tags) <= BROADCAST_MAX_ROWS and sum(len(f) + len(t) for f, t in tags.items()) <= BROADCAST_MAX_BYTES // 2:
        files = F.broadcast(files)
    return df.join(files, F.col(PATH) == F.col("_name")).select(*cols, F.col("_tag").alias(tag), PATH)


def file_types(df: DataFrame, by: str, keep: Sequence[str] = ()) -> DataFrame:
    """(``by``, column, type): the narrowest of bigint, double, boolean and string that holds every value that a
    file has in a column; ``none`` where it has no value.  One aggregate over all columns."""
    todo = [c for c in df.columns if c not in keep and c != by]

    def fits(i: int, c: str) -> list[Column]:
        v = F.when(~F.col(q(c)).isin(*NULL_TOKENS), F.col(q(c)))
        whole = v.rlike(_INTEGER) & v.try_cast("bigint").isNotNull()
        return [F.bool_and(F.when(v.isNotNull(), whole)).alias(f"n{i}"), F.bool_and(v.rlike(_NUMBER)).alias(f"d{i}"),
                F.bool_and(v.isin(*BOOLEAN_TOKENS)).alias(f"b{i}")]

    found = df.groupBy(by).agg(*[e for i, c in enumerate(todo) for e in fits(i, c)])
    kinds = [F.struct(F.lit(c).alias("column"), F.when(F.col(f"d{i}").isNull(), "none").when(F.col(f"n{i}"), "bigint")
                      .when(F.col(f"d{i}"), "double").when(F.col(f"b{i}"), "boolean").otherwise("string").alias("type")) for i, c in enumerate(todo)]
    return found.select(by, F.inline(F.array(*kinds)))


def widest(types: Column) -> Column:
    """The type that holds columns of all these types: numbers widen to double, other mixtures to string; a column
    without any value is double."""
    has = lambda *t: F.forall(F.array_remove(types, "none"), lambda x: x.isin(*t))
    return (F.when(F.size(F.array_remove(types, "none")) == 0, "double").when(has("bigint"), "bigint")
            .when(has("bigint", "double"), "double").when(has("boolean"), "boolean").otherwise("string"))


def cast_to(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Missing-value tokens to NULL and the given type for each column of ``kinds``; others as they are."""
    def one(c: str) -> Column:
        v = F.when(~F.col(q(c)).isin(*NULL_TOKENS), F.col(q(c)))
        return (v.try_cast(kinds[c]) if c in kinds else F.col(q(c))).alias(c)
    return df.select(*[one(c) for c in df.columns])


def infer_types(df: DataFrame, keep: Sequence[str] = (), by: str | None = None) -> DataFrame:
    """Missing-value tokens to NULL, then the type that widens those of all files (``by``; all rows if not given).

    A column without any value is DOUBLE.  Whole numbers with missing values stay BIGINT.
    """
    types = file_types(df if by else df.withColumn(PATH, F.lit("")), by or PATH, keep)
    return cast_to(df, merged_types(types))


def merged_types(types: DataFrame) -> dict[str, str]:
    """Column -> widened type (one row per column reaches the driver)."""
    merged = types.groupBy("column").agg(F.collect_set("type").alias("t")).select("column", widest(F.col("t")).alias("type"))
    return {r["column"]: r["type"] for r in bounded_rows(merged, 100_000, "columns")}


def _local(path: str) -> str:
    """A path without scheme, authority and closing slash."""
    return re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


# What Spark and Hadoop say where a file itself cannot be read.
_UNREADABLE = ("FAILED_READ_FILE", "CANNOT_READ_FILE", "PATH_NOT_FOUND", "Permission denied", "AccessControlException",
               "ZipException", "EOFException", "not a gzip file", "incorrect header check")


def _probe(spark: SparkSession, paths: list[str]) -> tuple[list[Row], dict[str, str]]:
    """Rows of ``probe_files`` and the error of each path that cannot be read (found by halving).

    Other failures are raised: they would come again for every half.
    """
    if not paths:
        return [], {}
    try:
        return bounded_rows(probe_files(spark, paths), MAX_FILES, "files"), {}
    except Exception as exc:  # noqa: BLE001 - only unreadable files are logged
        if not any(t in str(exc) for t in _UNREADABLE):
            raise
        if len(paths) == 1:
            return [], {paths[0]: str(exc)[:200]}
        rows, errors = _probe(spark, paths[:len(paths) // 2])
        more, other = _probe(spark, paths[len(paths) // 2:])
        return rows + more, errors | other


@dataclass
class Loaded:
    """What a load gives: ``flows`` (None if nothing could be read), the ``log`` of the paths (file, rows, encoding,
    error), the ``files`` below them (file, path, encoding, fields, too_long, quoted_breaks, ok) and the ``types``
    of each file's columns (file, path, column, type)."""
    flows: DataFrame | None
    log: DataFrame
    files: DataFrame
    types: DataFrame | None


def load_files(spark: SparkSession, paths: Sequence[str], tag: str = "Day",
               tag_values: Sequence[str] | None = None, infer_schema: bool = True) -> Loaded:
    """Read every existing file or folder (encoding fallback file by file), tag rows with its name, union by name.

    A file with a record of more fields than its header is malformed: it is left out and logged as an error.
    Records of fewer fields end in missing values.  Quoted values may hold separators and line ends.
    """
    named = [(p, tag_values[i] if tag_values else p.rstrip("/").split("/")[-1]) for i, p in enumerate(paths)]
    with ThreadPoolExecutor(16) as pool:
        there = list(pool.map(lambda x: path_exists(spark, x[0]), named))
    present = [x for x, e in zip(named, there) if e]
    rows, errors = _probe(spark, [p for p, _ in present])
    long = {r["file"]: r["too_long"] for r in rows if not r["quoted_breaks"]}
    broken: dict[tuple, list[str]] = {}
    for r in rows:
        if r["quoted_breaks"]:
            broken.setdefault((r["encoding"], len(_header(r))), []).append(r["file"])
    for (e, n), where in broken.items():
        long |= dict.fromkeys(where, 0)
        long |= {r["file"]: r["too_long"] for r in bounded_rows(too_long_records(spark, [unquote(w) for w in where], n, e), MAX_FILES, "files")}
    known = {_local(p): p for p, _ in present}
    files: dict[str, list[Row]] = {p: [] for p, _ in present}
    for r in rows:
        at = _local(unquote(r["file"]))
        while at and at not in known:  # part files belong to their folder
            at = at.rpartition("/")[0]
        if at:
            files[known[at]].append(r)
    log_rows, file_rows = [], []
    groups: dict[tuple, tuple[list[str], dict[str, str]]] = {}
    for p, name in named:
        if p not in files:
            log_rows.append((name, 0, "none", "FileNotFoundError"))
            continue
        if not files[p]:
            log_rows.append((name, 0, "none", errors.get(p, "EmptyDataError")))
            continue
        kinds = {r["file"]: (r["encoding"], tuple(pandas_style_names(_header(r))), bool(r["quoted_breaks"])) for r in files[p]}
        good = [r for r in files[p] if not long[r["file"]]]
        for r in files[p]:
            file_rows.append((name, unquote(r["file"]), r["encoding"], len(kinds[r["file"]][1]), int(long[r["file"]]), bool(r["quoted_breaks"]),
                              not long[r["file"]]))
        for r in good:
            where, tags = groups.setdefault(kinds[r["file"]], ([], {}))
            whole = len(good) == len(files[p]) and len(set(kinds.values())) == 1
            where.append(p if whole else unquote(r["file"]))
            tags[r["file"]] = name
        bad = sum(long[r["file"]] for r in files[p])
        error = None if not bad else f"ParserError: {bad} records of too many fields" + (
            "" if len(files[p]) == 1 else f" in {len(files[p]) - len(good)} of {len(files[p])} files")
        log_rows.append((name, None if good else 0, UTF8 if all(r["encoding"] == UTF8 for r in files[p]) else LATIN1, error))
    flows = None
    for (e, names, multi), (where, tags) in groups.items():
        df = read_texts(spark, list(dict.fromkeys(where)), names, e, tags, tag, multi)
        flows = df if flows is None else flows.unionByName(df, allowMissingColumns=True)
    log = spark.createDataFrame(log_rows, "file string, rows bigint, encoding string, error string")
    listed = spark.createDataFrame(file_rows, "file string, path string, encoding string, fields int, too_long bigint, quoted_breaks boolean, ok boolean")
    if flows is None:
        return Loaded(None, log.withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint"))), listed, None)
    flows = flows.select(*[F.col(q(c)) for c in flows.columns if c not in (tag, PATH)], F.col(q(tag)), PATH)
    counts = flows.groupBy(F.col(q(tag)).alias("file")).agg(F.count(F.lit(1)).alias("_n"))
    log = log.join(counts, "file", "left").select(
        "file", F.coalesce("rows", "_n", F.lit(0)).cast("bigint").alias("rows"), "encoding", "error")
    types = file_types(flows, PATH, keep=[tag])
    if infer_schema:
        types = materialize(types)
        flows = cast_to(flows, merged_types(types))
    names = spark.createDataFrame([(f, name) for _, tags in groups.values() for f, name in tags.items()], "_name string, file string")
    types = types.join(names, F.col(PATH) == F.col("_name")).select("file", F.col(PATH).alias("path"), "column", "type")
    return Loaded(flows.drop(PATH), log, listed, types)


def _header(row: Row) -> list[str]:
    return next(csv.reader([bytes(row["header"]).decode("utf-8-sig" if row["encoding"] == UTF8 else row["encoding"])]))


def load_flows(spark: SparkSession, paths: Sequence[str], tag: str = "Day",
               tag_values: Sequence[str] | None = None,
               infer_schema: bool = True) -> tuple[DataFrame | None, DataFrame]:
    """(flows or None, load log (file, rows, encoding, error)) of ``load_files``."""
    got = load_files(spark, paths, tag, tag_values, infer_schema)
    return got.flows, got.log
