"""Label and file-name text functions, as native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (``str.isspace``),
# written as one Java regex character class.
_WS_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x85\\xA0\\u1680\\u2000-\\u200A"
    "\\u2028\\u2029\\u202F\\u205F\\u3000]"
)
# Substrings removed from a file name to shorten a day tag, in order.
SHORT_DAY_DROPS = (".pcap_ISCX.csv", "WorkingHours", "MachineLearningCVE/")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: Column | str) -> Column:
    """Remove leading and trailing whitespace (same set as Python's strip)."""
    return F.regexp_replace(_c(col), f"^{_WS_CLASS}+|{_WS_CLASS}+$", "")


def title_case(col: Column | str) -> Column:
    """Python ``str.title``: a letter run starts upper, the rest lower.

    Spark's ``initcap`` only splits on spaces (``o'neil`` -> ``O'neil``), so the
    text is cut into letter and non-letter runs and each run is capitalised.
    """
    runs = F.regexp_extract_all(_c(col), F.lit("\\p{L}+|[^\\p{L}]+"), 0)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def normalize_label(col: Column | str) -> Column:
    """strip -> one pass of double space to space -> '-' to space -> title case.

    A missing label becomes the text ``nan`` first, as text conversion of a
    missing value does in the original workflow.
    """
    s = F.coalesce(_c(col).cast("string"), F.lit("nan"))
    s = strip_ws(s)
    s = F.replace(s, F.lit("  "), F.lit(" "))
    s = F.replace(s, F.lit("-"), F.lit(" "))
    return title_case(s)


def short_day(col: Column | str) -> Column:
    """Drop the fixed substrings from a source file name, in order."""
    s = _c(col)
    for drop in SHORT_DAY_DROPS:
        s = F.replace(s, F.lit(drop), F.lit(""))
    return s
