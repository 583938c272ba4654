"""Numeric guards used by the cleaning operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_infinite(col: Column | str) -> Column:
    return F.abs(_c(col)) == F.lit(INF)


def null_if_negative(col: Column | str) -> Column:
    c = _c(col)
    return F.when(c < 0, F.lit(None)).otherwise(c)


def null_if_infinite(col: Column | str) -> Column:
    c = _c(col)
    return F.when(is_infinite(c), F.lit(None)).otherwise(c)


def nan_to_null(col: Column | str) -> Column:
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)
