"""A scoring stream with a quarantine: rows whose values cannot be read go to a table of their own.

Each micro-batch is split once and written to folders named by its number, which a repeated batch overwrites:
after a failure and a restart from the same checkpoint every row is in one of the two tables, once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.operators.clean import NON_NEGATIVE_COLS, present, q

SCORED, REJECTED = "scored", "rejected"


def cast_failures(df: DataFrame, types: dict[str, str]) -> Column:
    """The columns of ``types`` (column -> wanted type) whose value a row has but cannot give as that type."""
    bad = [F.when(F.col(q(c)).isNotNull() & F.col(q(c)).try_cast(t).isNull(), F.lit(c)) for c, t in types.items() if c in df.columns]
    return F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")


def numeric_types(df: DataFrame, cols: Sequence[str] = NON_NEGATIVE_COLS) -> dict[str, str]:
    return dict.fromkeys(present(df, cols), "double")


def run_quarantined(stream: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, types: dict[str, str] | None = None) -> None:
    """Run the stream until the available input is consumed, into ``out/scored`` and ``out/rejected``.

    ``score`` gets the good rows of a batch; a rejected row is kept as it came, with ``reasons``: the columns that
    cannot be read as ``types`` say.  Calling again with the same ``out`` goes on where it ended or broke off.
    """
    types = numeric_types(stream) if types is None else types

    def write(batch: DataFrame, number: int) -> None:
        split = batch.withColumn("reasons", cast_failures(batch, types)).persist()
        try:
            score(split.filter(F.size("reasons") == 0).drop("reasons")).write.mode("overwrite").parquet(f"{out}/{SCORED}/batch={number}")
            split.filter(F.size("reasons") > 0).write.mode("overwrite").parquet(f"{out}/{REJECTED}/batch={number}")
        finally:
            split.unpersist()

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
