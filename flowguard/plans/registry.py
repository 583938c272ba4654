"""Collects the registered queries of all catalog modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MODULES = ("flowguard.plans.catalog", "flowguard.plans.catalog_features",
            "flowguard.plans.catalog_balance", "flowguard.plans.catalog_models",
            "flowguard.plans.catalog_stream", "flowguard.plans.catalog_ingest")


def _load():
    import importlib
    for m in _MODULES:
        importlib.import_module(m)
    from flowguard.plans import catalog
    return catalog


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    cat = _load()

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from flowguard.session import ensure_checkpoint_dir
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(v) for k, v in cat.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_load().SQL)
