"""Registry of named queries: a Spark callable and, where SQL can say it, an oracle.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame that
reads the driver's parquet tables at ``sf_dir``.  The oracle is DuckDB SQL
over the same tables with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # Importing the query modules fills the registry.
    from .plans import q_checked, q_clean, q_features, q_models, q_profile, q_serve, q_wide  # noqa: F401
