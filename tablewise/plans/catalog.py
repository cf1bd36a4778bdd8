"""Registry of named queries: key -> (Spark builder, DuckDB oracle SQL).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables (or fixture views derived from them).  Oracles are independent
SQL over the same tables, inlining fixture views as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}
DOCS: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        DOCS[key] = (fn.__doc__ or "").strip()
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import queries_audit  # noqa: F401
    from . import queries_explore  # noqa: F401
    from . import queries_prepare  # noqa: F401
    from . import queries_eval  # noqa: F401
    from . import queries_features  # noqa: F401
    from . import queries_model  # noqa: F401
    from . import queries_io  # noqa: F401
