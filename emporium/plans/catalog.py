"""Registry of named queries: ``name → fn(spark, sf_dir) → DataFrame``.

Each query module registers its Spark builder with ``@query(name, sql)``
where ``sql`` is the DuckDB body appended to ``oracle.PRELUDE`` (``None`` for
operators SQL cannot state; those are checked against brute force in tests).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emporium.plans import oracle
from emporium.plans.context import Ctx

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str, sql: str | None):
    """Register ``fn(ctx) → DataFrame`` as ``name`` with its oracle SQL body."""
    def deco(fn: Callable[[Ctx], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Ctx(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            oracle.register(name, sql)
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from emporium.plans import queries_core  # noqa: F401
    from emporium.plans import queries_metrics  # noqa: F401
    from emporium.plans import queries_business  # noqa: F401
    from emporium.plans import queries_text  # noqa: F401
    from emporium.plans import queries_quality  # noqa: F401
    from emporium.plans import queries_semantic  # noqa: F401
    from emporium.plans import queries_io  # noqa: F401


def all_queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    load_all()
    return dict(oracle.ORACLE)
