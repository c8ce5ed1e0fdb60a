"""Registry of the verified queries: a Spark plan per operator plus its DuckDB twin.

Each registered callable takes ``(spark, sf_dir)`` and returns a lazy
DataFrame built with the library's operators over the adapter views of
:mod:`ledgerlake.sources.adapters`.  The twin is independent SQL over the
same views (inlined as CTEs), used as the correctness oracle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.sources.adapters import MartTables, store_table, tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, views: Sequence[str] = (), sql: str | None = None):
    """Register ``fn(t: MartTables) -> DataFrame`` under ``key``."""
    def deco(fn: Callable[[MartTables], DataFrame]):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tables(spark, sf_dir))

        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = with_views(views, sql)
        return fn
    return deco


def shared(fn):
    """Memoise a sub-plan builder ``fn(t, *args)`` per table set."""
    def wrapper(t: MartTables, *args):
        return t.memo(f"{fn.__module__}.{fn.__qualname__}{args!r}", lambda: fn(t, *args))
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def stored(fn):
    """Like :func:`shared`, for an upstream model whose output the reference
    stores as a table and downstream models read back: the result is written
    once to the shared checkpoint folder (lineage cut, executor-loss safe) and
    later plans read it instead of recomputing the chain."""
    def wrapper(t: MartTables, *args):
        def build():
            df = fn(t, *args)
            return store_table(df, fn.__name__) if t.materialize else df
        return t.memo(f"stored:{fn.__module__}.{fn.__qualname__}{args!r}", build)
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def load_all() -> None:
    """Import every module that registers queries."""
    from ledgerlake.plans import (  # noqa: F401
        q_scans, q_cleaning, q_rules, q_scalars, q_relational, q_marts, q_gross, q_ingest, q_catalog, q_writes, q_io, q_versioned,
    )
