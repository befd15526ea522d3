"""Registry of the runnable queries and their SQL counterparts."""

from __future__ import annotations

import importlib

from .bindings import Tables, oracle_text

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_GROUPS = ("a_sources", "b_columns", "c_joins", "d_aggregates", "e_ranking",
           "f_iterative", "g_tiling", "h_sets", "i_functions", "k_streams", "l_jobs")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and, where SQL can say it, its oracle."""

    def wrap(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")

        def run(spark, sf_dir):
            return fn(Tables(spark, sf_dir))

        run.__doc__ = fn.__doc__
        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = oracle_text(sql)
        return fn

    return wrap


def load() -> None:
    for group in _GROUPS:
        importlib.import_module(f"{__name__}.{group}")
