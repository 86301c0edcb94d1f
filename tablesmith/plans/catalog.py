"""Registry of plans: name -> (Spark callable (spark, sf_dir) -> DataFrame, DuckDB oracle SQL or None).

Every plan reads the driver's tables (or what Spark derives from them) in full. Float results are rounded to
6 decimals on both sides so the engines' last-bit differences do not count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate plan {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load_all():
    # importing the plan modules fills REGISTRY
    from tablesmith.plans import (q_boosting, q_clean, q_drift, q_eval, q_io, q_lines, q_models,  # noqa: F401
                                  q_prep, q_profile, q_split)
