"""Registry of named plans: key -> (spark, sf_dir) -> DataFrame, plus the
DuckDB statement that computes the same rows for the correctness check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalframe.fixtures import with_fixtures

PlanFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, PlanFn] = {}
ORACLES: dict[str, str] = {}


def plan(key: str, oracle: str | None = None, fixtures: tuple[str, ...] = ()):
    """Register a plan; ``oracle`` (DuckDB SQL) is wrapped with the fixtures it reads."""
    def deco(fn: PlanFn) -> PlanFn:
        if key in QUERIES:
            raise KeyError(f"duplicate plan {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = with_fixtures(oracle, *fixtures) if fixtures else oracle
        return fn
    return deco


def r9(c: str | Column, name: str | None = None) -> Column:
    """Doubles rounded to 9 places for the comparison (summation order moves
    the last bits)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 9).alias(name or (c if isinstance(c, str) else "value"))
