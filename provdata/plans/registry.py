"""Query registry: name -> (Spark builder, oracle SQL or None).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the library's operators over the driver tables. The oracle SQL is an
independent DuckDB formulation of the same result (often the naive form the
Spark operator was rewritten from, e.g. all candidate pairs + row_number).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    oracle: str | None
    operators: str  # survey ids covered, e.g. "AGG3, FLT1"


REGISTRY: dict[str, Query] = {}


def _zero_count_if(sql: str) -> str:
    """DuckDB's ``count_if`` is NULL when every input is NULL (Spark and the warehouse give 0).

    Rewrite each ``count_if(...)`` call to ``coalesce(count_if(...), 0)``.
    """
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _zero_count_if(sql[j + len(key):k])
        out.append(sql[i:j] + f"coalesce(count_if({inner}), 0)")
        i = k + 1


def query(name: str, oracle: str | None, operators: str):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, _zero_count_if(oracle) if oracle else None, operators)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from . import (q_providers, q_staging, q_match, q_enrich,  # noqa: F401
                   q_governance, q_export, q_streaming, q_people, q_ops, q_io, q_more, q_gov2, q_connectors)
    return REGISTRY
