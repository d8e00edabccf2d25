"""The query catalogue: every registered query and its DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole test tables.
What a randomised fit leaves open (k-means, isolation forest) is not part of a
result; their entries return what the data fixes.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_FAMILIES = [
    "legworks.plans.ingest_queries",
    "legworks.plans.recovery_queries",
    "legworks.plans.propagation_queries",
    "legworks.plans.route_queries",
    "legworks.plans.path_queries",
    "legworks.plans.report_queries",
    "legworks.plans.ml_queries",
    "legworks.plans.state_queries",
]


def _modules():
    return [importlib.import_module(name) for name in _FAMILIES]


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracle() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _modules():
        out.update(getattr(m, "ORACLE", {}))
    return out
