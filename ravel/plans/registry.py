"""Named queries over the given tables and their DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is SQL over
the pre-registered table views returning the same columns (names aliased
alike, arrays rendered as strings). Queries without an oracle are
iterative or streaming; tests check them against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ravel.plans import graph_q, phones_q, trending_q, words_q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

for _mod in (words_q, phones_q, graph_q, trending_q):
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)
