"""Registry of the core queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioweave.queries import assembly, checks, corpus, extras, problems, records, scalars, sources, texts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
for _module in (problems, scalars, texts, assembly, corpus, sources, extras, records, checks):
    QUERIES |= _module.QUERIES
    ORACLE |= _module.ORACLE


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best system of every dataset and metric over all result rows."""
    return QUERIES["q4_leaderboards"](spark, sf_dir)
