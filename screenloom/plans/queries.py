"""Registry of the queries for the screening operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from screenloom.plans import reference_queries, screening_queries, text_queries, verdict_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**verdict_queries.QUERIES, **reference_queries.QUERIES, **text_queries.QUERIES, **screening_queries.QUERIES}
