"""Incremental runs: what has been answered is never asked again."""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_available(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> None:
    """Process the files that arrived since the last run, once each, and append the results.

    The checkpoint holds what was read, so a run after a crash goes on where it stopped and a run with nothing
    new adds nothing. ``work`` must keep rows apart (no aggregation over the stream).
    """
    rows = spark.readStream.schema(schema).parquet(source)
    query = work(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", sink).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def new_only(rows: DataFrame, key: str, time_col: str, delay: str) -> DataFrame:
    """First arrivals of each key: repeats within the delay are dropped with bounded state."""
    return rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


def arrivals(rows: DataFrame, time_col: str, width: str, delay: str, by: str) -> DataFrame:
    """Rows per window of time and value of ``by``; late rows are counted until the delay is over."""
    return rows.withWatermark(time_col, delay).groupBy(F.window(time_col, width), by).agg(F.count("*").alias("n"))


def with_retry(call: Callable[[], str | None], attempts: int = 6, first: float = 2.0, most: float = 30.0, pause: Callable[[float], None] = time.sleep) -> str | None:
    """Repeat a call that raises or gives nothing, with doubling pauses and jitter; the last failure is raised."""
    wait = first
    for k in range(attempts):
        try:
            found = call()
            if found is not None:
                return found
            error: Exception = ValueError("empty answer")
        except Exception as raised:  # any failure of the far side
            error = raised
        if k + 1 < attempts:
            pause(min(most, wait) * random.uniform(0.8, 1.0))
            wait *= 2
    raise error
