"""Work that is left, and replacing part of what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(records: DataFrame, done: DataFrame, key: str = "record_id") -> DataFrame:
    """Records without a row in ``done``; null keys there (lines that could not be read) finish nothing."""
    return records.join(done.select(key).filter(F.col(key).isNotNull()), key, "left_anti")


def replaced(old: DataFrame, new: DataFrame, key: str = "record_id") -> DataFrame:
    """Old rows, but those of keys in ``new`` replaced; keys only in ``new`` are added, and no old row is lost."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by ``order``."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def with_flags(results: DataFrame, wanted: list[str]) -> DataFrame:
    """Results that carry one of the flags."""
    return results.filter(F.arrays_overlap(F.coalesce("flags", F.array().cast("array<string>")), F.array(*map(F.lit, wanted))))


def id_sets(a: DataFrame, b: DataFrame, key: str = "record_id") -> DataFrame:
    """How many distinct ids stand in both, only in the first, only in the second."""
    x, y = a.select(key).distinct().withColumn("in_a", F.lit(1)), b.select(key).distinct().withColumn("in_b", F.lit(1))
    side = F.when(F.col("in_a").isNotNull() & F.col("in_b").isNotNull(), "both").when(F.col("in_a").isNotNull(), "only_a").otherwise("only_b")
    return x.join(y, key, "full").groupBy(side.alias("side")).agg(F.count("*").alias("n"))
