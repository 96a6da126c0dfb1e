"""Pairs of rows that share a key, without an unbounded group in any task, and groups of linked ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.session import cut

#: A key with more rows than this is split into chunks; each pair of chunks is a task's worth of its own.
CHUNK_ROWS = 1_000


def key_pairs(rows: DataFrame, key: str, id_col: str, chunk: int | None = None, carry: tuple[str, ...] = (), keep: Callable[[str, str], Column] | None = None) -> DataFrame:
    """Distinct (a, b), a < b, of ids that share a value of ``key``; no pair is left out.

    Hot keys are found by a pre-aggregated count and split by a hash of the id into chunks: each row goes to
    the cells (own chunk, other chunk), so that a key's pairs spread over many tasks. Keys of one row go no further. Null keys pair nothing.
    ``keep``, a condition on the columns ``carry`` of both sides (it gets the sides' suffixes, in either order), is tested where rows meet, so
    that pairs which fail it are never written.
    """
    chunk = chunk or CHUNK_ROWS
    rows = rows.select(F.col(key).alias("k"), F.col(id_col).alias("id"), *carry).filter("k IS NOT NULL AND id IS NOT NULL")
    shared = rows.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1").select("k", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    placed = rows.join(shared, "k").withColumn("c", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    left = placed.select("k", F.col("id").alias("x"), *[F.col(c).alias(f"{c}_x") for c in carry], F.col("c").alias("ci"), F.explode(F.sequence("c", F.col("chunks") - 1)).alias("cj"))
    right = placed.select("k", F.col("id").alias("y"), *[F.col(c).alias(f"{c}_y") for c in carry], F.explode(F.sequence(F.lit(0), F.col("c"))).alias("ci"), F.col("c").alias("cj"))
    met = left.join(right, ["k", "ci", "cj"]).filter((F.col("x") != F.col("y")) & ((F.col("ci") < F.col("cj")) | (F.col("x") < F.col("y"))))
    if keep is not None:
        met = met.filter(keep("_x", "_y"))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 50) -> DataFrame:
    """(id, component): the smallest id that links of any length lead to, for every id in an edge.

    Alternating large-star and small-star contraction: every round moves links towards the smallest
    neighbour, and the number of rounds grows with the logarithm of the longest path. Rounds end when the
    links no longer change; each round's table is cut into the shared checkpoint folder.
    """
    links = cut(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    before = None
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        links = cut(small.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"links still move after {rounds} rounds")
    leaves = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return leaves.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
