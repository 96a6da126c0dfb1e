"""Exemplars by BM25 over an inverted index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenloom.functions.keys import tokens

K1, B, EPSILON = 1.5, 0.75, 0.25


def index(pool: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf, dl) of every document of the pool; null texts have no terms."""
    rows = pool.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("t"))
    return rows.select("id", F.size("t").alias("dl"), F.explode("t").alias("term")).groupBy("id", "term", "dl").agg(F.count("*").alias("tf"))


def bm25(pool: DataFrame, queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(q, id, score) of all pool documents that share a term with the query, the query's own document apart.

    Repeated query terms count by their number; a term in more than half of the documents gets EPSILON times the mean
    idf instead of a negative one. The collection's totals are one row; the join is on the term.
    """
    own = index(pool, id_col, text_col)
    asked = index(queries, id_col, text_col).select(F.col("id").alias("q"), "term", F.col("tf").alias("qf"))
    total = pool.select(F.size(tokens(F.col(text_col))).alias("dl")).agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    df = own.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(total))  # one row
    raw = df.withColumn("idf", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    mean = raw.agg(F.avg("idf").alias("mean"))
    terms = raw.crossJoin(F.broadcast(mean)).select("term", "avgdl", F.when(F.col("idf") < 0, EPSILON * F.col("mean")).otherwise(F.col("idf")).alias("idf"))  # one row
    hits = asked.join(terms, "term").join(own, "term").filter("q <> id")
    part = F.col("qf") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return hits.groupBy("q", "id").agg(F.sum(part).alias("score"))


def top(scores: DataFrame, n: int = 16) -> DataFrame:
    """The best n documents of each query; ties go to the smaller id."""
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc(F.round("score", 6)), "id"))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= n).select("q", "id", F.round("score", 4).alias("score"), "rank")


def balanced(best: DataFrame, labels: DataFrame, n: int = 4) -> DataFrame:
    """Of each query's best documents, n that alternate between the labels, negatives first. ``labels``: (id, label 0/1)."""
    ranked = best.join(labels, "id").withColumn("within", F.row_number().over(Window.partitionBy("q", "label").orderBy("rank")))
    place = F.row_number().over(Window.partitionBy("q").orderBy("within", "label"))
    return ranked.withColumn("place", place).filter(F.col("place") <= n).select("q", "id", "label", "place")


def split(labels: DataFrame, share: float = 0.4, seed: int = 42) -> DataFrame:
    """(id, label, part): a test part of that share of each label, rounded half to even, in order of a hash of the id."""
    size = labels.groupBy("label").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit(f"|{seed}"))), "id"))
    return labels.withColumn("r", rank).join(F.broadcast(size), "label").select("id", "label", F.when(F.col("r") <= F.bround(F.col("n") * share), "test").otherwise("train").alias("part"))  # a row per label


def sample(rows: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in order of a hash of the id: the sampling operator."""
    return rows.orderBy(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}"))), id_col).limit(n)
