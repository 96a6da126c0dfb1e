"""Retrieval inventory: parents and children, attachments, worklists, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenloom.functions import keys


def with_child(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    return parents.join(children.select(key), key, "left_semi")


def without_child(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    return parents.join(children.select(key), key, "left_anti")


def all_children(children: DataFrame, key: str, test: Column) -> DataFrame:
    """Keys with at least one child of which all pass the test; a null test fails."""
    return children.groupBy(key).agg(F.bool_and(F.coalesce(test, F.lit(False))).alias("ok")).filter("ok").select(key)


def best_child(children: DataFrame, key: str, order: list[Column], keep: list[str]) -> DataFrame:
    """The first child of each parent by ``order``; a combined minimum, so a huge parent is no hot task."""
    return children.groupBy(key).agg(F.min(F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)], *keep)).alias("m")).select(key, *[f"m.{c}" for c in keep])


def missing(library: DataFrame) -> DataFrame:
    """Items without a file that have a real DOI, with their publisher."""
    doi = F.trim(F.coalesce("doi", F.lit("")))
    return library.filter(~keys.is_true(F.col("has_pdf")) & (doi != "") & ~keys.is_stub(doi)).withColumn("publisher", keys.publisher(doi))


def numbered(rows: DataFrame, by: list[str], tie: list[str]) -> DataFrame:
    """Rows with their number in the order of ``by``, then ``tie``. Groups are numbered on their own and shifted by the
    sizes of those before, so no task sees all rows; only the table of group sizes is ordered as a whole."""
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select(*[F.col(c).alias(f"s_{c}") for c in by], before.alias("shift"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*tie))
    same = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in by]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return rows.withColumn("_r", rank).join(shifts, on).withColumn("number", F.col("_r") + F.col("shift")).drop("_r", "shift", *[f"s_{c}" for c in by])


def coverage(library: DataFrame) -> DataFrame:
    """Per item type: items, with DOI, with file, with both."""
    doi, pdf = F.trim(F.coalesce("doi", F.lit(""))) != "", keys.is_true(F.col("has_pdf"))
    return library.groupBy("item_type").agg(F.count("*").alias("n"), F.count_if(doi).alias("with_doi"), F.count_if(pdf).alias("with_pdf"), F.count_if(doi & pdf).alias("with_both"))


def mentioning(notes: DataFrame, key: str, text: str, word: str) -> DataFrame:
    """Parents with a note that holds the word, and the number of their notes; texts are tested one by one and never joined
    into one per parent."""
    hit = F.coalesce(F.lower(keys.strip_tags(F.col(text))).contains(word), F.lit(False))
    return notes.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_notes"), F.count_if(hit).alias("n_hits")).filter("n_hits > 0")


def files_by_key(files: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """File names joined to items by the part before the first '_'; the exact name wins, then the first by name."""
    owned = files.withColumn(key, F.split_part("file", F.lit("_"), F.lit(1))).join(items.select(key, "expected"), key)
    return best_child(owned, key, [F.col("file") != F.col("expected"), F.col("file")], ["file"])


def numbered_all(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows of a report with their place in an order; for tables of groups, which are small: one task orders them."""
    return rows.withColumn("place", F.row_number().over(Window.orderBy(*order)))
