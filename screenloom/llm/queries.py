"""The pN_ queries: each applies an operator to its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.llm import abuse, characters, consensus, leakage, names, nearduplicates, titles, tokenization, truncation
from screenloom.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles.already_there(table(spark, sf_dir, "records")).select("row_no")


def p1_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles.already_there(table(spark, sf_dir, "records"))


#: Likeness of p2, over runs of three words, as its statement asks.
P2_WORDS, P2_LIKENESS = 3, 0.5


def p2_operator(spark: SparkSession, sf_dir: str) -> nearduplicates.NearDuplicates:
    rows = table(spark, sf_dir, "records").filter("abstract IS NOT NULL AND abstract NOT IN ('', 'NA')")
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.col("abstract"))
    return nearduplicates.NearDuplicates(rows, "row_no", text, P2_WORDS, P2_LIKENESS)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_operator(spark, sf_dir).pairs().toDF("row_no_a", "row_no_b")


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_operator(spark, sf_dir).groups().withColumnRenamed("id", "row_no")


def p3_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "library_export")
    blanks = r"^\s+|\s+$"
    people = rows.select(F.lit("authors").alias("field"), F.explode(F.split("authors", ";")).alias("name"))
    periodicals = rows.select(F.lit("publication").alias("field"), F.col("publication").alias("name"))
    return names.entities(people.unionByName(periodicals).withColumn("name", F.regexp_replace("name", blanks, "")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.spelling_pairs(p3_operator(spark, sf_dir))


def p3_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_operator(spark, sf_dir)


def p4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, row_key, text) of the two fields that are compared with each other."""
    a = table(spark, sf_dir, "records").select(F.lit("records.abstract").alias("field"), F.col("row_no").alias("row_key"), F.col("abstract").alias("text"))
    b = table(spark, sf_dir, "results").select(F.lit("results.supporting_quote").alias("field"), F.col("result_id").alias("row_key"), F.col("supporting_quote").alias("text"))
    return a.unionByName(b)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return characters.consistent_form(p4_texts(spark, sf_dir)).filter("is_case").select("field", "row_key")


def p4_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return characters.consistent_form(p4_texts(spark, sf_dir)).select("field", "row_key", "text")


def p5_operator(spark: SparkSession, sf_dir: str) -> consensus.Consensus:
    records = table(spark, sf_dir, "records").filter("record_id IS NOT NULL")
    text = F.concat_ws(" ", "title", "abstract")
    texts = records.groupBy(F.col("record_id").alias("item")).agg(F.min_by(text, F.col("row_no")).alias("text"))
    votes = table(spark, sf_dir, "results").select("record_id", "model", "screening_decision")
    labels = table(spark, sf_dir, "gt_error_candidates_5_fp").select("record_id", "current_gt_label")
    return consensus.Consensus(votes, labels, texts)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_operator(spark, sf_dir).items().select(F.col("item").alias("record_id"), "decision")


def p5_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_operator(spark, sf_dir).items().withColumnRenamed("item", "record_id")


def p5_annotators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_operator(spark, sf_dir).annotators()


def p5_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_operator(spark, sf_dir).agreement()


def p6_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "records").select(F.lit("records.abstract").alias("field"), F.col("row_no").alias("row_key"), F.col("source_file").alias("source"), F.col("abstract").alias("text"))
    b = table(spark, sf_dir, "results").select(F.lit("results.explanation").alias("field"), F.col("result_id").alias("row_key"), F.col("model").alias("source"), F.col("explanation").alias("text"))
    return truncation.judged(a.unionByName(b).filter("text NOT IN ('', 'NA')"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_judged(spark, sf_dir).filter("cut").select("field", "row_key")


def p6_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.rates(p6_judged(spark, sf_dir))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenization.encode(table(spark, sf_dir, "documents"))


def p7_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenization.encode_with_offsets(table(spark, sf_dir, "documents"))


def p7_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenization.roundtrip(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leakage.leaked(found).select("item_id", "doc_id")


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return leakage.item_report(items, leakage.leaked(leakage.leaks(table(spark, sf_dir, "documents"), items)))


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_scores(spark, sf_dir).filter("flagged").select("doc_id")


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.rates(p9_scores(spark, sf_dir))


QUERIES = {
    "p1_found": p1_found,
    "p1_reasons": p1_reasons,
    "p2_found": p2_found,
    "p2_groups": p2_groups,
    "p3_found": p3_found,
    "p3_entities": p3_entities,
    "p4_found": p4_found,
    "p4_normalized": p4_normalized,
    "p5_found": p5_found,
    "p5_items": p5_items,
    "p5_annotators": p5_annotators,
    "p5_agreement": p5_agreement,
    "p6_found": p6_found,
    "p6_judged": p6_judged,
    "p6_rates": p6_rates,
    "p7_ids": p7_ids,
    "p7_offsets": p7_offsets,
    "p7_roundtrip": p7_roundtrip,
    "p8_found": p8_found,
    "p8_items": p8_items,
    "p9_found": p9_found,
    "p9_scores": p9_scores,
    "p9_rates": p9_rates,
}
