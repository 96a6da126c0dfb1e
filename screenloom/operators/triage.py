"""Lists for reviewers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.functions.keys import DESIGN_WORDS, truncate_text
from screenloom.operators.votes import decision_of

# Reasons for a flag and the words that show them, in order.
FLAG_REASONS = {
    "age_overlap": ("overlap",),
    "do_not_exclude_population": ("postpartum", "postnatal", "do-not-exclude", "do not exclude"),
    "governance_safety_carveout": ("governance", "ethics", "safety", "regulation", "carve-out", "carveout"),
    "possible_duplicate": ("sibling", "defer-to-merge", "defer to merge"),
    "ambiguous_ai_component": ("ambiguous", "unclear"),
    "feasibility_dev_study": ("feasibility", "usability", "development"),
    "model_defensive_flag": ("second opinion", "needs_second_opinion"),
}


def flag_reasons(explanation: Column) -> Column:
    """Reasons in order, joined by ';', or 'other'."""
    text = F.lower(F.coalesce(explanation, F.lit("")))
    hits = []
    for name, words in FLAG_REASONS.items():
        test = text.contains(words[0])
        for w in words[1:]:
            test = test | text.contains(w)
        hits.append(F.when(test, name))
    found = F.concat_ws(";", *hits)
    return F.when(found == "", "other").otherwise(found)


def design_words(text: Column) -> Column:
    """Words for a study design that a text holds."""
    plain = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.array(*map(F.lit, DESIGN_WORDS)), lambda w: plain.contains(w))


def first_runs(results: DataFrame) -> DataFrame:
    """The first run of each record: smallest model, run and result."""
    keep = ["result_id", "screening_code", "screening_decision", "explanation", "supporting_quote", "flags", "needs_second_opinion"]
    return results.groupBy("record_id").agg(F.min_by(F.struct(*keep), F.struct("model", "run_idx", "result_id")).alias("r")).select("record_id", "r.*")


def with_record(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Rows with year and title of the record's first delivery, '' where it has none."""
    first = records.groupBy("record_id").agg(F.min_by(F.struct("year", "title", "abstract"), "row_no").alias("x"))
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c.split(".")[1])
    return rows.join(first, "record_id", "left").select(rows["*"], blank("x.year"), blank("x.title"), blank("x.abstract"))


def exclude_list(results: DataFrame, records: DataFrame) -> DataFrame:
    rows = first_runs(results).filter(decision_of(F.col("screening_decision")) == "EXCLUDE")
    return with_record(rows, records).select("record_id", "year", "title", "screening_code", F.array_join("flags", ";").alias("flag_text"))


def flagged_includes(results: DataFrame, records: DataFrame) -> DataFrame:
    rows = first_runs(results).filter((decision_of(F.col("screening_decision")) == "INCLUDE") & F.col("needs_second_opinion"))
    return with_record(rows, records).select("record_id", "year", "title", flag_reasons(F.col("explanation")).alias("reasons"), F.array_join("flags", ";").alias("flag_text"))


def review_table(results: DataFrame, records: DataFrame) -> DataFrame:
    """For human review: texts shortened, decision columns blank."""
    rows = with_record(first_runs(results).filter("needs_second_opinion"), records)
    return rows.select("record_id", F.substring("title", 1, 200).alias("title"), "year", F.substring("abstract", 1, 500).alias("abstract"), "screening_code", F.lit("").alias("human_decision"), F.lit("").alias("human_notes"))


def text_audit(documents: DataFrame, low: int = 200, limit: int = 1500) -> DataFrame:
    """Texts that are missing, short (kept all the same) or longer than the limit, with their length after the cut."""
    n = F.length("text")
    reason = F.when(F.coalesce(n, F.lit(0)) == 0, "missing").when(n < low, "low_text").when(n > limit, "truncated")
    return documents.select("doc_id", reason.alias("reason"), n.cast("bigint").alias("n"), F.length(truncate_text(F.col("text"), limit)).cast("bigint").alias("kept")).filter("reason IS NOT NULL")
