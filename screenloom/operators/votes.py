"""From runs (one model response each) to one verdict per record.

Every operator is a two-level aggregation whose first level (record, model, code) is combined on the map side, so a
record that was screened a million times shuffles a handful of rows. No window over a record's runs is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INCLUDE_CODE = "INCLUDE_TA"
BAND = (0.4, 0.6)


def decision_of(column: Column) -> Column:
    """INCLUDE or EXCLUDE without case and surrounding blanks; anything else is null."""
    plain = F.upper(F.regexp_replace(column, r"^\s+|\s+$", ""))
    return F.when(plain.isin("INCLUDE", "EXCLUDE"), plain)


def runs(results: DataFrame) -> DataFrame:
    """The long table of runs; a missing code stays null."""
    return results.select(
        "result_id", "record_id", "model", "run_idx", F.col("screening_code").alias("code"), decision_of(F.col("screening_decision")).alias("decision"),
        F.coalesce("needs_second_opinion", F.lit(False)).alias("run_flagged"), F.coalesce("flags", F.array().cast("array<string>")).alias("flags"),
    )


def code_level(rows: DataFrame) -> DataFrame:
    """(record_id, model, code): n, whether a run was flagged, and the first run; a missing code counts as INCLUDE_TA
    in the counts but not in the share of includes, which is kept apart as n_include."""
    code = F.coalesce("code", F.lit(INCLUDE_CODE))
    return rows.groupBy("record_id", "model", code.alias("code")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("code") == INCLUDE_CODE).alias("n_include"),
        F.bool_or("run_flagged").alias("run_flagged"),
        F.min(F.struct("run_idx", "result_id")).alias("first"),
    )


def code_counts(rows: DataFrame) -> DataFrame:
    """Codes of a record over all models, as rows (record_id, code, n)."""
    return code_level(rows).groupBy("record_id", "code").agg(F.sum("n").alias("n"))


def code_count_maps(rows: DataFrame) -> DataFrame:
    """The same as a map per record."""
    return code_counts(rows).groupBy("record_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("code", "n")))).alias("code_counts"))


def _majority(order: list[str]) -> Column:
    """Most frequent code; of equally frequent ones the code seen first in run order, not the smallest."""
    return F.min(F.struct((-F.col("n")).alias("neg"), *order, "code"))


def per_model(rows: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """One row per record and model: share of includes, majority, tier of confidence, and whether it is flagged."""
    grouped = code_level(rows).groupBy("record_id", "model").agg(
        F.sum("n").alias("n_runs"), F.sum("n_include").alias("n_include"), F.max("n").alias("top"), F.bool_or("run_flagged").alias("run_flagged"), _majority(["first"]).alias("best")
    )
    share, top = F.col("n_include") / F.col("n_runs"), F.col("top") / F.col("n_runs")
    tier = F.when(top >= 1.0, "High").when(top >= 0.6, "Medium").otherwise("Low")
    return grouped.select(
        "record_id", "model", "n_runs", F.round(share, 6).alias("vote_share_include"), F.col("best.code").alias("majority_code"),
        F.when(F.col("best.code") == INCLUDE_CODE, "INCLUDE").otherwise("EXCLUDE").alias("decision"), tier.alias("confidence"),
        share.between(*band).alias("in_band"), (F.col("run_flagged") | share.between(*band)).alias("flagged"), "run_flagged",
    )


def verdicts(rows: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """One row per record over the flat pool of runs. A second opinion is needed if models disagree, if the pooled or
    a model's share lies in the closed band, or if a run asked for it."""
    level = code_level(rows)
    pooled = level.groupBy("record_id", "code").agg(F.sum("n").alias("n"), F.sum("n_include").alias("n_include"), F.min(F.struct("model", "first")).alias("first"))
    pooled = pooled.groupBy("record_id").agg(F.sum("n").alias("n_runs"), F.sum("n_include").alias("n_include"), _majority(["first"]).alias("best"))
    models = per_model(rows, band).groupBy("record_id").agg(F.count("*").alias("n_models"), (F.min("decision") == F.max("decision")).alias("model_agreement"), F.bool_or("flagged").alias("model_flagged"))
    share = F.col("n_include") / F.col("n_runs")
    return pooled.join(models, "record_id").select(
        "record_id", F.col("best.code").alias("screening_code"), F.when(F.col("best.code") == INCLUDE_CODE, "INCLUDE").otherwise("EXCLUDE").alias("screening_decision"),
        F.round(share, 6).alias("vote_share_include"), "n_runs", "n_models", "model_agreement", share.between(*band).alias("in_uncertainty_band"),
        (~F.col("model_agreement") | share.between(*band) | F.col("model_flagged")).alias("needs_second_opinion"),
    )


def disagreements(found: DataFrame) -> DataFrame:
    """Verdicts inside the open band."""
    return found.filter((F.col("vote_share_include") > BAND[0]) & (F.col("vote_share_include") < BAND[1]))


def tie_window(found: DataFrame, width: float = 0.1) -> DataFrame:
    """Verdicts whose share is at most ``width`` from one half."""
    return found.filter(F.abs(F.col("vote_share_include") - F.lit(0.5)) <= width)


def merge_panels(old: DataFrame, new: DataFrame, from_old: list[str], from_new: list[str]) -> DataFrame:
    """Runs of some models from one file and of others from another: the union is aggregated again."""
    return old.filter(F.col("model").isin(from_old)).unionByName(new.filter(F.col("model").isin(from_new)))


def critic_override(found: DataFrame, critic: DataFrame) -> DataFrame:
    """Verdicts with the critic's code and decision where it answered on a flagged record; the share stays.

    ``critic``: (record_id, critic_code, critic_flag), at most one row per record.
    """
    joined = found.join(critic, "record_id", "left")
    applied = F.col("needs_second_opinion") & F.col("critic_code").isNotNull()
    code = F.when(applied, F.col("critic_code")).otherwise(F.col("screening_code"))
    return joined.select(
        "record_id", code.alias("screening_code"), F.when(code == INCLUDE_CODE, "INCLUDE").otherwise("EXCLUDE").alias("screening_decision"), "vote_share_include",
        applied.alias("critic_applied"), (applied & (F.col("critic_code") != F.col("screening_code"))).alias("critic_overrode"),
        F.when(applied, F.coalesce("critic_flag", F.lit(False))).otherwise(F.col("needs_second_opinion")).alias("needs_second_opinion"),
    )


def tiebreak(found: DataFrame, third: DataFrame) -> DataFrame:
    """Verdicts in the open band get a third vote: majority of three, share n/3, flagged if alone or if the third is
    unsure. ``third``: (record_id, third_vote 0/1, third_unsure)."""
    tied = disagreements(found).join(third, "record_id")
    yes = F.round(F.col("vote_share_include") * 2).cast("bigint") + F.col("third_vote")
    return tied.select(
        "record_id", yes.alias("votes"), F.when(yes >= 2, "INCLUDE").otherwise("EXCLUDE").alias("screening_decision"), F.round(yes / F.lit(3.0), 6).alias("vote_share_include"),
        ((yes == 1) | F.coalesce("third_unsure", F.lit(False))).alias("needs_second_opinion"),
    )


def valid_share(rows: DataFrame) -> DataFrame:
    """Share of INCLUDE among valid decisions per record; null, and no decision, if none is valid."""
    share = F.avg((F.col("decision") == "INCLUDE").cast("double"))
    return rows.groupBy("record_id").agg(share.alias("s"), F.count("decision").alias("n_valid"), F.count("*").alias("n_runs")).select(
        "record_id", "n_runs", "n_valid", F.round("s", 6).alias("share"), F.when(F.col("s") >= 0.5, "INCLUDE").when(F.col("s") < 0.5, "EXCLUDE").alias("decision")
    )


def agreement_stats(found: DataFrame) -> DataFrame:
    """One row over all verdicts: how many models agree, disagree, and how many verdicts need a second opinion."""
    return found.agg(F.count("*").alias("n"), F.count_if("model_agreement").alias("agree"), F.count_if(~F.col("model_agreement")).alias("disagree"), F.count_if("needs_second_opinion").alias("flagged"))
