"""Verdicts against human labels: confusion, agreement, calibration error and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.operators.votes import INCLUDE_CODE

# Human labels and the codes they stand for.
LABEL_CODES = {
    "EXCLUDE on language": "EXCLUDE_LANGUAGE",
    "EXCLUDE on publication year (< 2015)": "EXCLUDE_YEAR",
    "EXCLUDE on population": "EXCLUDE_POPULATION",
    "EXCLUDE on topic/interest": "EXCLUDE_TOPIC",
    "EXCLUDE on evidence/record type": "EXCLUDE_EVIDENCE_TYPE",
    "EXCLUDE on duplicate publication": "EXCLUDE_DUPLICATE",
    "INCLUDE on title & abstract": "INCLUDE_TA",
    "EXCLUDE on intervention": "EXCLUDE_INTERVENTION_TOPIC",
    "EXCLUDE on study design": "EXCLUDE_STUDY_DESIGN",
    "EXCLUDE on outcome": "EXCLUDE_OUTCOME",
    "EXCLUDE on context/geography": "EXCLUDE_CONTEXT_GEOGRAPHY",
    "EXCLUDE on time/language": "EXCLUDE_TIME_LANGUAGE",
    "EXCLUDE - duplicate (provide ID in info box)": "EXCLUDE_DUPLICATE",
}
BINS = 10
#: Acceptance: sensitivity, kappa, calibration error.
ACCEPT = (0.95, 0.70, 0.10)


def mapped_labels(labels: DataFrame) -> DataFrame:
    """Every label row with its code: exact match after blanks around it are cut, else null."""
    table = F.create_map(*[F.lit(x) for pair in LABEL_CODES.items() for x in pair])
    return labels.select("record_id", F.col("current_gt_label").alias("label"), table[F.regexp_replace("current_gt_label", r"^\s+|\s+$", "")].alias("code"))


def truth(labels: DataFrame) -> DataFrame:
    """(record_id, y) of records with a mapped label; rows have no order here, so of conflicting labels INCLUDE wins."""
    return mapped_labels(labels).filter("code IS NOT NULL AND record_id IS NOT NULL").groupBy("record_id").agg(F.max((F.col("code") == INCLUDE_CODE).cast("int")).alias("y"))


def unmapped(labels: DataFrame) -> DataFrame:
    """Labels that match nothing, with their number: an audit instead of a silent loss."""
    return mapped_labels(labels).filter("code IS NULL").groupBy("label").agg(F.count("*").alias("n"))


def scored(verdicts: DataFrame, labels: DataFrame) -> DataFrame:
    """Verdicts that have a label: (record_id, p, predicted, y, code)."""
    return verdicts.join(truth(labels), "record_id").select("record_id", F.col("vote_share_include").alias("p"), (F.col("vote_share_include") >= 0.5).cast("int").alias("predicted"), "y", F.col("screening_code").alias("code"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b == 0, 0.0).otherwise(a / b)


def counts(predicted: Column, y: Column) -> list[Column]:
    cells = {"tp": (1, 1), "fp": (1, 0), "fn": (0, 1), "tn": (0, 0)}
    return [F.count_if((predicted == p) & (y == t)).alias(name) for name, (p, t) in cells.items()]


def with_metrics(df: DataFrame) -> DataFrame:
    """Adds sensitivity, specificity, precision, f1 and kappa to rows of tp, fp, fn, tn; zero denominators give 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    chance = ratio((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    return df.withColumns(
        {
            "n": (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")),
            "sensitivity": F.round(ratio(tp, tp + fn), 6),
            "specificity": F.round(ratio(tn, tn + fp), 6),
            "precision": F.round(ratio(tp, tp + fp), 6),
            "f1": F.round(ratio(2 * tp, 2 * tp + fp + fn), 6),
            "kappa": F.round(ratio(ratio(tp + tn, n) - chance, 1 - chance), 6),
        }
    )


def confusion(rows: DataFrame) -> DataFrame:
    return with_metrics(rows.agg(*counts(F.col("predicted"), F.col("y"))))


def reliability(rows: DataFrame) -> DataFrame:
    """Ten bins of the share; p = 1 falls in the last, empty bins stand with null means."""
    bins = rows.groupBy(F.least(F.floor(F.col("p") * 10), F.lit(BINS - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.avg("p").alias("p"), F.avg("y").alias("y"))
    every = rows.sparkSession.range(BINS).select(F.col("id").cast("int").alias("bin"))
    return every.join(bins, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), F.round("p", 6).alias("mean_p"), F.round("y", 6).alias("mean_y"), F.col("p").alias("_p"), F.col("y").alias("_y"))


def binned(rows: DataFrame, *by: str) -> DataFrame:
    """Per bin of the share p, and of other columns: all that metrics are made of, so that they need the rows once only."""
    error = F.sum((F.col("p") - F.col("y")) ** 2).alias("b")
    return rows.groupBy(*by, F.least(F.floor(F.col("p") * 10), F.lit(BINS - 1)).alias("bin")).agg(*counts(F.col("predicted"), F.col("y")), F.count("*").alias("n"), F.sum("p").alias("p"), F.sum("y").alias("y"), error)


def _ece_brier() -> list[Column]:
    return [F.round(F.sum(F.abs(F.col("p") - F.col("y"))) / F.sum("n"), 6).alias("ece"), F.round(F.sum("b") / F.sum("n"), 6).alias("brier")]


def _cells() -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn", "tn")]


def ece_brier(rows: DataFrame) -> DataFrame:
    """Expected calibration error over the bins, Brier score, number of records."""
    return binned(rows).agg(F.sum("n").alias("n"), *_ece_brier())


def calibration(rows: DataFrame) -> DataFrame:
    """One row: confusion, metrics, calibration error, Brier score and whether each threshold is met."""
    one = binned(rows).agg(*_cells(), *_ece_brier())
    return with_metrics(one).withColumns({"sensitivity_ok": F.col("sensitivity") >= ACCEPT[0], "kappa_ok": F.col("kappa") >= ACCEPT[1], "ece_ok": F.col("ece") <= ACCEPT[2]})


def per_model(models: DataFrame, labels: DataFrame) -> DataFrame:
    """Metrics of each model, with its own calibration error; its class is the majority decision, not a share of one half."""
    rows = models.join(truth(labels), "record_id").withColumns({"predicted": (F.col("decision") == "INCLUDE").cast("int"), "p": F.col("vote_share_include")})
    return with_metrics(binned(rows, "model").groupBy("model").agg(*_cells(), *_ece_brier()))


def inter_model(models: DataFrame, least_common: int = 2) -> DataFrame:
    """Agreement and kappa of every pair of models over the records both judged; null under ``least_common``."""
    a = models.select("record_id", F.col("model").alias("model_a"), (F.col("decision") == "INCLUDE").cast("int").alias("x"))
    b = models.select("record_id", F.col("model").alias("model_b"), (F.col("decision") == "INCLUDE").cast("int").alias("y"))
    both = a.join(b, "record_id").filter("model_a < model_b").groupBy("model_a", "model_b").agg(*counts(F.col("x"), F.col("y")))
    enough = F.col("n") >= least_common
    return with_metrics(both).select("model_a", "model_b", F.col("n").alias("n_common"), F.when(enough, F.round((F.col("tp") + F.col("tn")) / F.col("n"), 6)).alias("agreement"), F.when(enough, F.col("kappa")).alias("kappa"))


def errors(rows: DataFrame) -> DataFrame:
    """False positives and false negatives at one half."""
    return rows.filter("predicted <> y").select("record_id", F.when(F.col("predicted") == 1, "FP").otherwise("FN").alias("error_type"), F.col("p").alias("vote_share_include"), "code")


def cutoffs(rows: DataFrame, at: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Recall, precision and workload at each cutoff; cutoff 0 means a share above 0."""
    parts = []
    for c in at:
        hit = (F.col("p") > 0) if c == 0 else (F.col("p") >= c)
        parts += [F.count_if(hit).alias(f"h{c}"), F.count_if(hit & (F.col("y") == 1)).alias(f"t{c}")]
    one = rows.agg(F.count("*").alias("n"), F.sum("y").alias("pos"), *parts)  # one pass, one row
    stack = F.array(*[F.struct(F.lit(c).alias("cutoff"), F.col(f"`h{c}`").alias("flagged"), F.col(f"`t{c}`").alias("hits")) for c in at])
    long = one.select("n", "pos", F.explode(stack).alias("c")).select("n", "pos", "c.*")
    return long.select("cutoff", "flagged", F.round(ratio(F.col("hits"), F.col("pos")), 6).alias("recall"), F.round(ratio(F.col("hits"), F.col("flagged")), 6).alias("precision"), F.round(ratio(F.col("flagged"), F.col("n")), 6).alias("workload"))


def bands(rows: DataFrame) -> DataFrame:
    """Verdicts and positives by band of the share: to .3, below .5, below .7, and above."""
    p = F.col("p")
    band = F.when(p <= 0.3, "a: to .3").when(p < 0.5, "b: to .5").when(p < 0.7, "c: to .7").otherwise("d: from .7")
    return rows.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.sum("y").alias("n_positive"))


def adjudication(labels: DataFrame) -> DataFrame:
    """Two blind adjudicators against label and pipeline: both back the label, both back the pipeline, or fuzzy; none
    valid is its own verdict, and a single valid vote is fuzzy. Rows whose label says nothing are left out."""
    say = lambda c: F.when(F.upper(F.trim(c)).isin("INCLUDE", "EXCLUDE"), F.upper(F.trim(c)))
    label = F.upper(F.regexp_replace("current_gt_label", r"^\s+", ""))
    base = labels.select("record_id", F.when(label.startswith("INCLUDE"), "INCLUDE").when(label.startswith("EXCLUDE"), "EXCLUDE").alias("gt"), say("pipeline_decision").alias("pipeline"), say("gpt4o_decision").alias("a"), say("gemini_decision").alias("b"))
    n = F.col("a").isNotNull().cast("int") + F.col("b").isNotNull().cast("int")
    both = (n == 2) & (F.col("a") == F.col("b"))
    verdict = F.when(n == 0, "no_valid").when(both & (F.col("a") == F.col("gt")), "gt_robust").when(both & (F.col("a") == F.col("pipeline")), "gt_error_candidate").otherwise("fuzzy_boundary")
    return base.filter("gt IS NOT NULL").select("record_id", "gt", "pipeline", verdict.alias("verdict"))


def what_if(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Confusion of the scored records as it is and with labels corrected where both adjudicators contradict them."""
    fix = verdicts.filter("verdict = 'gt_error_candidate'").select("record_id").distinct().withColumn("fix", F.lit(1))
    both = rows.join(fix, "record_id", "left").withColumn("fixed", F.when(F.col("fix").isNotNull(), 1 - F.col("y")).otherwise(F.col("y")))
    long = both.select("predicted", F.explode(F.array(F.struct(F.lit("as it is").alias("scenario"), F.col("y").alias("t")), F.struct(F.lit("corrected").alias("scenario"), F.col("fixed").alias("t")))).alias("s"))
    return with_metrics(long.groupBy("s.scenario").agg(*counts(F.col("predicted"), F.col("s.t"))))


def distribution(df: DataFrame, column: Column, name: str = "value") -> DataFrame:
    """Number of rows per value, null included."""
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("n"))


def flag_projection(rows: DataFrame, corpus: int) -> DataFrame:
    """One row from (share) per record, null where no answer is valid: records, flagged ones (any INCLUDE), sure excludes, their rates, and both
    projected to a corpus of so many records."""
    one = rows.agg(F.count("*").alias("n"), F.count_if(F.coalesce("share", F.lit(0.0)) > 0).alias("flagged"), F.count_if(F.col("share") == 0).alias("sure_exclude"))
    rate, sure = F.try_divide("flagged", "n"), F.try_divide("sure_exclude", "n")
    return one.select("n", "flagged", "sure_exclude", F.round(rate, 6).alias("flag_rate"), F.round(sure, 6).alias("sure_rate"), F.round(rate * corpus).cast("bigint").alias("projected_flags"), F.round(sure * corpus).cast("bigint").alias("projected_sure"))


def metrics_of_counts(spark: SparkSession, tp: int, fp: int, fn: int, tn: int) -> DataFrame:
    """The metrics of one given confusion table."""
    return with_metrics(spark.createDataFrame([(tp, fp, fn, tn)], "tp bigint, fp bigint, fn bigint, tn bigint"))
