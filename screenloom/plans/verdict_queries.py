"""Queries of votes and calibration with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenloom.operators import calibration as cal
from screenloom.operators import votes
from screenloom.session import table


def _runs(spark, d):
    return votes.runs(table(spark, d, "results"))


def _labels(spark, d):
    return table(spark, d, "gt_error_candidates_5_fp")


def _scored(spark, d):
    return cal.scored(votes.verdicts(_runs(spark, d)), _labels(spark, d))


def _critic(spark, d):
    """A deterministic stand-in for the critic: its code follows from a hash of the record."""
    h = F.pmod(F.conv(F.substring(F.md5("record_id"), 1, 4), 16, 10).cast("bigint"), F.lit(5))
    return votes.verdicts(_runs(spark, d)).select("record_id", F.when(h < 2, "INCLUDE_TA").when(h == 2, "EXCLUDE_OUTCOME").when(h == 3, "EXCLUDE_POPULATION").alias("critic_code"), (h == 3).alias("critic_flag"))


def _third(spark, d):
    h = F.pmod(F.conv(F.substring(F.md5("record_id"), 1, 4), 16, 10).cast("bigint"), F.lit(4))
    return votes.verdicts(_runs(spark, d)).select("record_id", (h % 2).alias("third_vote"), (h == 3).alias("third_unsure"))


def _merged(spark, d):
    rows = _runs(spark, d)
    first, second = ["orlo-large-2", "quillon-4"], ["tessera-pro", "kestra-xl"]
    return votes.verdicts(votes.merge_panels(rows, rows, first, second))


QUERIES = {
    "panel_runs": lambda s, d: _runs(s, d).select("result_id", "record_id", "model", "run_idx", "code", "decision", "run_flagged"),
    "vote_share_per_model": lambda s, d: votes.per_model(_runs(s, d)).select("record_id", "model", "n_runs", "vote_share_include"),
    "majority_code": lambda s, d: votes.per_model(_runs(s, d)).select("record_id", "model", "majority_code", "decision"),
    "confidence_tier": lambda s, d: votes.per_model(_runs(s, d)).groupBy("model", "confidence").agg(F.count("*").alias("n")),
    "code_counts": lambda s, d: votes.code_counts(_runs(s, d)),
    "code_count_maps": lambda s, d: votes.code_count_maps(_runs(s, d)).select("record_id", F.to_json("code_counts").alias("code_counts")),
    "consensus_verdict": lambda s, d: votes.verdicts(_runs(s, d)),
    "needs_second_opinion": lambda s, d: votes.verdicts(_runs(s, d)).filter("needs_second_opinion").select("record_id"),
    "disagreement_band": lambda s, d: votes.disagreements(votes.verdicts(_runs(s, d))).select("record_id", "vote_share_include"),
    "tie_window": lambda s, d: votes.tie_window(votes.verdicts(_runs(s, d))).select("record_id", "vote_share_include"),
    "valid_vote_share": lambda s, d: votes.valid_share(_runs(s, d)),
    "merge_panels": _merged,
    "critic_override": lambda s, d: votes.critic_override(votes.verdicts(_runs(s, d)), _critic(s, d)),
    "tiebreak_majority3": lambda s, d: votes.tiebreak(votes.verdicts(_runs(s, d)), _third(s, d)),
    "label_map": lambda s, d: cal.mapped_labels(_labels(s, d)),
    "label_distribution": lambda s, d: cal.distribution(_labels(s, d), F.col("current_gt_label"), "label"),
    "unmapped_labels": lambda s, d: cal.unmapped(_labels(s, d)),
    "confusion_matrix": lambda s, d: cal.confusion(_scored(s, d)).select("tp", "fp", "fn", "tn"),
    "binary_metrics": lambda s, d: cal.confusion(_scored(s, d)),
    "reliability_bins": lambda s, d: cal.reliability(_scored(s, d)).drop("_p", "_y"),
    "ece_brier": lambda s, d: cal.ece_brier(_scored(s, d)),
    "calibration_metrics": lambda s, d: cal.calibration(_scored(s, d)),
    "per_model_metrics": lambda s, d: cal.per_model(votes.per_model(_runs(s, d)), _labels(s, d)),
    "inter_model_kappa": lambda s, d: cal.inter_model(votes.per_model(_runs(s, d))),
    "errors_fn_fp": lambda s, d: cal.errors(_scored(s, d)),
    "errors_by_label": lambda s, d: cal.errors(_scored(s, d)).join(_labels(s, d).select("record_id", F.col("current_gt_label").alias("label")), "record_id").groupBy("error_type", "label").agg(F.count("*").alias("n")),
    "cutoff_table": lambda s, d: cal.cutoffs(_scored(s, d)),
    "vote_bands": lambda s, d: cal.bands(_scored(s, d)),
    "score_distribution": lambda s, d: cal.distribution(votes.verdicts(_runs(s, d)), F.round("vote_share_include", 2), "share"),
    "adjudication_verdict": lambda s, d: cal.adjudication(_labels(s, d)),
    "label_correction_whatif": lambda s, d: cal.what_if(_scored(s, d), cal.adjudication(_labels(s, d))),
}

_DEC = r"upper(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"
RUNS = rf"""runs AS (SELECT result_id, record_id, model, run_idx, screening_code AS code,
  CASE WHEN {_DEC.format(c='screening_decision')} IN ('INCLUDE','EXCLUDE') THEN {_DEC.format(c='screening_decision')} END AS decision,
  coalesce(needs_second_opinion, false) AS run_flagged FROM results)"""


def models_sql(runs: str = "runs", name: str = "models") -> str:
    return f"""{name} AS (SELECT record_id, model, n_runs, n_include / n_runs AS share, code AS majority_code,
  CASE WHEN code = 'INCLUDE_TA' THEN 'INCLUDE' ELSE 'EXCLUDE' END AS decision, top / n_runs AS top_share, run_flagged,
  (run_flagged OR n_include / n_runs BETWEEN 0.4 AND 0.6) AS flagged FROM (
    SELECT record_id, model, coalesce(code, 'INCLUDE_TA') AS code,
      sum(count(*)) OVER (PARTITION BY record_id, model) AS n_runs,
      sum(count(*) FILTER (WHERE code = 'INCLUDE_TA')) OVER (PARTITION BY record_id, model) AS n_include,
      max(count(*)) OVER (PARTITION BY record_id, model) AS top,
      bool_or(bool_or(run_flagged)) OVER (PARTITION BY record_id, model) AS run_flagged,
      row_number() OVER (PARTITION BY record_id, model ORDER BY count(*) DESC, min(run_idx::bigint * 1000000000 + result_id)) AS rn
    FROM {runs} GROUP BY record_id, model, coalesce(code, 'INCLUDE_TA')) WHERE rn = 1)"""


def verdicts_sql(runs: str = "runs", models: str = "models") -> str:
    return f"""pooled AS (SELECT record_id, code, n_runs, n_include / n_runs AS share FROM (
    SELECT record_id, coalesce(code, 'INCLUDE_TA') AS code,
      sum(count(*)) OVER (PARTITION BY record_id) AS n_runs,
      sum(count(*) FILTER (WHERE code = 'INCLUDE_TA')) OVER (PARTITION BY record_id) AS n_include,
      row_number() OVER (PARTITION BY record_id ORDER BY count(*) DESC, min(model || '|' || lpad(cast(run_idx AS varchar), 6, '0') || '|' || lpad(cast(result_id AS varchar), 12, '0'))) AS rn
    FROM {runs} GROUP BY record_id, coalesce(code, 'INCLUDE_TA')) WHERE rn = 1),
verdicts AS (SELECT p.record_id, p.code AS screening_code, CASE WHEN p.code = 'INCLUDE_TA' THEN 'INCLUDE' ELSE 'EXCLUDE' END AS screening_decision,
  round(p.share, 6) AS vote_share_include, cast(p.n_runs AS bigint) AS n_runs, m.n_models, m.model_agreement, p.share BETWEEN 0.4 AND 0.6 AS in_uncertainty_band,
  (NOT m.model_agreement OR p.share BETWEEN 0.4 AND 0.6 OR m.model_flagged) AS needs_second_opinion
  FROM pooled p JOIN (SELECT record_id, count(*) AS n_models, min(decision) = max(decision) AS model_agreement, bool_or(flagged) AS model_flagged FROM {models} GROUP BY 1) m USING (record_id))"""


BASE = f"WITH {RUNS}, {models_sql()}, {verdicts_sql()}"
_MAP = ", ".join(f"('{k}', '{v}')" for k, v in cal.LABEL_CODES.items())
LABELS = rf"""codes(l, c) AS (VALUES {_MAP}),
mapped AS (SELECT record_id, current_gt_label AS label, c AS code FROM gt_error_candidates_5_fp LEFT JOIN codes ON regexp_replace(current_gt_label, '^\s+|\s+$', '', 'g') = l),
truth AS (SELECT record_id, max(CASE WHEN code = 'INCLUDE_TA' THEN 1 ELSE 0 END) AS y FROM mapped WHERE code IS NOT NULL GROUP BY 1),
scored AS (SELECT record_id, vote_share_include AS p, CASE WHEN vote_share_include >= 0.5 THEN 1 ELSE 0 END AS predicted, y, screening_code AS code FROM verdicts JOIN truth USING (record_id))"""
SCORED = f"{BASE}, {LABELS}"


def _cells(p: str = "predicted", y: str = "y") -> str:
    return ", ".join(f"count(*) FILTER (WHERE {p} = {a} AND {y} = {b}) AS {n}" for n, a, b in (("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1), ("tn", 0, 0)))


METRICS = """tp, fp, fn, tn, tp + fp + fn + tn AS n,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS sensitivity, round(CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END, 6) AS specificity,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0::double * tp / (2 * tp + fp + fn) END, 6) AS f1,
  round(CASE WHEN tp + fp + fn + tn = 0 THEN 0 WHEN (tp + fp) * (tp + fn) + (fn + tn) * (fp + tn) = (tp + fp + fn + tn) ** 2 THEN 0
    ELSE ((tp + tn) / (tp + fp + fn + tn) - ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) ** 2)) / (1 - ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) ** 2)) END, 6) AS kappa"""
_ECE = "(SELECT cast(sum(n) AS bigint) AS n, round(sum(abs(sp - sy)) / sum(n), 6) AS ece, round(sum(b) / sum(n), 6) AS brier FROM (SELECT least(floor(p * 10), 9) AS bin, count(*) AS n, sum(p) AS sp, sum(y) AS sy, sum((p - y) ** 2) AS b FROM scored GROUP BY 1))"
_HASH = "cast('0x' || substr(md5(record_id), 1, 4) AS bigint)"
_ADJ = r"""adj AS (SELECT record_id, gt, pipeline, CASE WHEN a IS NULL AND b IS NULL THEN 'no_valid' WHEN a = b AND a = gt THEN 'gt_robust' WHEN a = b AND a = pipeline THEN 'gt_error_candidate' ELSE 'fuzzy_boundary' END AS verdict FROM (
  SELECT record_id, CASE WHEN upper(regexp_replace(current_gt_label, '^\s+', '')) LIKE 'INCLUDE%' THEN 'INCLUDE' WHEN upper(regexp_replace(current_gt_label, '^\s+', '')) LIKE 'EXCLUDE%' THEN 'EXCLUDE' END AS gt,
  CASE WHEN upper(trim(pipeline_decision)) IN ('INCLUDE','EXCLUDE') THEN upper(trim(pipeline_decision)) END AS pipeline,
  CASE WHEN upper(trim(gpt4o_decision)) IN ('INCLUDE','EXCLUDE') THEN upper(trim(gpt4o_decision)) END AS a, CASE WHEN upper(trim(gemini_decision)) IN ('INCLUDE','EXCLUDE') THEN upper(trim(gemini_decision)) END AS b
  FROM gt_error_candidates_5_fp) WHERE gt IS NOT NULL)"""
_BAND = "CASE WHEN p <= 0.3 THEN 'a: to .3' WHEN p < 0.5 THEN 'b: to .5' WHEN p < 0.7 THEN 'c: to .7' ELSE 'd: from .7' END"

ORACLES = {
    "panel_runs": f"WITH {RUNS} SELECT * FROM runs",
    "vote_share_per_model": f"{BASE} SELECT record_id, model, cast(n_runs AS bigint) AS n_runs, round(share, 6) AS vote_share_include FROM models",
    "majority_code": f"{BASE} SELECT record_id, model, majority_code, decision FROM models",
    "confidence_tier": f"{BASE} SELECT model, CASE WHEN top_share >= 1 THEN 'High' WHEN top_share >= 0.6 THEN 'Medium' ELSE 'Low' END AS confidence, count(*) AS n FROM models GROUP BY 1, 2",
    "code_count_maps": f"""WITH {RUNS}, c AS (SELECT record_id, coalesce(code, 'INCLUDE_TA') AS code, count(*) AS n FROM runs GROUP BY 1, 2) SELECT record_id, '{{' || string_agg('"' || code || '":' || n, ',' ORDER BY code) || '}}' AS code_counts FROM c GROUP BY 1""",
    "code_counts": f"WITH {RUNS} SELECT record_id, coalesce(code, 'INCLUDE_TA') AS code, count(*) AS n FROM runs GROUP BY 1, 2",
    "consensus_verdict": f"{BASE} SELECT * FROM verdicts",
    "needs_second_opinion": f"{BASE} SELECT record_id FROM verdicts WHERE needs_second_opinion",
    "disagreement_band": f"{BASE} SELECT record_id, vote_share_include FROM verdicts WHERE vote_share_include > 0.4 AND vote_share_include < 0.6",
    "tie_window": f"{BASE} SELECT record_id, vote_share_include FROM verdicts WHERE abs(vote_share_include - 0.5::double) <= 0.1::double",
    "valid_vote_share": f"WITH {RUNS} SELECT record_id, count(*) AS n_runs, count(decision) AS n_valid, round(avg(CASE decision WHEN 'INCLUDE' THEN 1.0 WHEN 'EXCLUDE' THEN 0.0 END), 6) AS share, CASE WHEN avg(CASE decision WHEN 'INCLUDE' THEN 1.0 WHEN 'EXCLUDE' THEN 0.0 END) >= 0.5 THEN 'INCLUDE' WHEN count(decision) > 0 THEN 'EXCLUDE' END AS decision FROM runs GROUP BY 1",
    "merge_panels": f"WITH {RUNS}, own AS (SELECT * FROM runs WHERE model IN ('orlo-large-2','quillon-4','tessera-pro','kestra-xl')), {models_sql('own')}, {verdicts_sql('own')} SELECT * FROM verdicts",
    "critic_override": f"""{BASE}, critic AS (SELECT *, CASE WHEN {_HASH} % 5 < 2 THEN 'INCLUDE_TA' WHEN {_HASH} % 5 = 2 THEN 'EXCLUDE_OUTCOME' WHEN {_HASH} % 5 = 3 THEN 'EXCLUDE_POPULATION' END AS cc, {_HASH} % 5 = 3 AS cf FROM verdicts),
      done AS (SELECT *, needs_second_opinion AND cc IS NOT NULL AS ok FROM critic)
      SELECT record_id, CASE WHEN ok THEN cc ELSE screening_code END AS screening_code, CASE WHEN (CASE WHEN ok THEN cc ELSE screening_code END) = 'INCLUDE_TA' THEN 'INCLUDE' ELSE 'EXCLUDE' END AS screening_decision, vote_share_include,
      ok AS critic_applied, ok AND cc <> screening_code AS critic_overrode, CASE WHEN ok THEN cf ELSE needs_second_opinion END AS needs_second_opinion FROM done""",
    "tiebreak_majority3": f"""{BASE}, t AS (SELECT record_id, cast(round(vote_share_include * 2) AS bigint) + {_HASH} % 4 % 2 AS votes, {_HASH} % 4 = 3 AS unsure FROM verdicts WHERE vote_share_include > 0.4 AND vote_share_include < 0.6)
      SELECT record_id, votes, CASE WHEN votes >= 2 THEN 'INCLUDE' ELSE 'EXCLUDE' END AS screening_decision, round(votes / 3.0::double, 6) AS vote_share_include, votes = 1 OR unsure AS needs_second_opinion FROM t""",
    "label_map": f"{SCORED} SELECT * FROM mapped",
    "label_distribution": "SELECT current_gt_label AS label, count(*) AS n FROM gt_error_candidates_5_fp GROUP BY 1",
    "unmapped_labels": f"{SCORED} SELECT label, count(*) AS n FROM mapped WHERE code IS NULL GROUP BY 1",
    "confusion_matrix": f"{SCORED} SELECT {_cells()} FROM scored",
    "binary_metrics": f"{SCORED} SELECT {METRICS} FROM (SELECT {_cells()} FROM scored)",
    "reliability_bins": f"{SCORED} SELECT cast(r.bin AS int) AS bin, coalesce(n, 0) AS n, mean_p, mean_y FROM range(10) r(bin) LEFT JOIN (SELECT least(floor(p * 10), 9) AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS mean_y FROM scored GROUP BY 1) b ON b.bin = r.bin",
    "ece_brier": f"{SCORED} SELECT * FROM {_ECE}",
    "calibration_metrics": f"{SCORED} SELECT m.*, e.ece, e.brier, sensitivity >= 0.95 AS sensitivity_ok, kappa >= 0.7 AS kappa_ok, ece <= 0.1 AS ece_ok FROM (SELECT {METRICS} FROM (SELECT {_cells()} FROM scored)) m, {_ECE} e",
    "per_model_metrics": f"{SCORED}, pm AS (SELECT model, round(share, 6) AS p, y, CASE WHEN decision = 'INCLUDE' THEN 1 ELSE 0 END AS predicted FROM models JOIN truth USING (record_id)), e AS (SELECT model, round(sum(abs(sp - sy)) / sum(k), 6) AS ece FROM (SELECT model, count(*) AS k, sum(p) AS sp, sum(y) AS sy FROM pm GROUP BY model, least(floor(p * 10), 9)) GROUP BY 1) SELECT model, brier, ece, {METRICS} FROM (SELECT model, round(avg((p - y) ** 2), 6) AS brier, {_cells('predicted')} FROM pm GROUP BY model) JOIN e USING (model)",
    "inter_model_kappa": f"""{BASE} SELECT model_a, model_b, n AS n_common, CASE WHEN n >= 2 THEN round((tp + tn) / n, 6) END AS agreement, CASE WHEN n >= 2 THEN kappa END AS kappa FROM (SELECT model_a, model_b, {METRICS} FROM (
      SELECT a.model AS model_a, b.model AS model_b, {_cells("(a.decision = 'INCLUDE')::int", "(b.decision = 'INCLUDE')::int")} FROM models a JOIN models b ON a.record_id = b.record_id AND a.model < b.model GROUP BY 1, 2))""",
    "errors_fn_fp": f"{SCORED} SELECT record_id, CASE WHEN predicted = 1 THEN 'FP' ELSE 'FN' END AS error_type, p AS vote_share_include, code FROM scored WHERE predicted <> y",
    "errors_by_label": f"{SCORED} SELECT CASE WHEN predicted = 1 THEN 'FP' ELSE 'FN' END AS error_type, current_gt_label AS label, count(*) AS n FROM scored JOIN gt_error_candidates_5_fp USING (record_id) WHERE predicted <> y GROUP BY 1, 2",
    "cutoff_table": f"""{SCORED} SELECT cutoff, flagged, round(CASE WHEN pos = 0 THEN 0 ELSE hits / pos END, 6) AS recall, round(CASE WHEN flagged = 0 THEN 0 ELSE hits / flagged END, 6) AS precision, round(CASE WHEN n = 0 THEN 0 ELSE flagged / n END, 6) AS workload FROM (
      SELECT cutoff::double AS cutoff, count(*) FILTER (WHERE ok) AS flagged, count(*) FILTER (WHERE ok AND y = 1) AS hits, count(*) AS n, count(*) FILTER (WHERE y = 1) AS pos FROM (SELECT cutoff, y, CASE WHEN cutoff = 0 THEN p > 0 ELSE p >= cutoff END AS ok FROM scored, (VALUES (0.0), (0.25), (0.5), (0.75), (1.0)) c(cutoff)) GROUP BY 1)""",
    "vote_bands": f"{SCORED} SELECT {_BAND} AS band, count(*) AS n, cast(sum(y) AS bigint) AS n_positive FROM scored GROUP BY 1",
    "score_distribution": f"{BASE} SELECT round(vote_share_include, 2) AS share, count(*) AS n FROM verdicts GROUP BY 1",
    "adjudication_verdict": f"WITH {_ADJ} SELECT * FROM adj",
    "label_correction_whatif": f"""{SCORED}, {_ADJ}, fixed AS (SELECT predicted, y, CASE WHEN record_id IN (SELECT record_id FROM adj WHERE verdict = 'gt_error_candidate') THEN 1 - y ELSE y END AS z FROM scored)
      SELECT 'as it is' AS scenario, {METRICS} FROM (SELECT {_cells()} FROM fixed) UNION ALL SELECT 'corrected' AS scenario, {METRICS} FROM (SELECT {_cells('predicted', 'z')} FROM fixed)""",
}
