"""Queries of responses, quotes, triage, panel and incremental work with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenloom.functions import keys, quotes
from screenloom.operators import incremental as inc
from screenloom.operators import panel
from screenloom.operators import responses as res
from screenloom.operators import triage
from screenloom.session import table


def _pick(names: list[str], shift: int = 0) -> str:
    """SQL of a field name that rotates with the row."""
    return f"CASE cast(floor(result_id / 8) AS bigint) % {len(names)} " + " ".join(f"WHEN {(k - shift) % len(names)} THEN '{n}'" for k, n in enumerate(names)) + " END"


def _quoted(sql: str) -> str:
    return f"""coalesce('"' || {sql} || '"', 'null')"""


def _pair(name: str, value: str) -> str:
    return f"""'"' || {name} || '": ' || {value}"""


_NAMES = {
    "code": ["screening_code", "final_code", "code", "exclusion_code", "verdict"],
    "decision": ["screening_decision", "final_decision", "decision", "exclusion_decision"],
    "quote": ["supporting_quote", "quote", "evidence_quote", "exclusion_reason"],
    "explanation": ["explanation", "rationale", "summary", "reasoning", "reason"],
    "second": ["needs_second_opinion", "flag_for_review", "uncertain"],
    "confidence": ["confidence", "confidence_level"],
}
_FIELDS = " || ', ' || ".join(
    [
        _pair(_pick(_NAMES["code"]), _quoted("CASE WHEN result_id % 3 > 0 THEN screening_code WHEN result_id % 9 = 0 THEN ' Retain ' ELSE '' END")),
        _pair(_pick(_NAMES["code"], 1), _quoted("CASE WHEN result_id % 2 = 0 THEN 'EXCLUDE_CLASH' END")),
        _pair(_pick(_NAMES["decision"]), _quoted("screening_decision")),
        _pair(_pick(_NAMES["decision"], 1), "'\"EXCLUDE_SECOND\"'"),
        _pair(_pick(_NAMES["quote"]), _quoted("CASE WHEN result_id % 5 = 0 THEN 'NA' ELSE 'q' || cast(result_id AS string) END")),
        _pair(_pick(_NAMES["quote"], 1), "'\"other quote\"'"),
        _pair(_pick(_NAMES["explanation"]), _quoted("CASE WHEN result_id % 4 > 0 THEN 'e' || cast(result_id AS string) END")),
        _pair(_pick(_NAMES["explanation"], 1), "'\"other reason\"'"),
        _pair(_pick(_NAMES["second"]), "CASE WHEN result_id % 7 = 0 THEN 'true' WHEN result_id % 7 = 1 THEN 'null' ELSE 'false' END"),
        _pair(_pick(_NAMES["confidence"]), "'\"Medium\"'"),
    ]
)
_VERDICT = "CASE cast(floor(result_id / 8) AS bigint) % 5 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'UNCLEAR' WHEN 3 THEN 'fail' ELSE 'FAIL' END"
_STEPS = " || ".join(
    [
        """'{"hierarchical_trace": {"2_outcome": {"verdict": "'""", _VERDICT, """'", "code_if_fail": '""", _quoted("CASE result_id % 3 WHEN 0 THEN 'NA' WHEN 1 THEN screening_code ELSE '' END"),
        """', "failed_code": "EXCLUDE_FAILED", "quote": "q two", "supporting_quote": '""", _quoted("CASE WHEN result_id % 2 = 0 THEN '' ELSE 'NA' END"),
        """', "rationale": "r"}, "1_population": {"verdict": "PASS", "supporting_quote": "q one", "code_if_fail": "NA", "rationale": "'""", "CASE WHEN result_id % 4 = 0 THEN '' ELSE 'why' END",
        """'"}, "3_time": {"verdict": "'""", "CASE WHEN result_id % 5 = 0 THEN 'FAIL' ELSE 'NOT_EVALUATED' END", """'", "failed_code": "EXCLUDE_TIME"}}, "screening_decision": '""", _quoted("screening_decision"), "'}'",
    ]
)
#: Raw responses made from results, the same text for the query and its twin: every name of every field, two names at once,
#: fences, prose, traces, and cut or empty ones.
RAW_SQL = f"""CASE result_id % 8 WHEN 4 THEN '```json' || chr(10) || '{{' || {_FIELDS} || '}}' || chr(10) || '```' WHEN 5 THEN {_STEPS} WHEN 6 THEN '{{}}' WHEN 7 THEN 'Here: ' || substr('{{' || {_FIELDS}, 1, 40)
  WHEN 3 THEN 'Sure. {{' || {_FIELDS} || '}} Done.' ELSE '{{' || {_FIELDS} || '}}' END"""


def _raw(spark, d):
    return table(spark, d, "results").select("result_id", F.expr(RAW_SQL).alias("raw"))


def _sources(spark, d):
    """(record_id, source): one text per record, of its first delivery."""
    return table(spark, d, "records").groupBy("record_id").agg(F.min_by(F.struct("title", "abstract", "year"), "row_no").alias("r")).select("record_id", F.concat_ws(" ", "r.title", "r.abstract", "r.year").alias("source"))


def _exact(spark, d):
    rows = table(spark, d, "results").select("result_id", "record_id", "supporting_quote").join(_sources(spark, d), "record_id", "left")
    return rows.select("result_id", F.forall(quotes.fragments(F.col("supporting_quote")), lambda x: F.contains(F.lower("source"), F.lower(x))).alias("exact"))


def _tolerant(spark, d):
    """One join; exact matches are seen in generated code, only the others go through Arrow. A record's text is brought
    into normal form once."""
    sources = _sources(spark, d).withColumn("plain", quotes.normal_text("source"))
    rows = table(spark, d, "results").select("result_id", "record_id", quotes.fragments(F.col("supporting_quote")).alias("parts")).join(sources, "record_id", "left")
    rows = rows.withColumn("hit", F.coalesce(F.forall("parts", lambda x: F.contains(F.col("source"), x)), F.lit(False)))
    slow = quotes.verified_plain(F.when(~F.col("hit"), F.col("parts")), F.when(~F.col("hit"), F.col("plain")))
    return rows.select("result_id", (F.col("hit") | slow).alias("verified"))


def _criteria(spark, d):
    """Criterion results made from results by a hash; some are missing."""
    order = ["population", "study_design", "intervention", "outcome"]
    rows = table(spark, d, "results").select("record_id", "model").distinct().withColumn("criterion", F.explode(F.array(*map(F.lit, order))))
    h = F.conv(F.substring(F.md5(F.concat_ws("|", "record_id", "model", "criterion")), 1, 4), 16, 10).cast("bigint") % 10
    made = rows.withColumn("h", h).filter("h < 9").select("record_id", "model", "criterion", (F.col("h") > 2).alias("pass"), (F.col("h").isin(2, 5)).alias("uncertain"))
    return res.first_failure(made, order)


def _routes(spark, d):
    h = F.col("row_no") % 5
    routes = F.when(h == 0, F.array()).when(h == 1, F.array(F.lit("not_applicable"))).when(h == 2, F.array(F.lit("determinants"), F.lit("not_applicable"))).when(h == 3, F.array(F.lit("determinants"), F.lit("intervention"))).otherwise(F.array(F.lit("measurement")))
    return table(spark, d, "records").select("row_no", res.screener_for(routes.cast("array<string>")).alias("screener"))


def _panel(spark, d):
    rows = table(spark, d, "records").select("record_id").filter("record_id IS NOT NULL").distinct()
    return panel.hash_panel(panel.expand(rows, ["m0", "m1"], 3))


def _resume(spark, d):
    records = table(spark, d, "records").select("record_id").distinct()
    return inc.pending(records, table(spark, d, "results").filter("model = 'orlo-large-2'"))


def _replace(spark, d):
    rows = table(spark, d, "results").select("result_id", "record_id", "screening_code")
    new = table(spark, d, "gt_error_candidates_5_fp").select("record_id").distinct().select(F.lit(-1).cast("bigint").alias("result_id"), "record_id", F.lit("INCLUDE_TA").alias("screening_code"))
    return inc.replaced(rows, new)


def _res(s, d):
    return table(s, d, "results")


def _rec(s, d):
    return table(s, d, "records")


QUERIES = {
    "alias_repair": lambda s, d: res.repaired(_raw(s, d)).select("result_id", "parsed", "screening_code", "screening_decision", "explanation", "confidence", "needs_second_opinion", F.array_join("flags", ";").alias("flags")),
    "decisive_quote": lambda s, d: res.repaired(_raw(s, d)).select("result_id", "supporting_quote"),
    "trace_machine_checks": lambda s, d: res.trace_checks(_raw(s, d)),
    "criteria_first_fail": _criteria,
    "route_screener": _routes,
    "year_gate": lambda s, d: res.year_gate(_rec(s, d)),
    "quote_fragments": lambda s, d: _res(s, d).select("result_id", F.posexplode(quotes.fragments(F.col("supporting_quote"))).alias("pos", "fragment")),
    "quote_exact_verify": _exact,
    "quote_tolerant_verify": _tolerant,
    "normal_text": lambda s, d: _rec(s, d).select("row_no", quotes.normal_text("title").alias("title")),
    "clean_extracted": lambda s, d: table(s, d, "documents").select("doc_id", quotes.clean_extracted("text").alias("text")),
    "flag_reasons": lambda s, d: _res(s, d).select("result_id", triage.flag_reasons(F.col("explanation")).alias("reasons")),
    "flag_reason_counts": lambda s, d: _res(s, d).select(F.explode(F.split(triage.flag_reasons(F.col("explanation")), ";")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n")),
    "flag_counts": lambda s, d: _res(s, d).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n")),
    "flagged_results": lambda s, d: inc.with_flags(_res(s, d), ["parse_error", "api_error", "record_error"]).select("result_id"),
    "exclude_triage": lambda s, d: triage.exclude_list(_res(s, d), _rec(s, d)),
    "flag_triage": lambda s, d: triage.flagged_includes(_res(s, d), _rec(s, d)),
    "review_summary": lambda s, d: triage.review_table(_res(s, d), _rec(s, d)),
    "design_words": lambda s, d: _rec(s, d).select("row_no", F.explode(triage.design_words(F.concat_ws(" ", "title", "abstract"))).alias("word")),
    "text_quality_audit": lambda s, d: triage.text_audit(table(s, d, "documents")),
    "text_statistics": lambda s, d: table(s, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.round(F.avg("n_chars"), 4).alias("mean")),
    "truncate_text": lambda s, d: table(s, d, "documents").select("doc_id", keys.truncate_text(F.col("text"), 1000).alias("text")),
    "panel_hash": _panel,
    "resume_pending": _resume,
    "replaced_results": _replace,
    "last_result_wins": lambda s, d: inc.last_wins(_res(s, d).select("record_id", "result_id", "screening_code"), "record_id", "result_id"),
    "id_set_sizes": lambda s, d: inc.id_sets(_rec(s, d), _res(s, d)),
}

_DEC = r"upper(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"
_FIRST = "firsts AS (SELECT record_id, unnest(r) FROM (SELECT record_id, arg_min(struct_pack(result_id, screening_code, screening_decision, explanation, supporting_quote, flags, needs_second_opinion), model || '|' || lpad(run_idx::varchar, 6, '0') || '|' || lpad(result_id::varchar, 12, '0')) AS r FROM results GROUP BY 1))"
_RECS = "recs AS (SELECT record_id, unnest(x) FROM (SELECT record_id, arg_min(struct_pack(year, title, abstract), row_no) AS x FROM records GROUP BY 1))"


def _reasons(c: str) -> str:
    cases = ", ".join("CASE WHEN " + " OR ".join(f"lower(coalesce({c}, '')) LIKE '%{w.replace('_', chr(92) + '_')}%' ESCAPE '\\'" for w in words) + f" THEN '{name}' END" for name, words in triage.FLAG_REASONS.items())
    return f"coalesce(nullif(concat_ws(';', {cases}), ''), 'other')"




def _cut(limit: int) -> str:
    head = f"substr(text, 1, {limit})"
    page = f"(CASE WHEN strpos(reverse({head}), chr(10) || chr(12) || chr(10)) > 0 THEN length({head}) - strpos(reverse({head}), chr(10) || chr(12) || chr(10)) - 2 END)"
    line = f"(CASE WHEN strpos(reverse({head}), chr(10) || chr(10)) > 0 THEN length({head}) - strpos(reverse({head}), chr(10) || chr(10)) - 1 END)"
    return f"CASE WHEN length(text) <= {limit} THEN text ELSE substr(text, 1, CASE WHEN {page} >= {limit * 0.8} THEN {page} WHEN {line} >= {limit * 0.8} THEN {line} ELSE {limit} END) END"


_H10 = "cast('0x' || substr(md5(record_id || '|' || model || '|' || c), 1, 4) AS bigint) % 10"
_CODES = ", ".join(f"'{c}'" for c in panel.HASH_CODES)


def _field(own: str, *others: str) -> str:
    """A field of the JSON object j by its own name, else by the first other name with a value."""
    rest = ", ".join(f"nullif(j->>'{a}', '')" for a in others)
    return f"CASE WHEN list_contains(json_keys(j), '{own}') THEN j->>'{own}' ELSE coalesce({rest}) END"


def _given(*values: str) -> str:
    parts = ", ".join(f"nullif({v}, '')" for v in values)
    return f"nullif(coalesce({parts}), 'NA')"


# the lists of names stand here once more, as they are asked for, so that the twin doesn't repeat an error of the operator
_FIXED = f"""WITH raws AS (SELECT result_id, {RAW_SQL.replace(' string)', ' varchar)')} AS raw FROM results), bodies AS (SELECT result_id, regexp_extract(raw, '(?s)(\\{{.*\\}})', 1) AS t FROM raws),
  objects AS (SELECT result_id, CASE WHEN json_valid(t) AND len(json_keys(CASE WHEN json_valid(t) THEN t ELSE '{{}}' END::json)) > 0 THEN t::json END AS j FROM bodies),
  named AS (SELECT result_id, j, j->'hierarchical_trace' AS tr, {_field("screening_code", "final_code", "code", "exclusion_code", "verdict")} AS code, {_field("screening_decision", "final_decision", "decision", "exclusion_decision")} AS dec,
    {_field("supporting_quote", "quote", "evidence_quote", "exclusion_reason")} AS quote, {_field("explanation", "rationale", "summary", "reasoning", "reason")} AS expl, {_field("needs_second_opinion", "flag_for_review", "uncertain")} AS second, {_field("confidence", "confidence_level")} AS conf FROM objects),
  steps AS (SELECT *, tr->'2_outcome'->>'verdict' AS v2, tr->'3_time'->>'verdict' AS v3, {_given("tr->'2_outcome'->>'code_if_fail'", "tr->'2_outcome'->>'failed_code'")} AS c2, {_given("tr->'3_time'->>'failed_code'")} AS c3, {_given("tr->'2_outcome'->>'supporting_quote'", "tr->'2_outcome'->>'quote'")} AS q2, tr->'1_population'->>'supporting_quote' AS q1 FROM named),
  codes AS (SELECT *, coalesce(nullif(code, ''), CASE WHEN dec NOT IN ('INCLUDE', 'EXCLUDE') THEN nullif(dec, '') END, CASE WHEN tr IS NOT NULL THEN coalesce(CASE WHEN v2 = 'FAIL' THEN c2 END, CASE WHEN v3 = 'FAIL' THEN c3 END, 'INCLUDE_TA') END) AS found FROM steps),
  fixed AS (SELECT *, CASE lower(trim(found)) WHEN 'include' THEN 'INCLUDE_TA' WHEN 'include_ta' THEN 'INCLUDE_TA' WHEN 'retain' THEN 'INCLUDE_TA' WHEN 'unclear' THEN 'INCLUDE_TA' WHEN 'exclude' THEN 'EXCLUDE_INTERVENTION_TOPIC' END AS renamed FROM codes)"""

ORACLES = {
    "alias_repair": f"""{_FIXED} SELECT result_id, j IS NOT NULL AS parsed, CASE WHEN j IS NULL THEN 'INCLUDE_TA' ELSE coalesce(renamed, found) END AS screening_code,
      CASE WHEN j IS NULL OR renamed = 'INCLUDE_TA' THEN 'INCLUDE' WHEN renamed IS NOT NULL THEN 'EXCLUDE' WHEN dec IN ('INCLUDE', 'EXCLUDE') THEN dec WHEN found = 'INCLUDE_TA' THEN 'INCLUDE' WHEN found IS NOT NULL THEN 'EXCLUDE' END AS screening_decision,
      CASE WHEN j IS NULL THEN 'MODEL_ERROR: could not parse JSON after 2 attempts.' ELSE expl END AS explanation, CASE WHEN j IS NULL THEN 'Low' ELSE conf END AS confidence,
      j IS NULL OR coalesce(lower(second) NOT IN ('false', '0', 'null', ''), false) AS needs_second_opinion, CASE WHEN j IS NULL THEN 'parse_error' ELSE '' END AS flags FROM fixed""",
    "decisive_quote": f"""{_FIXED} SELECT result_id, coalesce(nullif(nullif(quote, ''), 'NA'), CASE WHEN v2 = 'FAIL' THEN q2 END, q1, 'NA') AS supporting_quote FROM fixed""",
    "trace_machine_checks": f"""{_FIXED} SELECT result_id, false AS complete, v2 <> 'fail' AS known_verdicts, NOT (v2 = 'FAIL' AND v3 = 'FAIL') AS stops_at_failure, v2 = 'FAIL' OR v3 = 'FAIL' AS goes_on,
      NOT (v2 = 'FAIL' AND c2 IS NULL) AS failure_has_code, NOT (v2 = 'PASS' AND c2 IS NOT NULL) AS pass_has_no_code, NOT (v2 = 'PASS' AND q2 IS NULL) AS pass_has_quote, result_id % 4 > 0 AND v3 = 'NOT_EVALUATED' AS has_rationale,
      false AS code_matches, dec IS NULL AS decision_matches, v2 <> 'UNCLEAR' AS unclear_is_flagged FROM fixed WHERE tr IS NOT NULL""",
    "quote_exact_verify": rf"""WITH {_RECS}, q AS (SELECT result_id, record_id, supporting_quote AS t, list_transform(regexp_extract_all(supporting_quote, '"((?:\\.|[^"\\])*)(?:"|$)', 1), lambda x: regexp_replace(x, '\\(.)', '\1', 'g')) AS p FROM results),
      f AS (SELECT result_id, record_id, list_filter(CASE WHEN t IS NULL OR upper(trim(t)) IN ('NA', '') THEN [] WHEN len(p) > 0 THEN p ELSE [trim(trim(t), '"')] END, lambda x: x <> '') AS l FROM q)
      SELECT result_id, len(list_filter(l, lambda x: NOT contains(lower(concat_ws(' ', title, abstract, year)), lower(x)))) = 0 AS exact FROM f LEFT JOIN recs USING (record_id)""",
    "quote_fragments": r"""WITH q AS (SELECT result_id, supporting_quote AS t, list_transform(regexp_extract_all(supporting_quote, '"((?:\\.|[^"\\])*)(?:"|$)', 1), lambda x: regexp_replace(x, '\\(.)', '\1', 'g')) AS p FROM results),
      f AS (SELECT result_id, list_filter(CASE WHEN t IS NULL OR upper(trim(t)) IN ('NA', '') THEN [] WHEN len(p) > 0 THEN p ELSE [trim(trim(t), '"')] END, lambda x: x <> '') AS l FROM q)
      SELECT result_id, cast(pos - 1 AS int) AS pos, l[pos] AS fragment FROM (SELECT result_id, l, unnest(range(1, len(l) + 1)) AS pos FROM f)""",
    "truncate_text": f"SELECT doc_id, {_cut(1000)} AS text FROM documents",
    "text_quality_audit": f"SELECT * FROM (SELECT doc_id, CASE WHEN coalesce(length(text), 0) = 0 THEN 'missing' WHEN length(text) < 200 THEN 'low_text' WHEN length(text) > 1500 THEN 'truncated' END AS reason, length(text) AS n, length({_cut(1500)}) AS kept FROM documents) WHERE reason IS NOT NULL",
    "criteria_first_fail": f"""WITH r AS (SELECT DISTINCT record_id, model FROM results), o(i, c) AS (VALUES (1, 'population'), (2, 'study_design'), (3, 'intervention'), (4, 'outcome')),
      x AS (SELECT record_id, model, i, c, {_H10} AS h FROM r, o), f AS (SELECT record_id, model, min(i) FILTER (WHERE h IN (0, 1)) AS fail, min(i) FILTER (WHERE h IN (2, 5, 9)) AS doubt, count(*) FILTER (WHERE h < 9) AS n FROM x GROUP BY 1, 2)
      SELECT record_id, model, c AS failed, CASE WHEN fail IS NULL THEN 'INCLUDE' ELSE 'EXCLUDE' END AS decision, doubt IS NOT NULL AND (fail IS NULL OR doubt < fail) AS needs_second_opinion FROM f LEFT JOIN o ON i = fail WHERE n > 0""",
    "route_screener": "SELECT row_no, CASE WHEN row_no % 5 IN (2, 4) THEN 'no_intervention' ELSE 'intervention' END AS screener FROM records",
    "year_gate": "SELECT row_no, record_id, cast(trunc(try_cast(year AS double)) AS int) AS year, 'EXCLUDE_TIME_LANGUAGE' AS screening_code, 0 AS n_runs FROM records WHERE try_cast(year AS double) < 2000",
    "flag_reasons": f"SELECT result_id, {_reasons('explanation')} AS reasons FROM results",
    "flag_reason_counts": f"SELECT reason, count(*) AS n FROM (SELECT unnest(string_split({_reasons('explanation')}, ';')) AS reason FROM results) GROUP BY 1",
    "flag_counts": "SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM results) GROUP BY 1",
    "flagged_results": "SELECT result_id FROM results WHERE list_has_any(flags, ['parse_error', 'api_error', 'record_error'])",
    "exclude_triage": f"WITH {_FIRST}, {_RECS} SELECT f.record_id, coalesce(year, '') AS year, coalesce(title, '') AS title, screening_code, array_to_string(flags, ';') AS flag_text FROM firsts f LEFT JOIN recs USING (record_id) WHERE {_DEC.format(c='screening_decision')} = 'EXCLUDE'",
    "flag_triage": f"WITH {_FIRST}, {_RECS} SELECT f.record_id, coalesce(year, '') AS year, coalesce(title, '') AS title, {_reasons('explanation')} AS reasons, array_to_string(flags, ';') AS flag_text FROM firsts f LEFT JOIN recs USING (record_id) WHERE {_DEC.format(c='screening_decision')} = 'INCLUDE' AND needs_second_opinion",
    "review_summary": f"WITH {_FIRST}, {_RECS} SELECT f.record_id, substr(coalesce(title, ''), 1, 200) AS title, coalesce(year, '') AS year, substr(coalesce(abstract, ''), 1, 500) AS abstract, screening_code, '' AS human_decision, '' AS human_notes FROM firsts f LEFT JOIN recs USING (record_id) WHERE needs_second_opinion",
    "design_words": f"SELECT row_no, word FROM records, (SELECT unnest([{', '.join(repr(w) for w in keys.DESIGN_WORDS)}]) AS word) WHERE contains(lower(concat_ws(' ', title, abstract)), word)",
    "text_statistics": "SELECT source, count(*) AS n, min(n_chars) AS least, max(n_chars) AS most, round(avg(n_chars), 4) AS mean FROM documents GROUP BY 1",
    "panel_hash": f"SELECT record_id, model, cast(k AS int) AS run_idx, [{_CODES}][cast('0x' || substr(md5(record_id || '|' || model || '|' || k), 1, 4) AS bigint) % 5 + 1] AS code FROM (SELECT DISTINCT record_id FROM records WHERE record_id IS NOT NULL), (VALUES ('m0'), ('m1')) m(model), range(3) r(k)",
    "resume_pending": "SELECT DISTINCT record_id FROM records WHERE record_id NOT IN (SELECT record_id FROM results WHERE model = 'orlo-large-2')",
    "replaced_results": "SELECT result_id, record_id, screening_code FROM results WHERE record_id NOT IN (SELECT record_id FROM gt_error_candidates_5_fp) UNION ALL SELECT DISTINCT -1, record_id, 'INCLUDE_TA' FROM gt_error_candidates_5_fp",
    "last_result_wins": "SELECT record_id, max(result_id) AS result_id, arg_max_null(screening_code, result_id) AS screening_code FROM results GROUP BY 1",
    "id_set_sizes": "SELECT side, count(*) AS n FROM (SELECT CASE WHEN a.record_id IS NOT NULL AND b.record_id IS NOT NULL THEN 'both' WHEN b.record_id IS NULL THEN 'only_a' ELSE 'only_b' END AS side FROM (SELECT DISTINCT record_id FROM records) a FULL JOIN (SELECT DISTINCT record_id FROM results) b ON a.record_id = b.record_id) GROUP BY 1",
}
