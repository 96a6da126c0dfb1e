"""Repair of raw model responses: JSON extraction, aliases, codes and quotes from a trace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names under which a field may stand, in order of precedence, and words for codes.
FIELD_ALIASES = {
    "screening_code": ("final_code", "code", "screening_code", "exclusion_code", "verdict"),
    "screening_decision": ("final_decision", "decision", "screening_decision", "exclusion_decision"),
    "supporting_quote": ("quote", "supporting_quote", "evidence_quote", "exclusion_reason"),
    "explanation": ("rationale", "explanation", "summary", "reasoning", "reason"),
    "needs_second_opinion": ("needs_second_opinion", "flag_for_review", "uncertain"),
    "confidence": ("confidence", "confidence_level"),
}
CODE_ALIASES = {"include": "INCLUDE_TA", "include_ta": "INCLUDE_TA", "retain": "INCLUDE_TA", "exclude": "EXCLUDE_INTERVENTION_TOPIC", "unclear": "INCLUDE_TA"}
TRACE = "map<string,struct<verdict:string,code_if_fail:string,failed_code:string,rationale:string,supporting_quote:string,quote:string>>"


def json_object(raw: Column) -> Column:
    """The first-to-last brace part of a text if it parses as an object with a field; null otherwise. Fences and prose
    around it don't matter; arrays, '{}' and cut texts give null."""
    body = F.regexp_extract(raw, r"(?s)(\{.*\})", 1)
    return F.when(F.is_variant_null(F.try_parse_json(body)).isNotNull() & (F.json_array_length(body).isNull()) & (F.size(F.json_object_keys(body)) > 0), body)


def fields(body: Column) -> Column:
    """All fields of an object as texts, parsed once; objects within stay JSON."""
    return F.from_json(body, "map<string,string>")


def field(own: Column, name: str) -> Column:
    """A field under its own name, or the first alias with a value; its own name wins even if it holds null."""
    aliases = [F.nullif(own[a], F.lit("")) for a in FIELD_ALIASES[name]]
    return F.when(F.map_contains_key(own, name), own[name]).otherwise(F.coalesce(*aliases))


def _trace(own: Column) -> Column:
    """Trace entries in the order of their keys, under its own name or the short one; null if the trace is no object."""
    part = F.coalesce(own["hierarchical_trace"], own["trace"])
    return F.when(part.startswith("{"), F.array_sort(F.map_entries(F.from_json(part, TRACE))))


def _first_given(*cols: Column) -> Column:
    """The first value that is not empty; null if that is 'NA'."""
    return F.nullif(F.coalesce(*[F.nullif(c, F.lit("")) for c in cols]), F.lit("NA"))


def _entry_code(e: Column) -> Column:
    return _first_given(e["value"]["code_if_fail"], e["value"]["failed_code"])


def _entry_quote(e: Column) -> Column:
    return _first_given(e["value"]["supporting_quote"], e["value"]["quote"])


def truthy(c: Column) -> Column:
    """Whether a field holds anything but false, 0, null and the empty text."""
    return F.coalesce(~F.lower(F.trim(c)).isin("false", "0", "null", ""), F.lit(False))


def repaired(raw: DataFrame, text: str = "raw") -> DataFrame:
    """Adds parsed, screening_code, screening_decision, supporting_quote, explanation, confidence, needs_second_opinion and
    flags to rows with a raw response.

    A decision that is not exactly INCLUDE or EXCLUDE and no code: the decision was the code. A word for a code becomes
    the code and decides. Still no code and a trace: the first criterion
    that fails with a usable code decides, else the record stays in. Unparsable and null responses stay in too, flagged
    parse_error and for a second opinion: a failure never excludes.
    """
    df = raw.withColumn("_b", fields(json_object(F.col(text)))).withColumn("_t", _trace(F.col("_b")))
    own = lambda name: field(F.col("_b"), name)
    code, decision = own("screening_code"), own("screening_decision")
    binary = F.coalesce(decision.isin("INCLUDE", "EXCLUDE"), F.lit(False))
    given = F.coalesce(F.nullif(code, F.lit("")), F.when(~binary, F.nullif(decision, F.lit(""))))
    entries = lambda verdict: F.filter("_t", lambda e: e["value"]["verdict"] == verdict)
    first = lambda verdict, of: F.get(F.filter(F.transform(entries(verdict), of), lambda x: x.isNotNull()), F.lit(0))
    traced = F.when(F.col("_t").isNotNull(), F.coalesce(first("FAIL", _entry_code), F.lit("INCLUDE_TA")))
    alias = F.create_map(*[F.lit(x) for p in CODE_ALIASES.items() for x in p])
    found = F.coalesce(given, traced)
    renamed = alias[F.lower(F.regexp_replace(found, r"^\s+|\s+$", ""))]
    final = F.coalesce(renamed, found)
    quote = F.coalesce(_first_given(own("supporting_quote")), first("FAIL", _entry_quote), first("PASS", _entry_quote), F.lit("NA"))
    parsed = F.col("_b").isNotNull()
    of = lambda c: F.when(c == "INCLUDE_TA", "INCLUDE").when(c.isNotNull(), "EXCLUDE")
    decided = F.when(renamed.isNotNull(), of(renamed)).when(binary, decision).otherwise(of(found))
    added = {
        "parsed": parsed,
        "screening_code": F.when(parsed, final).otherwise("INCLUDE_TA"),
        "screening_decision": F.when(parsed, decided).otherwise("INCLUDE"),
        "supporting_quote": quote,
        "explanation": F.when(parsed, own("explanation")).otherwise("MODEL_ERROR: could not parse JSON after 2 attempts."),
        "confidence": F.when(parsed, own("confidence")).otherwise("Low"),
        "needs_second_opinion": ~parsed | truthy(own("needs_second_opinion")),
        "flags": F.when(parsed, F.array().cast("array<string>")).otherwise(F.array(F.lit("parse_error"))),
    }
    return df.withColumns(added).drop("_b", "_t")


#: Verdicts of a trace, and criteria in the order in which they are judged.
VERDICTS = ("PASS", "FAIL", "UNCLEAR", "NOT_EVALUATED")
CRITERIA = 6


def trace_checks(raw: DataFrame, text: str = "raw") -> DataFrame:
    """Machine checks of a trace, one column each; rows without a trace are left out. An empty trace passes all but the count.

    complete: all CRITERIA are there. known_verdicts. stops_at_failure: criteria after the first failure are not evaluated.
    goes_on: none before it is skipped. failure_has_code, pass_has_no_code, pass_has_quote, has_rationale (of what was
    evaluated). code_matches: the code is that of the first failure, or INCLUDE_TA without one. decision_matches: the decision is
    that of the code. unclear_is_flagged: an unclear criterion asks for a second opinion.
    """
    df = raw.withColumn("_b", fields(json_object(F.col(text)))).withColumn("_t", _trace(F.col("_b"))).filter("_t IS NOT NULL")
    own = lambda name: field(F.col("_b"), name)
    verdicts = F.transform("_t", lambda e: e["value"]["verdict"])
    at = F.coalesce(F.array_position(verdicts, "FAIL"), F.lit(0))
    none = F.array().cast("array<string>")
    after = F.when(at > 0, F.slice(verdicts, (at + 1).cast("int"), F.size(verdicts))).otherwise(none)
    before = F.when(at > 1, F.slice(verdicts, 1, F.greatest((at - 1).cast("int"), F.lit(1)))).when(at == 1, none).otherwise(verdicts)
    having = lambda v: F.filter("_t", lambda e: e["value"]["verdict"] == v)
    evaluated = F.filter("_t", lambda e: e["value"]["verdict"] != "NOT_EVALUATED")
    yes = lambda c: F.coalesce(c, F.lit(False))
    code = own("screening_code")
    return df.select(
        *raw.columns[:1],
        (F.size("_t") == CRITERIA).alias("complete"),
        F.forall(verdicts, lambda v: yes(v.isin(*VERDICTS))).alias("known_verdicts"),
        F.forall(after, lambda v: yes(v == "NOT_EVALUATED")).alias("stops_at_failure"),
        F.forall(before, lambda v: yes(v != "NOT_EVALUATED")).alias("goes_on"),
        F.forall(having("FAIL"), lambda e: _entry_code(e).isNotNull()).alias("failure_has_code"),
        F.forall(having("PASS"), lambda e: _entry_code(e).isNull()).alias("pass_has_no_code"),
        F.forall(having("PASS"), lambda e: _entry_quote(e).isNotNull()).alias("pass_has_quote"),
        F.forall(evaluated, lambda e: F.coalesce(F.trim(e["value"]["rationale"]), F.lit("")) != "").alias("has_rationale"),
        F.coalesce(_entry_code(F.get(having("FAIL"), F.lit(0))), F.lit("INCLUDE_TA")).eqNullSafe(code).alias("code_matches"),
        F.when(code == "INCLUDE_TA", "INCLUDE").when(code.isNotNull(), "EXCLUDE").eqNullSafe(own("screening_decision")).alias("decision_matches"),
        (~F.exists(verdicts, lambda v: yes(v == "UNCLEAR")) | truthy(own("needs_second_opinion"))).alias("unclear_is_flagged"),
    )


def first_failure(criteria: DataFrame, order: list[str]) -> DataFrame:
    """One row per record and model from (record_id, model, criterion, pass, uncertain): the first criterion in order that
    clearly fails decides. A missing criterion passes but is uncertain; uncertainty after the deciding one doesn't flag."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("criterion"))
    seen = criteria.withColumn("o", place.cast("int")).filter("o > 0").groupBy("record_id", "model").agg(
        F.min(F.when(~F.col("pass") & ~F.col("uncertain"), F.col("o"))).alias("fail"), F.min(F.when(F.col("uncertain"), F.col("o"))).alias("unsure"), F.sort_array(F.collect_set("o")).alias("has")
    )
    gap = F.array_min(F.array_except(F.sequence(F.lit(1), F.lit(len(order))), F.col("has")))
    doubt = F.least("unsure", gap)
    flagged = doubt.isNotNull() & (F.col("fail").isNull() | (doubt < F.col("fail")))
    return seen.select("record_id", "model", F.get(F.array(*map(F.lit, order)), F.col("fail") - 1).alias("failed"), F.when(F.col("fail").isNull(), "INCLUDE").otherwise("EXCLUDE").alias("decision"), flagged.alias("needs_second_opinion"))


def screener_for(routes: Column) -> Column:
    """'no_intervention' if the routes, without not_applicable, are a non-empty part of determinants and measurement."""
    own = F.array_remove(F.coalesce(routes, F.array().cast("array<string>")), "not_applicable")
    return F.when((F.size(own) > 0) & (F.size(F.array_except(own, F.array(F.lit("determinants"), F.lit("measurement")))) == 0), "no_intervention").otherwise("intervention")


def year_gate(records: DataFrame, first: int = 2000) -> DataFrame:
    """Records whose year is before ``first``, decided without a model; an unreadable year passes the gate."""
    year = F.col("year").try_cast("double").cast("int")
    return records.filter(year < first).select("row_no", "record_id", year.alias("year"), F.lit("EXCLUDE_TIME_LANGUAGE").alias("screening_code"), F.lit(0).alias("n_runs"))
