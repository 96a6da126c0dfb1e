"""Screening as a whole: request texts, calls, repair, quote check, one more try, critic, router, criteria and exemplars.

A call to a model is opaque: a ``Screener`` gets a batch of requests and gives raw responses. Its answers are written before anything
reads them, so none is asked for twice; all else is columns around the calls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.functions import quotes
from screenloom.operators.panel import Screener, expand, screen
from screenloom.operators.responses import field, fields, json_object, repaired, screener_for, truthy
from screenloom.operators.votes import INCLUDE_CODE
from screenloom.session import stage

# Labels of the fields in a request, in order, for each kind of request, and its last sentence.
SCREEN, RESCREEN = "Screen this record. Return the JSON object now.", "Independently re-screen this record. Confirm or override. Return the JSON object now."
RECORD = {"RECORD_ID": "record_id", "PUBLICATION_YEAR": "year", "TITLE": "title", "ABSTRACT": "abstract"}
HIERARCHICAL = {
    "RECORD_ID": "record_id", "SCREENING_LEVEL": "screening_level", "PUBLICATION_YEAR": "year", "LANGUAGE_METADATA": "language_metadata", "TITLE": "title",
    "ABSTRACT": "abstract", "KEYWORDS": "keywords", "SOURCE_REVIEW_ID": "source_review_id", "SOURCE_REVIEW_IN_SCOPE": "source_review_in_scope",
}
ROUTED = {"RECORD_ID": "record_id", "SCREENING_LEVEL": "screening_level", "PUBLICATION_YEAR": "year", "TITLE": "title", "ABSTRACT": "abstract", "ROUTER_ASSIGNED_ROUTES": "routes"}
ROUTED_CRITIC = {"RECORD_ID": "record_id", "PUBLICATION_YEAR": "year", "TITLE": "title", "ABSTRACT": "abstract", "ROUTER_ASSIGNED_ROUTES": "routes"}
PRIMARY = {"screening_code": "primary_code", "screening_decision": "primary_decision", "explanation": "primary_explanation", "supporting_quote": "primary_quote"}
REPROMPT = "The supporting quote you provided does not appear verbatim in the title or abstract. Re-screen the record using only text that is present in the source. Return the JSON object now."
#: What stands for a missing field of a record; everything else is 'NA'.
MISSING = {"title": "", "screening_level": "review"}


@dataclass(frozen=True)
class Project:
    """What differs between projects: fields of the request, its last sentence, the usual level and the longest response."""

    labels: dict[str, str]
    ask: str = SCREEN
    level: str | None = None
    max_tokens: int = 1500


# The projects.
PROJECTS = {
    "mhaa": Project(RECORD),
    "strongminds": Project(HIERARCHICAL, "Screen this record using the ULCM hierarchical TAS rules. Return the JSON object now.", "review", 4000),
}


def _value(df: DataFrame, name: str, level: str | None = None) -> Column:
    default = level if name == "screening_level" and level else MISSING.get(name, "NA")
    if name not in df.columns:
        return F.lit(default)
    own = F.col(name).cast("string") if name != "routes" else F.concat_ws(", ", name)
    return F.coalesce(F.nullif(own, F.lit("")) if name == "screening_level" else own, F.lit(default))


def request(df: DataFrame, labels: dict[str, str], ask: str, level: str | None = None, critic: bool = False) -> Column:
    """Request text of each record: a paragraph per label, for a critic the verdict in question, and what is asked.
    A missing title is empty, a missing level is the project's, any other missing field 'NA'; braces in the data are only text."""
    parts = [F.concat(F.lit(f"{label}: "), _value(df, name, level)) for label, name in labels.items()]
    if critic:
        lines = [F.concat(F.lit(f"  {label}: "), _value(df, name)) for label, name in PRIMARY.items()]
        parts.append(F.concat_ws("\n", F.lit("PRIMARY_SCREENER_VERDICT:"), *lines))
    return F.concat_ws("\n\n", *parts, F.lit(ask))


def _checked(raw: DataFrame, source: DataFrame) -> DataFrame:
    """Repaired responses with ``quote_ok``: exact matches are seen in generated code, only others go through Arrow."""
    rows = repaired(raw).join(source, "record_id")
    parts = quotes.fragments(F.when(F.col("supporting_quote") != "NA", F.col("supporting_quote")))
    rows = rows.withColumn("_parts", parts).withColumn("_hit", F.forall("_parts", lambda x: F.contains(F.col("source"), x)))
    slow = quotes.verified(F.when(~F.col("_hit"), F.col("_parts")), F.when(~F.col("_hit"), F.col("source")))
    return rows.withColumn("quote_ok", F.col("_hit") | slow).drop("_parts", "_hit", "source")


RUN = ["record_id", "model", "run_idx", "screening_code", "screening_decision", "explanation", "supporting_quote", "confidence", "needs_second_opinion", "flags"]


def screen_records(records: DataFrame, models: list[str], k: int, screener: Screener, project: str = "mhaa", critic: bool = False) -> DataFrame:
    """k runs per model and record, as rows of RUN with ``attempts``.

    A response that can't be parsed is asked for once more, one whose quote isn't in title, abstract or year once
    more with a remark; only these are asked again. A second bad quote keeps the answer and flags it
    quote_validation_failed, a second unparsable response gives an abstaining row flagged parse_error; a call that
    fails in the end is an abstaining row flagged api_error. Record ids must be unique and not null; other columns are ignored.
    """
    own = PROJECTS[project]
    ask = RESCREEN if critic else own.ask
    asked = records.filter("record_id IS NOT NULL").select("record_id", request(records, own.labels, ask, own.level, critic).alias("prompt"))
    title, abstract, year = (F.coalesce(F.col(c), F.lit("")) for c in ("title", "abstract", "year"))
    source = records.select("record_id", F.concat_ws(" ", title, abstract, year).alias("source"))
    requests = expand(asked, models, k)
    first = stage(screen(requests, screener, "prompt"))
    one = stage(_checked(first, source))
    again = one.filter("error IS NULL AND NOT (parsed AND quote_ok)").select("record_id", "model", "run_idx", "parsed")
    text = F.when(F.col("parsed"), F.concat("prompt", F.lit(f"\n\n{REPROMPT}"))).otherwise(F.col("prompt"))
    retried = again.join(asked, "record_id").withColumn("prompt", text)
    two = _checked(stage(screen(retried, screener, "prompt")), source)
    done = one.join(again.select("record_id", "model", "run_idx"), ["record_id", "model", "run_idx"], "left_anti").withColumn("attempts", F.lit(1))
    both = done.unionByName(two.withColumn("attempts", F.lit(2)))
    failed = F.col("error").isNotNull()
    bad = ~failed & F.col("parsed") & ~F.col("quote_ok")
    flags = F.when(failed, F.array(F.lit("api_error"))).when(bad, F.array_append("flags", "quote_validation_failed")).otherwise(F.col("flags"))
    explanation = F.when(failed, F.concat(F.lit("API_ERROR: "), "error")).otherwise(F.col("explanation"))
    return both.withColumns({"flags": flags, "explanation": explanation, "needs_second_opinion": F.col("needs_second_opinion") | bad}).select(*RUN, "attempts")


def critic_review(verdicts: DataFrame, records: DataFrame, runs: DataFrame, model: str, screener: Screener, project: str = "mhaa") -> DataFrame:
    """Verdicts with the critic's review of those that need a second opinion: (..., critic_applied, adjudication, overridden_code).

    The critic sees the verdict with the first run's explanation and quote. Another code overrides it, the share stays; the
    flag is the critic's own. A critic whose answers can't be parsed confirms the verdict and leaves it flagged.
    """
    first = runs.groupBy("record_id").agg(F.min_by(F.struct("explanation", "supporting_quote"), F.struct("model", "run_idx")).alias("f"))
    flagged = verdicts.filter("needs_second_opinion").select("record_id", F.col("screening_code").alias("primary_code"), F.col("screening_decision").alias("primary_decision"))
    asked = records.join(flagged, "record_id").join(first, "record_id", "left").withColumns({"primary_explanation": F.col("f.explanation"), "primary_quote": F.col("f.supporting_quote")}).drop("f")
    answers = screen_records(asked, [model], 1, screener, project, critic=True).select("record_id", F.col("screening_code").alias("critic_code"), F.col("needs_second_opinion").alias("critic_flag"), (F.array_contains("flags", "parse_error") | F.array_contains("flags", "api_error")).alias("mute"))
    return adjudicated(verdicts.join(answers, "record_id", "left"))


def adjudicated(joined: DataFrame) -> DataFrame:
    """Verdicts with (critic_code, critic_flag, mute) of the critic, null where it wasn't asked, as ``critic_review`` gives them."""
    applied = F.col("mute").isNotNull()
    differs = applied & ~F.coalesce(F.col("mute"), F.lit(False)) & F.col("critic_code").isNotNull() & (F.col("critic_code") != F.col("screening_code"))
    code = F.when(differs, F.col("critic_code")).otherwise(F.col("screening_code"))
    return joined.withColumns(
        {
            "overridden_code": F.when(differs, F.col("screening_code")),
            "adjudication": F.when(applied, F.when(differs, "override").otherwise("confirm")),
            "needs_second_opinion": F.when(applied, F.coalesce("critic_flag", F.lit(False))).otherwise(F.col("needs_second_opinion")),
            "critic_applied": applied,
            "screening_decision": F.when(differs, F.when(F.col("critic_code") == INCLUDE_CODE, "INCLUDE").otherwise("EXCLUDE")).otherwise(F.col("screening_decision")),
            "screening_code": code,
        }
    ).drop("critic_code", "critic_flag", "mute")


def critic_counts(reviewed: DataFrame) -> DataFrame:
    """Over all verdicts: how many the critic saw and how many it changed."""
    return reviewed.agg(F.count("*").alias("n"), F.count_if("critic_applied").alias("applied"), F.count_if(F.col("adjudication") == "override").alias("overrides"))


ROUTER_ASK = "Classify this record into one or more ULCM routes. Return the JSON object now."  # fixed value


def routed(records: DataFrame, model: str, screener: Screener) -> DataFrame:
    """(record_id, routes, primary_route, confidence, router_error, screener): one call per record; an answer without routes
    counts as intervention, with low confidence and the error noted."""
    asked = expand(records.filter("record_id IS NOT NULL").select("record_id", request(records, RECORD, ROUTER_ASK).alias("prompt")), [model], 1)
    own = fields(json_object(F.col("raw")))
    given = F.from_json(own["routes"], "array<string>")
    bad = F.coalesce(F.size(given) <= 0, F.lit(True))
    usual = F.lit("intervention")
    rows = stage(screen(asked, screener, "prompt")).select("record_id", F.when(bad, F.array(usual)).otherwise(given).alias("routes"), F.when(bad, usual).otherwise(own["primary_route"]).alias("primary_route"), F.when(bad, "Low").otherwise(own["confidence"]).alias("confidence"), bad.alias("router_error"))
    return rows.withColumn("screener", screener_for(F.col("routes")))


def exemplar_block(picked: DataFrame, head: str = "EXEMPLARS (similar previously-decided records):") -> DataFrame:
    """(query, block): the chosen exemplars (query, place, label, title, abstract) of each query as text, in order, title and abstract cut to 140
    and 420 characters. A query has a handful of exemplars."""
    cut = lambda c, n: F.substring(F.coalesce(F.col(c), F.lit("")), 1, n)
    text = F.concat(F.lit("- GOLD: "), F.coalesce("label", F.lit("None")), F.lit("\n  TITLE: "), cut("title", 140), F.lit("\n  ABSTRACT: "), cut("abstract", 420))
    rows = picked.select("query", "place", text.alias("text")).groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("own"))
    return rows.select("query", F.concat_ws("\n", F.lit(head), F.transform("own", lambda x: x["text"])).alias("block"))


#: The criterion that is judged first and goes with the others as context.
LEADING = "outcome"


def criteria_results(raw: DataFrame) -> DataFrame:
    """(record_id, model, criterion, pass, uncertain, reasoning) of raw answers (record_id, model, criterion, raw, error); an answer without a field, or
    unparsable, doesn't pass and is not uncertain; a failed call is uncertain. Reasoning is cut to 500 characters."""
    own = fields(json_object(F.col("raw")))
    failed = F.col("error").isNotNull()
    reason = F.when(failed, F.concat(F.lit("API_ERROR: "), "error")).otherwise(F.substring(F.coalesce(own["reasoning"], F.lit("")), 1, 500))
    return raw.select("record_id", "model", "criterion", (~failed & truthy(own["pass"])).alias("pass"), (failed | truthy(own["uncertain"])).alias("uncertain"), reason.alias("reasoning"))


def criterion_request(df: DataFrame) -> Column:
    """Request text of one criterion: exemplars, the record, and before both the leading criterion's result where there is one."""
    lines = F.concat_ws("\n", F.lit("=== TARGET RECORD ==="), *[F.concat(F.lit(f"{label}: "), _value(df, name)) for label, name in (("RECORD_ID", "record_id"), ("SCREENING_LEVEL", "screening_level"), ("PUBLICATION_YEAR", "year"), ("TITLE", "title"))])
    body = F.concat(F.coalesce("block", F.lit("")), F.lit("\n\n"), lines, F.lit("\n\nABSTRACT: "), _value(df, "abstract"), F.lit("\n"))
    return F.when(F.col("context").isNotNull(), F.concat(F.lit("CONTEXT FROM PRIOR CRITERION EVALUATION:\n"), "context", F.lit("\n\n"), body)).otherwise(body)


def judge_criteria(records: DataFrame, models: list[str], criteria: list[str], screener: Screener) -> DataFrame:
    """Results of every criterion for every record and model: LEADING first, then the others with its result as context.
    ``records`` may bring ``block`` (see ``exemplar_block``). Two stages of calls, each written before it is read."""
    base = records.filter("record_id IS NOT NULL")
    base = base if "block" in base.columns else base.withColumn("block", F.lit(""))

    def ask(rows: DataFrame, own: list[str]) -> DataFrame:
        asked = rows.withColumn("criterion", F.explode(F.array(*map(F.lit, own)))).withColumn("run_idx", F.array_position(F.array(*map(F.lit, criteria)), F.col("criterion")).cast("int"))
        calls = asked.select("record_id", "model", "run_idx", F.concat(F.lit("CRITERION: "), "criterion", F.lit("\n\n"), criterion_request(asked)).alias("prompt"))
        raw = screen(calls, screener, "prompt").withColumn("criterion", F.get(F.array(*map(F.lit, criteria)), F.col("run_idx") - 1))
        return stage(criteria_results(raw))

    panel = base.withColumn("model", F.explode(F.array(*map(F.lit, models))))
    lead = ask(panel.withColumn("context", F.lit(None).cast("string")), [LEADING])
    context = F.concat(F.lit("OUTCOME CRITERION RESULT: pass="), F.initcap(F.col("pass").cast("string")), F.lit(", uncertain="), F.initcap(F.col("uncertain").cast("string")), F.lit(", reasoning="), "reasoning", F.lit("."))
    rest = panel.join(lead.select("record_id", "model", context.alias("context")), ["record_id", "model"])
    return lead.unionByName(ask(rest, [c for c in criteria if c != LEADING]))


def few_shot_request(df: DataFrame) -> Column:
    """Request text of a record after its exemplars (``block``)."""
    year = F.coalesce(F.col("year"), F.lit(""))
    return F.concat(F.coalesce("block", F.lit("")), F.lit("\n\n=== TARGET RECORD ===\nscreening_level: "), _value(df, "screening_level"), F.lit("\nyear: "), year, F.lit("\nTITLE: "), _value(df, "title"), F.lit("\n\nABSTRACT: "), F.coalesce("abstract", F.lit("")), F.lit("\n"))


def few_shot(records: DataFrame, models: list[str], k: int, screener: Screener) -> DataFrame:
    """(record_id, model, run_idx, decision) of requests with exemplars; an answer that is neither decision is null, never a vote."""
    asked = records.filter("record_id IS NOT NULL").select("record_id", few_shot_request(records).alias("prompt"))
    said = F.upper(field(fields(json_object(F.col("raw"))), "screening_decision"))
    return stage(screen(expand(asked, models, k), screener, "prompt")).select("record_id", "model", "run_idx", F.when(said.isin("INCLUDE", "EXCLUDE"), said).alias("decision"))


def compared(base: DataFrame, new: DataFrame, truth: DataFrame) -> DataFrame:
    """One row per scenario, base and new, over the records with truth (record_id, y): counts and metrics that skip records without a decision; a
    metric without a case is null."""
    both = truth.join(base.select("record_id", F.col("decision").alias("base")), "record_id", "left").join(new.select("record_id", F.col("decision").alias("new")), "record_id", "left")
    long = both.select("y", F.explode(F.array(F.struct(F.lit("base").alias("scenario"), F.col("base").alias("d")), F.struct(F.lit("new").alias("scenario"), F.col("new").alias("d")))).alias("s"))
    yes, hit = F.col("s.d") == "INCLUDE", F.col("y") == 1
    cells = long.groupBy("s.scenario").agg(F.count_if(yes & hit).alias("tp"), F.count_if(yes & ~hit).alias("fp"), F.count_if(~yes & hit).alias("fn"), F.count_if(~yes & ~hit).alias("tn"), F.count_if(F.col("s.d").isNull()).alias("n_undecided"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    pp, ap = F.try_divide(tp + fp, n), F.try_divide(tp + fn, n)
    chance = pp * ap + (1 - pp) * (1 - ap)
    return cells.withColumns({"sensitivity": F.round(F.try_divide(tp, tp + fn), 6), "specificity": F.round(F.try_divide(tn, tn + fp), 6), "kappa": F.round(F.try_divide(F.try_divide(tp + tn, n) - chance, 1 - chance), 6)})
