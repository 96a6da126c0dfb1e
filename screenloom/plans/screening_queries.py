"""Queries of screening as a whole, matching by hand-found files, and sources and sinks read back, with their SQL twins."""

from __future__ import annotations

import hashlib
import json
import uuid

import pandas as pd
from pyspark.sql import functions as F

from screenloom.functions import keys
from screenloom.operators import calibration as cal
from screenloom.operators import inventory as inv
from screenloom.operators import matching, screening, votes
from screenloom.plans import verdict_queries
from screenloom.session import ensure_checkpoint_dir, table
from screenloom.sources import library, ris, sinks, tabular


def _shape(record_id: str, model: str) -> int:
    return int(hashlib.md5(f"{record_id}|{model}".encode()).hexdigest()[:4], 16) % 8


def stand_in(batch: pd.DataFrame) -> pd.Series:
    """A deterministic screener: a hash of record and model chooses a response, among them unparsable ones and bad quotes."""
    out = []
    for rid, model, text in zip(batch["record_id"], batch["model"], batch["text"], strict=True):
        k, title = _shape(rid, model), text.split("TITLE: ", 1)[1].split("\n\n", 1)[0]
        quote = title[:30] if title else "NA"
        if k == 0:
            out.append(json.dumps({"screening_code": "INCLUDE_TA", "screening_decision": "INCLUDE", "supporting_quote": quote, "confidence": "High"}))
        elif k == 1:
            out.append("```json\n" + json.dumps({"final_code": "EXCLUDE_OUTCOME", "quote": quote, "reason": "other outcome"}) + "\n```")
        elif k == 2:  # a bad quote, then a good one
            good = text.endswith(screening.REPROMPT)
            out.append(json.dumps({"code": "retain", "evidence_quote": quote if good else "zzzz qqqq zzzz qqqq", "flag_for_review": False}))
        elif k == 3:  # a bad quote both times
            out.append(json.dumps({"decision": "EXCLUDE_POPULATION", "supporting_quote": "zzzz qqqq zzzz qqqq"}))
        elif k == 4:
            out.append("I cannot answer.")
        elif k == 5:
            out.append(json.dumps({"hierarchical_trace": {"1_population": {"verdict": "PASS", "supporting_quote": quote}, "2_design": {"verdict": "FAIL", "code_if_fail": "EXCLUDE_STUDY_DESIGN"}}, "uncertain": True}))
        elif k == 6:
            out.append("Here: " + json.dumps({"verdict": "EXCLUDE_TOPIC", "screening_decision": "INCLUDE"}) + " Done.")
        else:
            raise ConnectionError("far side closed")
    return pd.Series(out)


def _records(spark, d):
    """One row per record_id: the first delivery."""
    rows = table(spark, d, "records").filter("record_id IS NOT NULL")
    return rows.groupBy("record_id").agg(F.min_by(F.struct("title", "abstract", "year"), "row_no").alias("r")).select("record_id", "r.*")


def _once(spark, d):
    found = screening.screen_records(_records(spark, d), ["m0", "m1"], 1, stand_in)
    return found.select("record_id", "model", "screening_code", "screening_decision", "confidence", "needs_second_opinion", F.array_join("flags", ";").alias("flags"), "attempts")


def _requests(spark, d):
    rec = _records(spark, d)
    own = screening.PROJECTS
    return rec.select(
        "record_id", F.md5(screening.request(rec, own["mhaa"].labels, own["mhaa"].ask)).alias("plain"),
        F.md5(screening.request(rec, own["strongminds"].labels, own["strongminds"].ask, own["strongminds"].level)).alias("hierarchical"),
    )


def _critic(spark, d):
    """Verdicts of the results, reviewed: the critic's answer is a hash of the record."""
    found = votes.verdicts(votes.runs(table(spark, d, "results"))).select("record_id", "screening_code", "screening_decision", "needs_second_opinion")
    h = F.conv(F.substring(F.md5("record_id"), 1, 4), 16, 10).cast("bigint") % 4
    code = F.when(h == 0, "INCLUDE_TA").when(h == 1, "EXCLUDE_OUTCOME").when(h == 2, F.col("screening_code"))
    asked = F.col("needs_second_opinion")
    joined = found.withColumns({"critic_code": F.when(asked, code), "critic_flag": F.when(asked, h == 3), "mute": F.when(asked, h == 3)})
    return screening.adjudicated(joined)


def _compare(spark, d):
    rows = votes.per_model(votes.runs(table(spark, d, "results")))
    y = cal.truth(table(spark, d, "gt_error_candidates_5_fp"))
    pick = lambda m: rows.filter(F.col("model") == m).select("record_id", "decision")
    return screening.compared(pick("orlo-large-2"), pick("orlo-mini-2"), y)


def _blocks(spark, d):
    """Exemplar blocks: for each labelled record the first four of its source file by row number."""
    rows = table(spark, d, "records").filter("title IS NOT NULL AND source_file IS NOT NULL")
    picked = rows.groupBy("source_file").agg(F.slice(F.sort_array(F.collect_set(F.when(F.col("row_no") < 400, F.struct("row_no", "title", "abstract")))), 1, 4).alias("x"))
    long = picked.select(F.col("source_file").alias("query"), F.posexplode("x").alias("place", "e")).select("query", "place", F.lit("INCLUDE").alias("label"), "e.title", "e.abstract")
    return screening.exemplar_block(long)


def _files(spark, d):
    """Files made of library items: some tell a DOI, some the title (with another word at its end), some neither."""
    items = table(spark, d, "library_export").filter("title <> ''").groupBy("zotero_key").agg(F.min(F.struct("title", F.coalesce("doi", F.lit("")).alias("doi"))).alias("x"))
    h = F.conv(F.substring(F.md5("zotero_key"), 1, 4), 16, 10).cast("bigint") % 4
    doi = F.concat(F.lit("Downloaded. doi:"), "x.doi", F.lit(").\nsecond line"))
    text = F.when((h == 0) & (F.col("x.doi") != ""), doi).when(h == 1, F.concat(F.lit("Page 1\n"), "x.title", F.lit(" x\n\fmore"))).otherwise("short\nlines\nonly")
    return items.filter(h < 3).select(F.concat("zotero_key", F.lit(".pdf")).alias("file"), text.alias("text"), F.lit(None).cast("string").alias("meta_title"))


def _items(spark, d):
    rows = table(spark, d, "library_export").groupBy("zotero_key").agg(F.min(F.struct("title", "doi")).alias("x")).select("zotero_key", "x.*")
    return rows.withColumn("ord", F.conv(F.substring(F.md5("zotero_key"), 1, 12), 16, 10).cast("bigint"))


def _sniffed(spark, d):
    return matching.sniffed(_files(spark, d)).select("file", F.array_join("dois", ";").alias("dois"), "rough_title")


def _folder(spark, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share; it goes with the application."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def _ris_round(spark, d):
    """Records written as RIS and read again."""
    path = _folder(spark, "ris")
    one_line = [F.regexp_replace(c, r"\s+", " ").alias(c) for c in ("title", "abstract")]
    rows = table(spark, d, "records").select("row_no", F.col("row_no").cast("string").alias("record_id"), "year", *one_line, "type", "doi")
    sinks.write_ris(rows, path)
    return ris.read_records(spark, path).select("record_id", "title", "year", "type", "doi")


def _jsonl_round(spark, d):
    """Results written as JSON lines in two runs, the second with some of them again, and read so that the last one counts."""
    path = _folder(spark, "jsonl")
    rows = table(spark, d, "results").select("record_id", "result_id", "screening_code")
    sinks.write_jsonl(rows, path)
    sinks.write_jsonl(rows.filter("result_id % 3 = 0").withColumns({"result_id": F.col("result_id") + 1_000_000_000, "screening_code": F.lit("AGAIN")}), path, append=True)
    return tabular.last_by(tabular.read_jsonl(spark, path, "record_id string, result_id bigint, screening_code string"), "record_id", "result_id")


def _csv_round(spark, d):
    """A review sheet written with line breaks and quotes in its cells, and read again."""
    path = _folder(spark, "csv")
    sinks.write_review_csv(table(spark, d, "records").select(F.col("row_no").cast("string").alias("row_no"), F.concat(F.lit('a "b",\n'), F.coalesce("title", F.lit("-"))).alias("title")), path)
    return spark.read.schema("row_no string, title string").option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def _paired(spark, d):
    """The paired layout: a decision stands in the row after its record."""
    rows = table(spark, d, "records").filter("row_no IS NOT NULL")
    both = F.array(
        F.struct((F.col("row_no") * 2).alias("ord"), F.concat(F.lit("k"), F.col("row_no").cast("string")).alias("record_id"), "year", "title", "abstract", F.lit(None).cast("string").alias("decision")),
        F.struct((F.col("row_no") * 2 + 1).alias("ord"), F.lit(None).cast("string").alias("record_id"), F.lit(None).cast("string").alias("year"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("abstract"), F.upper("screening_level").alias("decision")),
    )
    sheet = rows.select(F.explode(F.filter(both, lambda x: (x["record_id"].isNotNull()) | (F.col("row_no") % 3 > 0))).alias("x")).select("x.*")
    found = tabular.paired_records(sheet, {c: c for c in ("record_id", "year", "title", "abstract", "decision")})
    return found.select("record_id", "title", "label")


def _label_round(spark, d):
    """A label map written as one JSON object and read again."""
    path = _folder(spark, "labels")
    one = table(spark, d, "gt_error_candidates_5_fp").filter("record_id IS NOT NULL AND current_gt_label IS NOT NULL").groupBy("record_id").agg(F.max("current_gt_label").alias("label"))
    pair = F.concat(F.to_json(F.struct("record_id")), F.lit("|"), F.to_json(F.struct("label")))
    text = one.select(F.regexp_replace(pair, r'^\{"record_id":(.*)\}\|\{"label":(.*)\}$', "$1: $2").alias("p")).agg(F.concat(F.lit("{"), F.concat_ws(",", F.collect_list("p")), F.lit("}")).alias("value"))
    text.coalesce(1).write.text(path)  # one human-made object by its meaning
    return tabular.read_label_map(spark, path)


def _library_round(spark, d):
    """A library dump written as JSON, parents with attachments, and read into an inventory."""
    path = _folder(spark, "library")
    items = table(spark, d, "library_export").groupBy("zotero_key").agg(F.min(F.struct("title", "authors", "year", "doi", "url", "item_type")).alias("x"))
    h = F.conv(F.substring(F.md5("zotero_key"), 1, 4), 16, 10).cast("bigint") % 4
    text = lambda c: c.cast("string")
    none = text(F.lit(None))
    parent = F.struct(F.col("zotero_key").alias("key"), none.alias("parentItem"), F.coalesce("x.item_type", F.lit("journalArticle")).alias("itemType"), none.alias("contentType"), none.alias("filename"), F.col("x.title").alias("title"), none.alias("linkMode"), none.alias("md5"), F.col("x.doi").alias("DOI"), F.col("x.url").alias("url"), F.col("x.year").alias("date"))
    child = lambda n, kind, mode, sum_: F.struct(F.concat("zotero_key", F.lit(n)).alias("key"), F.col("zotero_key").alias("parentItem"), F.lit("attachment").alias("itemType"), F.lit(kind).alias("contentType"), F.concat("zotero_key", F.lit(f"{n}.pdf")).alias("filename"), none.alias("title"), F.lit(mode).alias("linkMode"), text(F.lit(sum_)).alias("md5"), none.alias("DOI"), none.alias("url"), none.alias("date"))
    rows = F.when(h == 0, F.array(parent)).when(h == 1, F.array(parent, child("_a", "application/pdf", "linked_url", None))).when(h == 2, F.array(parent, child("_a", "application/pdf", "imported_file", None), child("_b", "application/pdf", "imported_file", "c0ffee"))).otherwise(F.array(parent, child("_a", "application/pdf", "linked_url", "c0ffee"), child("_b", "text/plain", "imported_file", None)))
    items.select(F.explode(rows).alias("data")).write.json(path)
    own = spark.read.schema(library.SCHEMA).json(path).select("data.*")
    return library.inventory(own).select("zotero_key", "year", "has_pdf", "pdf_attachment_key")


def _html(spark, d):
    page = F.concat(F.lit('<meta name="citation_pdf_url" content="/full/'), "zotero_key", F.lit('.pdf"> <a href="files/a.pdf?x=1&amp;y=2">PDF</a> https://iris.who.int/server/api/core/bitstreams/0a-1B/content'))
    return table(spark, d, "library_export").filter("url <> ''").select("zotero_key", "url", F.coalesce("doi", F.lit("")).alias("doi"), page.alias("html")).distinct()


def _patterns(spark, d):
    h = F.conv(F.substring(F.md5("zotero_key"), 1, 4), 16, 10).cast("bigint") % 5
    host = F.when(h == 0, "https://onlinelibrary.wiley.com/doi/full/10.1002/x1").when(h == 1, "https://journals.sagepub.com/doi/abs/10.1177/y2?a=b").when(h == 2, "https://www.jmir.org/2020/1/e1/").when(h == 3, "https://www.mdpi.com/1/2/3").otherwise("https://link.springer.com/article/10.1007/z3")
    rows = _html(spark, d).select("zotero_key", host.alias("url"), "doi", "html").distinct()
    return rows.select("zotero_key", "doi", F.posexplode(keys.derived_pdf_urls(F.col("url"), F.col("doi"), F.col("html"))).alias("pos", "link"))


def _merge_stats(spark, d):
    return votes.agreement_stats(votes.verdicts(votes.runs(table(spark, d, "results"))))


def _flag_rate(spark, d):
    return cal.flag_projection(votes.valid_share(votes.runs(table(spark, d, "results"))), 29_251)


def _common(spark, d):
    """Most common codes first, ties by name, with their place."""
    rows = table(spark, d, "results").groupBy(F.coalesce("screening_code", F.lit("none")).alias("code")).agg(F.count("*").alias("n"))
    return inv.numbered_all(rows, [F.desc("n"), F.asc("code")])


QUERIES = {
    "screen_once": _once,
    "request_texts": _requests,
    "critic_review": _critic,
    "critic_counts": lambda s, d: screening.critic_counts(_critic(s, d)),
    "few_shot_comparison": _compare,
    "exemplar_blocks": _blocks,
    "manual_files_sniffed": _sniffed,
    "manual_files_matched": lambda s, d: matching.match_files(matching.sniffed(_files(s, d)), _items(s, d)),
    "ris_round_trip": _ris_round,
    "jsonl_last_wins": _jsonl_round,
    "csv_round_trip": _csv_round,
    "paired_rows": _paired,
    "label_map_round_trip": _label_round,
    "library_inventory": _library_round,
    "absolute_pdf_links": lambda s, d: _html(s, d).select("zotero_key", "url", F.posexplode(keys.page_pdf_links(F.col("html"), F.col("url"))).alias("pos", "link")),
    "derived_pdf_urls": _patterns,
    "merge_statistics": _merge_stats,
    "flag_rate_projection": _flag_rate,
    "common_codes_ordered": _common,
}


def _hash(text: str, digits: int = 4) -> str:
    return f"cast('0x' || substr(md5({text}), 1, {digits}) AS bigint)"


_RECS = "recs AS (SELECT record_id, unnest(x) FROM (SELECT record_id, arg_min(struct_pack(title, abstract, year), row_no) AS x FROM records WHERE record_id IS NOT NULL GROUP BY 1))"
_BODY = {"PUBLICATION_YEAR": "coalesce(year, 'NA')", "TITLE": "coalesce(title, '')", "ABSTRACT": "coalesce(abstract, 'NA')"}


def _request_sql(labels: list[str], ask: str) -> str:
    values = {"RECORD_ID": "record_id", "SCREENING_LEVEL": "'review'", **_BODY}
    parts = " || chr(10) || chr(10) || ".join(f"'{x}: ' || {values.get(x, repr('NA'))}" for x in labels)
    return f"{parts} || chr(10) || chr(10) || '{ask}'"


_VERDICTS = f"{verdict_queries.BASE}, seen AS (SELECT *, {_hash('record_id')} % 4 AS h FROM verdicts), asked AS (SELECT *, needs_second_opinion AND h IN (0, 1) AND screening_code <> CASE h WHEN 0 THEN 'INCLUDE_TA' ELSE 'EXCLUDE_OUTCOME' END AS changed FROM seen)"
_REVIEWED = """SELECT record_id, CASE WHEN NOT changed THEN screening_code WHEN h = 0 THEN 'INCLUDE_TA' ELSE 'EXCLUDE_OUTCOME' END AS screening_code, CASE WHEN NOT changed THEN screening_decision WHEN h = 0 THEN 'INCLUDE' ELSE 'EXCLUDE' END AS screening_decision,
  needs_second_opinion AND h = 3 AS needs_second_opinion, CASE WHEN changed THEN screening_code END AS overridden_code, CASE WHEN needs_second_opinion THEN CASE WHEN changed THEN 'override' ELSE 'confirm' END END AS adjudication, needs_second_opinion AS critic_applied FROM asked"""
_ITEMS = f"items AS (SELECT zotero_key, x.title AS title, x.doi AS doi, {_hash('zotero_key')} % 4 AS h FROM (SELECT zotero_key, min(struct_pack(title, doi := coalesce(doi, ''))) AS x FROM library_export WHERE title <> '' GROUP BY 1))"
_PAGE = "pages AS (SELECT DISTINCT zotero_key, url, coalesce(doi, '') AS doi FROM library_export WHERE url <> '')"

ORACLES = {
    "screen_once": f"""WITH {_RECS}, x AS (SELECT record_id, m AS model, {_hash("record_id || '|' || m")} % 8 AS h, coalesce(title, '') = '' AS bare FROM recs, (VALUES ('m0'), ('m1')) t(m))
      SELECT record_id, model, CASE h WHEN 1 THEN 'EXCLUDE_OUTCOME' WHEN 3 THEN 'EXCLUDE_POPULATION' WHEN 5 THEN 'EXCLUDE_STUDY_DESIGN' WHEN 6 THEN 'EXCLUDE_TOPIC' ELSE 'INCLUDE_TA' END AS screening_code, CASE WHEN h IN (1, 3, 5) THEN 'EXCLUDE' ELSE 'INCLUDE' END AS screening_decision,
      CASE WHEN h = 0 THEN 'High' WHEN h IN (4, 7) THEN 'Low' END AS confidence, h IN (3, 4, 5, 7) AS needs_second_opinion, CASE h WHEN 3 THEN 'quote_validation_failed' WHEN 4 THEN 'parse_error' WHEN 7 THEN 'api_error' ELSE '' END AS flags, CASE WHEN h IN (2, 3, 4) THEN 2 ELSE 1 END AS attempts FROM x""",
    "request_texts": f"""WITH {_RECS} SELECT record_id, md5({_request_sql(["RECORD_ID", "PUBLICATION_YEAR", "TITLE", "ABSTRACT"], "Screen this record. Return the JSON object now.")}) AS plain,
      md5({_request_sql(["RECORD_ID", "SCREENING_LEVEL", "PUBLICATION_YEAR", "LANGUAGE_METADATA", "TITLE", "ABSTRACT", "KEYWORDS", "SOURCE_REVIEW_ID", "SOURCE_REVIEW_IN_SCOPE"], "Screen this record using the ULCM hierarchical TAS rules. Return the JSON object now.")}) AS hierarchical FROM recs""",
    "critic_review": f"{_VERDICTS} {_REVIEWED}",
    "critic_counts": f"{_VERDICTS} SELECT count(*) AS n, count(*) FILTER (WHERE critic_applied) AS applied, count(*) FILTER (WHERE adjudication = 'override') AS overrides FROM ({_REVIEWED})",
    "few_shot_comparison": f"""{verdict_queries.SCORED}, s AS (SELECT x.scenario, y, decision AS d FROM truth t, (VALUES ('base', 'orlo-large-2'), ('new', 'orlo-mini-2')) x(scenario, m) LEFT JOIN models ON models.record_id = t.record_id AND models.model = x.m),
      c AS (SELECT scenario, count(*) FILTER (WHERE d = 'INCLUDE' AND y = 1) AS tp, count(*) FILTER (WHERE d = 'INCLUDE' AND y = 0) AS fp, count(*) FILTER (WHERE d = 'EXCLUDE' AND y = 1) AS fn, count(*) FILTER (WHERE d = 'EXCLUDE' AND y = 0) AS tn, count(*) FILTER (WHERE d IS NULL) AS n_undecided FROM s GROUP BY 1),
      e AS (SELECT *, tp + fp + fn + tn AS n, (tp + fp) / nullif(tp + fp + fn + tn, 0) AS pp, (tp + fn) / nullif(tp + fp + fn + tn, 0) AS ap FROM c)
      SELECT scenario, tp, fp, fn, tn, n_undecided, round(tp / nullif(tp + fn, 0), 6) AS sensitivity, round(tn / nullif(tn + fp, 0), 6) AS specificity, round(((tp + tn) / nullif(n, 0) - (pp * ap + (1 - pp) * (1 - ap))) / nullif(1 - (pp * ap + (1 - pp) * (1 - ap)), 0), 6) AS kappa FROM e""",
    "exemplar_blocks": """WITH r AS (SELECT source_file, row_no, title, abstract, row_number() OVER (PARTITION BY source_file ORDER BY row_no) AS k FROM records WHERE title IS NOT NULL AND source_file IS NOT NULL AND row_no < 400)
      SELECT source_file AS query, 'EXEMPLARS (similar previously-decided records):' || chr(10) || string_agg('- GOLD: INCLUDE' || chr(10) || '  TITLE: ' || substr(title, 1, 140) || chr(10) || '  ABSTRACT: ' || substr(coalesce(abstract, ''), 1, 420), chr(10) ORDER BY k) AS block FROM r WHERE k <= 4 GROUP BY 1""",
    "manual_files_sniffed": rf"""WITH {_ITEMS} SELECT zotero_key || '.pdf' AS file, CASE WHEN h = 0 AND doi <> '' THEN regexp_replace(lower(regexp_extract('doi:' || doi || ').', '(10\.\d{{4,9}}/[^\s"''<>)\]}}]+)', 1)), '[.,;:)\]}}]+$', '') ELSE '' END AS dois,
      CASE WHEN h = 1 AND length(trim(title || ' x')) > 25 THEN trim(title || ' x') WHEN h = 0 AND doi <> '' AND length('Downloaded. doi:' || doi || ').') > 25 THEN 'Downloaded. doi:' || doi || ').' ELSE '' END AS rough_title FROM items WHERE h < 3""",
    "ris_round_trip": r"""SELECT cast(row_no AS varchar) AS record_id, trim(regexp_replace(coalesce(title, ''), '\s+', ' ', 'g')) AS title, regexp_extract(coalesce(year, ''), '(\d{4})', 1) AS year, CASE WHEN upper(type) IN ('JOUR', 'RPRT', 'CHAP', 'THES', 'CONF') THEN upper(type) ELSE 'JOUR' END AS type,
      trim(regexp_replace(lower(coalesce(doi, '')), 'https?://doi\.org/', '')) AS doi FROM records""",
    "jsonl_last_wins": "SELECT record_id, max(CASE WHEN result_id % 3 = 0 THEN result_id + 1000000000 ELSE result_id END) AS result_id, CASE WHEN bool_or(result_id % 3 = 0) THEN 'AGAIN' ELSE arg_max_null(screening_code, result_id) END AS screening_code FROM results WHERE record_id IS NOT NULL GROUP BY 1",
    "csv_round_trip": "SELECT cast(row_no AS varchar) AS row_no, 'a \"b\",' || chr(10) || coalesce(title, '-') AS title FROM records",
    "paired_rows": r"SELECT 'k' || row_no AS record_id, CASE WHEN lower(trim(coalesce(title, ''))) IN ('', 'nan') THEN '' ELSE regexp_replace(title, '^\s+|\s+$', '', 'g') END AS title, CASE WHEN row_no % 3 = 0 THEN 'NA' ELSE coalesce(upper(screening_level), 'NA') END AS label FROM records",
    "label_map_round_trip": "SELECT record_id, max(current_gt_label) AS label FROM gt_error_candidates_5_fp WHERE record_id IS NOT NULL AND current_gt_label IS NOT NULL GROUP BY 1",
    "library_inventory": rf"""SELECT zotero_key, regexp_extract(coalesce(x.year, ''), '(\d{{4}})', 1) AS year, h > 0 AS has_pdf, CASE h WHEN 1 THEN zotero_key || '_a' WHEN 2 THEN zotero_key || '_b' WHEN 3 THEN zotero_key || '_b' END AS pdf_attachment_key
      FROM (SELECT zotero_key, min(struct_pack(title, authors, year)) AS x, {_hash("zotero_key")} % 4 AS h FROM library_export GROUP BY 1)""",
    "absolute_pdf_links": rf"""WITH {_PAGE}, b AS (SELECT *, regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS base, regexp_extract(url, '^([a-z]+://.*/)', 1) AS folder FROM pages)
      SELECT zotero_key, url, cast(pos AS int) AS pos, link FROM (SELECT DISTINCT zotero_key, url, unnest([0, 1, 2]) AS pos, unnest([base || '/full/' || zotero_key || '.pdf', folder || 'files/a.pdf?x=1&y=2', 'https://iris.who.int/server/api/core/bitstreams/0a-1B/content']) AS link, doi FROM b)""",
    "derived_pdf_urls": f"""WITH {_PAGE}, h AS (SELECT DISTINCT zotero_key, doi, {_hash("zotero_key")} % 5 AS h FROM pages),
      l AS (SELECT zotero_key, doi, CASE h WHEN 0 THEN ['https://onlinelibrary.wiley.com/doi/pdfdirect/' || doi || '?download=true', 'https://onlinelibrary.wiley.com/doi/pdf/' || doi || '?download=true', 'https://onlinelibrary.wiley.com/full/' || zotero_key || '.pdf', 'https://onlinelibrary.wiley.com/doi/pdfdirect/10.1002/x1?download=true']
        WHEN 1 THEN ['https://journals.sagepub.com/doi/pdf/' || doi || '?download=true', 'https://journals.sagepub.com/full/' || zotero_key || '.pdf', 'https://journals.sagepub.com/doi/pdfdirect/10.1177/y2?download=true'] WHEN 2 THEN ['https://www.jmir.org/2020/1/e1/PDF', 'https://www.jmir.org/full/' || zotero_key || '.pdf']
        WHEN 3 THEN ['https://www.mdpi.com/1/2/3/pdf', 'https://www.mdpi.com/full/' || zotero_key || '.pdf'] ELSE ['https://link.springer.com/content/pdf/' || doi || '.pdf', 'https://link.springer.com/full/' || zotero_key || '.pdf'] END AS l FROM h)
      SELECT zotero_key, doi, cast(pos - 1 AS int) AS pos, l[pos] AS link FROM (SELECT zotero_key, doi, l, unnest(range(1, len(l) + 1)) AS pos FROM l)""",
    "merge_statistics": f"{verdict_queries.BASE} SELECT count(*) AS n, count(*) FILTER (WHERE model_agreement) AS agree, count(*) FILTER (WHERE NOT model_agreement) AS disagree, count(*) FILTER (WHERE needs_second_opinion) AS flagged FROM verdicts",
    "flag_rate_projection": r"""WITH s AS (SELECT record_id, avg(CASE upper(regexp_replace(screening_decision, '^\s+|\s+$', '', 'g')) WHEN 'INCLUDE' THEN 1.0 WHEN 'EXCLUDE' THEN 0.0 END) AS share FROM results GROUP BY 1), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE share > 0) AS flagged, count(*) FILTER (WHERE share = 0) AS sure_exclude FROM s)
      SELECT *, round(flagged / n, 6) AS flag_rate, round(sure_exclude / n, 6) AS sure_rate, cast(round(flagged / n * 29251) AS bigint) AS projected_flags, cast(round(sure_exclude / n * 29251) AS bigint) AS projected_sure FROM n""",
    "common_codes_ordered": "SELECT code, n, cast(row_number() OVER (ORDER BY n DESC, code) AS int) AS place FROM (SELECT coalesce(screening_code, 'none') AS code, count(*) AS n FROM results GROUP BY 1)",
}
