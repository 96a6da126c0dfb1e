"""Queries of references, retrieval and inventory with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenloom.functions import keys
from screenloom.operators import inventory as inv
from screenloom.operators import matching
from screenloom.operators import references as ref
from screenloom.operators import retrieval as ret
from screenloom.session import table


def _cascade(spark, d):
    """Library items against records by DOI and title, and against another list that knows items by their address only."""
    lib = table(spark, d, "library_export")
    rows = lib.select(F.col("zotero_key").alias("key"), "doi", "url", "title").dropDuplicates(["key", "doi", "url", "title"])
    none = F.lit(None).cast("string")
    records = table(spark, d, "records").select(F.col("record_id").alias("map_id"), "doi", none.alias("url"), "title", F.col("row_no").alias("ord"))
    h = F.conv(F.substring(F.md5("url"), 1, 12), 16, 10).cast("bigint")
    listed = lib.filter("url <> ''").select(F.concat(F.lit("U"), F.md5("url")).alias("map_id"), none.alias("doi"), F.concat(F.upper("url"), F.lit("//")).alias("url"), none.alias("title"), h.alias("ord")).filter("ord % 3 = 0")
    return ref.cascade_lookup(rows, records.unionByName(listed))


def _pool(spark, d):
    return table(spark, d, "documents").filter("text IS NOT NULL").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


def _top(spark, d):
    """Queries are the labelled documents whose id is divisible by 50, against all labelled documents."""
    pool = _pool(spark, d)
    return ret.top(ret.bm25(pool, pool.filter("doc_id % 50 = 0"), "doc_id", "text"))


def _candidates(spark, d):
    """Candidates of a library item: records with a DOI whose title is like the item's, of any year; the operator rates the years."""
    rows = table(spark, d, "library_export").groupBy(F.col("zotero_key").alias("key")).agg(F.min(F.struct("title", "year")).alias("x")).select("key", "x.*")
    cand = table(spark, d, "records").select(F.col("row_no").alias("r"), "title", keys.doi_key(F.col("doi")).alias("doi"), keys.first_year(F.col("year")).try_cast("int").alias("cand_year")).filter("doi <> ''")
    near = matching.best_title_pairs(rows.select(F.col("key").alias("l"), "title", F.col("year").try_cast("int").alias("year")), cand.select("r", "title", F.col("cand_year").alias("year")), 0.6)
    full = near.join(cand, "r").select(F.col("l").alias("key"), F.col("r").alias("ord"), "doi", F.col("title").alias("cand_title"), "cand_year", "ratio")
    return ref.best_candidates(rows.select("key", "year"), full)


def _html(spark, d):
    url = F.coalesce("url", F.lit(""))
    page = F.concat(F.lit('<html><head><meta name="citation_pdf_url" content="'), url, F.lit('/full.pdf"></head><a href="'), url, F.lit('/a.pdf?x=1&amp;y=2">PDF</a><a href='), url, F.lit("/b.pdf>b</a></html>"))
    return table(spark, d, "library_export").filter("url <> ''").select("zotero_key", page.alias("html")).distinct()


def _best(spark, d):
    rank = [F.when(F.col("l_returnflag") == "R", 0).otherwise(1), F.when(F.col("l_linestatus") == "F", 0).otherwise(1), F.col("l_linenumber")]
    return inv.best_child(table(spark, d, "lineitem"), "l_orderkey", rank, ["l_linenumber", "l_returnflag"])


def _work(spark, d):
    rows = inv.missing(table(spark, d, "library_export")).select("zotero_key", "publisher", "year", "doi", "title").distinct()
    return inv.numbered(rows, ["publisher", "year"], ["zotero_key", "doi", "title"]).select("number", "publisher", "year", "zotero_key")


def _lib(s, d):
    return table(s, d, "library_export")


QUERIES = {
    "dedup_funnel": lambda s, d: ref.dedup_funnel(table(s, d, "records")),
    "dedup_kept": lambda s, d: ref.dedup_stages(table(s, d, "records"))[-1].select("row_no"),
    "data_quality": lambda s, d: ref.data_quality(table(s, d, "records")),
    "cascade_lookup": _cascade,
    "match_method_counts": lambda s, d: _cascade(s, d).groupBy("method").agg(F.count("*").alias("n")),
    "ris_export_lines": lambda s, d: ref.ris_lines(table(s, d, "records")),
    "seed_overlap": lambda s, d: ref.overlap(table(s, d, "gt_error_candidates_5_fp"), table(s, d, "records")),
    "doi_candidates_best": _candidates,
    "key_normalisers": lambda s, d: table(s, d, "records").select("row_no", keys.doi_key(F.col("doi")).alias("doi_key"), keys.title_key_ascii(F.col("title")).alias("title_ascii"), keys.title_key_untagged(F.col("title")).alias("title_untagged"), keys.first_year(F.col("year")).alias("year4")),
    "title_key_words": lambda s, d: table(s, d, "records").select("row_no", keys.title_key_words(F.col("title")).alias("title_key")),
    "first_author": lambda s, d: _lib(s, d).select("zotero_key", keys.first_author(F.col("authors")).alias("first_author")).distinct(),
    "safe_filename": lambda s, d: _lib(s, d).select("zotero_key", keys.target_filename(F.col("zotero_key"), F.col("doi"), F.col("title")).alias("file")).distinct(),
    "url_host": lambda s, d: _lib(s, d).groupBy(keys.url_host(F.col("url")).alias("host")).agg(F.count("*").alias("n")),
    "citation_pdf_url": lambda s, d: _html(s, d).select("zotero_key", keys.citation_pdf_url(F.col("html")).alias("pdf_url")),
    "pdf_link_candidates": lambda s, d: _html(s, d).select("zotero_key", F.posexplode(keys.pdf_links(F.col("html"))).alias("pos", "link")),
    "publisher_map": lambda s, d: inv.missing(_lib(s, d)).groupBy("publisher").agg(F.count("*").alias("n")),
    "worklist_numbered": _work,
    "library_coverage": lambda s, d: inv.coverage(_lib(s, d)),
    "parents_with_child": lambda s, d: inv.with_child(_lib(s, d), table(s, d, "documents"), "zotero_key").select("zotero_key").distinct(),
    "parents_without_child": lambda s, d: inv.without_child(_lib(s, d), table(s, d, "documents"), "zotero_key").select("zotero_key").distinct(),
    "all_children_empty": lambda s, d: inv.all_children(table(s, d, "lineitem"), "l_orderkey", F.col("l_returnflag") == "N"),
    "best_attachment": _best,
    "notes_exclude": lambda s, d: inv.mentioning(table(s, d, "documents"), "zotero_key", "text", "excl"),
    "bm25_top16": _top,
    "balanced_exemplars": lambda s, d: ret.balanced(_top(s, d), table(s, d, "labels").groupBy(F.col("doc_id").alias("id")).agg((F.max("quality") >= 3).cast("int").alias("label"))),
    "stratified_split": lambda s, d: ret.split(table(s, d, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))),
    "seeded_sample": lambda s, d: ret.sample(table(s, d, "records").select("row_no"), "row_no", 50),
}

_DOI = r"coalesce(regexp_replace(lower(trim({c})), '^(?:https?://[^/]+/|doi:?\s*)+', ''), '')"
_ASCII = "coalesce(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')), '')"
_UNTAG = "coalesce(trim(regexp_replace(regexp_replace(regexp_replace(lower(title), '<[^>]+>', ' ', 'g'), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g')), '')"
_WORDS = r"coalesce(trim(regexp_replace(regexp_replace(lower(title), '\s+', ' ', 'g'), '[^\p{L}\p{M}\p{N}_\s]', '', 'g')), '')"
_SAFE = "CASE WHEN {x} = '' THEN 'untitled' ELSE {x} END"


def _safe(c: str) -> str:
    return _SAFE.format(x=f"substr(regexp_replace(regexp_replace(coalesce(trim({c}), ''), '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80)")


_STAGES = f"""a AS (SELECT *, row_number() OVER (PARTITION BY coalesce(trim(record_id), '') ORDER BY row_no) AS rn, coalesce(trim(record_id), '') AS k FROM records),
b0 AS (SELECT * EXCLUDE (rn, k) FROM a WHERE rn = 1 OR k = ''),
b AS (SELECT *, {_DOI.format(c='doi')} AS k, row_number() OVER (PARTITION BY {_DOI.format(c='doi')} ORDER BY row_no) AS rn FROM b0),
c0 AS (SELECT * EXCLUDE (rn, k) FROM b WHERE rn = 1 OR k = ''),
c AS (SELECT *, {_ASCII} AS k, row_number() OVER (PARTITION BY {_ASCII} ORDER BY row_no) AS rn FROM c0),
d0 AS (SELECT * EXCLUDE (rn, k) FROM c WHERE rn = 1 OR k = '')"""
_CASCADE = f"""m AS (SELECT record_id, row_no, {_DOI.format(c='doi')} AS kd, {_WORDS} AS kt FROM records),
md AS (SELECT kd, arg_max(record_id, row_no) AS id FROM m WHERE kd <> '' GROUP BY 1), mt AS (SELECT kt, arg_max(record_id, row_no) AS id FROM m WHERE kt <> '' GROUP BY 1),
mu AS (SELECT DISTINCT lower(url) AS ku, 'U' || md5(url) AS id FROM library_export WHERE url <> '' AND cast('0x' || substr(md5(url), 1, 12) AS bigint) % 3 = 0),
l AS (SELECT DISTINCT zotero_key AS key, doi, url, title, {_DOI.format(c='doi')} AS kd, rtrim(lower(trim(url)), '/') AS ku, {_WORDS} AS kt FROM library_export),
f AS (SELECT l.key, CASE WHEN md.kd IS NOT NULL THEN md.id WHEN mu.ku IS NOT NULL THEN mu.id ELSE mt.id END AS id, CASE WHEN md.kd IS NOT NULL THEN 'doi' WHEN mu.ku IS NOT NULL THEN 'url' WHEN mt.kt IS NOT NULL THEN 'title' END AS how FROM l LEFT JOIN md ON l.kd = md.kd LEFT JOIN mu ON l.ku = mu.ku LEFT JOIN mt ON l.kt = mt.kt),
cascade_result AS (SELECT key, nullif(id, '') AS map_id, CASE WHEN coalesce(id, '') <> '' THEN how ELSE 'unmatched' END AS method FROM f)"""
_BLANK = "coalesce(trim({c}), '') IN ('', 'NA')"
_Y4 = r"regexp_extract({c}, '(\d{{4}})', 1)"
_PUB = ", ".join(f"('{k}', '{v}')" for k, v in keys.PUBLISHERS.items())
_MISSING = rf"""pubs(px, pn) AS (VALUES {_PUB}), missing AS (SELECT l.*, coalesce(pn, 'Other') AS publisher FROM library_export l LEFT JOIN pubs ON regexp_extract(trim(coalesce(doi, '')), '^(10\.\d+)', 1) = px
  WHERE NOT coalesce(has_pdf, false) AND trim(coalesce(doi, '')) <> '' AND NOT (upper(doi) LIKE '%ISRCTN%' OR upper(doi) LIKE '%/CENTRAL/CN-%' OR upper(trim(doi)) LIKE '10.1002/CENTRAL%'))"""
_TOK = r"list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: length(x) > 2)"
_BM25 = f"""pool AS (SELECT doc_id, {_TOK} AS t FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL),
own AS (SELECT doc_id, term, dl, count(*) AS tf FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM pool) GROUP BY 1, 2, 3),
st AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM pool),
idf0 AS (SELECT term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM own, st GROUP BY term, n),
idf AS (SELECT term, CASE WHEN idf < 0 THEN 0.25::double * (SELECT avg(idf) FROM idf0) ELSE idf END AS idf FROM idf0),
sc AS (SELECT q.doc_id AS q, o.doc_id AS id, sum(q.tf * idf * o.tf * 2.5::double / (o.tf + 1.5::double * (0.25::double + 0.75::double * o.dl / avgdl))) AS score FROM own q JOIN idf USING (term) JOIN own o USING (term), st WHERE q.doc_id % 50 = 0 AND q.doc_id <> o.doc_id GROUP BY 1, 2),
top AS (SELECT q, id, round(score, 4) AS score, rank FROM (SELECT *, cast(row_number() OVER (PARTITION BY q ORDER BY round(score, 6) DESC, id) AS int) AS rank FROM sc) WHERE rank <= 16)"""
_PAGE = "page AS (SELECT DISTINCT zotero_key, url FROM library_export WHERE url <> '')"

ORACLES = {
    "dedup_funnel": f"WITH {_STAGES} SELECT 0 AS step, 'raw' AS stage, count(*) AS n FROM records UNION ALL SELECT 1, 'after_id', count(*) FROM b0 UNION ALL SELECT 2, 'after_doi', count(*) FROM c0 UNION ALL SELECT 3, 'after_title', count(*) FROM d0",
    "dedup_kept": f"WITH {_STAGES} SELECT row_no FROM d0",
    "data_quality": f"SELECT source_file, count(*) AS n, count(*) FILTER (WHERE {_BLANK.format(c='abstract')}) AS no_abstract, count(*) FILTER (WHERE {_BLANK.format(c='title')}) AS no_title, count(*) FILTER (WHERE {_BLANK.format(c='doi')}) AS no_doi, count(*) FILTER (WHERE coalesce({_Y4.format(c='year')}, '') = '') AS no_year, count(*) FILTER (WHERE try_cast({_Y4.format(c='year')} AS int) < 2000) AS before_2000 FROM records GROUP BY 1",
    "cascade_lookup": f"WITH {_CASCADE} SELECT * FROM cascade_result",
    "match_method_counts": f"WITH {_CASCADE} SELECT method, count(*) AS n FROM cascade_result GROUP BY 1",
    "ris_export_lines": f"""WITH ty(a, b) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in keys.RIS_TYPES.items())})
      SELECT row_no, concat_ws(chr(10), 'TY  - ' || coalesce(b, 'JOUR'), CASE WHEN title <> '' THEN 'T1  - ' || title END, CASE WHEN year <> '' THEN 'PY  - ' || year END, CASE WHEN abstract NOT IN ('', 'NA') THEN 'AB  - ' || abstract END,
      CASE WHEN doi <> '' THEN 'DO  - ' || regexp_replace(lower(doi), 'https?://doi\\.org/', '', 'g') END, CASE WHEN record_id <> '' THEN 'U1  - ' || record_id END, 'ER  - ') AS ris FROM records LEFT JOIN ty ON upper(type) = a""",
    "seed_overlap": "SELECT DISTINCT record_id FROM gt_error_candidates_5_fp WHERE record_id IN (SELECT record_id FROM records)",
    "key_normalisers": f"SELECT row_no, {_DOI.format(c='doi')} AS doi_key, {_ASCII} AS title_ascii, {_UNTAG} AS title_untagged, coalesce({_Y4.format(c='year')}, '') AS year4 FROM records",
    "title_key_words": f"SELECT row_no, {_WORDS} AS title_key FROM records",
    "first_author": r"SELECT DISTINCT zotero_key, coalesce(regexp_extract(trim(regexp_extract(authors, '^([^;,]*)', 1)), '(\S+)$', 1), '') AS first_author FROM library_export",
    "safe_filename": f"SELECT DISTINCT zotero_key, zotero_key || '_' || CASE WHEN coalesce(doi, '') <> '' THEN {_safe('doi')} ELSE {_safe('title')} END || '.pdf' AS file FROM library_export",
    "url_host": "SELECT coalesce(replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), 'www.', ''), '') AS host, count(*) AS n FROM library_export GROUP BY 1",
    "citation_pdf_url": f"WITH {_PAGE} SELECT zotero_key, url || '/full.pdf' AS pdf_url FROM page",
    "pdf_link_candidates": f"WITH {_PAGE} SELECT zotero_key, 0 AS pos, url || '/full.pdf' AS link FROM page UNION ALL SELECT zotero_key, 1, url || '/a.pdf?x=1&y=2' FROM page UNION ALL SELECT zotero_key, 2, url || '/b.pdf' FROM page",
    "publisher_map": f"WITH {_MISSING} SELECT publisher, count(*) AS n FROM missing GROUP BY 1",
    "worklist_numbered": f"WITH {_MISSING} SELECT row_number() OVER (ORDER BY publisher, year NULLS FIRST, zotero_key, doi NULLS FIRST, title NULLS FIRST) AS number, publisher, year, zotero_key FROM (SELECT DISTINCT zotero_key, publisher, year, doi, title FROM missing)",
    "library_coverage": "SELECT item_type, count(*) AS n, count(*) FILTER (WHERE trim(coalesce(doi, '')) <> '') AS with_doi, count(*) FILTER (WHERE has_pdf) AS with_pdf, count(*) FILTER (WHERE has_pdf AND trim(coalesce(doi, '')) <> '') AS with_both FROM library_export GROUP BY 1",
    "parents_with_child": "SELECT DISTINCT zotero_key FROM library_export WHERE zotero_key IN (SELECT zotero_key FROM documents WHERE zotero_key IS NOT NULL)",
    "parents_without_child": "SELECT DISTINCT zotero_key FROM library_export WHERE zotero_key NOT IN (SELECT zotero_key FROM documents WHERE zotero_key IS NOT NULL)",
    "all_children_empty": "SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_and(l_returnflag = 'N')",
    "best_attachment": "SELECT l_orderkey, l_linenumber, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_returnflag = 'R') DESC, (l_linestatus = 'F') DESC, l_linenumber, l_returnflag) AS rn FROM lineitem) WHERE rn = 1",
    "notes_exclude": "SELECT zotero_key, count(*) AS n_notes, count(*) FILTER (WHERE lower(regexp_replace(text, '<[^>]+>', ' ', 'g')) LIKE '%excl%') AS n_hits FROM documents WHERE zotero_key IS NOT NULL GROUP BY 1 HAVING n_hits > 0",
    "bm25_top16": f"WITH {_BM25} SELECT * FROM top",
    "balanced_exemplars": f"""WITH {_BM25}, lab AS (SELECT doc_id AS id, CASE WHEN max(quality) >= 3 THEN 1 ELSE 0 END AS label FROM labels GROUP BY 1),
      w AS (SELECT *, row_number() OVER (PARTITION BY q, label ORDER BY rank) AS within FROM top JOIN lab USING (id))
      SELECT q, id, label, cast(place AS int) AS place FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY within, label) AS place FROM w) WHERE place <= 4""",
    "stratified_split": "SELECT id, label, CASE WHEN r <= round_even(n * 0.4, 0) THEN 'test' ELSE 'train' END AS part FROM (SELECT doc_id AS id, quality AS label, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '|42'), doc_id) AS r, count(*) OVER (PARTITION BY quality) AS n FROM labels)",
    "seeded_sample": "SELECT row_no FROM records ORDER BY md5(row_no || '|42'), row_no LIMIT 50",
}
