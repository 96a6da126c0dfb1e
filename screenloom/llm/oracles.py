"""DuckDB SQL twins of the pN_ queries that SQL can express."""

from __future__ import annotations

from screenloom.llm import characters

_LOOK = "".join(characters.LOOKALIKES)
_CASE = "|".join((characters.INVISIBLE, characters.BLANKS, characters.STYLED, characters.ACCENT, rf"\p{{Latin}}\p{{M}}*[{_LOOK}\p{{Cyrillic}}]", rf"[{_LOOK}\p{{Cyrillic}}]\p{{M}}*\p{{Latin}}"))

ORACLES: dict[str, str] = {
    "p2_found": r"""
        WITH words AS (SELECT row_no, regexp_extract_all(lower(coalesce(title, '') || ' ' || abstract), '[\p{L}\p{N}]+') AS w FROM records WHERE abstract IS NOT NULL AND abstract NOT IN ('', 'NA')),
        triples AS (SELECT DISTINCT row_no, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM (SELECT row_no, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
        sizes AS (SELECT row_no, count(*) AS n FROM triples GROUP BY 1),
        shared AS (SELECT a.row_no AS x, b.row_no AS y, count(*) AS s FROM triples a JOIN triples b ON a.t = b.t AND a.row_no < b.row_no GROUP BY 1, 2)
        SELECT x AS row_no_a, y AS row_no_b FROM shared JOIN sizes a ON a.row_no = x JOIN sizes b ON b.row_no = y WHERE s >= 0.5 * (a.n + b.n - s)""",
    "p4_found": f"""
        SELECT field, row_key FROM (
          SELECT 'records.abstract' AS field, row_no AS row_key, abstract AS text FROM records
          UNION ALL SELECT 'results.supporting_quote', result_id, supporting_quote FROM results) WHERE regexp_matches(text, '{_CASE}')""",
}
