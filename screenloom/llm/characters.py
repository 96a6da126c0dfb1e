"""One consistent form for texts that look the same but are made of different characters.

The work is embedded SQL: a DuckDB connection inside each Python worker runs one statement per Arrow batch
(``nfc_normalize``, ``translate``, regular expressions). Nothing is shuffled.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

# Latin ligatures and what they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
# Letters of other scripts that look like a Latin letter.
LOOKALIKES = {
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԝ": "W",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ї": "ï", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѵ": "v", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ё": "ë",
    # Armenian
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g",
}
# Fixed values, as classes of regular expressions. Characters without a shape; blanks other than the common one (line breaks aside).
INVISIBLE = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}]"
BLANKS = r"[\t\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]"
# Width forms, mathematical and enclosed alphabets, letter-like symbols, segmented digits, ligatures.
STYLED = r"[\x{FF01}-\x{FF5E}\x{FF61}-\x{FFDC}\x{FFE0}-\x{FFE6}\x{1D400}-\x{1D7FF}\x{2460}-\x{24FF}\x{1F110}-\x{1F169}\x{2102}\x{210A}-\x{2115}\x{2119}-\x{211D}\x{2124}\x{2128}-\x{2131}\x{2133}-\x{2139}\x{1FBF0}-\x{1FBF9}\x{1FDF0}-\x{1FDF9}\x{FB00}-\x{FB06}]"
ACCENT = r"\p{L}[\x{0300}-\x{036F}]"


@lru_cache(maxsize=1)
def styled_table() -> tuple[str, str]:
    """Styled characters and their plain forms, by rule: the compatibility decomposition where it is one
    character; digit blocks that have none are counted from their zero."""
    spans = ((0xFF01, 0xFF5E), (0xFF61, 0xFFDC), (0xFFE0, 0xFFE6), (0x1D400, 0x1D7FF), (0x2460, 0x24FF), (0x1F110, 0x1F169), (0x2102, 0x2139))
    pairs = {}
    for first, last in spans:
        for code in range(first, last + 1):
            plain = unicodedata.normalize("NFKC", chr(code))
            if plain != chr(code) and len(plain) == 1:
                pairs[chr(code)] = plain
    for zero in (0x1FBF0, 0x1FDF0):
        pairs |= {chr(zero + k): str(k) for k in range(10)}
    return "".join(pairs), "".join(pairs.values())


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@lru_cache(maxsize=1)
def statement() -> str:
    """SQL over a view ``batch(field, row_key, text)``: the consistent form, and whether the text was a case."""
    look = "".join(LOOKALIKES)
    mixed = rf"\p{{Latin}}\p{{M}}*[{look}\p{{Cyrillic}}]|[{look}\p{{Cyrillic}}]\p{{M}}*\p{{Latin}}"
    case = f"regexp_matches(text, {_quoted('|'.join((INVISIBLE, BLANKS, STYLED, ACCENT, mixed)))})"
    old, new = styled_table()
    plain = f"regexp_replace(regexp_replace(text, {_quoted(INVISIBLE)}, '', 'g'), {_quoted(BLANKS)}, ' ', 'g')"
    for lig, letters in LIGATURES.items():
        plain = f"replace({plain}, {_quoted(lig)}, {_quoted(letters)})"
    plain = f"nfc_normalize(translate({plain}, {_quoted(old)}, {_quoted(new)}))"
    pieces = rf"regexp_extract_all(plain, '[\p{{L}}\p{{M}}]+|[^\p{{L}}\p{{M}}]+')"
    words = rf"array_to_string(list_transform({pieces}, lambda w: CASE WHEN regexp_matches(w, '\p{{Latin}}') THEN translate(w, {_quoted(look)}, {_quoted(''.join(LOOKALIKES.values()))}) ELSE w END), '')"
    return f"""
        WITH marked AS (SELECT field, row_key, text, coalesce({case}, false) AS is_case FROM batch),
        plained AS (SELECT *, CASE WHEN is_case THEN {plain} ELSE text END AS plain FROM marked)
        SELECT field, row_key, CASE WHEN is_case THEN {words} ELSE text END AS text, is_case FROM plained"""


#: Bytes that a statement works on at once (a longer text alone).
BATCH_BYTES = 16_000_000


def consistent_form(df: DataFrame) -> DataFrame:
    """(field, row_key, text) -> (field, row_key, text, is_case): every text in one consistent form.

    Compatibility forms become plain characters, invisible characters go, blanks become the common space,
    separate accents join their letter, and letters of other scripts within a word of Latin letters become
    the letter they look like. Words wholly of another script stay. A null text stays null and is no case,
    an empty one stays empty. Rows are neither merged nor dropped; other columns don't matter.
    """
    sql = statement()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})  # nothing goes to a machine's own disk
        names = pa.schema([("field", pa.string()), ("row_key", pa.int64()), ("text", pa.string()), ("is_case", pa.bool_())])
        for batch in batches:
            rows = max(1, int(BATCH_BYTES / max(1, batch.nbytes / max(1, batch.num_rows))))
            for at in range(0, batch.num_rows, rows):
                con.register("batch", pa.Table.from_batches([batch.slice(at, rows)]))
                found = con.sql(sql).to_arrow_table().cast(names)
                con.unregister("batch")
                yield from found.to_batches()

    return df.select("field", "row_key", "text").mapInArrow(run, "field string, row_key bigint, text string, is_case boolean")
