"""Supporting quotes against their source: fragments, exact and tolerant matching."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONGEST_FRAGMENT, MOST_WINDOWS, LIKENESS = 200, 500, 0.90
# Sequences left by a wrong reading of UTF-8, and what they stood for. Five can't occur after
# compatibility composition, which changes their second or third character.
MOJIBAKE = {
    "\u00e2\u20ac\u2122": "'",
    "\u00e2\u20ac\u02dc": "'",
    "\u00e2\u20ac\u0153": '"',
    "\u00e2\u20ac\u009d": '"',
    "\u00e2\u20ac\u201c": "-",
    "\u00e2\u20ac\u2013": "-",
    "\u00e2\u20ac\u201d": "-",
    "\u00e2\u20ac\u00a6": "...",
    "\u00c3\u00a9": "\u00e9",
    "\u00c3\u00a8": "\u00e8",
    "\u00c3\u00a0": "\u00e0",
    "\u00c3\u00a2": "\u00e2",
    "\u00c3\u00bc": "\u00fc",
    "\u00c3\u00b6": "\u00f6",
    "\u00c3\u00b1": "\u00f1",
}
# Characters for single quotes and for dashes.
_SINGLE, _DASH = re.compile("[‘’ʼʹ′`]"), re.compile("[‐‑‒–—―]")


def fragments(quote: Column) -> Column:
    """The quoted pieces of a quote field, a last one without its closing mark included, escapes resolved; the whole
    field if nothing is quoted; none for null, blank and 'NA' in any case."""
    parts = F.transform(F.regexp_extract_all(quote, F.lit(r'"((?:\\.|[^"\\])*)(?:"|$)'), 1), lambda x: F.regexp_replace(x, r"\\(.)", "$1"))
    whole = F.array(F.regexp_replace(F.trim(quote), r'^"+|"+$', ""))
    full = F.when(F.size(parts) > 0, parts).otherwise(whole)
    none = quote.isNull() | F.upper(F.trim(quote)).isin("NA", "")
    return F.when(none, F.array().cast("array<string>")).otherwise(F.filter(full, lambda x: x != ""))


def normal(text: str | None) -> str:
    """Form for matching: compatibility decomposition without marks, plain quotes and dashes, words joined over line breaks."""
    s = _DASH.sub("-", _SINGLE.sub("'", unicodedata.normalize("NFKD", text or "")))
    s = "".join(c for c in re.sub(r"-\s+", "", s) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", s.lower()).strip()


def tolerant(fragment: str, text: str) -> bool:
    """Whether the fragment, or nearly its characters in any order, stands in the text (both in normal form).

    Windows of the fragment's length that begin with its first character are tried, MOST_WINDOWS at most, for fragments
    to LONGEST_FRAGMENT characters; these limits are the operator's meaning, not an approximation of it.
    """
    if fragment in text:
        return True
    n = len(fragment)
    if not n or n > LONGEST_FRAGMENT or n > len(text):
        return False
    want, at, tried = Counter(fragment), text.find(fragment[0]), 0
    while at != -1 and at + n <= len(text) and tried < MOST_WINDOWS:
        if sum((want & Counter(text[at : at + n])).values()) >= LIKENESS * n:
            return True
        tried += 1
        at = text.find(fragment[0], at + 1)
    return False


@F.pandas_udf(T.StringType())
def normal_text(text: pd.Series) -> pd.Series:
    return text.map(normal)


@F.pandas_udf(T.BooleanType())
def verified(parts: pd.Series, source: pd.Series) -> pd.Series:
    """All fragments stand in the source; true if there are none."""
    out = []
    for own, text in zip(parts, source, strict=True):
        plain = normal(text)
        out.append(all(tolerant(normal(f), plain) for f in (own if own is not None else [])))
    return pd.Series(out, dtype=bool)


@F.pandas_udf(T.BooleanType())
def verified_plain(parts: pd.Series, plain: pd.Series) -> pd.Series:
    """As ``verified``, against a source in normal form; a null source holds nothing."""
    return pd.Series([all(tolerant(normal(f), text or "") for f in (own if own is not None else [])) for own, text in zip(parts, plain, strict=True)], dtype=bool)


@F.pandas_udf(T.StringType())
def clean_extracted(text: pd.Series) -> pd.Series:
    """Text taken from a PDF file without ligatures, marks, words cut at line ends and signs of a wrong reading."""

    def one(t: str | None) -> str:
        s = unicodedata.normalize("NFKC", t or "")
        s = re.sub(r"-\s+", "", "".join(c for c in s if not unicodedata.combining(c)))
        for bad, good in MOJIBAKE.items():
            s = s.replace(bad, good)
        return re.sub(r"\s+", " ", s).strip()

    return text.map(one)
