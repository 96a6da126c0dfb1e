"""New batches against all accepted history: a segment index for titles within a bounded edit distance.

A title of length l is cut into SEGMENTS fixed segments, known by (l, number, text). A title within TAU edits
(insertions, deletions, substitutions; a swap of neighbours is two) leaves half of the segments whole, SHARED of them at odd places or
SHARED at even ones, so three of one parity at once are the join key: single segments ("costs and effects of") are shared by too many. The
history keeps the threes of its titles. A new title probes, for each length within TAU, the substrings near each segment's place; those
that may be in the history, by a filter of fixed size, are put together in threes. Titles that share one are candidates and are verified.
The batch's own threes, words and ids are appended. Nothing is computed again for the history: a batch reads the narrow
columns that it is joined with, and what it is told depends on earlier batches and itself only. Batches that wait may be taken
together: each is told what it would be told alone, by one reading of the history for all of them.
"""

from __future__ import annotations

import html
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.session import ensure_checkpoint_dir, stage, unstage

TAU = 5
SHARED = 3
#: With TAU of them hit, as many are whole, so SHARED of one parity are.
SEGMENTS = 2 * TAU
assert TAU == 2 * SHARED - 1
#: Shorter titles only equal others.
SHORTEST = 8
#: Short titles may differ by one edit per so many characters, at most.
CHARS_PER_EDIT = 5
#: Bits of either filter, of entries and of threes: a fixed 16 MB each. A full filter lets more through, never less.
FILTER_BITS = 27
#: Characters of a plan that the driver keeps for each job of a replay.
PLAN_TEXT = 2_000
#: Two spellings are both words of their own if each stands in so many titles and they are about as frequent.
OWN_WORD_TITLES, OWN_WORD_RATIO = 3, 0.02

_TAG = re.compile(r"<[^<>]{1,40}>")
_BRACKET = re.compile(r"\s*(?:\[([^\[\]]{1,40})\]|\(([^()]{1,40})\))\W*$")
_HALVES = re.compile(r"\s*[:;?]\s+|(?<=\w{3})\.\s+|\s+[-–—]+\s+|\s*[—]\s*")
_NOT_WORD = re.compile(r"[\W_]+")
# Words that may be missing, and words that number things.
ARTICLES = frozenset(("the", "a", "an"))
CONNECTIVES = frozenset(("and", "of", "in", "for", "to", "with", "from", "on", "by", "at", "as"))
NUMBERS = frozenset(
    "one two three four five six seven eight nine ten eleven twelve first second third fourth fifth sixth "
    "i ii iii iv v vi vii viii ix x baseline midline endline".split()
)
# Words that make a bracket at the end part of what a title says.
TELLING = frozenset("part phase stage wave follow followup baseline endline protocol correction erratum reply comment year month series volume".split())
# Endings and stems that differ between British and American spelling.
SPELLINGS = ((r"is(e|ed|es|ing|ation|ations)$", r"iz\1"), (r"ll(ing|ed|er|ers|or|ors)$", r"l\1"), (r"our(s|al|ally|ed|ing)?$", r"or\1"), (r"mmes?$", "m"), (r"tre(s?)$", r"ter\1"), (r"^(p)ae(d)", r"\1e\2"), (r"^gynae", "gyne"), (r"oe(d|s)", r"e\1"))
_SPELLINGS = tuple((re.compile(a), b) for a, b in SPELLINGS)


def _word(word: str) -> str:
    for pattern, to in _SPELLINGS:
        if len(word) > 5:
            word = pattern.sub(to, word)
    return word


def _untagged(text: str) -> str:
    """Without brackets at the end that say nothing of the study, such as the kind of record."""
    while found := _BRACKET.search(text):
        inside = _NOT_WORD.sub(" ", (found[1] or found[2] or "").lower()).split()
        if len(inside) > 3 or any(w in TELLING or w in NUMBERS or any(c.isdigit() for c in w) for w in inside):
            break
        text = text[: found.start()]
    return text


def _plain(text: str) -> str:
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    words = _NOT_WORD.sub(" ", text.replace("'", "").replace("’", "").lower().replace("&", " and ")).split()
    return " ".join(_word(w) for w in words if w not in ARTICLES)


def title_forms(title: str | None) -> list[str]:
    """The title without differences of writing, in canonical order of its two halves and in the other.

    Markup, tags in brackets at the end, case, accents, punctuation, articles and British or American spelling go.
    A title that is null, blank, 'NA' or has no words has no form and equals nothing.
    """
    text = _untagged(_TAG.sub("", html.unescape(title or "")))
    if text.strip().upper() in ("", "NA"):
        return []
    halves = _HALVES.split(text.strip(), maxsplit=1)
    parts = [p for p in (_plain(h) for h in halves) if p]
    if not parts:
        return []
    parts.sort()
    return [" ".join(parts)] if len(parts) == 1 else [" ".join(parts), " ".join(parts[::-1])]


def segment_spans(length: int) -> list[tuple[int, int]]:
    """(start, length) of the segments of a title of this length, the longer ones last."""
    base, longer = divmod(length, SEGMENTS)
    spans, at = [], 0
    for k in range(SEGMENTS):
        size = base + (k >= SEGMENTS - longer)
        spans.append((at, size))
        at += size
    return spans


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []
_OWN_THREES = np.array([t for parity in (0, 1) for t in combinations(range(parity, SEGMENTS, 2), SHARED)])


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n + 1 of each at least."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(1024, 2 * n)
        _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, b, dtype=np.uint64))), dtype=np.uint64) for b in (_BASE, _INVERSE)]
    return _POWERS


def _substrings(text: str, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of substrings, by differences of one running sum."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    up, down = _powers(len(codes))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(codes * down[1 : len(codes) + 1], dtype=np.uint64)))
    return (sums[start + size] - sums[start]) * up[start + size]


def edits_allowed(length: int) -> int:
    """Edits by which a title may differ from one that is not shorter."""
    return min(TAU, length // CHARS_PER_EDIT)


@lru_cache(maxsize=2_048)
def _own_plan(n: int) -> tuple[np.ndarray, ...]:
    """(start, size, salt) of the segments of a title of length n; salt tells length and number."""
    spans = np.array(segment_spans(n), dtype=np.int64)
    return spans[:, 0], spans[:, 1], np.array([n * 64 + k for k in range(SEGMENTS)], dtype=np.uint64) * np.uint64(_BASE)


@lru_cache(maxsize=2_048)
def _probe_plan(n: int) -> tuple[np.ndarray, ...]:
    """(start, size, salt, length, number, shift) of all substrings that may be whole segments of a title within TAU edits."""
    rows = []
    for length in range(max(SHORTEST, n - TAU), n + TAU + 1):
        delta = n - length
        before, after = (TAU - delta) // 2, (TAU + delta) // 2
        spans = segment_spans(length)
        for k in (*range(0, SEGMENTS, 2), *range(1, SEGMENTS, 2)):
            at, size = spans[k]
            rows += [(start, size, length * 64 + k, length, k, start - at) for start in range(max(0, at - before), min(n - size, at + after) + 1)]
    plan = np.array(rows, dtype=np.int64).reshape(-1, 6)
    return plan[:, 0], plan[:, 1], plan[:, 2].astype(np.uint64) * np.uint64(_BASE), plan[:, 3], plan[:, 4], plan[:, 5]


@lru_cache(maxsize=256)
def _places(n: int) -> np.ndarray:
    """All threes of n places, a row for each place of the three."""
    return np.array(list(combinations(range(n), SHARED)), dtype=np.int64).reshape(-1, SHARED).T


def _join_three(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return _mix(_mix(_mix(a) + b) + c)


def own_entries(form: str) -> np.ndarray:
    """The index entries of a title's segments; a title of fewer than SHORTEST characters has none: it only equals others."""
    if len(form) < SHORTEST:
        return np.empty(0, dtype=np.uint64)
    start, size, salt = _own_plan(len(form))
    return _mix(_substrings(form, start, size) + salt)


def own_threes(form: str) -> np.ndarray:
    """The join keys of a title of the history: the threes of its segments at even places and of those at odd ones."""
    e = own_entries(form)
    return _join_three(*(e[_OWN_THREES[:, k]] for k in range(3))) if len(e) else e


class Filter:
    """Which entries and threes a history may hold: two bit fields of fixed size, of 64-bit words."""

    KINDS = 2

    def __init__(self) -> None:
        self.words = np.zeros((self.KINDS, 1 << (FILTER_BITS - 6)), dtype=np.uint64)

    def __getstate__(self) -> list[bytes]:
        return [zlib.compress(w, 1) for w in self.words]  # nearly empty ones travel small

    def __setstate__(self, state: list[bytes]) -> None:
        self.words = [np.frombuffer(zlib.decompress(w), dtype=np.uint64) for w in state]

    @staticmethod
    def places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, bit) of each key."""
        place = keys >> np.uint64(64 - FILTER_BITS)
        return (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))

    def add(self, kind: int, keys: np.ndarray) -> None:
        word, bit = self.places(keys)
        np.bitwise_or.at(self.words[kind], word, bit)

    def may_hold(self, kind: int, keys: np.ndarray) -> np.ndarray:
        word, bit = self.places(keys)
        return (self.words[kind][word] & bit) != 0


def probe_threes(form: str, known: Filter) -> np.ndarray:
    """The threes of a history that a title may share: those of titles within TAU edits, less what the filter rules out.

    Characters put in or left out before, between and after the three show in how far each is shifted; they are edits, too.
    """
    if edits_allowed(len(form)) == 0:
        return np.empty(0, dtype=np.uint64)
    start, size, salt, length, number, shift = _probe_plan(len(form))
    entries = _mix(_substrings(form, start, size) + salt)
    at = np.nonzero(known.may_hold(0, entries))[0]
    of = length[at] * 2 + number[at] % 2  # in rising order, as plans are
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(at)]
    threes = [at[i:j][_places(j - i)] for i, j in pairwise(cuts) if j - i >= SHARED]
    if not threes:
        return np.empty(0, dtype=np.uint64)
    a, b, c = np.concatenate(threes, axis=1)
    moved = np.abs(shift[a]) + np.abs(shift[b] - shift[a]) + np.abs(shift[c] - shift[b]) + np.abs(len(form) - length[c] - shift[c])
    fit = (number[a] < number[b]) & (number[b] < number[c]) & (moved <= TAU)
    keys = np.unique(_join_three(entries[a[fit]], entries[b[fit]], entries[c[fit]]))
    return keys[known.may_hold(1, keys)]


def edit_distance(a: str, b: str, most: int, swap: int = 1) -> int:
    """Edit distance in which a swap of neighbours costs ``swap``, or most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    begin, end = 0, 0
    while begin < min(len(a), len(b)) and a[begin] == b[begin]:
        begin += 1
    while end < min(len(a), len(b)) - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[begin : len(a) - end], b[begin : len(b) - end]
    earlier: list[int] = []
    last = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        row = [i] + [most + 1] * len(b)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            cost = min(last[j - 1] + (a[i - 1] != b[j - 1]), last[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                cost = min(cost, earlier[j - 2] + swap)
            row[j] = cost
        if min(row) > most and (swap == 2 or not earlier or min(last) > most):
            return most + 1
        earlier, last = last, row
    return min(last[-1], most + 1)


def _slip(a: str, b: str) -> bool:
    if any(c.isdigit() for c in a + b) or a in NUMBERS or b in NUMBERS:
        return False
    short = min(len(a), len(b))
    return edit_distance(a, b, 2) <= (0 if short < 3 else 1 if short < 6 else 2)


def word_slips(a: str, b: str) -> list[tuple[str, str]] | None:
    """The pairs of words in which two forms differ, if each may be a slip; None if they say something else."""
    most = edits_allowed(min(len(a), len(b)))
    if edit_distance(a, b, most, swap=2) > most:
        return None
    x, y = a.split(), b.split()
    while x and y and x[0] == y[0]:
        x, y = x[1:], y[1:]
    while x and y and x[-1] == y[-1]:
        x, y = x[:-1], y[:-1]
    if "".join(x) == "".join(y):
        return []
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        pairs = [(p, q) for p, q in zip(x, y, strict=True) if p != q]
        return pairs if all(_slip(p, q) for p, q in pairs) else None
    if len(y) == len(x) + 1:
        for k in range(len(y)):  # a blank too many or too few, or a missing connective
            joined = [*y[:k], "".join(y[k : k + 2]), *y[k + 2 :]]
            for other in (joined, [*y[:k], *y[k + 1 :]] if y[k] in CONNECTIVES else joined):
                if len(other) == len(x):
                    pairs = [(p, q) for p, q in zip(x, other, strict=True) if p != q]
                    if all(_slip(p, q) for p, q in pairs):
                        return pairs
    return None


def with_forms(rows: DataFrame) -> DataFrame:
    """The titles of rows (title, batch_no) with ``form`` (canonical), ``other`` (halves swapped, or null), ``class`` (hash of form) and the
    first and last batch (``since``, ``until``) that they stand in."""

    def run(titles: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in titles:
            forms = [title_forms(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] if f else None for f in forms], pa.string()), pa.array([f[1] if len(f) > 1 else None for f in forms], pa.string())], names=["title", "since", "until", "form", "other"])

    titles = rows.filter("title IS NOT NULL").groupBy("title").agg(F.min("batch_no").alias("since"), F.max("batch_no").alias("until"))
    return titles.mapInArrow(run, "title string, since int, until int, form string, other string").filter("form IS NOT NULL").withColumn("class", F.xxhash64("form"))


def threes_of(classes: DataFrame) -> DataFrame:
    """(class, three): the join keys of title classes (class, form)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [own_threes(f) for f in batch.column(1).to_pylist()]
            yield _keyed(batch.column(0), keys, "class")

    return classes.select("class", "form").mapInArrow(run, "class bigint, three bigint")


def probes_of(classes: DataFrame, shared: Broadcast) -> DataFrame:
    """(probe, three) of title classes (class, form, other): both orders of the halves probe. Each row is a key that the
    filter (a broadcast Filter) may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.unique(np.concatenate([probe_threes(f or "", shared.value) for f in own])) for own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield _keyed(batch.column(0), keys, "probe")

    return classes.select("class", "form", "other").mapInArrow(run, "probe bigint, three bigint")


def _keyed(ids: pa.Array, keys: list[np.ndarray], name: str) -> pa.RecordBatch:
    many = np.array([len(k) for k in keys], dtype=np.int64)
    flat = np.concatenate(keys).view(np.int64) if len(keys) else np.empty(0, dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids.to_numpy(), many), pa.int64()), pa.array(flat, pa.int64())], names=[name, "three"])


def filter_words(classes: DataFrame) -> DataFrame:
    """(kind, word, bits): what title classes add to the filter; at most its size, whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(0).to_pylist()
            kinds, words, bits = [], [], []
            for kind, make in enumerate((own_entries, own_threes)):
                keys = np.concatenate([make(f) for f in forms] or [np.empty(0, dtype=np.uint64)])
                word, bit = Filter.places(keys)
                own, where = np.unique(word, return_inverse=True)
                merged = np.zeros(len(own), dtype=np.uint64)
                np.bitwise_or.at(merged, where, bit)
                kinds.append(np.full(len(own), kind))
                words.append(own)
                bits.append(merged.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in ((kinds, pa.int32()), (words, pa.int32()), (bits, pa.int64()))], names=["kind", "word", "bits"])

    return classes.select("form").mapInArrow(run, "kind int, word int, bits bigint").groupBy("kind", "word").agg(F.bit_or("bits").alias("bits"))


def candidates(probes: DataFrame, threes: DataFrame) -> DataFrame:
    """Distinct (probe, known) classes that share a three. Titles within TAU edits do, so nothing is lost and nothing is capped. A key with
    many titles is one for titles that agree in nearly half of their text; its rows are split by the adaptive skew join."""
    return probes.join(threes.withColumnRenamed("class", "known"), "three").filter("probe <> known").select("probe", "known").distinct()


def verified(pairs: DataFrame, probe_classes: DataFrame, known_classes: DataFrame, counts: DataFrame) -> DataFrame:
    """The candidate pairs (probe, known) that are the same title but for slips.

    ``known_classes`` and ``counts`` (word, n: the number of titles of each word) tell since which batch they are so: a title is held against
    those of batches before the probe's, and a pair of spellings that are both words of their own up to its batch tells two publications apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.string()), ("b", pa.string())]))
        for batch in batches:
            probe, known, at, slips = [], [], [], []
            for p, k, since, form, other, against in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for own in (form, other):
                    found = word_slips(own, against) if own else None
                    if found is not None:
                        probe.append(p)
                        known.append(k)
                        at.append(since)
                        slips.append([{"a": a, "b": b} for a, b in found])
                        break
            yield pa.RecordBatch.from_arrays([pa.array(probe, pa.int64()), pa.array(known, pa.int64()), pa.array(at, pa.int32()), pa.array(slips, kind)], names=["probe", "known", "at", "slips"])

    own = probe_classes.select(F.col("class").alias("probe"), F.col("since").alias("at"), "form", "other")
    texts = pairs.join(own, "probe").join(known_classes.select(F.col("class").alias("known"), F.col("since").alias("before"), F.col("form").alias("against")), "known").filter("before < at")
    likely = stage(texts.select("probe", "known", "at", "form", "other", "against").mapInArrow(run, "probe bigint, known bigint, at int, slips array<struct<a:string,b:string>>"))
    slips = likely.select("probe", "known", "at", F.explode("slips").alias("s")).select("probe", "known", "at", "s.a", "s.b")
    wanted = slips.select(F.explode(F.array("a", "b")).alias("word"), "at").distinct()
    so_far = counts.join(wanted, "word").filter("since <= at").groupBy("word", "at").agg(F.sum("n").alias("n"))
    counted = slips.join(so_far.select(F.col("word").alias("a"), "at", F.col("n").alias("na")), ["a", "at"], "left").join(so_far.select(F.col("word").alias("b"), "at", F.col("n").alias("nb")), ["b", "at"], "left")
    low, high = F.least(F.coalesce("na", F.lit(0)), F.coalesce("nb", F.lit(0))), F.greatest(F.coalesce("na", F.lit(0)), F.coalesce("nb", F.lit(0)))
    told = counted.filter((low >= OWN_WORD_TITLES) & (low >= OWN_WORD_RATIO * high)).select("probe", "known").distinct()
    return likely.select("probe", "known").join(told, ["probe", "known"], "left_anti")


class TitleHistory:
    """The accepted history as files: classes of titles, their threes and words, filters and the accepted record_ids.

    ``accept`` answers for one new batch and appends it, ``accept_all`` for several that wait. They write under their own (last) number, so
    what is tried again, as a whole, replaces its own files and adds nothing twice. Batches are accepted in rising order. ``since`` is the batch
    that something first stood in.
    """

    TABLES = {
        "classes": "class bigint, form string, since int, batch int",
        "threes": "class bigint, three bigint, batch int",
        "words": "word string, n bigint, since int, batch int",
        "filters": "kind int, word int, bits bigint, batch int",
        "ids": "record_id string, since int, batch int",
    }

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._filter: Filter | None = None
        self._filter_before = -1

    def _read(self, name: str, batch_no: int) -> DataFrame:
        try:
            return self.spark.read.schema(self.TABLES[name]).parquet(f"{self.path}/{name}").filter(F.col("batch") < batch_no)
        except Exception as error:  # no batch accepted so far
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], self.TABLES[name])

    def _known_filter(self, batch_no: int) -> Filter:
        """What batches before this one hold; read from the files unless the last accepted one is at hand."""
        if self._filter is None or self._filter_before > batch_no:
            self._filter = Filter()
            self._learn(self._read("filters", batch_no).groupBy("kind", "word").agg(F.bit_or("bits").alias("bits")))
        self._filter_before = batch_no
        return self._filter

    def _learn(self, words: DataFrame) -> None:
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kind, word, bits = (c.to_numpy() for c in batch.columns)
                of = [kind == k for k in range(Filter.KINDS)]
                yield pa.RecordBatch.from_arrays([pa.array(range(Filter.KINDS), pa.int32()), pa.array([word[k].tobytes() for k in of], pa.binary()), pa.array([bits[k].tobytes() for k in of], pa.binary())], names=["kind", "word", "bits"])

        packed = words.select("kind", "word", "bits").mapInArrow(pack, "kind int, word binary, bits binary")
        for r in packed.toLocalIterator():  # one part of the table at a time; at most the filter's fixed size
            np.bitwise_or.at(self._filter.words[r["kind"]], np.frombuffer(r["word"], dtype=np.int32), np.frombuffer(r["bits"], dtype=np.uint64))

    def accept(self, batch: DataFrame, batch_no: int) -> DataFrame:
        """(row_no, by_id, by_title) of the batch's rows that are already there; then appends the batch."""
        return self.accept_all(batch.withColumn("batch_no", F.lit(batch_no)), batch_no, batch_no)

    def accept_all(self, batches: DataFrame, first: int, last: int) -> DataFrame:
        """``accept`` for the batches from first to last at once: a row is told what stands in batches before its own, these among them."""
        alone = first == last
        base = batches.select("row_no", "record_id", "title", F.col("batch_no").cast("int").alias("batch_no"))
        forms = stage(with_forms(base))
        first_form = F.min(F.struct("since", F.col("other").isNull().alias("whole"), "other")).alias("own")
        own = forms.groupBy("class").agg(F.first("form").alias("form"), first_form, F.max("until").alias("until")).select("class", "form", "own.since", "own.other", "until")
        known = self._read("classes", first).select("class", F.lit(True).alias("equal"))
        # probing is work for all cores
        classes = stage(own.join(known, "class", "left").repartition(self.spark.sparkContext.defaultParallelism, "class"))
        fresh = classes.filter("equal IS NULL")
        new_words = fresh.select(F.explode(F.array_distinct(F.split("form", " "))).alias("word"), "since").groupBy("word", "since").agg(F.count("*").alias("n"))
        new_ids = base.filter("record_id IS NOT NULL").groupBy("record_id").agg(F.min("batch_no").alias("since")).join(self._read("ids", first).select("record_id"), "record_id", "left_anti")
        before = self._known_filter(first)
        shared = self.spark.sparkContext.broadcast(before) if alone else None
        for name, rows in {"words": new_words, "ids": new_ids, "filters": filter_words(fresh), "threes": threes_of(fresh), "classes": fresh.select("class", "form", "since")}.items():
            rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={last}")
        self._learn(self.spark.read.schema(self.TABLES["filters"]).parquet(f"{self.path}/filters/batch={last}"))
        shared = shared or self.spark.sparkContext.broadcast(before)
        self._filter_before = last
        # titles of one batch alone are held against earlier ones only
        threes = self._read("threes", first if alone else last + 1).select("class", "three")
        links = verified(candidates(probes_of(fresh, shared), threes), fresh, self._read("classes", first if alone else last + 1), self._read("words", last + 1))
        linked = links.select(F.col("probe").alias("class"), F.lit(True).alias("linked")).distinct()
        told = classes.join(linked, "class", "left").select("class", "since", F.coalesce("equal", "linked", F.lit(False)).alias("told")).filter((F.col("told")) | (F.col("since") < F.col("until")))
        titles = forms.select("title", "class").join(told, "class").select("title", "told", F.col("since").alias("title_since"))
        ids = self._read("ids", last + 1).select("record_id", F.col("since").alias("id_since"))
        by_id, by_title = F.coalesce(F.col("id_since") < F.col("batch_no"), F.lit(False)), F.coalesce(F.col("told") | (F.col("title_since") < F.col("batch_no")), F.lit(False))
        found = base.join(ids, "record_id", "left").join(titles, "title", "left").select("row_no", by_id.alias("by_id"), by_title.alias("by_title"))
        found = stage(found.filter("by_id OR by_title"))
        shared.destroy()  # the answer is written
        for table in (forms, classes):
            unstage(table)
        self.spark._jvm.System.gc()  # what the driver holds of this batch goes, with its shuffle files and broadcasts
        return found


def runs(batches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(first, last) of the batches, of (number, rows), that are taken together: no more rows than the batches before them have, so a
    history is read as often as it doubles."""
    out: list[tuple[int, int]] = []
    before = own = 0
    for number, rows in sorted(batches):
        if not out or own + rows > before:
            before, own = before + own, 0
            out.append((number, number))
        own += rows
        out[-1] = (out[-1][0], number)
    return out


def already_there(rows: DataFrame) -> DataFrame:
    """(row_no, by_id, by_title): rows whose publication stands in a row of an earlier batch.

    Gives the batches to a history of its own, in rising order, in runs that grow with it: a row is found if its record_id, its form or
    a form within the allowed edits stands in an accepted batch. Null record_ids and missing titles equal nothing; repeats
    within one batch alone don't count; rows with a null batch_no are never found and accept nothing.
    """
    spark = rows.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/titles-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    history, found = TitleHistory(spark, path), None
    base = rows.select("row_no", "record_id", "title", "batch_no")
    before = spark.conf.get("spark.sql.maxPlanStringLength")
    spark.conf.set("spark.sql.maxPlanStringLength", PLAN_TEXT)  # the driver keeps the plans of all these jobs as text
    try:
        sizes = base.filter("batch_no IS NOT NULL").groupBy("batch_no").count().collect()
        for first, last in runs([tuple(r) for r in sizes]):
            part = history.accept_all(base.filter(F.col("batch_no").between(first, last)), first, last)
            found = part if found is None else found.unionByName(part)
    finally:
        spark.conf.set("spark.sql.maxPlanStringLength", before)
    return found if found is not None else spark.createDataFrame([], "row_no bigint, by_id boolean, by_title boolean")
