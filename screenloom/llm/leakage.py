"""Evaluation texts inside training text: rare n-gram seeds, then Smith-Waterman alignment of words.

The corpus is scanned once and never shuffled: the evaluation set, a stated query set, is sent to the
executors in blocks of bounded size. Blocks don't change what is found: rarity is counted over all items.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Characters of accounts in a broadcast, and in all broadcasts of one scan of the corpus; more items take another scan.
BLOCK_CHARS, SCAN_CHARS = 4_000_000, 64_000_000
#: A passage of ten words or more with a changed word in four at most has three equal words in a row.
SEED_WORDS = 3
#: A seed is rare if it stands in at most so many items of the evaluation set.
SEED_ITEMS = 3
MIN_PASSAGE = 10
MIN_SHARE = 1 / 3
MIN_IDENTITY = 0.75
#: A changed word costs a little less than an equal one gives, so that one next to the end of a passage doesn't cut it short.
MATCH, MISMATCH, GAP = 1.0, -0.9, -1.0
#: Lowest score of a passage: ten words of which two are changed.
MIN_SCORE = MIN_PASSAGE * MATCH + 2 * (MISMATCH - MATCH) - 1e-6
#: Words in a row that may be changed within a passage, and marks that may stand between two of its words in the text.
CHANGED, MARKS = 1, 1
#: Passages hold one shared seed in so many words at least: twelve words with three changed ones may have a single one.
WORDS_PER_SEED = 12
#: Words by which text and account may shift against each other between two seeds.
DRIFT = 4
WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case, compatibility forms folded; null has none."""
    text = text or ""
    return WORD.findall((text if text.isascii() else unicodedata.normalize("NFKC", text)).lower())


def accounts(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, account): the part of each item that is its own.

    An item is an account between an optional standing instruction and a question with its answer. A
    sentence recurs if it stands in several different texts; leading recurring sentences are instruction,
    and the account ends before the last sentence that asks. Without a question it ends with the last
    sentence that doesn't recur. Null and empty texts, and texts that recur sentence by sentence, have no account.
    """
    base = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL AND trim(text) <> ''")
    sentences = base.select("item_id", F.xxhash64("text").alias("whole"), F.posexplode(F.split(F.trim("text"), r"(?<=[.!?:])\s+")).alias("pos", "sentence"))
    key = F.regexp_replace(F.lower("sentence"), r"[^\p{L}\p{N}]+", " ")
    sentences = sentences.withColumn("key", key)
    often = sentences.groupBy("key").agg(F.count_distinct("whole").alias("texts"))
    by_item = Window.partitionBy("item_id")
    marked = sentences.join(often, "key").withColumns(
        {
            "asks": F.max(F.when(F.col("sentence").endswith("?"), F.col("pos"))).over(by_item),
            "first": F.min(F.when(F.col("texts") == 1, F.col("pos"))).over(by_item),
            "last": F.max(F.when(F.col("texts") == 1, F.col("pos"))).over(by_item),
        }
    )
    kept = marked.filter((F.col("pos") >= F.col("first")) & F.coalesce(F.col("pos") < F.col("asks"), F.col("pos") <= F.col("last")))
    return kept.groupBy("item_id").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("pos", "sentence"))), lambda s: s["sentence"])).alias("account"))


def align(a: np.ndarray, b: np.ndarray) -> tuple[list[tuple[int, int]], float]:
    """Best local alignment of two word-id sequences (Smith-Waterman, linear gaps).

    Gives the aligned pairs of positions, equal or changed, and the score. Rows are computed at once: the gap
    along a row is a running maximum.
    """
    n, m = len(a), len(b)
    h = np.zeros((n + 1, m + 1))
    steps = np.arange(m + 1) * GAP
    for i in range(1, n + 1):
        row = np.maximum(h[i - 1] + GAP, 0.0)
        row[1:] = np.maximum(row[1:], h[i - 1, :-1] + np.where(b == a[i - 1], MATCH, MISMATCH))
        h[i] = np.maximum.accumulate(row - steps) + steps
    i, j = np.unravel_index(int(h.argmax()), h.shape)
    best, pairs = float(h[i, j]), []
    while i > 0 and j > 0 and h[i, j] > 0:
        step = MATCH if a[i - 1] == b[j - 1] else MISMATCH
        if abs(h[i, j] - (h[i - 1, j - 1] + step)) < 1e-9:
            pairs.append((int(i) - 1, int(j) - 1))
            i, j = i - 1, j - 1
        elif abs(h[i, j] - (h[i - 1, j] + GAP)) < 1e-9:
            i -= 1
        else:
            j -= 1
    return pairs[::-1], best


def _accepted(pairs: list[tuple[int, int]], a: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """Spans of the account within one alignment that are passages: only single words are changed within one, so the alignment is cut where
    more words in a row differ, and a mark may stand between words of the text."""
    same = [(i, j) for i, j in pairs if a[i] == text[j]]
    found, begin = [], 0
    for k in range(1, len(same) + 1):
        if k == len(same) or same[k][0] - same[k - 1][0] > CHANGED + 1 or same[k][1] - same[k - 1][1] > CHANGED + MARKS + 1:
            first, last = same[begin][0], same[k - 1][0]
            if last - first + 1 >= MIN_PASSAGE and k - begin >= MIN_IDENTITY * (last - first + 1):
                found.append((first, last))
            begin = k
    return found


def passages(account: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """Spans (first, last word) of the account repeated in the text; each has MIN_PASSAGE words or more."""
    a, found = account.copy(), []
    while True:
        pairs, score = align(a, text)
        if score < MIN_SCORE:
            return found
        found += _accepted(pairs, a, text)
        a[pairs[0][0] : pairs[-1][0] + 1] = -2  # never equal to a word of a text


_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _grams(codes: np.ndarray) -> np.ndarray:
    """A code for each run of SEED_WORDS word codes."""
    n = max(0, len(codes) - SEED_WORDS + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(SEED_WORDS):
        out = (out ^ (out >> np.uint64(29))) * _STEP[0] + (codes[k : k + n].astype(np.int64).view(np.uint64) + np.uint64(1)) * _STEP[1]
    return out


class LeakScanner:
    """Holds one block of accounts (id, words, places of rare seeds); applied to texts on the executors."""

    def __init__(self, block: list[tuple[int, list[str], list[int]]]):
        self.ids = [k for k, _, _ in block]
        self.vocabulary: dict[str, int] = {}
        self.accounts = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws], dtype=np.int32) for _, ws, _ in block]
        grams, item, place, rare = [np.empty(0, dtype=np.uint64)], [], [], []
        for k, (codes, (_, _, own)) in enumerate(zip(self.accounts, block, strict=True)):
            g = _grams(codes)
            mark = np.zeros(len(g), dtype=bool)
            mark[own] = True
            grams.append(g)
            item += [k] * len(g)
            place += range(len(g))
            rare += mark.tolist()
        every = np.concatenate(grams)
        order = np.argsort(every, kind="stable")
        self.grams, self.start = np.unique(every[order], return_index=True)
        self.start = np.append(self.start, len(every))
        self.item, self.place, self.rare = (np.array(x, dtype=t)[order] for x, t in ((item, np.int32), (place, np.int32), (rare, bool)))

    def _hits(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(item, place in the account, place in the text, rare) of all seeds that a text shares with accounts."""
        own = _grams(codes)
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        where = np.nonzero(self.grams[at] == own)[0] if len(self.grams) else np.empty(0, dtype=np.int64)
        first = self.start[at[where]] if len(where) else where
        many = self.start[at[where] + 1] - first if len(where) else where
        entry = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return self.item[entry], self.place[entry], np.repeat(where, many), self.rare[entry]

    def _most_repeated(self, account: np.ndarray, codes: np.ndarray, shifts: np.ndarray) -> int:
        """No passages of the text repeat more words of the account than this. Around each shift between text and account on which they share a seed, words may
        stand DRIFT apart from it; single words that differ are filled in, and stretches of MIN_PASSAGE words count."""
        n, pad = len(account), len(account) + DRIFT
        if n < MIN_PASSAGE:
            return 0
        padded = np.concatenate((np.full(pad, -1, dtype=np.int32), codes, np.full(pad, -1, dtype=np.int32)))
        at = pad + shifts[:, None] + np.arange(n)[None, :]
        near = np.zeros(at.shape, dtype=bool)
        for drift in range(-DRIFT, DRIFT + 1):
            near |= padded[at + drift] == account
        near[:, 1:-1] |= near[:, :-2] & near[:, 2:]
        sums = np.zeros((len(near), n + 1), dtype=np.int32)
        np.cumsum(near, axis=1, out=sums[:, 1:])
        whole = (sums[:, MIN_PASSAGE:] - sums[:, :-MIN_PASSAGE] == MIN_PASSAGE).any(axis=0)
        covered = np.zeros(n, dtype=bool)
        for k in range(MIN_PASSAGE):
            covered[k : k + len(whole)] |= whole
        return int(covered.sum())

    def scan(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, words repeated, words of the account, passages) of each item of which the text may repeat MIN_SHARE, and that has a rare seed in it and a passage."""
        codes = np.array([self.vocabulary.get(w, -1) for w in words(text)], dtype=np.int32)
        item, i, j, rare = self._hits(codes)
        for k in np.unique(item[rare]).tolist():
            account, own = self.accounts[k], item == k
            if own.sum() * WORDS_PER_SEED < MIN_SHARE * len(account) or self._most_repeated(account, codes, np.unique(j[own] - i[own])) < MIN_SHARE * len(account):
                continue
            covered, count = np.zeros(len(account), dtype=bool), 0
            for start, stop in self._windows(sorted(j[own].tolist()), len(account), len(codes)):
                for first, last in passages(account, codes[start:stop]):
                    covered[first : last + 1] = True
                    count += 1
            if count:
                yield self.ids[k], int(covered.sum()), len(account), count

    @staticmethod
    def _windows(at: list[int], reach: int, length: int) -> Iterator[tuple[int, int]]:
        """Stretches of the text around seeds, merged where they touch: very long texts are aligned near seeds only."""
        start, stop = max(0, at[0] - reach), at[0] + reach
        for p in at[1:]:
            if p - reach > stop:
                yield start, min(stop, length)
                start = p - reach
            stop = p + reach
        yield start, min(stop, length)


def seeded(found: DataFrame) -> DataFrame:
    """(item_id, words, rare): the words of each account and the places of its rare seeds, counted over all accounts. An account without a rare
    seed, such as one that stands in many items, keeps all of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [words(t) for t in batch.column(1).to_pylist()]
            grams = [[" ".join(ws[p : p + SEED_WORDS]) for p in range(len(ws) - SEED_WORDS + 1)] for ws in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.string())), pa.array(grams, pa.list_(pa.string()))], names=["item_id", "words", "grams"])

    own = found.select("item_id", "account").mapInArrow(run, "item_id bigint, words array<string>, grams array<string>")
    places = own.select("item_id", F.posexplode("grams").alias("place", "gram"))
    rare = places.groupBy("gram").agg(F.count_distinct("item_id").alias("n")).filter(F.col("n") <= SEED_ITEMS).select("gram")
    kept = places.join(rare, "gram", "left_semi").groupBy("item_id").agg(F.sort_array(F.collect_list("place")).alias("rare"))  # one account's places
    every = F.when(F.size("grams") > 0, F.sequence(F.lit(0), F.size("grams") - 1)).otherwise(F.array().cast("array<int>"))
    return own.join(kept, "item_id", "left").select("item_id", "words", F.coalesce("rare", every).alias("rare"))


def leaks(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(item_id, doc_id, words_repeated, account_words, passages) of pairs that may reach MIN_SHARE (see ``scan`` and ``leaked``).

    Null and empty texts have no passage; equal texts under several ids are found each. Items without an
    account (see ``accounts``) and accounts under MIN_PASSAGE words match nothing.
    """
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "item_id bigint, doc_id bigint, words_repeated bigint, account_words bigint, passages bigint"
    sc = documents.sparkSession.sparkContext
    result = None
    for scan in _scans(_blocks(seeded(accounts(items)))):
        shared = [sc.broadcast(LeakScanner(block)) for block in scan]

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(k, d, n, m, c) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for own in shared for k, n, m, c in own.value.scan(t)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names=["item_id", "doc_id", "words_repeated", "account_words", "passages"])

        part = docs.mapInArrow(run, schema)
        result = part if result is None else result.unionByName(part)
    return result if result is not None else documents.sparkSession.createDataFrame([], schema)


def _blocks(found: DataFrame) -> Iterator[list[tuple[int, list[str], list[int]]]]:
    """The accounts in blocks of bounded size, one block at the driver at a time."""
    block: list[tuple[int, list[str], list[int]]] = []
    size = 0
    for row in found.toLocalIterator():
        own = sum(map(len, row["words"])) + len(row["words"])
        if block and size + own > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["words"], row["rare"]))
        size += own
    if block:
        yield block


def _scans(blocks: Iterator[list]) -> Iterator[list[list]]:
    """Blocks that go with one scan of the corpus."""
    scan: list[list] = []
    for block in blocks:
        scan.append(block)
        if len(scan) * BLOCK_CHARS >= SCAN_CHARS:
            yield scan
            scan = []
    if scan:
        yield scan


def leaked(found: DataFrame) -> DataFrame:
    """Pairs whose document repeats at least MIN_SHARE of the account."""
    return found.filter(F.col("words_repeated") >= MIN_SHARE * F.col("account_words"))


def item_report(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per item: number of documents that leak it, and the largest share of its account found in one."""
    shares = pairs.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max(F.round(F.col("words_repeated") / F.col("account_words"), 6)).alias("max_share"))
    return items.select("item_id").join(shares, "item_id", "left").select("item_id", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("max_share", F.lit(0.0)).alias("max_share"))
