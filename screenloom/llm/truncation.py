"""Texts cut off by field limits or in transfer.

One scan counts, over the different texts of the corpus, which words follow each other and where sentences end. Copies
of a text count once, so that they can't vouch for each other's end. The words after
each word form a trie: a final word that is rare there, while longer words it begins are common, was cut. Where
the final word is whole, the share of its last words' occurrences that end a sentence tells whether the sentence
is complete. Lengths at which a source's texts stop unfinished again and again, and marks of a cut, are further evidence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.session import stage

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?…]+|[^\w\s]|_")
ENTITY = re.compile(r"&#?\w{0,7}$")
STOPS = frozenset(".!?…")
#: What may follow a cut: marks of an ellipsis or a note, and closing quotes or braces.
MARK = re.compile(r"(?:\s*(?:\.{3,}|…|\[\s*(?:truncated|cut|more|abridged|\.{3}|…)\s*\]|\((?:truncated|cut|more)\)))+[\s\"'”’}\]]*$", re.I)
CLOSERS = re.compile(r"[\s\"”’}]+$")
#: A tag that is never closed (only its name, or with a first attribute) is a mark; a whole line break is one where no
#: full stop stands before it; an end tag is layout.
BROKEN_TAG = re.compile(r"</?(?:[a-z][a-z0-9]{0,9}(?:\s[^<>]*=[^<>]*)?\s*/?)?\s*$", re.I)
BREAK_TAG = re.compile(r"<(?:br|p|hr|div)\s*/?>\s*$", re.I)
END_TAG = re.compile(r"</[a-z][a-z0-9]{0,9}\s*>\s*$", re.I)
#: Strength (in log odds) of each piece of evidence, and the smoothing of the share of sentence ends.
CUT_WORD, CUT_LENGTH, CUT_MARK, FULL_STOP, NO_SIGN = 9.5, 2.5, 2.5, -6.0, -4.0
SMOOTH, PRIOR = 2.0, 0.15
#: A final word is cut if it is at most this share of the longer words it begins, which occur at least so often.
CUT_SHARE, LONGER_SEEN = 0.05, 4
#: A length is a limit of a source if so many of its texts stop there unfinished, and so many times the lengths around it.
LIMIT_TEXTS, LIMIT_TIMES, LIMIT_REACH = 4, 6.0, 10


def tail_parts(text: str) -> tuple[list[str], bool, bool]:
    """The tokens of a text without what follows a cut, whether a mark followed, and whether it ends with a stop.

    The beginning of a character entity or of a tag is a mark, too: only a cut leaves one.
    """
    core, mark, line_break = text, False, False
    while (found := MARK.search(core) or BROKEN_TAG.search(core) or BREAK_TAG.search(core) or END_TAG.search(core)) is not None:
        if BREAK_TAG.match(found[0]):
            line_break = True
        elif not END_TAG.match(found[0]):
            mark = True
        core = core[: found.start()]
    core = CLOSERS.sub("", core)
    if ENTITY.search(core):
        mark, core = True, ENTITY.sub("", core)
    tokens = ["#" if t[0].isdigit() else t for t in TOKEN.findall(core.lower())]
    stop = False
    while tokens and tokens[-1][0] in STOPS:
        tokens.pop()
        stop = True
    return tokens, mark or (line_break and not stop), stop


def _hash3(a: str, b: str, c: str) -> int:
    value = xxhash.xxh64_intdigest(f"{a} {b} {c}")
    return value - (1 << 64) if value >= 1 << 63 else value


def _last_sentence(tokens: list[str]) -> int:
    """Hash of the tokens after the last full stop within the text."""
    begin = max((k + 1 for k, t in enumerate(tokens) if t[0] in STOPS), default=0)
    value = xxhash.xxh64_intdigest(" ".join(tokens[begin:]))
    return value - (1 << 64) if value >= 1 << 63 else value


def scanned(texts: DataFrame) -> DataFrame:
    """One pass over different texts (h1, h2, text): a row per text with its tail, and pre-aggregated counts of
    pairs and threes of words with how many of them end a sentence."""
    kinds = [("h1", pa.int64()), ("h2", pa.int64()), ("mark", pa.bool_()), ("stop", pa.bool_()), ("w1", pa.string()), ("w2", pa.string()), ("three", pa.int64()), ("last", pa.int64()), ("n_all", pa.int64()), ("n_end", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: dict[str, int] = {}
            names: list[str] = []
            flow: list[int] = []
            ends: list[bool] = []
            tails = []
            for h1, h2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens, mark, stop = tail_parts(text)
                if not tokens:
                    continue
                own = ["", "", *tokens]
                tails.append((h1, h2, mark, stop, own[-1], own[-2], _hash3(own[-3], own[-2], own[-1]), _last_sentence(tokens), None, None))
                codes = [0, 0]
                for t in tokens:
                    k = ids.get(t)
                    if k is None:
                        k = ids[t] = len(ids) + 1
                        names.append(t)
                    codes.append(k)
                stops = [t[0] in STOPS for t in tokens]
                flow += codes
                ends += [False, False, *stops[1:], True]
            yield _batch(tails, kinds)
            yield from _counted(np.array(flow, dtype=np.int64), np.array(ends, dtype=bool), ["", *names], kinds)

    schema = "h1 bigint, h2 bigint, mark boolean, stop boolean, w1 string, w2 string, three bigint, last bigint, n_all bigint, n_end bigint"
    return texts.select("h1", "h2", "text").mapInArrow(run, schema)


def _batch(rows: list[tuple], kinds: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


def _counted(flow: np.ndarray, ends: np.ndarray, names: list[str], kinds: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Counts of a batch; 0 marks the two places before each text."""
    if not len(flow):
        return
    size = np.int64(len(names))
    real = np.nonzero((flow > 0) & np.array([n[:1] not in STOPS or not n for n in names], dtype=bool)[flow])[0]
    two = flow[real - 1] * size + flow[real]
    # threes are coded over the pairs that occur, so that no number of different words is too large
    pairs, of = np.unique(two, return_inverse=True)
    three = flow[real - 2] * np.int64(len(pairs)) + of
    for keys, width in ((two, 2), (three, 3)):
        values, where = np.unique(keys, return_inverse=True)
        n_all = np.bincount(where)
        n_end = np.bincount(where, weights=ends[real]).astype(np.int64)
        both = values if width == 2 else pairs[values % len(pairs)]
        last, before = both % size, both // size
        rows = len(values)
        nothing = pa.nulls(rows)
        if width == 2:
            w1, w2, h = pa.array([names[k] for k in last], pa.string()), pa.array([names[k] for k in before], pa.string()), nothing.cast(pa.int64())
        else:
            w1 = w2 = nothing.cast(pa.string())
            h = pa.array([_hash3(names[a], names[b], names[c]) for a, b, c in zip(values // len(pairs), before, last, strict=True)], pa.int64())
        full = {"w1": w1, "w2": w2, "three": h, "n_all": pa.array(n_all, pa.int64()), "n_end": pa.array(n_end, pa.int64())}
        yield pa.RecordBatch.from_arrays([full.get(n, nothing.cast(t)) for n, t in kinds], names=[n for n, _ in kinds])


def limits(tails: DataFrame) -> DataFrame:
    """(field, source, length): lengths at which different texts of a source stop without a full stop far more often than
    around them. ``tails``: (field, source, length, h1, h2, stop), a row per different text of a source."""
    counts = tails.filter("NOT stop").groupBy("field", "source", "length").agg(F.count("*").alias("n"))
    near = counts.select("field", "source", "n", F.explode(F.sequence(F.col("length") - LIMIT_REACH, F.col("length") + LIMIT_REACH)).alias("length"))
    around = near.groupBy("field", "source", "length").agg(F.sum("n").alias("around"))
    own = counts.join(around, ["field", "source", "length"])
    usual = (F.col("around") - F.col("n")) / F.lit(2.0 * LIMIT_REACH)
    return own.filter((F.col("n") >= LIMIT_TEXTS) & (F.col("n") >= LIMIT_TIMES * usual)).select("field", "source", "length", F.lit(True).alias("at_limit"))


def judged(texts: DataFrame) -> DataFrame:
    """(field, row_key, source, score, cut) of every text that has a word; cut if the score is above 0.

    Null texts, empty ones and texts without a word or sign have no row and are never cut. Equal texts of one
    source are judged alike. A source that is null is a source of its own.
    """
    present = texts.filter("text IS NOT NULL")
    both = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]  # 128 bits stand for the text
    keyed = stage(present.select("field", F.col("row_key").cast("bigint").alias("row_key"), F.coalesce("source", F.lit("")).alias("source"), F.length("text").cast("bigint").alias("length"), *both))
    rows = stage(scanned(present.select("text").distinct().select(*both, "text")))
    tails = rows.filter("n_all IS NULL").drop("n_all", "n_end")
    pairs = stage(rows.filter("w1 IS NOT NULL AND n_all IS NOT NULL").groupBy("w2", "w1").agg(F.sum("n_all").alias("a2"), F.sum("n_end").alias("e2")))
    threes = rows.filter("w1 IS NULL").groupBy("three").agg(F.sum("n_all").alias("a3"), F.sum("n_end").alias("e3"))
    words = pairs.groupBy("w1").agg(F.sum("a2").alias("a1"), F.sum("e2").alias("e1"))
    # the trie after each word, at the final words only: how often longer words with this beginning occur there
    final = tails.select("w2", "w1").filter(r"w1 RLIKE '^\\p{L}+$'").distinct()
    longer = pairs.filter((F.col("a2") >= LONGER_SEEN) & F.col("w1").rlike(r"^\p{L}{2,}$"))
    nodes = longer.select("w2", "a2", F.explode(F.transform(F.sequence(F.lit(1), F.length("w1") - 1), lambda n: F.substring("w1", F.lit(1), n))).alias("w1"))
    trie = nodes.join(final, ["w2", "w1"], "left_semi").groupBy("w2", "w1").agg(F.sum("a2").alias("longer"))
    seen = tails.join(threes, "three", "left").join(pairs, ["w2", "w1"], "left").join(words, "w1", "left").join(trie, ["w2", "w1"], "left")
    share, most = F.lit(PRIOR), F.lit(0.0)
    same = tails.filter("NOT stop").groupBy("last").agg(F.count("*").alias("same"))
    seen = seen.join(same, "last", "left")
    # without the text's own end; where sentences go on, texts that stop within the same sentence are no evidence for each other
    own_end = F.when((F.col("a3") > F.col("e3")) & ~F.col("stop"), F.coalesce("same", F.lit(1))).otherwise(F.lit(1))
    for n in (1, 2, 3):
        share = (F.greatest(F.coalesce(f"e{n}", F.lit(1)) - own_end, F.lit(0)) + SMOOTH * share) / (F.greatest(F.coalesce(f"a{n}", F.lit(1)) - own_end, F.lit(0)) + SMOOTH)
        most = F.greatest(most, share)
    share = F.when(F.col("stop") & ~F.col("mark"), most).otherwise(share)  # a full stop needs one context that allows it
    share = F.least(F.greatest(share, F.lit(0.0005)), F.lit(0.9995))
    cut_word = (F.coalesce("longer", F.lit(0)) >= LONGER_SEEN) & (F.coalesce("a2", F.lit(0)) <= CUT_SHARE * F.col("longer") + 1)
    sign = F.when(F.col("mark"), CUT_MARK).when(F.col("stop"), FULL_STOP).otherwise(0.0)
    logit = -F.log(share / (1 - share)) + F.when(cut_word, CUT_WORD).otherwise(0.0) + sign
    rated = stage(seen.select("h1", "h2", "mark", "stop", logit.alias("logit")))
    own = keyed.join(rated, ["h1", "h2"])
    of_source = keyed.select("field", "source", "length", "h1", "h2").distinct().join(rated.select("h1", "h2", "stop"), ["h1", "h2"])
    own = own.join(limits(of_source), ["field", "source", "length"], "left")
    at_limit = F.coalesce("at_limit", F.lit(False)) & ~F.col("stop")
    score = F.col("logit") + F.when(at_limit, CUT_LENGTH).otherwise(0.0) + F.when(~at_limit & ~F.col("mark") & ~F.col("stop"), NO_SIGN).otherwise(0.0)
    return own.select("field", "row_key", "source", F.round(score, 6).alias("score"), (score > 0).alias("cut"))


def rates(found: DataFrame) -> DataFrame:
    """Per field and source: texts, cut texts and their share."""
    return found.groupBy("field", "source").agg(F.count("*").alias("n_texts"), F.count_if("cut").alias("n_cut"), F.round(F.avg(F.col("cut").cast("double")), 6).alias("rate"))
