"""Abusive, hateful and sexual content: a support vector machine over a gap-weighted subsequence kernel.

The kernel counts subsequences of ORDER characters that span at most SPAN, each gap lowering the weight, so
that inserted or masked characters cost little. Its feature map is hashed to 1 << BITS; the machine is
trained on kernel values to landmark windows (Nyström), and its weights are then folded back through the
landmarks into one vector over the hashed features. Scoring a text is a map-only pass of table look-ups: its
value is that of its worst window.

Labels are of documents, so the windows that make a document toxic are found as the machine is trained
(multiple instances): each toxic document stands for its worst windows, each clean one for those that look
worst and some others. Machines are trained in tasks, one for each fold and one for all rows; the threshold
comes from values of labelled documents that their machine has not seen, weighed by how often such values
occur among all documents, as labelled documents hold more toxic ones than the corpus.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.session import stage

ORDER, SPAN, DECAY = 4, 6, 0.6
#: Of the hashed features of the machine, and of the finer ones of the first guess.
BITS, FINE_BITS = 16, 20
LANDMARKS = 256
#: Windows are of so many positions, one every STRIDE; a window's norm counts at least LEAST positions.
WINDOWS, STRIDE, LEAST = (24, 56), 4, 16
#: Bounds of the training sample: labelled documents of either kind (by hash of the id) and characters of each;
#: of a longer text, PIECES pieces spread over the whole of it are taken. Scoring has no bound.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS, PIECES = 600, 1_800, 4_000, 8
#: Windows that may stand for a toxic document, and those of a clean one that look worst, both anew in each round;
#: other windows of clean documents, all together.
TOXIC_WINDOWS, WORST_WINDOWS, OTHER_INSTANCES, ROUNDS = 2, 3, 9_000, 5
#: A toxic document's worst window is used at first if it looks worse than this share of clean documents' worst ones, a second window if it does than this.
LEAST_CLEAN, SURE_CLEAN = 0.9, 0.97
#: Values beyond which a window changes sides: one of a clean document is left out (a wrong label), one of a toxic document no longer stands for it, or does anew.
WRONG_CLEAN, WRONG_TOXIC, SURE_TOXIC = 0.6, -0.6, 0.5
FOLDS = 3
#: Characters scored at once (a longer text alone).
SCORED_CHARS = 100_000
RIDGE = 200.0
#: Pseudo-documents of either kind behind the first guess.
PRIOR = 0.3
#: Values are counted in steps of 1 / STEPS within +-LIMIT for the threshold; toxic documents' share comes from those steps at which so many are found.
STEPS, LIMIT, LEAST_FOUND = 20, 4, 0.25
#: The threshold is the middle of those whose F1 is so near the best one: a single wrong label moves it little.
NEAR_BEST = 0.02

PATTERNS = [(0, *c) for c in combinations(range(1, SPAN), ORDER - 1)]
WEIGHTS = np.array([DECAY ** (p[-1] - ORDER + 1) for p in PATTERNS], dtype=np.float32)
_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
# Characters written for letters.
LEET = str.maketrans("013457@$", "oieastas")
_INVISIBLE = re.compile("[" + "".join(re.escape(chr(c)) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cf") + "]+")
_MIXED = re.compile(r"(?<!\S)(?=\S*[013457@$])(?=\S*[^\W\d_])\S+")
_REPEAT = re.compile(r"(.)\1{2,}")
_SPACED = re.compile(r"(?<!\S)(?:\w ){3,}\w(?!\S)")
_BLANK = re.compile(r"\s+")


def _letters(match: re.Match) -> str:
    token = match[0]
    return token.translate(LEET) if 2 * sum(c.isalpha() for c in token) >= len(token) else token


def canonical(text: str | None) -> str:
    """Lower case without compatibility forms, characters in words written for letters, drawn-out or spaced letters."""
    text = text or ""
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    text = _BLANK.sub(" ", text.lower()).strip()
    return _REPEAT.sub(r"\1", _MIXED.sub(_letters, _SPACED.sub(lambda m: m[0].replace(" ", ""), text)))


def features(chars: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hashed subsequences by position and pattern: row t has those whose first character is at t."""
    n = max(0, len(chars) - SPAN + 1)
    out = np.empty((n, len(PATTERNS)), dtype=np.int32)
    terms = [[(chars[i : i + n] + np.uint32(1)) * _PRIMES[k] for i in range(SPAN)] for k in range(ORDER)]
    for col, pattern in enumerate(PATTERNS):
        h = terms[0][pattern[0]] ^ terms[1][pattern[1]]
        h = h * np.uint32(31) + terms[2][pattern[2]]
        h = h * np.uint32(31) + terms[3][pattern[3]]
        h ^= h >> np.uint32(15)
        out[:, col] = ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)).astype(np.int32)
    return out


class Texts:
    """Texts one after the other: the features of all positions and the range of positions of each text."""

    def __init__(self, texts: list[str | None]):
        plain = [canonical(t) for t in texts]
        self.present = np.array([bool(t) for t in plain], dtype=bool)
        padded = [f" {t} ".ljust(SPAN) for t in plain]
        size = np.array([len(t) for t in padded], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
        self.last = self.first + size - SPAN + 1
        self.chars = np.frombuffer("".join(padded).encode("utf-32-le"), dtype=np.uint32)
        self.features = features(self.chars)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first, last) of all windows; a text without a window of a length has itself as one."""
        own, begin, end = [], [], []
        for size in WINDOWS:
            many = np.maximum(1, -(-(self.last - self.first - size) // STRIDE) + 1)
            text = np.repeat(np.arange(len(many)), many)
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            stop = np.minimum(self.first[text] + at * STRIDE + size, self.last[text])
            own.append(text)
            begin.append(np.maximum(self.first[text], stop - size))
            end.append(stop)
        return tuple(np.concatenate(x) for x in (own, begin, end))


def window_values(positions: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The value of each window from values of positions, by running sums."""
    sums = np.concatenate(([0.0], np.cumsum(positions, dtype=np.float64)))
    return (sums[end] - sums[begin]) / _norm(end - begin)


def _norm(size: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(size, LEAST))


class Machine:
    """Weights over hashed features and bias."""

    def __init__(self, vector: np.ndarray, bias: float):
        self.vector, self.bias = vector, bias

    def positions(self, texts: Texts) -> np.ndarray:
        return self.vector[texts.features] @ WEIGHTS

    def values(self, texts: list[str | None]) -> list[float | None]:
        """The value of the worst window of each text; None for a text without a character."""
        if not texts:
            return []
        laid = Texts(texts)
        own, begin, end = laid.windows()
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, own, window_values(self.positions(laid), begin, end))
        return [float(v) + self.bias if there else None for v, there in zip(best, laid.present, strict=True)]


def _solve(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps; the last column is the bias."""
    x = np.hstack([z, np.ones((len(z), 1), dtype=z.dtype)])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-3
    for _ in range(12):
        on = y * (x @ w) < 1
        own = x[on].astype(np.float64)
        scaled = own * weight[on, None]
        new = np.linalg.solve(scaled.T @ own + np.diag(ridge), scaled.T @ y[on])
        done = np.abs(new - w).max() < 1e-5
        w = new
        if done:
            break
    return w[:-1], float(w[-1])


def _first_guess(texts: Texts, label: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Value of each position: log ratio of the toxic documents that hold its features to those expected from the
    clean documents of the same groups (sources). Each document leaves itself out, so that a feature of
    one document alone says nothing."""
    fine = features(texts.chars, FINE_BITS)
    toxic, clean = np.zeros(1 << FINE_BITS, dtype=np.float32), np.zeros(1 << FINE_BITS, dtype=np.float32)
    weight = np.ones(len(label), dtype=np.float32)
    for g in np.unique(group):
        inside = group == g
        weight[inside & ~label] = (inside & label).sum() / max(1, (inside & ~label).sum())
    for k in range(len(label)):
        (toxic if label[k] else clean)[np.unique(fine[texts.first[k] : texts.last[k]])] += weight[k]
    own = np.repeat(np.arange(len(label)), np.diff(np.append(texts.first, len(fine))))
    size = np.where(label, 1, weight)[own].astype(np.float32)
    at = label[own]
    out = np.zeros(len(fine), dtype=np.float32)
    for col in range(len(PATTERNS)):
        t, c = toxic[fine[:, col]], clean[fine[:, col]]
        out += WEIGHTS[col] * np.log((np.maximum(t - at * size, 0) + PRIOR) / (np.maximum(c - ~at * size, 0) + PRIOR))
    return out


def _worst(own: np.ndarray, begin: np.ndarray, end: np.ndarray, value: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Positions of the windows of highest value of each text that don't overlap, at most most[text]."""
    left, chosen = value.astype(np.float64), []
    for step in range(int(most.max(initial=0))):
        left[most[own] <= step] = -np.inf
        best = np.full(len(most), -np.inf)
        np.maximum.at(best, own, left)
        at = np.nonzero(np.isfinite(left) & (left == best[own]))[0]
        text, where = np.unique(own[at], return_index=True)
        chosen.append(at[where])
        a, b = np.zeros(len(most), dtype=np.int64), np.zeros(len(most), dtype=np.int64)
        a[text], b[text] = begin[at[where]], end[at[where]]
        left[(end > a[own]) & (begin < b[own])] = -np.inf
    return np.concatenate(chosen) if chosen else np.empty(0, dtype=np.int64)


def _spread(kernel: np.ndarray, most: int) -> np.ndarray:
    """Rows that span the others best, each next one the least explained so far (incomplete Cholesky)."""
    left = np.diag(kernel).astype(np.float64).copy()
    basis = np.zeros((len(kernel), min(most, len(kernel))))
    chosen = []
    for k in range(basis.shape[1]):
        at = int(left.argmax())
        if left[at] < 1e-6:
            break
        column = (kernel[:, at] - basis[:, :k] @ basis[at, :k]) / np.sqrt(left[at])
        basis[:, k] = column
        left -= column**2
        left[at] = 0
        chosen.append(at)
    return np.array(chosen, dtype=np.int64)


def fit(texts: list[str], labels: list[bool], groups: list[str], seed: int = 7) -> Machine | None:
    """A machine from labelled documents of some groups (sources); None unless both labels occur.

    Each round trains on windows, looks again for the worst windows of all documents, and adds those of clean
    ones. Landmarks are chosen anew in the first two rounds.
    """
    label = np.array(labels, dtype=bool)
    if not label.any() or label.all():
        return None
    rng = np.random.default_rng(seed)
    laid = Texts(texts)
    own, begin, end = laid.windows()
    toxic = label[own]
    most = np.where(label, TOXIC_WINDOWS, WORST_WINDOWS)
    value = window_values(_first_guess(laid, label, np.array(groups)), begin, end)
    worst = _worst(own, begin, end, value, most)
    top = _tops(own, value, len(label))
    least, sure = np.quantile(top[~label], [LEAST_CLEAN, SURE_CLEAN])
    own_top = value[worst] == top[own[worst]]
    positive = worst[toxic[worst] & (value[worst] > np.where(own_top, least, sure))]
    if not len(positive):  # hardly any label: every toxic document stands for itself
        positive = worst[toxic[worst] & own_top]
    others = OTHER_INSTANCES // int((~label).sum())
    used = np.zeros(len(own), dtype=bool)
    used[_some(own, np.where(label, 0, max(2, others)), rng)] = True
    now = None
    for step in range(ROUNDS):
        hard = worst[~toxic[worst]]
        used[hard] = True
        at = np.union1d(np.nonzero(used)[0], positive)
        if step < 2:
            basis = _Basis(laid, begin, end, [rng.permutation(positive), rng.permutation(hard)])
        z = basis.coordinates(at)
        y = np.where(toxic[at], 1.0, -1.0)
        current = None if now is None else now[at]
        for _ in range(2):
            use = np.ones(len(at), dtype=bool) if current is None else (y > 0) | (current < WRONG_CLEAN)
            ratio = (y[use] < 0).sum() / max(1, (y[use] > 0).sum())
            w, bias = _solve(z[use], y[use], np.where(y[use] > 0, min(4.0, max(1.0, 0.25 * ratio)), 1.0))
            current = z @ w + bias
        machine = Machine(basis.folded(w), bias)
        now = window_values(machine.positions(laid), begin, end) + bias
        worst = _worst(own, begin, end, now, most)
        own_top = now[worst] == _tops(own, now, len(label))[own[worst]]
        kept = np.isin(own[worst], own[positive]) & own_top & (now[worst] > WRONG_TOXIC)
        positive = worst[toxic[worst] & (kept | (now[worst] > SURE_TOXIC))]
        if not len(positive):
            break
    return machine


def _tops(own: np.ndarray, value: np.ndarray, texts: int) -> np.ndarray:
    """The highest value of each text's windows."""
    top = np.full(texts, -np.inf)
    np.maximum.at(top, own, value)
    return top


class _Basis:
    """Landmark windows and the coordinates of windows in their span; those computed once are kept."""

    def __init__(self, texts: Texts, begin: np.ndarray, end: np.ndarray, pools: list[np.ndarray]):
        self.texts, self.begin, self.end = texts, begin, end
        chosen = []
        for pool in pools:
            sketch = _sketches(texts, begin, end, pool[: 3 * LANDMARKS])
            chosen.append(pool[_spread(sketch @ sketch.T, LANDMARKS // 2)])
        marks = np.unique(np.concatenate(chosen))
        self.table = np.zeros((1 << BITS, len(marks)), dtype=np.float32)
        for col, k in enumerate(marks):
            size = end[k] - begin[k]
            np.add.at(self.table[:, col], texts.features[begin[k] : end[k]].ravel(), np.tile(WEIGHTS, size) / _norm(size))
        values, basis = np.linalg.eigh(self._kernel(marks).astype(np.float64))
        keep = values > 1e-3 * values.max()
        self.root = (10 * basis[:, keep] / np.sqrt(values[keep])).astype(np.float32)
        self.known, self.points = np.empty(0, dtype=np.int64), np.empty((0, self.root.shape[1]), dtype=np.float32)

    def _kernel(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), self.table.shape[1]), dtype=np.float32)
        for row, k in enumerate(windows):
            size = self.end[k] - self.begin[k]
            out[row] = np.tile(WEIGHTS, size) @ self.table[self.texts.features[self.begin[k] : self.end[k]].ravel()] / _norm(size)
        return out

    def coordinates(self, windows: np.ndarray) -> np.ndarray:
        new = np.setdiff1d(windows, self.known)
        self.known = np.concatenate([self.known, new])
        self.points = np.concatenate([self.points, self._kernel(new) @ self.root])
        order = np.argsort(self.known)
        return self.points[order[np.searchsorted(self.known[order], windows)]]

    def folded(self, w: np.ndarray) -> np.ndarray:
        """A linear machine in these coordinates as one vector over the hashed features."""
        return (self.table @ (self.root @ w)).astype(np.float32)


def _some(own: np.ndarray, most: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Positions of some windows of each text, at most most[text], drawn evenly from the whole of it."""
    order = rng.permutation(len(own))
    order = order[np.argsort(own[order], kind="stable")]
    rank = np.arange(len(own)) - np.searchsorted(own[order], own[order])
    return order[rank < most[own[order]]]


def _sketches(texts: Texts, begin: np.ndarray, end: np.ndarray, windows: np.ndarray, size: int = 1024) -> np.ndarray:
    """Signed count sketches of unit length of windows: their products are close to the kernel's cosines."""
    out = np.zeros((len(windows), size), dtype=np.float32)
    for row, k in enumerate(windows):
        h = texts.features[begin[k] : end[k]].ravel()
        out[row] = np.bincount(h & (size - 1), weights=np.where((h >> 10) & 1, 1.0, -1.0) * np.tile(WEIGHTS, end[k] - begin[k]), minlength=size)
    return out / np.maximum(1e-9, np.linalg.norm(out, axis=1, keepdims=True))


def training_sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, fold, source, text): at most TRAIN_TOXIC and TRAIN_CLEAN labelled documents with a text, by
    order of a hash of the id; equal texts are in one fold, and of long texts there are pieces."""
    own = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = own.filter("toxic").orderBy(*order).limit(TRAIN_TOXIC).unionByName(own.filter("NOT toxic").orderBy(*order).limit(TRAIN_CLEAN))
    size = TRAIN_CHARS // PIECES
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda k: F.substring("text", (1 + F.floor(k * (F.length("text") - size) / (PIECES - 1))).cast("int"), F.lit(size)))
    text = F.when(F.length("text") <= TRAIN_CHARS, F.col("text")).otherwise(F.concat_ws("\n", pieces))
    rows = documents.select("doc_id", "source", "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")  # so many rows at most
    return rows.select("doc_id", "toxic", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"), F.coalesce("source", F.lit("")).alias("source"), text.alias("text"))


def trained(sample: DataFrame) -> tuple[list[Machine | None], DataFrame]:
    """(a machine for each fold that has not seen it, and last one for all rows; (doc_id, fold) of the sample).
    Each is trained in a task of its own."""
    spark = sample.sparkSession
    rows = sorted((r["doc_id"], r["toxic"], r["fold"], r["source"], r["text"]) for r in sample.collect())  # the bounded sample
    shared = spark.sparkContext.broadcast(rows)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for k in part["id"]:
                own = [r for r in shared.value if r[2] != k]
                machine = fit([r[4] for r in own], [r[1] for r in own], [r[3] for r in own])
                if machine:
                    yield pd.DataFrame({"part": [k], "vector": [machine.vector.tobytes()], "bias": [machine.bias]})

    found = {r["part"]: r for r in spark.range(0, FOLDS + 1, 1, FOLDS + 1).mapInPandas(run, "part bigint, vector binary, bias double").collect()}
    machines = [Machine(np.frombuffer(found[k]["vector"], dtype=np.float32), found[k]["bias"]) if k in found else None for k in range(FOLDS + 1)]
    return machines, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, fold int")


def values(documents: DataFrame, machines: list[Machine | None], folds: DataFrame) -> DataFrame:
    """(doc_id, source, value, held_out): held_out comes from a machine that has not seen the document."""
    shared = documents.sparkSession.sparkContext.broadcast(machines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, fold = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            last = shared.value[-1]
            value: list[float | None] = []
            at = 0
            while at < len(texts):  # as many texts at once as have SCORED_CHARS characters, one at least
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to] or "") <= SCORED_CHARS):
                    chars += len(texts[to] or "")
                    to += 1
                value += last.values(texts[at:to]) if last else [None] * (to - at)
                at = to
            held = list(value)
            for k, own in enumerate(fold):
                if own is not None:
                    held[k] = shared.value[own].values([texts[k]])[0] if shared.value[own] else None
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value, pa.float64()), pa.array(held, pa.float64())], names=["doc_id", "source", "value", "held_out"])

    rows = documents.select("doc_id", "source", "text").join(F.broadcast(folds), "doc_id", "left")  # folds has the sample's rows
    return rows.select("doc_id", "source", "text", "fold").mapInArrow(run, "doc_id bigint, source string, value double, held_out double")


def threshold(found: DataFrame, labels: DataFrame) -> float:
    """The value above which a document is flagged: the best F1 that the corpus would have.

    Labelled toxic documents tell which share is found at each value, all documents how many are flagged
    there. The share of toxic documents in the corpus is what is flagged over what is found, where that is least: at high values,
    where nearly all flagged documents are toxic. Labels of clean documents aren't needed, so wrong ones do no harm.
    """
    step = lambda c: F.floor(F.least(F.greatest(F.col(c), F.lit(-LIMIT)), F.lit(LIMIT)) * STEPS).cast("int")
    toxic = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("toxic = 1").select("doc_id")
    everything = found.filter("value IS NOT NULL").groupBy(step("value").alias("step")).agg(F.count("*").alias("n")).withColumn("kind", F.lit(0))
    known = found.filter("held_out IS NOT NULL").join(toxic, "doc_id", "left_semi").groupBy(step("held_out").alias("step")).agg(F.count("*").alias("n")).withColumn("kind", F.lit(1))
    count = np.zeros((2, 2 * LIMIT * STEPS + 1))
    for r in everything.unionByName(known).collect():  # one row a step
        count[r["kind"], r["step"] + LIMIT * STEPS] = r["n"]
    return best_step(count[0], count[1])


def best_step(everything: np.ndarray, known: np.ndarray) -> float:
    """See ``threshold``; counts of all documents and of toxic ones by step."""
    if not everything.sum() or not known.sum():
        return 0.0
    above = np.cumsum(everything[::-1])[::-1] / everything.sum()
    hit = np.cumsum(known[::-1])[::-1] / known.sum()
    usable = hit >= min(LEAST_FOUND, hit.max())
    share = (above[usable] / hit[usable]).min()
    f1 = 2 * np.minimum(share * hit, above) / (share + above)
    near = np.nonzero(f1 >= f1.max() - NEAR_BEST)[0]
    return float((near.mean() - LIMIT * STEPS) / STEPS)


def scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, score, flagged) of every document; flagged if the score is above 0.

    Null and blank texts have a null score and are not flagged; equal texts have equal scores. Short texts are a window
    of their own, long ones are scored whole. Without labels of both kinds no document has a score.
    """
    machines, folds = trained(training_sample(documents, labels))
    found = stage(values(documents, machines, folds))
    limit = threshold(found, labels)
    score = F.col("value") - F.lit(limit)
    return found.select("doc_id", "source", score.alias("score"), F.coalesce(score > 0, F.lit(False)).alias("flagged"))


def rates(found: DataFrame) -> DataFrame:
    """Per source: documents, flagged documents and their share."""
    return found.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if("flagged").alias("n_flagged"), F.round(F.avg(F.col("flagged").cast("double")), 6).alias("rate"))
