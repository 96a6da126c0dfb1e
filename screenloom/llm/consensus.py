"""Consensus from several annotators: item features and annotator confusion matrices fitted jointly.

Expectation-maximisation. The label prior of an item is a ridge-regularised logistic classifier over hashed
words of its text; each annotator has a confusion matrix. Votes are first reduced to one share per item and
annotator, so an item that was labelled a million times is one row. Every round is one pass over the items
whose result is a table of fixed size, summed on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.llm.sketches import WORD
from screenloom.session import stage

POSITIVE, NEGATIVE = "INCLUDE", "EXCLUDE"
FEATURES = 48
RIDGE, ROUNDS, TOLERANCE = 20.0, 25, 1e-4
#: Pseudo-votes that every confusion matrix starts from, and the accuracy assumed in the first round.
PSEUDO, START_ACCURACY = 2.0, 0.7
#: An annotator is a column of the item table; more than this is an error, not a silent cut.
MOST_ANNOTATORS = 1_000
HUMAN = "human"


def vote_of(column: F.Column) -> F.Column:
    """INCLUDE or EXCLUDE, blanks around it and case aside; anything else is no vote."""
    plain = F.upper(F.regexp_replace(column, r"^\s+|\s+$", ""))
    return F.when(plain.isin(POSITIVE, NEGATIVE), plain)


def label_of(column: F.Column) -> F.Column:
    """The vote a human label begins with."""
    plain = F.upper(F.regexp_replace(column, r"^\s+", ""))
    return F.when(plain.startswith(POSITIVE), POSITIVE).when(plain.startswith(NEGATIVE), NEGATIVE)


def shares(votes: DataFrame, labels: DataFrame) -> DataFrame:
    """(item, annotator, share, n): share of INCLUDE among an annotator's votes on an item.

    ``votes``: (record_id, model, screening_decision); ``labels``: (record_id, current_gt_label). Null items,
    null models and non-votes are left out; repeated rows weigh within the share only.
    """
    machine = votes.select(F.col("record_id").alias("item"), F.concat(F.lit("model:"), "model").alias("annotator"), vote_of(F.col("screening_decision")).alias("vote"))
    human = labels.select(F.col("record_id").alias("item"), F.lit(HUMAN).alias("annotator"), label_of(F.col("current_gt_label")).alias("vote"))
    every = machine.unionByName(human).filter("item IS NOT NULL AND annotator IS NOT NULL AND vote IS NOT NULL")
    return every.groupBy("item", "annotator").agg(F.avg((F.col("vote") == POSITIVE).cast("double")).alias("share"), F.count("*").alias("n"))


def _hashed(text: str) -> list[float]:
    x = np.zeros(FEATURES, dtype=np.float64)
    for w in set(WORD.findall(text.lower())):
        h = xxhash.xxh32_intdigest(w)
        x[h % FEATURES] += 1.0 if h & 0x40000000 else -1.0
    size = np.linalg.norm(x)
    return [*(x / size if size else x), 1.0]


def item_features(items: DataFrame) -> DataFrame:
    """(item, x): signed hashed words of the text at unit length, and a constant; null and empty texts have the constant only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_hashed(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["item", "x"])

    return items.select("item", "text").mapInArrow(run, "item string, x array<double>")


class Consensus:
    """Fitted on construction; ``items``, ``annotators`` and ``agreement`` give the results."""

    def __init__(self, votes: DataFrame, labels: DataFrame, texts: DataFrame):
        own = stage(shares(votes, labels))
        names = [r[0] for r in own.select("annotator").distinct().orderBy("annotator").limit(MOST_ANNOTATORS + 1).collect()]
        if len(names) > MOST_ANNOTATORS:
            raise ValueError(f"more than {MOST_ANNOTATORS} annotators")
        self.names, self.shares = names, own
        place = F.create_map(*[x for k, n in enumerate(names) for x in (F.lit(n), F.lit(k))]) if names else F.lit(None)
        coded = own.withColumn("k", place[F.col("annotator")] if names else F.lit(0))
        is_model = F.col("annotator") != HUMAN
        items = coded.groupBy("item").agg(
            F.sort_array(F.collect_list(F.struct("k", "share"))).alias("v"),  # one entry per annotator at most
            F.count_if(is_model).alias("n_models"),
            F.sum("share").alias("include"),
            F.count("*").alias("n"),
        )
        features = item_features(texts.join(items.select("item"), "item", "left_semi"))
        blank = F.array(*[F.lit(0.0)] * FEATURES, F.lit(1.0))
        joined = items.join(features, "item", "left")
        self.rows = stage(joined.select("item", F.col("v.k").alias("k"), F.col("v.share").alias("s"), "n_models", "include", "n", F.coalesce("x", blank).alias("x")))
        self._fit()

    def _fit(self) -> None:
        a, d = len(self.names), FEATURES + 1
        right = np.log(START_ACCURACY / (1 - START_ACCURACY))
        # log of P(vote | truth) as differences: what an INCLUDE vote and an EXCLUDE vote add to the log odds
        self.gain = np.column_stack([np.full(a, right), np.full(a, -right)])
        self.w = np.zeros(d)
        self.sensitivity, self.specificity = np.full(a, START_ACCURACY), np.full(a, START_ACCURACY)
        for _ in range(ROUNDS if a else 0):
            sums = self._sums()
            conf = sums[: 4 * a].reshape(a, 4)  # votes INCLUDE, EXCLUDE under truth INCLUDE, then under truth EXCLUDE
            grad, hess = sums[4 * a : 4 * a + d], sums[4 * a + d :].reshape(d, d)
            ridge = np.full(d, RIDGE)
            ridge[-1] = 1e-3
            step = np.linalg.solve(hess + np.diag(ridge), grad - ridge * self.w)
            sens = (conf[:, 0] + PSEUDO * START_ACCURACY) / (conf[:, 0] + conf[:, 1] + PSEUDO)
            spec = (conf[:, 3] + PSEUDO * START_ACCURACY) / (conf[:, 2] + conf[:, 3] + PSEUDO)
            moved = max(np.abs(step).max() / 10, np.abs(sens - self.sensitivity).max(), np.abs(spec - self.specificity).max())
            self.w = self.w + np.clip(step, -3, 3)
            self.sensitivity, self.specificity = sens, spec
            self.gain = np.column_stack([np.log(sens / (1 - spec)), np.log((1 - sens) / spec)])
            if moved < TOLERANCE:
                break

    def _sums(self) -> np.ndarray:
        """Expected confusion counts, gradient and curvature of the classifier, summed over all items."""
        a, d, gain, w = len(self.names), FEATURES + 1, self.gain, self.w

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(4 * a + d + d * d)
            for batch in batches:
                k, s, x, at = _arrays(batch, d)
                q, prior = _posterior(k, s, at, x, gain, w)
                qv = np.repeat(q, np.diff(at))
                for col, part in enumerate((qv * s, qv * (1 - s), (1 - qv) * s, (1 - qv) * (1 - s))):
                    total[col : 4 * a : 4] += np.bincount(k, weights=part, minlength=a)
                total[4 * a : 4 * a + d] += x.T @ (q - prior)
                total[4 * a + d :] += ((x * (prior * (1 - prior))[:, None]).T @ x).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.float64())], names=["slot", "value"])

        parts = self.rows.select("k", "s", "x").mapInArrow(run, "slot int, value double")
        out = np.zeros(4 * a + d + d * d)
        for row in parts.groupBy("slot").agg(F.sum("value").alias("value")).collect():
            out[row["slot"]] = row["value"]
        return out

    def items(self, least_models: int = 3) -> DataFrame:
        """(item, decision, probability, n_models, agreement): items with votes of so many different models.

        agreement is the share of annotators' votes that go with the decision; a probability of exactly one
        half is INCLUDE, so that a doubtful record is kept.
        """
        d, gain, w = FEATURES + 1, self.gain, self.w

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k, s, x, at = _arrays(batch, d)
                q, _ = _posterior(k, s, at, x, gain, w)
                yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(4), batch.column(5), batch.column(6), pa.array(q, pa.float64())], names=["item", "n_models", "include", "n", "probability"])

        found = self.rows.filter(F.col("n_models") >= least_models).select("k", "s", "x", "item", "n_models", "include", "n").mapInArrow(run, "item string, n_models bigint, include double, n bigint, probability double")
        yes = F.col("probability") >= 0.5
        with_it = F.when(yes, F.col("include") / F.col("n")).otherwise(1 - F.col("include") / F.col("n"))
        return found.select("item", F.when(yes, POSITIVE).otherwise(NEGATIVE).alias("decision"), F.round("probability", 6).alias("probability"), "n_models", F.round(with_it, 6).alias("agreement"))

    def annotators(self) -> DataFrame:
        """(annotator, n_items, sensitivity, specificity, reliability): reliability is their mean; 0.5 is chance."""
        counts = self.shares.groupBy("annotator").agg(F.count("*").alias("n_items"))
        rows = [(n, float(p), float(q), float((p + q) / 2)) for n, p, q in zip(self.names, self.sensitivity, self.specificity, strict=True)]
        fitted = self.rows.sparkSession.createDataFrame(rows, "annotator string, sensitivity double, specificity double, reliability double")
        return counts.join(fitted, "annotator").select("annotator", "n_items", *(F.round(c, 4).alias(c) for c in ("sensitivity", "specificity", "reliability")))

    def agreement(self) -> DataFrame:
        """One row over items with two annotators or more: items, votes, observed agreement and Krippendorff's alpha.

        Nulls in observed and alpha if there is no such item; alpha is null if only one label was ever given.
        """
        both = self.rows.filter("n >= 2").select("n", "include")
        same = (F.col("include") * (F.col("include") - 1) + (F.col("n") - F.col("include")) * (F.col("n") - F.col("include") - 1)) / (F.col("n") - 1)
        sums = both.agg(F.count("*").alias("n_items"), F.sum("n").alias("n_votes"), F.sum(same).alias("same"), F.sum("include").alias("yes"))
        chance = (F.col("yes") * (F.col("yes") - 1) + (F.col("n_votes") - F.col("yes")) * (F.col("n_votes") - F.col("yes") - 1)) / (F.col("n_votes") - 1)
        alpha = F.when(chance < F.col("n_votes"), 1 - (F.col("n_votes") - F.col("same")) / (F.col("n_votes") - chance))
        return sums.select("n_items", F.coalesce("n_votes", F.lit(0)).alias("n_votes"), F.round(F.col("same") / F.col("n_votes"), 6).alias("observed"), F.round(alpha, 6).alias("alpha"))


def _arrays(batch: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at = batch.column(0).offsets.to_numpy()
    k = batch.column(0).values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
    s = batch.column(1).values.to_numpy(zero_copy_only=False)[at[0] : at[-1]]
    first = batch.column(2).offsets.to_numpy()
    x = batch.column(2).values.to_numpy(zero_copy_only=False)[first[0] : first[-1]].reshape(-1, d)
    return k, s, x, at - at[0]


def _posterior(k: np.ndarray, s: np.ndarray, at: np.ndarray, x: np.ndarray, gain: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of INCLUDE per item given votes and text, and given the text alone."""
    z = np.clip(x @ w, -30, 30)
    sums = np.concatenate(([0.0], np.cumsum(s * gain[k, 0] + (1 - s) * gain[k, 1])))
    return 1 / (1 + np.exp(-np.clip(z + sums[at[1:]] - sums[at[:-1]], -60, 60))), 1 / (1 + np.exp(-z))
