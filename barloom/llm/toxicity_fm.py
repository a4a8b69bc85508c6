"""Toxicity by a factorisation machine over hashed terms.

A text is the set of its hashed terms: words, and the first letters of longer
words, so that unseen forms of a learned stem still count. The score is a
logistic of ``w0 + sum w_i + sum over pairs <v_i, v_j>``; the factors let a pair
of terms (an insult and a mention of a group) weigh more than the two alone. The
pair sum over a whole document costs one pass: (|sum v|^2 - sum |v|^2) / 2.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import PUNCTUATION, prior_shift, remainder, slices, table, word_hashes

HELD_OUT = (5, 0)
#: Labelled documents per label that the model is fitted on (chosen by hash of the id), at most.
PER_LABEL = 4000
BITS = 20
PREFIXES = (4, 5, 6, 8)
#: A term is learned when it occurs in so many of the texts fitted on, and its count among the
#: positive ones is so many standard deviations away from the count that chance would give.
LEAST_TEXTS = 6
LEAST_Z = 4.0
#: So is a term of any pair whose positive texts differ by so many texts, and standard deviations, from what
#: the terms learned alone explain. All pairs are looked at, also those of terms that are neutral alone.
PAIR_TEXTS = 3.0
PAIR_Z = 12.0
FACTORS = 8


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct term buckets of a whole text."""
    if not text:
        return np.zeros(0, np.int32)
    hashes = word_hashes(text.encode("utf-8", "replace"), PUNCTUATION, PREFIXES)
    return np.unique((hashes >> np.uint64(64 - BITS)).astype(np.int32))


@dataclass
class FactorisationMachine:
    slots: np.ndarray       # bucket -> row of w and v, or -1
    bias: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, buckets: np.ndarray) -> float:
        rows = self.slots[buckets]
        rows = rows[rows >= 0]
        v = self.v[rows]
        return float(self.bias + self.w[rows].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v ** 2).sum()))


def descend(sets: list[np.ndarray], labels: np.ndarray, learned: np.ndarray, factors: int, epochs: int, rate: float, l2: float,
            batch: int) -> FactorisationMachine:
    """Adagrad on the logistic loss over the buckets ``learned``."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    slots = np.full(1 << BITS, -1, np.int32)
    slots[learned] = np.arange(len(learned))
    draw = np.random.default_rng(7)
    bias, w = float(np.log(share / (1 - share))), np.zeros(len(learned), np.float32)
    v = draw.normal(0, 0.01, (len(learned), factors)).astype(np.float32)
    if len(set(labels.tolist())) < 2 or not len(learned):
        return FactorisationMachine(slots, bias, w, v * 0)
    rows = [r[r >= 0] for r in (slots[s] for s in sets)]
    sum_w, sum_v, sum_b = np.full_like(w, 1e-6), np.full_like(v, 1e-6), 1e-6
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for part in (order[i:i + batch] for i in range(0, len(order), batch)):
            flat = np.concatenate([rows[i] for i in part])
            sizes = np.array([len(rows[i]) for i in part])
            some = sizes > 0                                # texts without a learned term still move the bias
            cuts = (np.cumsum(sizes) - sizes)[some]
            of = np.repeat(np.arange(len(part)), sizes)
            vf = v[flat]
            m, total = np.full(len(part), bias), np.zeros((len(part), factors), np.float32)
            if len(flat):
                total[some] = np.add.reduceat(vf, cuts, axis=0)
                m[some] += np.add.reduceat(w[flat], cuts) + 0.5 * (
                    (total[some] ** 2).sum(1) - np.add.reduceat(vf ** 2, cuts, axis=0).sum(1))
            g = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - labels[part]).astype(np.float32) / len(part)
            used, back = np.unique(flat, return_inverse=True)
            gw = np.bincount(back, g[of], len(used)).astype(np.float32) + l2 * w[used]
            gv_each = g[of, None] * (total[of] - vf)
            gv = np.stack([np.bincount(back, gv_each[:, f], len(used)) for f in range(factors)], 1).astype(np.float32) + l2 * v[used]
            gb = float(g.sum())
            sum_w[used] += gw ** 2
            sum_v[used] += gv ** 2
            sum_b += gb ** 2
            w[used] -= rate * gw / np.sqrt(sum_w[used])
            v[used] -= rate * 0.2 * gv / np.sqrt(sum_v[used])
            bias -= rate * gb / np.sqrt(sum_b)
    return FactorisationMachine(slots, bias, w, v)


def telling_pairs(sets: list[np.ndarray], rest: np.ndarray, spread: np.ndarray, least: float = PAIR_TEXTS,
                  z: float = PAIR_Z) -> np.ndarray:
    """Terms of all pairs whose common texts' residuals ``rest`` sum to at least ``least`` and ``z`` standard
    deviations (``spread`` are the variances). A pair's sum is no larger than that of the absolute residuals
    of either term, so terms below ``least`` are passed over without a loss."""
    flat, sizes = np.concatenate([*sets, np.zeros(0, np.int32)]), [len(s) for s in sets]
    reach = np.bincount(flat, np.repeat(np.abs(rest), sizes), minlength=1 << BITS)
    open_ = np.flatnonzero((reach >= least) & (np.bincount(flat, minlength=1 << BITS) >= LEAST_TEXTS))
    open_ = open_[np.argsort(reach[open_], kind="stable")]
    slots = np.full(1 << BITS, -1, np.int32)
    slots[open_] = np.arange(len(open_))      # a term meets those of larger reach only
    rows = [np.sort(r[r >= 0]) for r in (slots[s] for s in sets)]
    sizes = np.array([len(r) for r in rows], int)
    flat, ends = np.concatenate([*rows, np.zeros(0, np.int32)]), np.cumsum(sizes)
    of, stop = np.repeat(np.arange(len(rows)), sizes), np.repeat(ends, sizes)
    at = np.argsort(flat, kind="stable")
    found = np.zeros(len(open_), bool)
    for a, places in enumerate(np.split(at, np.cumsum(np.bincount(flat, minlength=len(open_)))[:-1]) if len(open_) else []):
        texts = of[places]
        mates = np.concatenate([flat[i + 1:stop[i]] for i in places])
        if not len(mates):
            continue
        counts = stop[places] - places - 1
        mates = mates - a
        total = np.bincount(mates, np.repeat(rest[texts], counts))
        some = np.flatnonzero(np.abs(total) >= least)
        if len(some):
            near = np.isin(mates, some)
            var = np.bincount(mates[near], np.repeat(spread[texts], counts)[near], minlength=len(total))[some]
            some = some[np.abs(total[some]) >= z * np.sqrt(var)]
            found[a + some] = True
            found[a] |= len(some) > 0
    return open_[found]


def fit(sets: list[np.ndarray], labels: np.ndarray, factors: int = FACTORS, epochs: int = 12, rate: float = 0.3,
        l2: float = 1e-4, batch: int = 64) -> FactorisationMachine:
    """The machine over the terms that tell alone, and again with the terms of the pairs that tell beyond it.
    With labels of one kind (or none) the model is its prior."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    flat = np.concatenate([*sets, np.zeros(0, np.int32)]).astype(np.int64)
    texts = np.bincount(flat, minlength=1 << BITS)
    positive = np.bincount(flat, np.repeat(labels, [len(s) for s in sets]), minlength=1 << BITS)
    z = (positive - share * texts) / np.sqrt(np.maximum(texts, 1) * share * (1 - share))
    alone = np.flatnonzero((texts >= LEAST_TEXTS) & (np.abs(z) >= LEAST_Z))
    model = descend(sets, labels, alone, factors, epochs, rate, l2, batch)
    if len(set(labels.tolist())) < 2:
        return model
    chance = 1 / (1 + np.exp(-np.clip([model.margin(s) for s in sets], -30, 30)))
    paired = np.setdiff1d(telling_pairs(sets, labels - chance, chance * (1 - chance)), alone)
    return descend(sets, labels, np.union1d(alone, paired), factors, epochs, rate, l2, batch) if len(paired) else model


def training_set(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Term sets and labels of a bounded sample of labelled rows, whole texts (of rows
    with one id that with the least hash of its terms), and what the sampling by label takes from the log odds."""
    parts, out = HELD_OUT
    marks = labels.where(F.col("toxic").isNotNull() & (remainder(F.col("doc_id"), parts) != out)).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    draw = F.xxhash64(F.lit("toxicity"), "doc_id")
    chosen = marks.where("toxic = 1").orderBy(draw).limit(per_label).union(
        marks.where("toxic = 0").orderBy(draw).limit(per_label))

    def build(batches):
        for b in slices(batches):
            sets = [terms(t).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(sets, pa.binary())],
                                             ["doc_id", "toxic", "terms"])

    # at most 2 * per_label ids are broadcast
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "toxic", "text").mapInArrow(build, "doc_id long, toxic int, terms binary")
            .groupBy("doc_id").agg(F.min_by(F.struct("toxic", "terms"), F.xxhash64("terms")).alias("r"))
            .select("doc_id", "r.*").toArrow().sort_by("doc_id"))
    return ([np.frombuffer(t, np.int32) for t in rows.column("terms").to_pylist()],
            rows.column("toxic").to_numpy().astype(np.int64), prior_shift(marks, "toxic", per_label))


def score_toxicity(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """doc_id and score (0 to 1) of the whole text of every row; NULL and empty
    texts have no terms and get the model's prior. Repeated rows get equal
    scores, NULL ids are kept, other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # 4 MB of slots; at most 36 bytes a learned bucket

    def score(batches):
        model = shared.value
        for b in slices(batches):
            m = np.array([model.margin(terms(t)) for t in b.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(m, -30, 30))))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, score double")


def detect_toxicity(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """Fit on the learning part of ``labels`` and score all ``docs``: doc_id, held_out, score, predicted."""
    *sample, shift = training_set(docs, labels, per_label)
    model = fit(*sample)
    model.bias += shift     # the labels' own odds, whatever the caps took
    parts, out = HELD_OUT
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), parts) == out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    return detect_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
