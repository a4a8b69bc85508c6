"""Document quality by a byte-level convolutional network in numpy.

Learned filters of five bytes slide over the whole text. Their rectified
responses are max-pooled over chunks that overlap by half and together cover
every byte, each chunk gets a logit, and the chunks' logits (mean, and share
above zero) with the text's size combine into one probability. A filter over
one-hot bytes is a table of 256 weights per position, so a response is a sum of
table rows and a backward step touches only the bytes that won the pooling.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import prior_shift, remainder, slices, table

HELD_OUT = (4, 2)
ACCEPT = 0.7
WIDTH, FILTERS = 5, 16
#: Chunks are two blocks, and each next chunk starts one block later.
BLOCK = 128
#: Labelled documents per label that the model is fitted on (chosen by hash of the id), at most.
PER_LABEL = 2500
#: Text bytes per label that the sample holds, at most (texts of over a 64th of it are not drawn for it).
SAMPLE_BYTES = 48 << 20
#: Bytes convolved at once; longer texts go slab by slab.
SLAB = 1 << 16


@dataclass
class ByteCNN:
    tables: np.ndarray      # (WIDTH, 256, FILTERS)
    bias: np.ndarray        # (FILTERS,)
    out: np.ndarray         # (FILTERS,)
    out_bias: float
    combine: np.ndarray     # weights of [1, mean logit, share above zero, size]

    def blocks(self, data: np.ndarray) -> np.ndarray:
        """Max-pooled responses per block of positions, for the whole text."""
        if len(data) < WIDTH:
            data = np.append(data, np.zeros(WIDTH - len(data), np.uint8))
        n = len(data) - WIDTH + 1
        found = []
        for start in range(0, n, SLAB):
            size = min(SLAB, n - start)
            total = self.tables[0][data[start:start + size]]
            for k in range(1, WIDTH):
                total += self.tables[k][data[start + k:start + k + size]]
            found.append(np.maximum.reduceat(total, np.arange(0, size, BLOCK), axis=0))
        return np.maximum(np.concatenate(found) + self.bias, 0)

    def features(self, data: np.ndarray) -> np.ndarray:
        pooled = self.blocks(data)
        chunks = np.maximum(pooled[:-1], pooled[1:]) if len(pooled) > 1 else pooled
        return summary(chunks @ self.out + self.out_bias, len(data))

    def probability(self, text: str | None) -> float:
        data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
        return float(1 / (1 + np.exp(-np.clip(self.features(data) @ self.combine, -30, 30))))


def summary(logits: np.ndarray, size: int) -> np.ndarray:
    return np.array([1.0, np.clip(logits, -8, 8).mean(), (logits > 0).mean(), np.log1p(size) / 10])


def chunk_places(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and for every half-overlapping chunk of each its text, its
    start there, and its positions (a convolution's places before the text ends)."""
    padded = [t if len(t) >= WIDTH else np.append(t, np.zeros(WIDTH - len(t), np.uint8)) for t in texts]
    flat = np.concatenate([*padded, np.zeros(2 * BLOCK + WIDTH, np.uint8)])
    size = np.array([len(t) for t in padded], np.int64)
    places = size - WIDTH + 1
    count = np.maximum(1, -(-places // BLOCK) - 1)
    of = np.repeat(np.arange(len(texts)), count)
    start = BLOCK * (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))
    return flat, of, (np.cumsum(size) - size)[of] + start, np.minimum(2 * BLOCK, places[of] - start)


def fit(texts: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, epochs: int = 3, batch: int = 256,
        rate: float = 0.02, cropped: float = 0.4) -> ByteCNN:
    """Adam on the logistic loss of all chunks of the ``texts`` (their bytes; labels weigh the same, and
    so do texts), then a logistic regression over the texts' summaries as they are scored. Each time, the
    share ``cropped`` of the chunks is cut to a random size, so that short texts are judged alike.
    With labels of one kind (or none) the model is its prior."""
    draw = np.random.default_rng(11)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    prior = np.array([np.log(share / (1 - share)), 0, 0, 0])
    model = ByteCNN(draw.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                    draw.normal(0, 0.3, FILTERS).astype(np.float32), 0.0, prior)
    if len(set(labels.tolist())) < 2:
        return model
    flat, of, start, valid = chunk_places(texts)
    y = labels[of].astype(np.float32)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32) / np.bincount(of)[of]
    weight /= weight.mean()
    n = 2 * BLOCK
    window = np.arange(n + WIDTH - 1)
    params = [model.tables, model.bias, model.out, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(of))
        for part in (order[i:i + batch] for i in range(0, len(order), batch)):
            data, rows = flat[start[part][:, None] + window], np.arange(len(part))
            response = params[0][0][data[:, :n]]
            for k in range(1, WIDTH):
                response += params[0][k][data[:, k:k + n]]
            cut = np.exp(draw.uniform(np.log(5), np.log(n), len(part)))
            upto = np.where(draw.random(len(part)) < cropped, np.minimum(cut, valid[part]), valid[part])
            response[np.arange(n) >= upto[:, None]] = -1e9
            at = response.argmax(axis=1)                                        # (rows, FILTERS)
            top = np.take_along_axis(response, at[:, None], 1)[:, 0] + params[1]
            pooled = np.maximum(top, 0)
            logit = pooled @ params[2] + params[3]
            g = weight[part] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[part]) / len(part)
            g_top = (g[:, None] * params[2]) * (top > 0)
            g_tables = np.zeros_like(params[0])
            for k in range(WIDTH):
                np.add.at(g_tables[k], (data[rows[:, None], at + k], np.arange(FILTERS)), g_top)
            grads = [g_tables + 1e-5 * params[0], g_top.sum(0), pooled.T @ g, g.sum(keepdims=True)]
            step += 1
            for p, d, a, b in zip(params, grads, first, second):
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    model.out_bias = float(params[3][0])
    seen = np.stack([model.features(t) for t in texts])
    model.combine = _logistic(seen, labels)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps of a ridge logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hessian, x.T @ (p - y) + ridge * w)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w


def training_set(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL):
    """Bytes, sizes and labels of a bounded sample of labelled rows (whole texts; of rows with one id
    the text with the least hash), and what the sampling by label takes from the log odds."""
    parts, out = HELD_OUT
    marks = labels.where(F.col("quality").isNotNull() & (remainder(F.col("doc_id"), parts) != out)).groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality"))
    draw = F.xxhash64(F.lit("quality"), "doc_id")
    chosen = marks.where("quality = 1").orderBy(draw).limit(per_label).union(
        marks.where("quality = 0").orderBy(draw).limit(per_label))
    # at most 2 * per_label ids are broadcast
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").where(F.octet_length("text") <= SAMPLE_BYTES // 64)
            .groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    upto = Window.partitionBy("quality").orderBy(draw).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum(F.octet_length("text") + 1).over(upto)).where(F.col("upto") <= SAMPLE_BYTES)
    rows = rows.select("doc_id", "quality", F.col("text").cast("binary").alias("text")).toArrow().sort_by("doc_id")
    texts = [np.frombuffer(t, np.uint8) for t in rows.column("text").to_pylist()]
    return (texts, np.array([len(t) for t in texts], np.int64), rows.column("quality").to_numpy().astype(np.int64),
            prior_shift(marks, "quality", per_label))


def score_quality(docs: DataFrame, model: ByteCNN) -> DataFrame:
    """doc_id and score (0 to 1) of the whole text of every row. NULL and empty
    texts are one chunk of padding. Repeated rows get equal scores, NULL ids are
    kept, other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # 82 kB of tables

    def score(batches):
        model = shared.value
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([model.probability(t) for t in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, score double")


def rate_quality(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """Fit on the learning part of ``labels`` and score all ``docs``: doc_id, held_out, score, predicted."""
    *sample, shift = training_set(docs, labels, per_label)
    model = fit(*sample)
    model.combine = model.combine + [shift, 0, 0, 0]        # the labels' own odds, whatever the caps took
    parts, out = HELD_OUT
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), parts) == out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    return rate_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
