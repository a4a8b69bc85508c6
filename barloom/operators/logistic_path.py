"""I4: logistic regression over a path of regularisation weights, for all folds at once.

Proximal Newton steps: one pass over the rows adds up, for every fold and penalty,
the gradient and the curvature at the present weights; the driver solves the small
quadratic models (in closed form for L2, by coordinate descent for L1). The weights
found for one strength start the next, so a strength takes a few passes, whatever
the number of folds. The objective is that of the usual grid: penalty + C x loss,
with the intercept free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import stored

c_ = F.col
#: FIXED VALUES: the strengths and penalties of the grid
STRENGTHS = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)
PENALTIES = ("l1", "l2")
#: Share of the objective that a step must gain for its fit to go on.
GAIN = 1e-9


def standardised(df: DataFrame, features: Sequence[str], label: str = "y", folds: int = 5, keys: Sequence[str] = ("ticker", "trading_date"),
                 seed: int = 42) -> DataFrame:
    """(fold, y, x): features scaled to mean 0 and population sd 1 over all rows (constant ones to 0, NULL and
    NaN to the mean), folds by hash of the key."""
    values = [F.when(F.isnan(c_(f).cast("double")), None).otherwise(c_(f).cast("double")) for f in features]
    stats = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
                   *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(values)]).first()
    scaled = [F.coalesce((v - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"]), F.lit(0.0)) if stats[f"s{i}"] else F.lit(0.0)
              for i, v in enumerate(values)]
    fold = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(folds)).cast("int")
    return df.where(c_(label).isNotNull()).select(fold.alias("fold"), c_(label).cast("int").alias("y"), F.array(*scaled).alias("x"))


def packed_rows(rows: DataFrame) -> DataFrame:
    """(fold, d, y, x) of ``standardised`` rows: per Arrow batch and fold the labels and the features (row by row, d of
    them) as binaries, written once. A pass then takes arrays instead of rows. Packed rows stay as they are."""
    if "d" in rows.columns:
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            fold, y = b.column(0).to_numpy(), b.column(1).to_numpy().astype(float)
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            own = [(k, fold == k) for k in np.unique(fold)]
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in own], pa.int32()), pa.array([x.shape[1]] * len(own), pa.int32()),
                pa.array([y[at].tobytes() for _, at in own], pa.binary()), pa.array([x[at].tobytes() for _, at in own], pa.binary())],
                names=["fold", "d", "y", "x"])

    return stored(rows.select("fold", "y", "x").mapInArrow(run, "fold int, d int, y binary, x binary"), "grid-packed")


def _sums(rows: DataFrame, fits: list[tuple[int, str]], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gradient, curvature, loss) of every fit (fold left out, penalty), one pass over ``packed_rows``."""
    d = weights.shape[1]
    left_out = np.array([fold for fold, _ in fits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, h, loss = np.zeros((len(fits), d)), np.zeros((len(fits), d, d)), np.zeros(len(fits))
        for b in batches:
            for fold, labels, values in zip(b.column(0).to_pylist(), b.column(2), b.column(3)):
                y = np.frombuffer(labels.as_buffer(), float)
                x = np.column_stack([np.ones(len(y)), np.frombuffer(values.as_buffer(), float).reshape(len(y), -1)])
                used = np.flatnonzero(left_out != fold)
                z = x @ weights[used].T
                e = np.exp(-np.abs(z))
                q = np.where(z >= 0, 1.0, e) / (1 + e)
                g[used] += (q - y[:, None]).T @ x
                loss[used] += (np.maximum(z, 0) + np.log1p(e) - y[:, None] * z).sum(0)
                for k, i in enumerate(used):
                    h[i] += (x * (q[:, k] * (1 - q[:, k]))[:, None]).T @ x
        for i in range(len(fits)):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(1 + d + d * d, i), pa.int32()), pa.array(np.arange(1 + d + d * d), pa.int32()),
                pa.array(np.concatenate([[loss[i]], g[i], h[i].ravel()]))], names=["i", "k", "v"])

    parts = rows.mapInArrow(run, "i int, k int, v double")
    total = np.zeros((len(fits), 1 + d + d * d))
    sums = parts.groupBy("i", "k").agg(F.sum("v").alias("v")).toPandas()       # features x features per fit
    total[sums["i"], sums["k"]] = sums["v"]
    return total[:, 1:1 + d], total[:, 1 + d:].reshape(len(fits), d, d), total[:, 0]


def _solve(w: np.ndarray, g: np.ndarray, h: np.ndarray, strength: float, penalty: str) -> np.ndarray:
    """Least point of the quadratic model of strength x loss plus the penalty (not on the first weight)."""
    if penalty == "l2":
        ridge = np.diag([0.0] + [1.0] * (len(w) - 1))
        return w - np.linalg.solve(strength * h + ridge + 1e-12 * np.eye(len(w)), strength * g + ridge @ w)
    new, slope = w.copy(), strength * g
    curve = strength * h
    for _ in range(1000):
        most = 0.0
        for k in range(len(w)):
            rest = -(slope[k] + curve[k] @ (new - w)) + curve[k, k] * new[k]
            bound = 0.0 if k == 0 else 1.0
            value = np.sign(rest) * max(abs(rest) - bound, 0.0) / max(curve[k, k], 1e-12)
            most = max(most, abs(value - new[k]))
            new[k] = value
        if most < 1e-9:
            break
    return new


def _objective(w: np.ndarray, loss: float, strength: float, penalty: str) -> float:
    return strength * loss + (np.abs(w[1:]).sum() if penalty == "l1" else (w[1:] ** 2).sum() / 2)


def path(rows: DataFrame, folds: int, strengths: Sequence[float] = STRENGTHS, penalties: Sequence[str] = PENALTIES,
         warm: bool = True, rounds: int = 60, tol: float = 1e-6) -> dict[tuple[int, str, float], np.ndarray]:
    """Weights (intercept first) by (fold left out, penalty, strength). A step that raises the objective is halved;
    a pass adds up only the fits that still move."""
    rows = packed_rows(rows)
    first = rows.select("d").first()
    d = 1 + (first[0] if first else 0)
    fits = [(fold, penalty) for fold in range(folds) for penalty in penalties]
    weights, found = np.zeros((len(fits), d)), {}
    g = h = loss = None
    for strength in sorted(strengths):
        if not warm:
            weights = np.zeros((len(fits), d))
        if g is None or not warm:               # else those of the last steps taken hold
            g, h, loss = _sums(rows, fits, weights)
        target = [_solve(w, g[i], h[i], strength, fits[i][1]) for i, w in enumerate(weights)]
        step, open_fits = np.ones(len(fits)), [*range(len(fits))]
        for _ in range(rounds):
            trial = np.array([weights[i] + step[i] * (target[i] - weights[i]) for i in open_fits])
            tg, th, tl = _sums(rows, [fits[i] for i in open_fits], trial)
            still = []
            for k, i in enumerate(open_fits):
                penalty = fits[i][1]
                before, after = (_objective(w, x, strength, penalty) for w, x in ((weights[i], loss[i]), (trial[k], tl[k])))
                if after <= before + 1e-9 * abs(before):
                    # features that are multiples of each other let weights move on between them with nothing to gain
                    moving = np.abs(trial[k] - weights[i]).max() > tol and before - after > GAIN * abs(before)
                    weights[i], g[i], h[i], loss[i], step[i] = trial[k], tg[k], th[k], tl[k], 1.0
                    if moving:
                        target[i] = _solve(weights[i], g[i], h[i], strength, penalty)
                        still.append(i)
                else:
                    step[i] /= 2
                    if step[i] > 1e-6:
                        still.append(i)
            open_fits = still
            if not open_fits:
                break
        for i, (fold, penalty) in enumerate(fits):
            found[fold, penalty, strength] = weights[i].copy()
    return found


def grid_scores(rows: DataFrame, folds: int, found: dict) -> DataFrame:
    """(penalty, strength, cv_f1): weighted F1 of the left-out rows, averaged over folds. Tasks count the calls of all
    fits of a fold; the counts, a row per fit, meet on the driver."""
    fits = [*found]
    of_fold = {fold: [k for k, f in enumerate(fits) if f[0] == fold] for fold in range(folds)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(fits), 4), np.int64)
        for b in batches:
            for fold, labels, values in zip(b.column(0).to_pylist(), b.column(2), b.column(3)):
                y, own = np.frombuffer(labels.as_buffer(), float) == 1, of_fold[fold]
                w = np.array([found[fits[k]] for k in own]).reshape(len(own), -1)
                called = np.frombuffer(values.as_buffer(), float).reshape(len(y), -1) @ w[:, 1:].T + w[:, 0] >= 0
                for k, up in zip(own, called.T):
                    n[k] += [(up & y).sum(), (up & ~y).sum(), (~up & y).sum(), (~up & ~y).sum()]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(fits)), pa.int32()), *[pa.array(c) for c in n.T]],
                                         names=["k", "tp", "fp", "fn", "tn"])

    def f1(hit: int, false: int, missed: int) -> float:
        return 2 * hit / (2 * hit + false + missed) if hit else 0.0

    counts = packed_rows(rows).mapInArrow(run, "k int, tp long, fp long, fn long, tn long").groupBy("k").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
    scores: dict[tuple[str, float], list[float]] = {}
    for r in counts.collect():
        n = r["tp"] + r["fp"] + r["fn"] + r["tn"]
        if n:
            up, down = f1(r["tp"], r["fp"], r["fn"]), f1(r["tn"], r["fn"], r["fp"])
            scores.setdefault(fits[r["k"]][1:], []).append((up * (r["tp"] + r["fn"]) + down * (r["tn"] + r["fp"])) / n)
    return rows.sparkSession.createDataFrame([(*k, float(np.mean(v))) for k, v in scores.items()],
                                             "penalty string, strength double, cv_f1 double")


def tune_grid(train: DataFrame, features: Sequence[str], folds: int = 5) -> DataFrame:
    """I4: the whole grid of strengths and penalties by k-fold cross-validation."""
    rows = packed_rows(standardised(train, features, folds=folds))
    return grid_scores(rows, folds, path(rows, folds))
