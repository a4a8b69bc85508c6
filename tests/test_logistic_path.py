"""The warm-started path against separate fits and against the library's own solver; concurrent fits against serial ones."""

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from barloom.functions.parallel import concurrently
from barloom.operators import logistic_path as lp


def frame(spark, n=400, d=4):
    draw = np.random.default_rng(11)
    x = draw.normal(0, 1, (n, d))
    x[:, 1] += x[:, 0]
    y = (draw.random(n) < 1 / (1 + np.exp(-(x @ np.array([1.5, -1, 0.5, 0][:d]))))).astype(int)
    return spark.createDataFrame([(str(i), *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))],
                                 "ticker string, " + ", ".join(f"f{k} double" for k in range(d)) + ", y int")


def test_path_equals_separate_fits(spark):
    rows = lp.standardised(frame(spark), ["f0", "f1", "f2", "f3"], folds=2, keys=("ticker",)).coalesce(2).cache()
    strengths = (0.01, 1.0, 100.0)
    warm, cold = (lp.path(rows, 2, strengths, warm=w) for w in (True, False))
    assert warm.keys() == cold.keys() and len(warm) == 12
    assert all(np.abs(warm[k] - cold[k]).max() < 1e-4 for k in warm)
    assert (warm[0, "l1", 0.01][1:] == 0).any() and np.abs(warm[0, "l2", 100.0][1:]).min() > 0
    for penalty, mix in (("l1", 1.0), ("l2", 0.0)):
        part = rows.where("fold <> 0").select("y", array_to_vector("x").alias("features"))
        n = part.count()
        m = LogisticRegression(labelCol="y", regParam=1.0 / n, elasticNetParam=mix, standardization=False, tol=1e-10, maxIter=500).fit(part)
        assert np.abs(np.array([m.intercept, *m.coefficients]) - warm[0, penalty, 1.0]).max() < 1e-3
    scores = lp.grid_scores(rows, 2, warm).collect()
    assert len(scores) == 6 and all(0.6 < r["cv_f1"] < 1 for r in scores if r["strength"] == 1.0)


def test_concurrent_results_keep_their_order(spark):
    tasks = [lambda k=k: spark.range(k).agg(F.sum("id")).first()[0] or 0 for k in range(9)]
    assert concurrently(spark, tasks, 4) == concurrently(spark, tasks, 1)
