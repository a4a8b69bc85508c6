"""Catalogue entries for 2.8 (training, scoring), 2.9 calibration fits and
A12 artifacts. Fitted-model outputs are rows-only checks; the ensemble and
best-model operators over a scores table have exact oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barloom.functions.columns import r4, r4_sql
from barloom.functions.parallel import concurrently
from barloom.operators import calibration as calib
from barloom.operators import labels as lab
from barloom.operators import metrics as met
from barloom.operators import models as mdl
from barloom.operators import records as rec
from barloom.operators.features import direction_label
from barloom.operators.logistic_path import tune_grid
from barloom.plans import derived as dv
from barloom.plans.catalog import register
from barloom.plans.pipelines import daily_scoring, labelled_features
from barloom.plans.q_more import effective_thresholds
from barloom.plans.q_features import features
from barloom.plans.q_prep import MI_COLS, RELATIVE, STOCK, train_rows
from barloom.session import scratch_path, stored

c_ = F.col
ML_FEATURES = STOCK + RELATIVE


# The keys fit at these sizes so that a comparison run stays short; the operators' own defaults are the
# production sizes, and ``weekly_retrain`` uses those.
KEY_SIZES = mdl.ModelSizes(trees=20, depth=8, rounds=20, round_depth=5)
SELECTION_SAMPLE = 20_000


def _ml_rows(fx):
    """Cleaned, labelled features: every labelled row, no split, unwritten."""
    lf = labelled_features(fx.spark, fx.sf_dir, ML_FEATURES)
    return lf.select("ticker", "trading_date", (c_("direction_5d") == "Up").cast("int").alias("y"), "direction_5d",
                     "next_5d_return", *ML_FEATURES)


def ml_base(fx):
    return fx.derived("ml_base", _ml_rows)


def ml_frame(fx):
    """``ml_base`` with purged split, dead zone (train and calibration only), clipped target and G6
    weights on the train slice. Split dates and weights are made of the narrow labels, so that the features are
    made once, while this frame is written."""
    def build(f):
        labels = direction_label(features(f, "next_5d_close", "next_5d_return")).select(
            "ticker", "trading_date", "direction_5d", "next_5d_return")
        labels = stored(labels, "ml-labels", "ticker", ("trading_date",))
        rows = ml_base(f) if f.has_derived("ml_base") else _ml_rows(f)
        lf = lab.label_clip(lab.dead_zone(lab.split_purged(rows, dates_of=labels))).withColumnRenamed(
            "next_5d_return_clipped", "y_return_clipped")
        train = lab.dead_zone(lab.split_purged(labels)).filter(c_("split") == "train")
        weights = lab.sample_weights(train).select("ticker", "trading_date", "sample_weight")
        return lf.join(weights, ["ticker", "trading_date"], "left").withColumn(
            "sample_weight", F.coalesce(c_("sample_weight"), F.lit(1.0)))
    return fx.derived("ml_frame", build)


def _train_test(fx):
    m = ml_frame(fx)
    return m.filter(c_("split") == "train"), m.filter(c_("split") == "test")


def _round(df):
    return df.select(*[r4(f.name).alias(f.name) if f.dataType.typeName() == "double" else c_(f.name)
                       for f in df.schema.fields])


@register("train_classifiers")
def q_train_classifiers(fx):
    tr, te = _train_test(fx)
    return _round(mdl.train_classifiers(tr, te, ML_FEATURES, sizes=KEY_SIZES))


@register("train_gbt")
def q_train_gbt(fx):
    tr, te = _train_test(fx)
    return _round(mdl.train_gbt_early_stopping(tr, te, ML_FEATURES, sizes=KEY_SIZES))


@register("train_zoo")
def q_train_zoo(fx):
    tr, te = _train_test(fx)
    return _round(mdl.train_zoo(tr, te, ML_FEATURES, sizes=KEY_SIZES))


@register("tune_random")
def q_tune_random(fx):
    tr, _ = _train_test(fx)
    folds = lab.cv_folds(tr, n_splits=3)
    return _round(mdl.tune_random(tr, folds, ML_FEATURES, draws=2, rounds=10))


@register("tune_grid")
def q_tune_grid(fx):
    tr, _ = _train_test(fx)
    return _round(tune_grid(tr, ML_FEATURES))


@register("train_regressors")
def q_train_regressors(fx):
    tr, te = _train_test(fx)
    return _round(mdl.train_regressors(tr, te, ML_FEATURES, sizes=KEY_SIZES))


@register("feature_importance")
def q_importance(fx):
    tr, _ = _train_test(fx)
    m = mdl.fit_classifier(tr, ML_FEATURES, mdl.classifier_zoo(sizes=KEY_SIZES)["random_forest"])
    return _round(mdl.feature_importance(m, ML_FEATURES))


@register("select_importance")
def q_select_importance(fx, sample_rows: int = SELECTION_SAMPLE, keep: int = 20):
    """H7: the ``keep`` most important features of all candidates, by a forest fitted on a seeded
    sample (sampling is the operator here, its size a parameter)."""
    # the features are made once, for the rows that are drawn; the count needs none of them
    n = train_rows(fx, "close_price").count()
    sample = train_rows(fx, *MI_COLS).select("ticker", "trading_date", "y", *MI_COLS).sample(
        fraction=min(1.0, sample_rows / max(n, 1)), seed=42)
    filled = stored(sample.select("ticker", "trading_date", "y", *[F.coalesce(c_(c).cast("double"), F.lit(0.0)).alias(c) for c in MI_COLS]),
                    "selection")
    # a forest draws by partition and place: the drawn rows are dealt as stored features are, by ticker and in order
    parts = int(fx.spark.conf.get("spark.sql.shuffle.partitions"))
    filled = filled.repartition(parts, "ticker").sortWithinPartitions("ticker", "trading_date")
    m = mdl.fit_classifier(filled, MI_COLS, mdl.classifier_zoo(weight=None, sizes=KEY_SIZES)["random_forest"])
    return _round(mdl.feature_importance(m, MI_COLS).limit(keep))


@register("predict_batch")
def q_predict_batch(fx):
    """Fit and save, then the daily run: load, score each ticker's newest bar, apply the
    rules under the derived threshold document over the defaults."""
    tr, _ = _train_test(fx)
    path = scratch_path(fx.spark, f"model_{uuid.uuid4().hex}")
    mdl.fit_classifier(tr, ML_FEATURES, mdl.classifier_zoo()["logistic"]).write().overwrite().save(path)
    doc = effective_thresholds(fx).first().asDict()       # one row
    d = daily_scoring(fx, path, {**doc, "min_stock_price": dv.TEST_CFG.min_stock_price}, ML_FEATURES)
    return _round(d.select("ticker", "trading_date", "up_probability", "predicted_signal", "confidence",
                           "is_actionable", "suppression_reason"))


COMPARED = ((1, 0.0), (3, 0.0), (5, 0.0), (1, 1.0), (3, 1.0), (5, 1.0))


@register("compare_feature_sets")
def q_compare(fx):
    """Baseline (price / volume only) against the enhanced set (+ relative) on one split, for the
    return 1, 3 and 5 days ahead (R2, linear regression) and six classes (up, and up by more than
    1 %, each 1, 3 and 5 days ahead; weighted F1, logistic regression), with the improvement."""
    sets = {"baseline": ("daily_return", "return_5d", "price_position", "RSI", "volume_sma_ratio"), "enhanced": ML_FEATURES}
    ahead = features(fx, "close_price", *[f"next_{d}d_close" for d in (1, 3, 5)]).select("ticker", "trading_date", *[
        ((c_(f"next_{d}d_close") / c_("close_price") - 1) * 100).alias(f"ret_{d}") for d in (1, 3, 5)])
    data = ml_frame(fx).join(ahead, ["ticker", "trading_date"]).select(
        "split", "sample_weight", *ML_FEATURES, *[F.greatest(F.least(c_(f"ret_{d}"), F.lit(10.0)), F.lit(-10.0)).alias(f"ret_{d}")
                                                  for d in (1, 3, 5)],
        *[(c_(f"ret_{d}") > t).cast("int").alias(f"up_{d}_{t:.0f}") for d, t in COMPARED])
    data = stored(data, "compare")
    tr, te = data.filter("split = 'train'"), data.filter("split = 'test'")
    rows = []
    for name, cols in sets.items():
        for d in (1, 3, 5):
            t = tr.filter(c_(f"ret_{d}").isNotNull())
            m = mdl.Pipeline(stages=[mdl.assembler(cols), mdl.scaler(), mdl.LinearRegression(
                labelCol=f"ret_{d}", weightCol="sample_weight", regParam=0.01)]).fit(t)
            scored = m.transform(te.filter(c_(f"ret_{d}").isNotNull())).select(
                c_(f"ret_{d}").alias("y_return"), c_("prediction").alias("pred_return"))
            rows.append(met.regression_metrics(scored, []).select(F.lit(f"return_{d}d").alias("target"), F.lit(name).alias("feature_set"),
                                                                  c_("r2").alias("value")))
        for d, t in COMPARED:
            y = f"up_{d}_{t:.0f}"
            m = mdl.fit_classifier(tr.filter(c_(y).isNotNull()), cols, mdl.classifier_zoo(sizes=KEY_SIZES)["logistic"], label=y)
            scored = mdl.score(m, te.filter(c_(y).isNotNull()), [y])
            rows.append(met.classification_metrics(scored, [], y=y).select(
                F.lit(y).alias("target"), F.lit(name).alias("feature_set"), c_("f1_weighted").alias("value")))
    both = rows[0]
    for r in rows[1:]:
        both = both.unionByName(r)
    pv = both.groupBy("target").pivot("feature_set", list(sets)).agg(F.first("value"))
    return _round(pv.withColumn("improvement_pct", F.try_divide(c_("enhanced") - c_("baseline"), F.abs("baseline")) * 100))


WALK_BANDS = ((0.0, 0.55, "<55%"), (0.55, 0.60, "55-60%"), (0.60, 0.67, "60-67%"), (0.67, 1.01, ">=67%"))


#: Folds that are fitted side by side: each fit keeps its rows in the executors' memory, and on disk beyond it.
FOLDS_AT_A_TIME = 2


def walk_forward(frame, feature_cols, estimator, folds: int = 6, test_window: int = 21, dead_zone_pct: float = 1.0,
                 least: int = 10):
    """Per walk-forward fold, on its own rows: dead zone off train and calibration, G6 weights on
    train, fit, Platt calibration, then the test dates: accuracy, accuracy outside the dead zone,
    weighted F1, accuracy by confidence band and by called side (cells of at least ``least`` rows).
    Long rows (fold, metric, key, n, value). ``frame`` holds every labelled row, with unique keys or not.

    A fold's rows are read from ``frame``; only its keys with their weights are written. ``FOLDS_AT_A_TIME`` bounds
    what the fits keep at once."""
    plan = stored(lab.walkforward_folds(frame, folds=folds, test_window=test_window), "walk-dates")
    # rows of a repeated key have weights of their own, which only the whole rows can carry
    unique = frame.groupBy("ticker", "trading_date").count().where("count > 1").isEmpty()

    def one(fid: int):
        dates = plan.filter(c_("fold") == fid).select("trading_date", "role")
        part = frame.join(F.broadcast(dates), "trading_date")        # one row per date
        moves = F.abs("next_5d_return") >= dead_zone_pct
        train = part.filter((c_("role") == "train") & moves)
        if unique:
            weights = lab.sample_weights(train.select("ticker", "trading_date", "direction_5d"))
            train = train.join(stored(weights.select("ticker", "trading_date", "sample_weight"), "fold", "ticker", ("trading_date",)),
                               ["ticker", "trading_date"])
        else:
            train = stored(lab.sample_weights(train), "fold")
        cal, test = part.filter((c_("role") == "calibration") & moves), part.filter(c_("role") == "test")
        m = mdl.fit_classifier(train, feature_cols, estimator.copy())
        scored = calib.platt(mdl.score(m, cal, ["y"]), mdl.score(m, test, ["y", "next_5d_return"])).select(
            "y", moves.alias("moves"), c_("p_calibrated").alias("p"), (c_("p_calibrated") >= 0.5).cast("int").alias("pred"))
        scored = stored(scored, "walk")
        right = (c_("y") == c_("pred")).cast("double")
        conf = F.greatest("p", 1 - c_("p"))
        band = F.coalesce(*[F.when((conf >= lo) & (conf < hi), F.lit(k)) for lo, hi, k in WALK_BANDS])
        cells = scored.select(right.alias("right"), F.explode(F.array(
            F.struct(F.lit("accuracy").alias("metric"), F.lit("all").alias("key")),
            F.struct(F.when(c_("moves"), F.lit("accuracy_ex_dead_zone")).alias("metric"), F.lit("all").alias("key")),
            F.struct(F.lit("by_confidence").alias("metric"), band.alias("key")),
            F.struct(F.lit("by_side").alias("metric"), F.when(c_("pred") == 1, "buy").otherwise("sell").alias("key")))).alias("c"))
        cells = cells.filter("c.metric IS NOT NULL").groupBy("c.metric", "c.key").agg(
            F.count("*").alias("n"), F.avg("right").alias("value")).filter(
            F.col("metric").startswith("accuracy") | (c_("n") >= least))
        f1 = met.classification_metrics(scored, []).select(
            F.lit("f1_weighted").alias("metric"), F.lit("all").alias("key"), "n", c_("f1_weighted").alias("value"))
        return cells.unionByName(f1).withColumn("fold", F.lit(fid))

    ids = [r[0] for r in plan.select("fold").distinct().orderBy("fold").collect()]       # one row per fold
    out = concurrently(frame.sparkSession, [lambda f=f: one(f) for f in ids], FOLDS_AT_A_TIME)
    res = out[0]
    for r in out[1:]:
        res = res.unionByName(r)
    return res.select("fold", "metric", "key", "n", "value")


@register("walkforward_eval")
def q_walkforward_eval(fx):
    return _round(walk_forward(ml_base(fx), ML_FEATURES, mdl.classifier_zoo(sizes=KEY_SIZES)["logistic"]))


PLATT_ROUNDS = 12


def _platt_sql() -> str:
    """The same Newton steps from (0, 0), a CTE per round; the fixture needs no halved step."""
    steps = ["i0 AS (SELECT 0e0 AS a, 0e0 AS b)"]
    for r in range(PLATT_ROUNDS):
        steps.append(f"""s{r} AS MATERIALIZED (SELECT ANY_VALUE(a) AS a, ANY_VALUE(b) AS b, SUM((q - y) * x) + ANY_VALUE(a) AS ga, SUM(q - y) AS gb,
  SUM(q * (1 - q) * x * x) + 1e0 AS haa, SUM(q * (1 - q) * x) AS hab, SUM(q * (1 - q)) AS hbb
  FROM (SELECT x, y, a, b, 1e0 / (1e0 + EXP(-(a * x + b))) AS q FROM cal, i{r}) t)""")
        steps.append(f"""i{r + 1} AS (SELECT a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a,
  b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM s{r})""")
    return ",\n".join(steps)


_CLIPPED = "LN(LEAST(GREATEST(p, 1e-6), 1 - 1e-6) / (1 - LEAST(GREATEST(p, 1e-6), 1 - 1e-6)))"
_BETWEEN = ("LEAST(GREATEST(CASE WHEN lx IS NULL THEN uv WHEN ux IS NULL OR ux = lx THEN lv "
            "ELSE lv + (uv - lv) * (p - lx) / (ux - lx) END, 0), 1)")


@register("calibrate_platt", f"""
WITH cal AS MATERIALIZED (SELECT {_CLIPPED} AS x, y FROM o_scored WHERE model = 'm1' AND split = 'calibration'),
{_platt_sql()}
SELECT row_id, {r4_sql('p')} AS p, {r4_sql(f'1e0 / (1e0 + EXP(-(a * {_CLIPPED} + b)))')} AS p_calibrated
FROM o_scored, i{PLATT_ROUNDS} WHERE model = 'm1' AND split = 'test'""", ctes=("o_scored",))
def q_platt(fx):
    """Platt scaling fitted on the calibration rows, applied to the test rows."""
    s = dv.scored(fx).filter(c_("model") == "m1")
    cal, test = s.filter(c_("split") == "calibration"), s.filter(c_("split") == "test")
    return _round(calib.platt(cal, test).select("row_id", "p", "p_calibrated"))


@register("calibrate_isotonic", f"""
WITH pts AS MATERIALIZED (SELECT p AS x, SUM(y) AS s, COUNT(*) AS n FROM o_scored WHERE model = 'm1' AND split = 'calibration' GROUP BY p),
cum AS MATERIALIZED (SELECT x, ROW_NUMBER() OVER (ORDER BY x) AS i, SUM(s) OVER (ORDER BY x) AS cs, SUM(n) OVER (ORDER BY x) AS cn,
  SUM(s) OVER (ORDER BY x) - s AS bs, SUM(n) OVER (ORDER BY x) - n AS bn FROM pts),
mins AS (SELECT k.i, MIN((k.cs - j.bs) / CAST(k.cn - j.bn AS DOUBLE)) OVER (PARTITION BY j.i ORDER BY k.i DESC) AS m
  FROM cum j JOIN cum k ON k.i >= j.i),
fit AS MATERIALIZED (SELECT cum.x, MAX(m) AS v FROM mins JOIN cum ON cum.i = mins.i GROUP BY cum.x),
t AS (SELECT row_id, p FROM o_scored WHERE model = 'm1' AND split = 'test'),
l AS (SELECT t.row_id, t.p, f.x AS lx, f.v AS lv FROM t ASOF LEFT JOIN fit f ON t.p >= f.x),
u AS (SELECT l.*, f.x AS ux, f.v AS uv FROM l ASOF LEFT JOIN fit f ON l.p <= f.x)
SELECT row_id, {r4_sql('p')} AS p, {r4_sql(_BETWEEN)} AS p_calibrated FROM u""", ctes=("o_scored",))
def q_isotonic(fx):
    """Isotonic fit on the calibration rows (in SQL by the max-min formula), applied to the test rows."""
    s = dv.scored(fx).filter(c_("model") == "m1")
    cal, test = s.filter(c_("split") == "calibration"), s.filter(c_("split") == "test")
    return _round(calib.isotonic(cal, test).select("row_id", "p", "p_calibrated"))


@register("model_roundtrip")
def q_roundtrip(fx):
    """Save the fitted pipeline to the shared folder, load it, score."""
    tr, te = _train_test(fx)
    m = mdl.fit_classifier(tr, ML_FEATURES, mdl.classifier_zoo()["logistic"])
    loaded = mdl.save_and_load(m, scratch_path(fx.spark, f"model_{uuid.uuid4().hex}"))
    a = mdl.score(m, te, ["ticker", "trading_date"]).withColumnRenamed("p", "p_fit")
    b = mdl.score(loaded, te, ["ticker", "trading_date"]).withColumnRenamed("p", "p_loaded").drop("pred")
    return _round(a.join(b, ["ticker", "trading_date"]).select("ticker", "trading_date", "p_fit", "p_loaded"))


@register("training_record", f"""
WITH d AS (SELECT DISTINCT ticker, trading_date, split, y_return FROM o_scored WHERE model = 'm1'),
r AS (SELECT split, MIN(trading_date) AS a, MAX(trading_date) AS b, COUNT(*) AS n,
             COUNT_IF(split <> 'test' AND ABS(y_return) < 1) AS dropped FROM d WHERE split IS NOT NULL GROUP BY split),
f AS (SELECT model, COUNT(*) AS n, SUM(y) AS n_up, AVG(CAST(y = pred AS INT)) AS acc,
  CASE WHEN SUM(pred) + SUM(y) > 0 THEN 2e0 * SUM(y * pred) / (SUM(pred) + SUM(y)) ELSE 0e0 END AS up,
  CASE WHEN SUM(1 - pred) + SUM(1 - y) > 0 THEN 2e0 * SUM((1 - y) * (1 - pred)) / (SUM(1 - pred) + SUM(1 - y)) ELSE 0e0 END AS down
  FROM o_scored WHERE split = 'test' GROUP BY model),
w AS (SELECT model, acc, (up * n_up + down * (n - n_up)) / n AS f1 FROM f),
b AS (SELECT model FROM w ORDER BY FLOOR(f1 * 1e9 + 0.5) DESC, model LIMIT 1)
SELECT 2 AS version, 'split' AS part, split AS name, a AS first_date, b AS last_date, n AS n_rows, dropped AS n_dropped,
       NULL AS accuracy, NULL AS f1_weighted, NULL AS is_best FROM r
UNION ALL SELECT 2, 'model', model, NULL, NULL, NULL, NULL, {r4_sql('acc')}, {r4_sql('f1')}, model = (SELECT model FROM b) FROM w""",
          ctes=("o_scored",))
def q_training_record(fx):
    """Two runs appended to a table of records; the newest one's splits and models."""
    scored = dv.scored(fx)
    results = met.classification_metrics(scored.filter(c_("split") == "test"), ["model"])
    rows = scored.filter(c_("model") == "m1").select("trading_date", "split", c_("y_return").alias("next_5d_return"))
    path = scratch_path(fx.spark, f"runs_{uuid.uuid4().hex}")
    for run in ("2001-10-01 00:00:00", "2001-11-01 00:00:00"):
        rec.append_record(rec.training_record(rows, results, ML_FEATURES, run, 1.0, 0.54, tuned={"maxDepth": 5}), path)
    newest = rec.latest_record(fx.spark, path)
    part = newest.select("version", F.lit("split").alias("part"), F.explode("splits").alias("x")).select(
        "version", "part", c_("x.split").alias("name"), "x.first_date", "x.last_date", "x.n_rows", "x.n_dropped")
    models = newest.select("version", "best_model", F.lit("model").alias("part"), F.explode("models").alias("x")).select(
        "version", "part", c_("x.model").alias("name"), "x.accuracy", "x.f1_weighted", (c_("x.model") == c_("best_model")).alias("is_best"))
    return _round(part.unionByName(models, allowMissingColumns=True))


# ----------------------------------------------- ensembles over scores (O)
@register("ensemble_vote", f"""
SELECT row_id, {r4_sql('AVG(p)')} AS p_ensemble, CAST(AVG(p) >= 5e-1 AS INT) AS pred FROM o_scored GROUP BY row_id""",
          ctes=("o_scored",))
def q_vote(fx):
    """Soft vote: mean class-1 probability over the models, per row."""
    s = dv.scored(fx).groupBy("row_id").agg(F.avg("p").alias("p_ensemble"))
    return s.select("row_id", r4("p_ensemble").alias("p_ensemble"), (c_("p_ensemble") >= 0.5).cast("int")
                    .alias("pred"))


@register("ensemble_mean", f"""
SELECT row_id, {r4_sql('AVG(pred_return)')} AS pred_return FROM o_scored GROUP BY row_id""", ctes=("o_scored",))
def q_ens_mean(fx):
    """I8: averaging ensemble of prefitted regressors' predictions."""
    return dv.scored(fx).groupBy("row_id").agg(r4(F.avg("pred_return")).alias("pred_return"))


@register("best_model", """
WITH f AS (SELECT model, CASE WHEN SUM(pred) + SUM(c) > 0 THEN 2e0 * SUM(c * pred) / (SUM(pred) + SUM(c)) ELSE 0e0 END AS f1_up,
             CASE WHEN SUM(1 - pred) + SUM(1 - c) > 0
                  THEN 2e0 * SUM((1 - c) * (1 - pred)) / (SUM(1 - pred) + SUM(1 - c)) ELSE 0e0 END AS f1_down,
             SUM(c) AS n_up, COUNT(*) AS n FROM (SELECT model, y AS c, pred FROM o_scored WHERE split = 'test') q
      GROUP BY model)
SELECT model AS best_model FROM f
ORDER BY FLOOR((f1_up * n_up + f1_down * (n - n_up)) / n * 1e9 + 0.5) DESC, model LIMIT 1""", ctes=("o_scored",))
def q_best(fx):
    """The model with the best weighted F1 on the test rows; equal ones by name."""
    m = met.classification_metrics(dv.scored(fx).filter(c_("split") == "test"), ["model"])
    score = F.floor(c_("f1_weighted") * 1e9 + 0.5)
    best = m.orderBy(score.desc(), "model").limit(1)
    return best.select(c_("model").alias("best_model"))
