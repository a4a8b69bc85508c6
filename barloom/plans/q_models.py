"""Catalogue entries for 2.6 (splits, folds, weights), 2.9 (thresholds) and
2.10 (metrics). Inputs: the label/split fixture, the scored fixture (FIXTURES
11) and the outcomes fixture (FIXTURES 10)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.functions.columns import r4, r4_sql
from barloom.operators import labels as lab
from barloom.operators import metrics as met
from barloom.operators import outcomes as out
from barloom.operators import signals as sig
from barloom.operators import thresholds as thr
from barloom.plans import derived as dv
from barloom.plans.catalog import register

c_ = F.col


def _round_doubles(df):
    return df.select(*[r4(f.name).alias(f.name) if f.dataType.typeName() == "double" else c_(f.name)
                       for f in df.schema.fields])


def _split_labels(fx):
    return lab.split_purged(dv.bar_labels(fx))


def _test(fx):
    return dv.scored(fx).filter(c_("split") == "test")


# ------------------------------------------------------------------ 2.6
@register("split_purged", "SELECT ticker, trading_date, split FROM o_split", ctes=("o_split",))
def q_split(fx):
    return _split_labels(fx).select("ticker", "trading_date", "split")


@register("dead_zone", """
SELECT ticker, trading_date, split FROM o_split
WHERE NOT (split IN ('train', 'calibration') AND ABS(next_5d_return) < 1e0) OR split IS NULL""", ctes=("o_split",))
def q_dead_zone(fx):
    return lab.dead_zone(_split_labels(fx)).select("ticker", "trading_date", "split")


@register("exact_row_index", """
SELECT ticker, trading_date, CAST(ROW_NUMBER() OVER (ORDER BY trading_date, ticker) - 1 AS BIGINT) AS row_idx
FROM bars""", ctes=("bars",))
def q_row_index(fx):
    return lab.global_order(fx.bars.select("ticker", "trading_date"), "row_idx")


@register("sample_weights", f"""
WITH t AS (SELECT * FROM o_split WHERE split = 'train' AND ABS(next_5d_return) >= 1e0),
o AS (SELECT t.*, ROW_NUMBER() OVER (ORDER BY trading_date, ticker) - 1 AS pos, COUNT(*) OVER () AS n FROM t),
c AS (SELECT direction_5d, COUNT(*) AS n_c FROM t GROUP BY direction_5d),
k AS (SELECT COUNT(*) AS k FROM c),
w AS (SELECT o.ticker, o.trading_date,
             (o.n / (k.k * c.n_c)) * (CASE WHEN o.direction_5d = 'Down' THEN 1.3e0 ELSE 1e0 END)
             * EXP(1.2e0 * (o.pos / o.n - 1)) AS raw
      FROM o JOIN c ON c.direction_5d = o.direction_5d CROSS JOIN k)
SELECT ticker, trading_date, {r4_sql('raw / AVG(raw) OVER ()')} AS sample_weight FROM w""", ctes=("o_split",))
def q_sample_weights(fx):
    train = lab.dead_zone(_split_labels(fx)).filter(c_("split") == "train")
    w = lab.sample_weights(train)
    return w.select("ticker", "trading_date", r4("sample_weight").alias("sample_weight"))


@register("split_temporal", """
SELECT ticker, trading_date,
       CASE WHEN ROW_NUMBER() OVER (ORDER BY trading_date, ticker) - 1 < FLOOR(8e-1 * COUNT(*) OVER ())
            THEN 'train' ELSE 'test' END AS split
FROM o_labels""", ctes=("o_labels",))
def q_split_temporal(fx):
    return lab.split_temporal(dv.bar_labels(fx)).select("ticker", "trading_date", "split")


@register("split_random", """
SELECT ticker, trading_date, direction_5d, CASE WHEN
  ROW_NUMBER() OVER (PARTITION BY direction_5d ORDER BY md5('42|' || ticker || '|' || CAST(trading_date AS VARCHAR)))
  <= (COUNT(*) OVER (PARTITION BY direction_5d) * 20 + 50) // 100 THEN 'test' ELSE 'train' END AS split
FROM o_labels""", ctes=("o_labels",))
def q_split_random(fx):
    return lab.split_stratified(dv.bar_labels(fx), "direction_5d").select("ticker", "trading_date", "direction_5d", "split")


@register("label_clip", f"""
SELECT ticker, trading_date, {r4_sql('LEAST(GREATEST(next_5d_return, -1e1), 1e1)')} AS next_5d_return_clipped
FROM o_labels""", ctes=("o_labels",))
def q_label_clip(fx):
    return lab.label_clip(dv.bar_labels(fx)).select(
        "ticker", "trading_date", r4("next_5d_return_clipped").alias("next_5d_return_clipped"))


@register("split_summary", """
SELECT split, MIN(trading_date) AS first_date, MAX(trading_date) AS last_date, CAST(COUNT(*) AS BIGINT) AS n_rows,
       CAST(COUNT_IF(direction_5d = 'Up') AS BIGINT) AS n_up, CAST(COUNT_IF(direction_5d = 'Down') AS BIGINT) AS n_down,
       CAST(COUNT(DISTINCT trading_date) AS BIGINT) AS n_dates
FROM o_split WHERE split IS NOT NULL GROUP BY split""", ctes=("o_split",))
def q_split_summary(fx):
    return lab.split_summary(_split_labels(fx))


@register("cv_folds", """
WITH o AS (SELECT trading_date, ROW_NUMBER() OVER (ORDER BY trading_date, ticker) - 1 AS pos,
                  COUNT(*) OVER () AS n FROM o_labels),
p AS (SELECT MAX(n) AS n, GREATEST(50, MAX(n) // 7) AS mt FROM o),
q AS (SELECT range AS fold, p.n, p.mt, GREATEST(20, (p.n - p.mt) // 5) AS fs FROM range(5), p),
f AS (SELECT fold, n, mt + fold * fs AS train_end, mt + fold * fs + 5 AS val_start,
             LEAST(mt + fold * fs + 5 + fs, n) AS val_end FROM q),
g AS (SELECT * FROM f WHERE NOT (val_start >= n OR val_end <= val_start)),
r AS (SELECT CAST(g.fold AS INT) AS fold,
             CASE WHEN o.pos < g.train_end THEN 'train' WHEN o.pos >= g.val_start THEN 'validation' END AS role,
             o.trading_date
      FROM o JOIN g ON o.pos < g.val_end)
SELECT fold, role, CAST(COUNT(*) AS BIGINT) AS n, MIN(trading_date) AS first_date, MAX(trading_date) AS last_date
FROM r WHERE role IS NOT NULL GROUP BY fold, role""", ctes=("o_labels",))
def q_cv_folds(fx):
    f = lab.cv_folds(dv.bar_labels(fx))
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                         F.min("trading_date").alias("first_date"),
                                         F.max("trading_date").alias("last_date"))


@register("walkforward_folds", """
WITH d AS (SELECT DISTINCT trading_date FROM o_labels),
i AS (SELECT trading_date, ROW_NUMBER() OVER (ORDER BY trading_date) - 1 AS idx, COUNT(*) OVER () AS n FROM d),
p AS (SELECT range AS fold, m.n - (5 - range) * 21 AS e FROM range(6), (SELECT MAX(n) AS n FROM i) m),
q AS (SELECT fold, e - 21 AS te_lo, e AS te_hi, GREATEST(e - 26, 0) AS pool,
             GREATEST(CAST(FLOOR(15e-2 * GREATEST(e - 26, 0)) AS BIGINT), 10) AS cal_n FROM p),
r AS (SELECT CAST(q.fold AS INT) AS fold, i.trading_date,
             CASE WHEN i.idx < GREATEST(q.pool - (q.cal_n + 5), 0) THEN 'train'
                  WHEN i.idx >= GREATEST(q.pool - q.cal_n, 0) AND i.idx < q.pool THEN 'calibration'
                  WHEN i.idx >= q.te_lo THEN 'test' END AS role
      FROM i JOIN q ON i.idx < q.te_hi)
SELECT fold, role, CAST(COUNT(*) AS BIGINT) AS n_dates, MIN(trading_date) AS first_date, MAX(trading_date) AS last_date
FROM r WHERE role IS NOT NULL GROUP BY fold, role""", ctes=("o_labels",))
def q_walkforward(fx):
    f = lab.walkforward_folds(dv.bar_labels(fx))
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).cast("bigint").alias("n_dates"),
                                         F.min("trading_date").alias("first_date"),
                                         F.max("trading_date").alias("last_date"))


# ------------------------------------------------------------------ 2.10
_TEST = "(SELECT * FROM o_scored WHERE split = 'test')"


def _k1_sql(src: str, extra_where: str = "") -> str:
    return f"""
WITH g AS (
  SELECT model, COUNT(*) AS n, COUNT_IF(y = 1 AND pred = 1) AS tp, COUNT_IF(y = 0 AND pred = 1) AS fp,
         COUNT_IF(y = 1 AND pred = 0) AS fn, COUNT_IF(y = 0 AND pred = 0) AS tn
  FROM {src} s {extra_where} GROUP BY model),
m AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END AS p1,
            CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END AS r1,
            CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0e0 END AS p0,
            CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0e0 END AS r0 FROM g),
f AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0e0 END AS f1,
                CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0e0 END AS f0 FROM m)
SELECT model, CAST(n AS BIGINT) AS n, {r4_sql('(tp + tn) / n')} AS accuracy,
       {r4_sql('(p1 * (tp + fn) + p0 * (tn + fp)) / n')} AS precision_weighted,
       {r4_sql('(r1 * (tp + fn) + r0 * (tn + fp)) / n')} AS recall_weighted,
       {r4_sql('(f1 * (tp + fn) + f0 * (tn + fp)) / n')} AS f1_weighted
FROM f"""


@register("metrics_classification", _k1_sql(_TEST), ctes=("o_scored",))
def q_k1(fx):
    return _round_doubles(met.classification_metrics(_test(fx), ["model"]))


@register("metrics_ex_deadzone", f"""
SELECT model, CAST(COUNT(*) AS BIGINT) AS n, {r4_sql('AVG(CAST(y = pred AS DOUBLE))')} AS accuracy
FROM {_TEST} s WHERE ABS(y_return) >= 1e0 GROUP BY model""", ctes=("o_scored",))
def q_k2(fx):
    t = _test(fx).filter(F.abs("y_return") >= 1.0)
    return _round_doubles(t.groupBy("model").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                                 F.avg((c_("y") == c_("pred")).cast("double")).alias("accuracy")))


@register("metrics_regression", f"""
SELECT model, CAST(COUNT(*) AS BIGINT) AS n, {r4_sql('AVG(ABS(pred_return - y_return))')} AS mae,
       {r4_sql('AVG((pred_return - y_return) * (pred_return - y_return))')} AS mse,
       {r4_sql('SQRT(AVG((pred_return - y_return) * (pred_return - y_return)))')} AS rmse,
       {r4_sql('1 - SUM((pred_return - y_return) * (pred_return - y_return)) / (COUNT(*) * VAR_POP(y_return))')} AS r2,
       {r4_sql('AVG(CAST((pred_return > 0) = (y_return > 0) AS DOUBLE))')} AS direction_accuracy
FROM {_TEST} s GROUP BY model""", ctes=("o_scored",))
def q_k3(fx):
    return _round_doubles(met.regression_metrics(_test(fx), ["model"]))


@register("metrics_auc", f"""
WITH r AS (SELECT model, y, RANK() OVER (PARTITION BY model ORDER BY p) AS rk,
                  COUNT(*) OVER (PARTITION BY model, p) AS ties FROM {_TEST} s),
a AS (SELECT model, SUM(CASE WHEN y = 1 THEN rk + (ties - 1) / 2e0 END) AS rank_pos, SUM(y) AS n_pos,
             COUNT(*) AS n FROM r GROUP BY model)
SELECT model, {r4_sql('(rank_pos - n_pos * (n_pos + 1) / 2e0) / (n_pos * (n - n_pos))')} AS auc FROM a""",
          ctes=("o_scored",))
def q_k4(fx):
    return _round_doubles(met.auc(_test(fx), ["model"]))


@register("roc_points", f"""
WITH g AS (SELECT model, p, SUM(y) AS pos, COUNT(*) AS cnt FROM {_TEST} s GROUP BY model, p)
SELECT model, {r4_sql('p')} AS threshold,
       {r4_sql('SUM(cnt - pos) OVER (PARTITION BY model ORDER BY p DESC) / SUM(cnt - pos) OVER (PARTITION BY model)')}
         AS fpr,
       {r4_sql('SUM(pos) OVER (PARTITION BY model ORDER BY p DESC) / SUM(pos) OVER (PARTITION BY model)')} AS tpr
FROM g""", ctes=("o_scored",))
def q_k5(fx):
    return _round_doubles(met.roc_points(_test(fx), ["model"]))


@register("confusion_matrix", f"""
SELECT model, y AS actual, CAST(COUNT_IF(pred = 0) AS BIGINT) AS pred_0, CAST(COUNT_IF(pred = 1) AS BIGINT) AS pred_1
FROM {_TEST} s GROUP BY model, y""", ctes=("o_scored",))
def q_k6(fx):
    cm = met.confusion_matrix(_test(fx), ["model"])
    return cm.select("model", "actual", c_("pred_0").cast("bigint").alias("pred_0"),
                     c_("pred_1").cast("bigint").alias("pred_1"))


@register("class_report", f"""
WITH g AS (SELECT model, COUNT_IF(y = 1 AND pred = 1) AS tp, COUNT_IF(y = 0 AND pred = 1) AS fp,
                  COUNT_IF(y = 1 AND pred = 0) AS fn, COUNT_IF(y = 0 AND pred = 0) AS tn
           FROM {_TEST} s GROUP BY model),
c AS (
  SELECT model, '0' AS label, tn AS tp_, fn AS fp_, fp AS fn_ FROM g
  UNION ALL SELECT model, '1', tp, fp, fn FROM g),
m AS (SELECT model, label, CASE WHEN tp_ + fp_ > 0 THEN tp_ / (tp_ + fp_) ELSE 0e0 END AS precision,
             CASE WHEN tp_ + fn_ > 0 THEN tp_ / (tp_ + fn_) ELSE 0e0 END AS recall,
             CAST(tp_ + fn_ AS BIGINT) AS support FROM c),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0e0 END
             AS f1 FROM m),
a AS (
  SELECT * FROM f
  UNION ALL SELECT model, 'macro avg', AVG(precision), AVG(recall), CAST(SUM(support) AS BIGINT), AVG(f1)
  FROM f GROUP BY model
  UNION ALL SELECT model, 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
         CAST(SUM(support) AS BIGINT), SUM(f1 * support) / SUM(support) FROM f GROUP BY model)
SELECT model, label, {r4_sql('precision')} AS precision, {r4_sql('recall')} AS recall, {r4_sql('f1')} AS f1, support
FROM a""", ctes=("o_scored",))
def q_k7(fx):
    return _round_doubles(met.class_report(_test(fx), ["model"]))


_BAND_SQL = ("CASE WHEN confidence < 55e-2 THEN '<55%' WHEN confidence < 6e-1 THEN '55-60%' "
             "WHEN confidence < 67e-2 THEN '60-67%' ELSE '>=67%' END")


@register("accuracy_by_band", f"""
SELECT {_BAND_SQL} AS band, CAST(COUNT(*) AS BIGINT) AS n, {r4_sql('AVG(CAST(correct AS DOUBLE))')} AS accuracy
FROM o_outcomes WHERE is_actionable GROUP BY 1""", ctes=("o_outcomes",))
def q_k8(fx):
    o = dv.outcomes(fx).filter("is_actionable")
    return _round_doubles(met.accuracy_by_band(o, []))


@register("accuracy_by_side", f"""
SELECT {dv.CLASSIFY_SQL.format(s='predicted_signal')} AS side, CAST(COUNT(*) AS BIGINT) AS n,
       {r4_sql('AVG(CAST(correct AS DOUBLE))')} AS accuracy
FROM o_outcomes WHERE is_actionable GROUP BY 1""", ctes=("o_outcomes",))
def q_k9(fx):
    o = dv.outcomes(fx).filter("is_actionable")
    g = o.groupBy(out.classify_signal("predicted_signal").alias("side")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.avg(c_("correct").cast("double")).alias("accuracy"))
    return _round_doubles(g)


@register("sell_band_accuracy", f"""
WITH s AS (SELECT model, 1e0 - p AS sp, y, pred FROM {_TEST} t),
b AS (SELECT model, CASE WHEN sp >= 5e-1 AND sp < 55e-2 THEN '50-55%' WHEN sp >= 55e-2 AND sp < 6e-1 THEN '55-60%'
                         WHEN sp >= 6e-1 AND sp < 7e-1 THEN '60-70%' WHEN sp >= 7e-1 AND sp < 1.01e0 THEN '70-100%' END
                    AS band, CAST(y = 0 AND pred = 0 AS DOUBLE) AS ok FROM s)
SELECT model, band, CAST(COUNT(*) AS BIGINT) AS n, {r4_sql('AVG(ok)')} AS sell_accuracy
FROM b WHERE band IS NOT NULL GROUP BY model, band HAVING COUNT(*) > 10""", ctes=("o_scored",))
def q_k10(fx):
    t = _test(fx).withColumn("sp", 1 - c_("p"))
    band = F.lit(None).cast("string")
    for lo, hi, name in reversed([(0.50, 0.55, "50-55%"), (0.55, 0.60, "55-60%"), (0.60, 0.70, "60-70%"),
                                  (0.70, 1.01, "70-100%")]):
        band = F.when((c_("sp") >= lo) & (c_("sp") < hi), F.lit(name)).otherwise(band)
    g = t.withColumn("band", band).filter(c_("band").isNotNull()).groupBy("model", "band").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.avg(((c_("y") == 0) & (c_("pred") == 0)).cast("double")).alias("sell_accuracy"))
    return _round_doubles(g.filter(c_("n") > 10))


@register("high_low_accuracy", f"""
SELECT model, GREATEST(p, 1e0 - p) >= 65e-2 AS high_confidence, CAST(COUNT(*) AS BIGINT) AS n,
       {r4_sql('AVG(CAST(y = pred AS DOUBLE))')} AS accuracy
FROM {_TEST} s GROUP BY 1, 2""", ctes=("o_scored",))
def q_k11(fx):
    t = _test(fx)
    g = t.groupBy("model", (F.greatest(c_("p"), 1 - c_("p")) >= 0.65).alias("high_confidence")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.avg((c_("y") == c_("pred")).cast("double")).alias("accuracy"))
    return _round_doubles(g)


@register("model_comparison", f"""
SELECT model, accuracy, f1_weighted, CAST(RANK() OVER (ORDER BY f1_weighted DESC) AS INT) AS f1_rank
FROM ({_k1_sql(_TEST)}) k""", ctes=("o_scored",))
def q_k12(fx):
    k = _round_doubles(met.classification_metrics(_test(fx), ["model"]))
    return k.select("model", "accuracy", "f1_weighted",
                    F.rank().over(Window.orderBy(c_("f1_weighted").desc())).alias("f1_rank"))


@register("signal_capture", f"""
SELECT model, CAST(COUNT_IF(y = 1) AS BIGINT) AS actual_buy, CAST(COUNT_IF(pred = 1) AS BIGINT) AS predicted_buy,
       CAST(COUNT_IF(y = 1 AND pred = 1) AS BIGINT) AS correct_buy, CAST(COUNT_IF(y = 0) AS BIGINT) AS actual_sell,
       CAST(COUNT_IF(pred = 0) AS BIGINT) AS predicted_sell, CAST(COUNT_IF(y = 0 AND pred = 0) AS BIGINT) AS correct_sell
FROM {_TEST} s GROUP BY model""", ctes=("o_scored",))
def q_k13(fx):
    t = _test(fx)
    return t.groupBy("model").agg(
        F.count_if(c_("y") == 1).cast("bigint").alias("actual_buy"),
        F.count_if(c_("pred") == 1).cast("bigint").alias("predicted_buy"),
        F.count_if((c_("y") == 1) & (c_("pred") == 1)).cast("bigint").alias("correct_buy"),
        F.count_if(c_("y") == 0).cast("bigint").alias("actual_sell"),
        F.count_if(c_("pred") == 0).cast("bigint").alias("predicted_sell"),
        F.count_if((c_("y") == 0) & (c_("pred") == 0)).cast("bigint").alias("correct_sell"))


@register("confidence_tiers", f"""
WITH s AS (SELECT model, GREATEST(p, 1e0 - p) AS confidence, CAST(y = pred AS INT) AS correct FROM {_TEST} t)
SELECT model, {r4_sql('AVG(CAST(confidence >= 7e-1 AS DOUBLE))')} AS high_share,
       {r4_sql('AVG(CAST(confidence >= 6e-1 AND confidence < 7e-1 AS DOUBLE))')} AS medium_share,
       {r4_sql('AVG(CAST(confidence < 6e-1 AS DOUBLE))')} AS low_share,
       {r4_sql('AVG(CASE WHEN confidence >= 7e-1 THEN CAST(correct AS DOUBLE) END)')} AS high_accuracy
FROM s GROUP BY model""", ctes=("o_scored",))
def q_k14(fx):
    t = _test(fx).select("model", F.greatest(c_("p"), 1 - c_("p")).alias("confidence"),
                         (c_("y") == c_("pred")).cast("int").alias("correct"))
    return _round_doubles(met.confidence_tiers(t, ["model"]))


@register("weekly_accuracy", f"""
WITH w AS (SELECT model, CAST(WEEKOFYEAR(trading_date) AS INT) AS week, AVG(CAST(y = pred AS DOUBLE)) AS acc
           FROM {_TEST} s GROUP BY model, 2)
SELECT model, CAST(COUNT(*) AS BIGINT) AS n_weeks, {r4_sql('AVG(acc)')} AS mean_weekly,
       {r4_sql('STDDEV_SAMP(acc)')} AS sd_weekly, {r4_sql('MIN(acc)')} AS min_weekly, {r4_sql('MAX(acc)')} AS max_weekly
FROM w GROUP BY model""", ctes=("o_scored",))
def q_k15(fx):
    w = _test(fx).groupBy("model", F.weekofyear("trading_date").alias("week")).agg(
        F.avg((c_("y") == c_("pred")).cast("double")).alias("acc"))
    g = w.groupBy("model").agg(F.count(F.lit(1)).cast("bigint").alias("n_weeks"), F.avg("acc").alias("mean_weekly"),
                               F.stddev_samp("acc").alias("sd_weekly"), F.min("acc").alias("min_weekly"),
                               F.max("acc").alias("max_weekly"))
    return _round_doubles(g)


@register("fold_summary", f"""
WITH d AS (SELECT DISTINCT trading_date FROM o_labels),
i AS (SELECT trading_date, ROW_NUMBER() OVER (ORDER BY trading_date) - 1 AS idx, COUNT(*) OVER () AS n FROM d),
p AS (SELECT range AS fold, m.n - (5 - range) * 21 AS e FROM range(6), (SELECT MAX(n) AS n FROM i) m),
t AS (SELECT p.fold, i.trading_date FROM i JOIN p ON i.idx >= p.e - 21 AND i.idx < p.e),
a AS (SELECT s.model, t.fold, AVG(CAST(s.y = s.pred AS DOUBLE)) AS acc
      FROM o_scored s JOIN t ON t.trading_date = s.trading_date GROUP BY s.model, t.fold)
SELECT model, CAST(COUNT(*) AS BIGINT) AS n_folds, {r4_sql('AVG(acc)')} AS mean_accuracy,
       {r4_sql('STDDEV_POP(acc)')} AS sd_accuracy FROM a GROUP BY model""", ctes=("o_labels", "o_scored"))
def q_k16(fx):
    folds = lab.walkforward_folds(dv.bar_labels(fx)).filter(c_("role") == "test")
    j = dv.scored(fx).join(F.broadcast(folds.select("fold", "trading_date")), "trading_date")
    a = j.groupBy("model", "fold").agg(F.avg((c_("y") == c_("pred")).cast("double")).alias("acc"))
    g = a.groupBy("model").agg(F.count(F.lit(1)).cast("bigint").alias("n_folds"),
                               F.avg("acc").alias("mean_accuracy"), F.stddev_pop("acc").alias("sd_accuracy"))
    return _round_doubles(g)


@register("improvement_rate", f"""
WITH k AS (
  SELECT split, model, AVG(CAST(y = pred AS DOUBLE)) AS acc FROM o_scored WHERE split IS NOT NULL
  GROUP BY split, model),
c AS (SELECT b.split, b.acc AS base_acc, e.acc AS new_acc, (e.acc - b.acc) / b.acc * 100 AS improvement_pct
      FROM k b JOIN k e ON e.split = b.split AND b.model = 'm1' AND e.model = 'm3')
SELECT split, {r4_sql('base_acc')} AS base_acc, {r4_sql('new_acc')} AS new_acc,
       {r4_sql('improvement_pct')} AS improvement_pct,
       {r4_sql('AVG(CAST(improvement_pct > 0 AS DOUBLE)) OVER ()')} AS improvement_rate
FROM c""", ctes=("o_scored",))
def q_k17(fx):
    k = dv.scored(fx).filter(c_("split").isNotNull()).groupBy("split").agg(
        F.avg(F.when(c_("model") == "m1", (c_("y") == c_("pred")).cast("double"))).alias("base_acc"),
        F.avg(F.when(c_("model") == "m3", (c_("y") == c_("pred")).cast("double"))).alias("new_acc"))
    k = k.withColumn("improvement_pct", (c_("new_acc") - c_("base_acc")) / c_("base_acc") * 100)
    k = k.withColumn("improvement_rate",
                     F.avg((c_("improvement_pct") > 0).cast("double")).over(Window.partitionBy()))
    return _round_doubles(k)


@register("run_delta", f"""
WITH r AS (SELECT run_timestamp, COUNT(*) AS total, COUNT_IF(predicted_signal = 'Buy') AS buys,
                  AVG(confidence) AS avg_conf FROM o_export GROUP BY run_timestamp)
SELECT run_timestamp, CAST(total - LAG(total) OVER (ORDER BY run_timestamp) AS BIGINT) AS total_change,
       CAST(buys - LAG(buys) OVER (ORDER BY run_timestamp) AS BIGINT) AS buy_change,
       {r4_sql('avg_conf - LAG(avg_conf) OVER (ORDER BY run_timestamp)')} AS avg_confidence_change
FROM r""", ctes=("o_export",))
def q_k18(fx):
    """Run-over-run change on the run history (one row per run: a bounded series)."""
    rows = sig.export_predictions(dv.signals(fx))
    r = rows.groupBy("run_timestamp").agg(F.count(F.lit(1)).alias("total"),
                                          F.count_if(c_("predicted_signal") == "Buy").alias("buys"),
                                          F.avg("confidence").alias("avg_conf"))
    w = Window.orderBy("run_timestamp")
    return r.select("run_timestamp", (c_("total") - F.lag("total").over(w)).cast("bigint").alias("total_change"),
                    (c_("buys") - F.lag("buys").over(w)).cast("bigint").alias("buy_change"),
                    r4(c_("avg_conf") - F.lag("avg_conf").over(w)).alias("avg_confidence_change"))


# ------------------------------------------------------------------ 2.9
@register("log_odds", f"""
SELECT row_id, model, {r4_sql('LN(LEAST(GREATEST(p, 1e-6), 1e0 - 1e-6) / (1e0 - LEAST(GREATEST(p, 1e-6), 1e0 - 1e-6)))')}
  AS log_odds FROM o_scored""", ctes=("o_scored",))
def q_log_odds(fx):
    s = dv.scored(fx)
    return s.select("row_id", "model", r4(thr.log_odds(c_("p"))).alias("log_odds"))


@register("tune_threshold", f"""
WITH cal AS (SELECT model, p, y FROM o_scored WHERE split = 'calibration'),
g AS (SELECT CAST(300 + 5 * range AS DOUBLE) / 1e3 AS thr FROM range(82)),
s AS (SELECT model, thr, COUNT_IF(p >= thr AND y = 1) AS tp, COUNT_IF(p < thr AND y = 1) AS fn,
             COUNT_IF(p < thr AND y = 0) AS tn, COUNT_IF(p >= thr AND y = 0) AS fp
      FROM cal CROSS JOIN g GROUP BY model, thr),
b AS (SELECT model, thr, ((CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END)
                          + (CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0e0 END)) / 2e0 AS bal FROM s),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY bal DESC, thr ASC) AS rn FROM b)
SELECT model, {r4_sql('thr')} AS threshold, {r4_sql('bal')} AS balanced_accuracy FROM r WHERE rn = 1""",
          ctes=("o_scored",))
def q_tune(fx):
    cal = dv.scored(fx).filter(c_("split") == "calibration")
    return _round_doubles(thr.tune_threshold(cal, ["model"]))


def _cutoff_sql(side: str, cmp: str, pick: str, targets: list[float], min_n: int) -> str:
    return f"""
WITH o AS (SELECT confidence, CAST(correct AS DOUBLE) AS correct FROM o_outcomes
           WHERE {dv.CLASSIFY_SQL.format(s='predicted_signal')} = '{side}'),
c AS (SELECT DISTINCT CAST(FLOOR(confidence * 1e4 + 0.501) AS BIGINT) AS ck FROM o),
s AS (SELECT ck, COUNT(*) AS n, AVG(correct) AS acc FROM c JOIN o ON o.confidence {cmp} CAST(ck AS DOUBLE) / 1e4
      GROUP BY ck),
t AS (SELECT * FROM (VALUES {', '.join(f'({x!r}e0)' for x in targets)}) v(target))
SELECT target, CAST({pick}(ck) AS DOUBLE) / 1e4 AS cutoff FROM t, s WHERE s.n >= {min_n} AND s.acc >= t.target
GROUP BY target"""


# reference targets .53 / .58 plus lower ones that the fixture's buys reach
_TARGETS = (0.40, 0.45, 0.53, 0.58)


@register("cutoff_lowest", _cutoff_sql("bullish", ">=", "MIN", list(_TARGETS), 200), ctes=("o_outcomes",))
def q_cutoff_lowest(fx):
    buys = dv.outcomes(fx).filter(out.classify_signal("predicted_signal") == "bullish")
    parts = [thr.cutoff_lowest(buys, [], t, 200).select(F.lit(t).alias("target"), "cutoff") for t in _TARGETS]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


@register("cutoff_highest", _cutoff_sql("bearish", "<=", "MAX", [0.50], 200), ctes=("o_outcomes",))
def q_cutoff_highest(fx):
    sells = dv.outcomes(fx).filter(out.classify_signal("predicted_signal") == "bearish")
    return thr.cutoff_highest(sells, [], 0.50, 200).select(F.lit(0.50).alias("target"), "cutoff")


def _j4_sql(src: str, target: str, min_n: int, cmp: str = ">=", pick: str = "MIN", group: str = "") -> str:
    g_sel = f"{group}, " if group else ""
    g_on = f" AND r.{group} = c.{group}" if group else ""
    return f"""(SELECT {g_sel}CAST({pick}(ck) AS DOUBLE) / 1e4 AS cutoff FROM (
      SELECT {'c.' + group + ', ' if group else ''}c.ck, COUNT(*) AS n, AVG(CAST(r.correct AS DOUBLE)) AS acc
      FROM (SELECT DISTINCT {g_sel}CAST(FLOOR(confidence * 1e4 + 0.501) AS BIGINT) AS ck FROM {src}) c
      JOIN {src} r ON r.confidence {cmp} CAST(c.ck AS DOUBLE) / 1e4{g_on}
      GROUP BY {'c.' + group + ', ' if group else ''}c.ck) q
    WHERE n >= {min_n} AND acc >= {target}{' GROUP BY ' + group if group else ''})"""


@register("derive_thresholds", f"""
WITH o AS (
  SELECT o.confidence, o.correct, s.sector, {dv.CLASSIFY_SQL.format(s='o.predicted_signal')} AS side
  FROM o_outcomes o LEFT JOIN securities s ON s.ticker = o.ticker
  WHERE o.correct IS NOT NULL AND o.confidence IS NOT NULL),
buys AS (SELECT * FROM o WHERE side = 'bullish'),
sells AS (SELECT * FROM o WHERE side = 'bearish'),
sbuys AS (SELECT * FROM buys WHERE sector IS NOT NULL),
tot AS (SELECT COUNT(*) AS n FROM o),
bh AS {_j4_sql('buys', '53e-2', 200)},
hh AS {_j4_sql('buys', '58e-2', 200)},
sh AS {_j4_sql('sells', '5e-1', 200, '<=', 'MAX')},
g AS (SELECT CASE WHEN (SELECT n FROM tot) >= 200 AND (SELECT MAX(cutoff) FROM bh) IS NOT NULL
                  THEN (SELECT MAX(cutoff) FROM bh) ELSE 55e-2 END AS gate),
sec_n AS (SELECT sector, COUNT(*) AS sn FROM sbuys GROUP BY sector),
sec AS (SELECT x.sector, x.cutoff FROM {_j4_sql('sbuys', '53e-2', 150, group='sector')} x
        JOIN sec_n USING (sector) WHERE sn >= 150 AND (SELECT n FROM tot) >= 200
          AND x.cutoff > (SELECT gate FROM g)),
rows_ AS (
  SELECT 'buy_min_confidence' AS name, CAST(NULL AS VARCHAR) AS key, (SELECT gate FROM g) AS value
  UNION ALL SELECT 'high_confidence_threshold', NULL,
    CASE WHEN (SELECT n FROM tot) >= 200 AND (SELECT MAX(cutoff) FROM hh) IS NOT NULL
         THEN GREATEST((SELECT MAX(cutoff) FROM hh), (SELECT gate FROM g))
         WHEN (SELECT n FROM tot) >= 200 THEN GREATEST(58e-2, (SELECT gate FROM g)) ELSE 58e-2 END
  UNION ALL SELECT 'sell_max_confidence', NULL,
    CASE WHEN (SELECT n FROM tot) >= 200 AND (SELECT MAX(cutoff) FROM sh) IS NOT NULL
         THEN (SELECT MAX(cutoff) FROM sh) ELSE 99e-2 END
  UNION ALL SELECT 'actionable_buy_fraction', NULL,
    (SELECT AVG(CAST(confidence >= (SELECT gate FROM g) AS DOUBLE)) FROM buys)
  UNION ALL SELECT 'n_outcomes', NULL, CAST((SELECT n FROM tot) AS DOUBLE)
  UNION ALL SELECT 'guardrail_buys_stranded', NULL,
    (SELECT CAST(AVG(CAST(confidence >= (SELECT gate FROM g) AS DOUBLE)) < 1e-2 AS DOUBLE) FROM buys)
  UNION ALL SELECT 'sector_override', sector, cutoff FROM sec
  UNION ALL SELECT 'sector_override', k, v FROM (VALUES ('Technology', 57e-2), ('Healthcare', 57e-2)) f(k, v)
    WHERE NOT EXISTS (SELECT 1 FROM sec))
SELECT name, key, {r4_sql('value')} AS value FROM rows_""", ctes=("o_outcomes", "securities"))
def q_derive(fx):
    return _round_doubles(thr.derive_thresholds(dv.outcomes(fx), fx.securities))


@register("probability_profile", f"""
WITH t AS {_TEST},
q AS (SELECT model, QUANTILE_CONT(p, [5e-2, 1e-1, 25e-2, 5e-1, 75e-2, 9e-1, 95e-2]) AS qs,
             QUANTILE_CONT(p, [4e-1, 45e-2, 5e-1]) AS cuts, AVG(CAST(y AS DOUBLE)) AS up FROM t GROUP BY model)
SELECT model, stat, {r4_sql('value')} AS value FROM (
  SELECT model, 'p5' AS stat, qs[1] AS value FROM q UNION ALL SELECT model, 'p10', qs[2] FROM q
  UNION ALL SELECT model, 'p25', qs[3] FROM q UNION ALL SELECT model, 'p50', qs[4] FROM q
  UNION ALL SELECT model, 'p75', qs[5] FROM q UNION ALL SELECT model, 'p90', qs[6] FROM q
  UNION ALL SELECT model, 'p95', qs[7] FROM q UNION ALL SELECT model, 'spread_p90_p10', qs[6] - qs[2] FROM q
  UNION ALL SELECT model, 'cut_for_60pct_up', cuts[1] FROM q UNION ALL SELECT model, 'cut_for_55pct_up', cuts[2] FROM q
  UNION ALL SELECT model, 'cut_for_50pct_up', cuts[3] FROM q UNION ALL SELECT model, 'up_share', up FROM q) x""",
          ctes=("o_scored",))
def q_profile(fx):
    return _round_doubles(thr.probability_profile(_test(fx), ["model"]))
