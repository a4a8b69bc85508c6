"""Evaluation metrics (2.10) as grouped aggregates over a scored table
``(model, y, pred, p, ...)``. Every metric is a partial aggregation: per-group
counters combine map-side, so no group's rows are ever collected in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.quantiles import ordered_prefix

c_ = F.col


def classification_metrics(df: DataFrame, group: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """K1: accuracy and support-weighted precision / recall / F1 (zero division
    -> 0) for a binary 0/1 target, per group."""
    g = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((c_(y) == 1) & (c_(pred) == 1)).alias("tp"),
        F.count_if((c_(y) == 0) & (c_(pred) == 1)).alias("fp"),
        F.count_if((c_(y) == 1) & (c_(pred) == 0)).alias("fn"),
        F.count_if((c_(y) == 0) & (c_(pred) == 0)).alias("tn"),
    )

    def prf(tp, fp, fn):
        p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
        r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
        f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
        return p, r, f

    p1, r1, f1 = prf(c_("tp"), c_("fp"), c_("fn"))
    p0, r0, f0 = prf(c_("tn"), c_("fn"), c_("fp"))
    s1, s0 = c_("tp") + c_("fn"), c_("tn") + c_("fp")
    n = c_("n")
    return g.select(
        *group, n.cast("bigint").alias("n"),
        ((c_("tp") + c_("tn")) / n).alias("accuracy"),
        ((p1 * s1 + p0 * s0) / n).alias("precision_weighted"),
        ((r1 * s1 + r0 * s0) / n).alias("recall_weighted"),
        ((f1 * s1 + f0 * s0) / n).alias("f1_weighted"),
    )


def class_report(df: DataFrame, group: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """K7: per-class precision / recall / F1 / support plus macro and weighted
    averages, as long rows."""
    g = df.groupBy(*group).agg(
        F.count_if((c_(y) == 1) & (c_(pred) == 1)).alias("tp"),
        F.count_if((c_(y) == 0) & (c_(pred) == 1)).alias("fp"),
        F.count_if((c_(y) == 1) & (c_(pred) == 0)).alias("fn"),
        F.count_if((c_(y) == 0) & (c_(pred) == 0)).alias("tn"))

    def rows_for(label, tp, fp, fn):
        p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
        r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
        f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
        return F.struct(F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        (tp + fn).cast("bigint").alias("support"))

    per = g.select(*group, F.array(rows_for("0", c_("tn"), c_("fn"), c_("fp")),
                                   rows_for("1", c_("tp"), c_("fp"), c_("fn"))).alias("r"))
    cls = per.select(*group, F.explode("r").alias("x")).select(*group, "x.*")
    tot = F.sum("support").over(Window.partitionBy(*group)) if group else F.sum("support").over(Window.partitionBy())
    cls = cls.withColumn("_tot", tot)
    avgs = cls.groupBy(*group).agg(
        F.struct(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                 F.sum("support").cast("bigint").alias("support")).alias("m"),
        F.struct(F.lit("weighted avg").alias("label"), (F.sum(c_("precision") * c_("support")) / F.sum("support"))
                 .alias("precision"), (F.sum(c_("recall") * c_("support")) / F.sum("support")).alias("recall"),
                 (F.sum(c_("f1") * c_("support")) / F.sum("support")).alias("f1"),
                 F.sum("support").cast("bigint").alias("support")).alias("w"))
    avg_rows = avgs.select(*group, F.explode(F.array("m", "w")).alias("x")).select(*group, "x.*")
    return cls.drop("_tot").unionByName(avg_rows)


def regression_metrics(df: DataFrame, group: list[str], y: str = "y_return", pred: str = "pred_return") -> DataFrame:
    """K3: MAE, MSE, RMSE, R2, direction accuracy (sign agreement, 0 counts as down)."""
    err = c_(pred) - c_(y)
    g = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"),
        F.sum(err * err).alias("_sse"), F.var_pop(y).alias("_vy"),
        F.avg(((c_(pred) > 0) == (c_(y) > 0)).cast("double")).alias("direction_accuracy"))
    return g.select(*group, c_("n").cast("bigint").alias("n"), "mae", "mse", F.sqrt("mse").alias("rmse"),
                    F.when(c_("_vy") > 0, 1 - c_("_sse") / (c_("n") * c_("_vy"))).alias("r2"),
                    "direction_accuracy")


def auc(df: DataFrame, group: list[str], y: str = "y", score: str = "p") -> DataFrame:
    """K4: ROC AUC by the average-rank (Mann-Whitney) formula. Ties share the
    average rank; ranks come from counts below each distinct score
    (``ordered_prefix``: no group is sorted in one task)."""
    per = df.groupBy(*group, score).agg(F.count(F.lit(1)).alias("cnt"), F.sum(c_(y)).alias("pos"))
    per = ordered_prefix(per, score, ["cnt"], group)
    per = per.withColumn("_avg_rank", c_("cnt_before") + (c_("cnt") + 1) / 2.0)
    g = per.groupBy(*group).agg(F.sum(c_("_avg_rank") * c_("pos")).alias("rank_pos"),
                                F.sum("pos").alias("n_pos"), F.sum("cnt").alias("n"))
    n_neg = c_("n") - c_("n_pos")
    return g.select(*group, F.when((c_("n_pos") > 0) & (n_neg > 0),
                                   (c_("rank_pos") - c_("n_pos") * (c_("n_pos") + 1) / 2.0) / (c_("n_pos") * n_neg))
                    .alias("auc"))


def roc_points(df: DataFrame, group: list[str], y: str = "y", score: str = "p") -> DataFrame:
    """K5: (fpr, tpr) at each distinct score threshold, highest first."""
    per = df.groupBy(*group, score).agg(F.sum(c_(y)).alias("pos"), F.count(F.lit(1)).alias("cnt"))
    per = per.withColumn("neg", c_("cnt") - c_("pos"))
    per = ordered_prefix(per, score, ["pos", "neg"], group, descending=True)
    if group:
        tot = per.groupBy(*group).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
        j, p_tot, n_tot = per.join(tot, group, "inner"), c_("_P"), c_("_N")
    else:
        j = per
        p_tot, n_tot = per.select(F.sum("pos")).scalar(), per.select(F.sum("neg")).scalar()
    return j.select(*group, c_(score).alias("threshold"),
                    ((c_("neg_before") + c_("neg")) / n_tot).alias("fpr"),
                    ((c_("pos_before") + c_("pos")) / p_tot).alias("tpr"))


def confusion_matrix(df: DataFrame, group: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """K6: counts per (actual, predicted)."""
    return df.groupBy(*group, c_(y).alias("actual")).pivot(pred, [0, 1]).count().na.fill(0) \
        .withColumnRenamed("0", "pred_0").withColumnRenamed("1", "pred_1")


def accuracy_by_band(df: DataFrame, group: list[str], conf: str = "confidence", correct: str = "correct",
                     min_n: int = 1) -> DataFrame:
    """K8: accuracy per confidence band (<55, 55-60, 60-67, >=67)."""
    c = c_(conf)
    band = (F.when(c < 0.55, F.lit("<55%")).when(c < 0.60, F.lit("55-60%")).when(c < 0.67, F.lit("60-67%"))
            .otherwise(F.lit(">=67%")))
    g = df.groupBy(*group, band.alias("band")).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                                   F.avg(c_(correct).cast("double")).alias("accuracy"))
    return g.filter(c_("n") >= min_n)


def confidence_tiers(df: DataFrame, group: list[str], conf: str = "confidence", correct: str = "correct") -> DataFrame:
    """Share of predictions per tier (>= .7 high, >= .6 medium, else low)
    and the high-tier accuracy."""
    c = c_(conf)
    return df.groupBy(*group).agg(
        F.avg((c >= 0.7).cast("double")).alias("high_share"),
        F.avg(((c >= 0.6) & (c < 0.7)).cast("double")).alias("medium_share"),
        F.avg((c < 0.6).cast("double")).alias("low_share"),
        F.avg(F.when(c >= 0.7, c_(correct).cast("double"))).alias("high_accuracy"))
