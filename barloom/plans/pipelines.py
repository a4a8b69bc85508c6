"""Composed pipelines (survey 3.1-3.4) over the operators."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.parallel import concurrently
from barloom.operators import calibration as calib
from barloom.operators import features as feat
from barloom.operators import models as mdl
from barloom.operators import signals as sig
from barloom.plans.q_features import features
from barloom.session import stored
from barloom.sources.fixtures import Fixtures


def labelled_features(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """Weekly training input: feature table (or ``columns`` of it and the label's return, unwritten) with the G1
    label and the E26 clean-up (per-ticker forward fill, then 0)."""
    fx = Fixtures(spark, sf_dir)
    frame = features(fx, *columns, "next_5d_close", "next_5d_return") if columns else features(fx)
    return cleaned(feat.direction_label(frame), ("ticker", "trading_date", "direction_5d"), looked_over=not columns)


def cleaned(frame: DataFrame, keep: tuple[str, ...], looked_over: bool = False) -> DataFrame:
    """E26 clean-up of the feature table. A written one is ``looked_over`` for columns without gaps, which then need
    no window; to make an unwritten one twice would cost more than the windows."""
    frame = frame.drop(*[c for c in feat.DROP_AFTER_FEATURES if c in frame.columns and c not in keep])
    return feat.forward_fill_clean(frame, keep, feat.columns_with_gaps(frame) if looked_over else None)


def newest_bars(fx: Fixtures, columns: tuple[str, ...] = ()) -> DataFrame:
    """Scoring input: each ticker's newest bar with cleaned features (all, or ``columns``), labelled or
    not, and the values that the rules read."""
    frame = features(fx, *columns, "close_price", "RSI", "sector") if columns else features(fx)
    raw = {"_close": "close_price", "_rsi": "RSI", "_sector": "sector"}
    # the values as they are go along through the clean-up, so that the features are made in one pass
    full = cleaned(frame.select("*", *[F.col(c).alias(k) for k, c in raw.items()]), ("ticker", "trading_date", *raw), looked_over=not columns)
    rest = [c for c in full.columns if c != "ticker"]
    newest = full.groupBy("ticker").agg(F.max_by(F.struct(*rest), "trading_date").alias("r"))
    return newest.select("ticker", "r.*")


def daily_scoring(fx: Fixtures, model_path: str, thresholds: dict, columns: tuple[str, ...] = ()) -> DataFrame:
    """The daily run: load a saved model, score each ticker's newest bar, decide and apply the
    reliability rules under a threshold document (A4)."""
    model = PipelineModel.load(model_path)
    scored = mdl.p_up(model.transform(newest_bars(fx, columns))).select(
        "ticker", "trading_date", F.col("p").alias("up_probability"), F.col("_close").alias("close_price"),
        F.col("_rsi").alias("RSI"), F.col("_sector").alias("sector"))
    cfg = sig.SignalConfig(
        min_stock_price=thresholds.get("min_stock_price", sig.SignalConfig.min_stock_price),
        buy_min_confidence=thresholds["buy_min_confidence"], high_confidence=thresholds["high_confidence_threshold"],
        sell_max_confidence=thresholds["sell_max_confidence"], sector_overrides=thresholds["sector_confidence_overrides"])
    return sig.reliability_filter(sig.decide_direction(scored, cfg), cfg)


def weekly_retrain(fx: Fixtures, feature_cols: tuple[str, ...] | None = None,
                   sizes: mdl.ModelSizes = mdl.ModelSizes()) -> DataFrame:
    """The weekly training run end to end (survey 3.1): feature table -> E26
    clean-up -> label -> feature selection on the train slice (H5, H6; unless
    ``feature_cols`` names them) -> purged split, dead zone, weights -> weighted
    forest, boosted trees and logistic regression -> Platt calibration and
    balanced-accuracy threshold on the calibration split -> test metrics per model."""
    from barloom.operators import labels as lab
    from barloom.operators.metrics import classification_metrics
    from barloom.operators.thresholds import tune_threshold
    from barloom.plans.q_prep import selected_features
    features(fx)        # the selection and the training rows read the same table
    # at most the sum of the category caps
    feats = tuple(feature_cols or sorted(r["feature"] for r in selected_features(fx).collect()))

    def build(f):
        lf = labelled_features(f.spark, f.sf_dir).withColumn("y", (F.col("direction_5d") == "Up").cast("int"))
        lf = stored(lab.dead_zone(lab.split_purged(lf)).select(
            "ticker", "trading_date", "split", "y", "direction_5d", *feats), "retrain-rows")
        w = lab.sample_weights(lf.filter(F.col("split") == "train")).select("ticker", "trading_date", "sample_weight")
        return lf.join(w, ["ticker", "trading_date"], "left").withColumn(
            "sample_weight", F.coalesce(F.col("sample_weight"), F.lit(1.0))).drop("direction_5d")
    data = fx.derived("retrain_frame_" + "_".join(feats), build)
    train, cal, test = (data.filter(F.col("split") == s) for s in ("train", "calibration", "test"))
    zoo = mdl.classifier_zoo(sizes=sizes)
    names, parts = ("random_forest", "gradient_boosting", "logistic"), []
    fits = concurrently(fx.spark, [lambda n=n: mdl.fit_classifier(train, feats, zoo[n]) for n in names])
    for name, m in zip(names, fits):
        cal_s = mdl.score(m, cal, ["y"])
        test_s = calib.platt(cal_s, mdl.score(m, test, ["y"]))
        thr_row = tune_threshold(calib.platt(cal_s, cal_s).withColumn("p", F.col("p_calibrated"))).first()
        t = thr_row["threshold"] if thr_row else 0.5
        scored = test_s.select("y", (F.col("p_calibrated") >= t).cast("int").alias("pred"))
        parts.append(classification_metrics(scored, []).select(
            F.lit(name).alias("model"), F.lit(t).alias("threshold"), "n", "accuracy", "f1_weighted"))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res
