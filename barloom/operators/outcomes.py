"""Outcome feedback loop (2.12): realised prices, pending predictions, scoring,
rolling live accuracy, the retrain trigger and the calendar gate."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.sizing import checked_broadcast
from barloom.functions.columns import wt

c_ = F.col

CONFIDENCE_BANDS = ((0.0, 0.55, "<55%"), (0.55, 0.60, "55-60%"), (0.60, 0.67, "60-67%"), (0.67, 1.01, ">=67%"))


def realized_prices(bars: DataFrame, asof: str | None = None, days_back: int | None = None) -> DataFrame:
    """M1: close and date five trading rows later, per ticker."""
    px = bars
    if asof is not None and days_back is not None:
        px = px.filter(c_("trading_date") >= F.date_sub(F.lit(asof).cast("date"), days_back))
    return px.select(
        "ticker", "trading_date", c_("close_price").alias("entry_close"),
        F.lead("close_price", 5).over(wt()).alias("realized_close_5d"),
        F.lead("trading_date", 5).over(wt()).alias("realized_date"),
    )


def pending_predictions(preds: DataFrame, prices: DataFrame, scored_ids: DataFrame) -> DataFrame:
    """M2: predictions with a realised price that are not yet scored (C8). An outcome has the ticker and
    date of its prediction: where ``scored_ids`` has them too, both sides meet in the buckets by ticker."""
    p = preds.select("prediction_id", "run_timestamp", "ticker", "trading_date", "predicted_signal",
                     "confidence", "is_actionable", "suppression_reason")
    joined = p.join(prices, ["ticker", "trading_date"], "inner")
    keys = [k for k in ("ticker", "trading_date", "prediction_id") if k in scored_ids.columns]
    joined = joined.join(scored_ids.select(*keys), keys, "left_anti")
    return joined.filter(c_("realized_close_5d").isNotNull() & (c_("entry_close") > 0))


def classify_signal(sig: Column | str) -> Column:
    """M3: buy/up -> bullish, sell/down -> bearish (buy/up tested first)."""
    s = F.lower((F.col(sig) if isinstance(sig, str) else sig).cast("string"))
    return (F.when(s.contains("buy") | s.contains("up"), F.lit("bullish"))
            .when(s.contains("sell") | s.contains("down"), F.lit("bearish")))


def score_outcomes(pending: DataFrame, trained_at: str | None = None, version: str | None = None) -> DataFrame:
    """M4: outcome rows. ``model_version`` only for runs at/after the training time;
    a NULL actionable flag (pre-flag rows) counts as actionable."""
    d = classify_signal("predicted_signal")
    ret = (c_("realized_close_5d") - c_("entry_close")) / c_("entry_close") * 100
    correct = F.when(d == "bullish", ret > 0).otherwise(ret <= 0).cast("int")
    mv = F.lit(None).cast("string")
    if trained_at and version:
        mv = F.when(c_("run_timestamp") >= F.lit(trained_at).cast("timestamp_ntz"), F.lit(version))
    return (pending.withColumn("direction", d).filter(c_("direction").isNotNull())
            .select("prediction_id", "ticker", "trading_date", "predicted_signal", "confidence", "entry_close",
                    "realized_close_5d", ret.alias("realized_return_5d"), "realized_date",
                    correct.alias("correct"), mv.alias("model_version"),
                    F.coalesce(c_("is_actionable"), F.lit(True)).alias("is_actionable"),
                    "suppression_reason"))


def last_n_dates(df: DataFrame, n: int, date_col: str = "trading_date") -> DataFrame:
    """C11: the last ``n`` distinct dates (a calendar-bounded table)."""
    dates = df.select(date_col).distinct()
    w = Window.orderBy(c_(date_col).desc())
    return dates.withColumn("_r", F.row_number().over(w)).filter(c_("_r") <= n).drop("_r")


def recent_outcomes(outcomes: DataFrame, securities: DataFrame, n_days: int) -> DataFrame:
    """Outcomes on the last ``n_days`` trading dates, with sector."""
    recent = last_n_dates(outcomes, n_days)
    o = outcomes.join(F.broadcast(recent), "trading_date", "left_semi")
    return o.join(checked_broadcast(securities.select("ticker", "sector")), "ticker", "left")


def rolling_accuracy(outcomes: DataFrame, securities: DataFrame, n_days: int = 20,
                     min_sector_n: int = 10) -> DataFrame:
    """M5: live accuracy over the last n trading dates, as long rows
    ``(window_trading_days, metric, key, n, accuracy)``. Stats are on
    actionable rows; ``suppressed`` covers the rest. Accuracies are unrounded."""
    o = recent_outcomes(outcomes, securities, n_days).withColumn("direction", classify_signal("predicted_signal"))
    act = c_("is_actionable")
    band = F.lit(None).cast("string")
    for lo, hi, label in reversed(CONFIDENCE_BANDS):
        band = F.when((c_("confidence") >= lo) & (c_("confidence") < hi), F.lit(label)).otherwise(band)
    keyed = o.select(
        "correct", act.alias("act"),
        F.array(
            F.struct(F.lit("overall").alias("metric"), F.lit("all").cast("string").alias("key"), act.alias("use")),
            F.struct(F.lit("side").alias("metric"), c_("direction").alias("key"),
                     (act & c_("direction").isNotNull()).alias("use")),
            F.struct(F.lit("band").alias("metric"), band.alias("key"), (act & band.isNotNull()).alias("use")),
            F.struct(F.lit("sector").alias("metric"), c_("sector").alias("key"),
                     (act & c_("sector").isNotNull()).alias("use")),
            F.struct(F.lit("suppressed").alias("metric"), F.lit("all").alias("key"), (~act).alias("use")),
        ).alias("_k"),
    )
    exploded = keyed.select("correct", F.explode("_k").alias("k")).filter(c_("k.use"))
    agg = exploded.groupBy(c_("k.metric").alias("metric"), c_("k.key").alias("key")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.avg("correct").alias("accuracy"))
    agg = agg.filter((c_("metric") != "sector") | (c_("n") >= min_sector_n))
    return agg.select(F.lit(n_days).alias("window_trading_days"), "metric", "key", "n", "accuracy")


def retrain_decision(rolling: DataFrame, run_date: str, last_trained: str | None, min_n: int = 100,
                     min_accuracy: float = 0.50, cooldown_days: int = 5) -> DataFrame:
    """M6: retrain when n >= min_n, accuracy < floor and the cooldown passed."""
    overall = rolling.filter(c_("metric") == "overall").select("n", "accuracy")
    days = (F.datediff(F.lit(run_date).cast("date"), F.lit(last_trained).cast("date"))
            if last_trained else F.lit(None).cast("int"))
    cooldown_ok = F.coalesce(days >= cooldown_days, F.lit(True))
    return overall.select(
        "n", "accuracy", days.alias("days_since_training"),
        ((c_("n") >= min_n) & (c_("accuracy") < min_accuracy) & cooldown_ok).alias("retrain"),
        F.when(c_("n") < min_n, F.lit("insufficient outcomes"))
        .when(c_("accuracy") >= min_accuracy, F.lit("accuracy above floor"))
        .when(~cooldown_ok, F.lit("cooldown"))
        .otherwise(F.lit("live accuracy below floor")).alias("reason"),
    )


def calendar_gate(dates: DataFrame, calendar: DataFrame, market: str = "NASDAQ") -> DataFrame:
    """M7: open unless a calendar row says closed; a missing row means open."""
    cal = calendar.filter(c_("market") == market).select(
        c_("calendar_date").alias("check_date"), "is_trading_day", "holiday_name")
    j = dates.join(cal, "check_date", "left")
    open_ = F.coalesce(c_("is_trading_day"), F.lit(True))
    wkday = F.weekday("check_date")
    reason = (F.when(c_("is_trading_day").isNull(), F.lit("no calendar row: assume open"))
              .when(open_, F.lit("trading day"))
              .when(F.coalesce(c_("holiday_name"), F.lit("")) != "", F.concat(F.lit("holiday: "), c_("holiday_name")))
              .otherwise(F.lit("market closed")))
    return j.select("check_date", open_.alias("is_open"), reason.alias("reason"), wkday.alias("day_of_week"))
