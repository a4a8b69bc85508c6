"""Catalogue entries for 2.11 (signals, exports) and 2.12 (outcome loop)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.columns import r4, r4_sql
from barloom.operators import outcomes as out
from barloom.operators import signals as sig
from barloom.plans import derived as dv
from barloom.plans.catalog import register
from barloom.plans.q_features import features

c_ = F.col


@register("decide_direction", f"""
SELECT prediction_id, CASE WHEN up_probability >= 54e-2 THEN 'Up' ELSE 'Down' END AS predicted_signal,
       {r4_sql('1e0 - up_probability')} AS down_probability,
       {r4_sql('CASE WHEN up_probability >= 54e-2 THEN up_probability ELSE 1e0 - up_probability END')} AS confidence,
       CASE WHEN up_probability >= 54e-2 THEN up_probability ELSE 1e0 - up_probability END > 58e-2 AS high_confidence
FROM predictions""", ctes=("predictions",))
def q_decide(fx):
    d = sig.decide_direction(fx.predictions, dv.TEST_CFG)
    return d.select("prediction_id", "predicted_signal", r4("down_probability").alias("down_probability"),
                    r4("confidence").alias("confidence"), "high_confidence")


@register("reliability_filter", """
SELECT prediction_id, predicted_signal, suppression_reason, is_actionable, high_confidence FROM o_signals""",
          ctes=("o_signals",))
def q_reliability(fx):
    return dv.signals(fx).select("prediction_id", "predicted_signal", "suppression_reason", "is_actionable",
                                 "high_confidence")


@register("suppression_counts", """
SELECT CAST(COUNT_IF(COALESCE(close_price < 5e3, FALSE)) AS BIGINT) AS penny_stock,
       CAST(COUNT_IF(COALESCE(predicted_signal = 'Up' AND confidence < 55e-2, FALSE)) AS BIGINT) AS buy_dead_zone,
       CAST(COUNT_IF(COALESCE(predicted_signal = 'Down' AND confidence > 99e-2, FALSE)) AS BIGINT) AS sell_high_conf,
       CAST(COUNT_IF(COALESCE(predicted_signal = 'Up' AND RSI IS NOT NULL AND RSI > 7e1, FALSE)) AS BIGINT)
         AS rsi_overbought_buy,
       CAST(COUNT_IF(COALESCE(sector = 'Energy', FALSE)) AS BIGINT) AS energy_sector,
       CAST(COUNT_IF(COALESCE(predicted_signal = 'Up' AND sector IN ('Technology', 'Healthcare')
                              AND confidence < 57e-2, FALSE)) AS BIGINT) AS sector_override,
       CAST(COUNT_IF(suppression_reason IS NOT NULL) AS BIGINT) AS total_suppressed,
       CAST(COUNT(*) AS BIGINT) AS total
FROM o_signals""", ctes=("o_signals",))
def q_suppression_counts(fx):
    return sig.suppression_counts(dv.signals(fx), dv.TEST_CFG)


_EXPORT_D = ("confidence", "confidence_percentage", "close_price", "RSI", "sell_probability", "buy_probability")


@register("export_predictions", f"""
SELECT prediction_id, run_timestamp, trading_date, ticker, company, predicted_signal,
       {', '.join(f'{r4_sql(c)} AS {c}' for c in _EXPORT_D)}, signal_strength, rsi_category, high_confidence,
       is_actionable, suppression_reason
FROM o_export""", ctes=("o_export",))
def q_export_predictions(fx):
    rows = sig.export_predictions(dv.signals(fx))
    return rows.select("prediction_id", "run_timestamp", "trading_date", "ticker", "company", "predicted_signal",
                       *[r4(c).alias(c) for c in _EXPORT_D], "signal_strength", "rsi_category",
                       "high_confidence", "is_actionable", "suppression_reason")


_TECH = ("sma_20", "sma_50", "macd", "macd_signal", "price_vs_sma20", "price_vs_sma50")


def _latest_nonnull_sql(cols):
    return ", ".join(f"ARG_MAX({c}, trading_date) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols)


@register("export_technical_rows", f"""
WITH l AS (SELECT ticker, MAX(trading_date) AS trading_date, {_latest_nonnull_sql(_TECH)} FROM o_feat GROUP BY ticker)
SELECT ticker, trading_date, {', '.join(f'{r4_sql(c)} AS {c}' for c in _TECH)},
       CASE WHEN macd > macd_signal THEN 'Bullish' ELSE 'Bearish' END AS macd_trend,
       {r4_sql('(price_vs_sma20 - 1) * 100')} AS price_vs_sma20_pct,
       {r4_sql('(price_vs_sma50 - 1) * 100')} AS price_vs_sma50_pct,
       CASE WHEN price_vs_sma50 > 102e-2 THEN 'Uptrend' WHEN price_vs_sma50 < 98e-2 THEN 'Downtrend'
            ELSE 'Sideways' END AS trend_direction
FROM l""", ctes=("o_feat",))
def q_export_technical_rows(fx):
    latest = latest_nonnull(features(fx, *_TECH), _TECH)
    t = sig.technical_rows(latest)
    return t.select("ticker", "trading_date", *[r4(c).alias(c) for c in _TECH], "macd_trend",
                    r4("price_vs_sma20_pct").alias("price_vs_sma20_pct"),
                    r4("price_vs_sma50_pct").alias("price_vs_sma50_pct"), "trend_direction")


def latest_nonnull(df, cols, key="ticker", order="trading_date"):
    """E30 ``groupby(key).last()``: last non-NULL value per column, as an aggregate."""
    return df.groupBy(key).agg(
        F.max(order).alias(order),
        *[F.max_by(c, F.when(c_(c).isNotNull(), c_(order))).alias(c) for c in cols])


_SUMMARY_SQL = """
SELECT {g}CAST(COUNT(*) AS BIGINT) AS total_predictions,
       CAST(COUNT_IF(is_actionable AND confidence > 7e-1) AS BIGINT) AS high_confidence_count,
       CAST(COUNT_IF(is_actionable AND confidence > 6e-1 AND confidence <= 7e-1) AS BIGINT) AS medium_confidence_count,
       CAST(COUNT_IF(is_actionable AND REGEXP_MATCHES(predicted_signal, 'Buy|Up')) AS BIGINT) AS buy_signals,
       CAST(COUNT_IF(is_actionable AND REGEXP_MATCHES(predicted_signal, 'Sell|Down')) AS BIGINT) AS sell_signals,
       {avgc} AS avg_confidence, {avgr} AS avg_rsi,
       COUNT(*) > 50 AND COUNT_IF(is_actionable AND REGEXP_MATCHES(predicted_signal, 'Buy|Up')) = 0 AS zero_buy_alert
FROM o_export s
{gb}"""


@register("run_summary", _SUMMARY_SQL.format(
    g="run_timestamp, ", gb="GROUP BY run_timestamp",
    avgc=r4_sql("AVG(CASE WHEN is_actionable THEN confidence END)"),
    avgr=r4_sql("AVG(CASE WHEN is_actionable THEN RSI END)")), ctes=("o_export",))
def q_run_summary(fx):
    rows = sig.export_predictions(dv.signals(fx))
    s = sig.run_summary(rows, group="run_timestamp")
    return s.withColumn("avg_confidence", r4("avg_confidence")).withColumn("avg_rsi", r4("avg_rsi"))


@register("latest_run", _SUMMARY_SQL.format(
    g="run_timestamp, ", gb="GROUP BY run_timestamp ORDER BY run_timestamp DESC LIMIT 1",
    avgc=r4_sql("AVG(CASE WHEN is_actionable THEN confidence END)"),
    avgr=r4_sql("AVG(CASE WHEN is_actionable THEN RSI END)")), ctes=("o_export",))
def q_latest_run(fx):
    return q_run_summary(fx).orderBy(c_("run_timestamp").desc()).limit(1)


@register("export_summary", f"""
SELECT CAST(COUNT_IF(predicted_signal = 'Buy') AS BIGINT) AS buy_count,
       CAST(COUNT_IF(predicted_signal = 'Sell') AS BIGINT) AS sell_count,
       {r4_sql('AVG(confidence)')} AS avg_confidence,
       {r4_sql("AVG(CASE WHEN predicted_signal = 'Buy' THEN confidence END)")} AS avg_buy_confidence,
       {r4_sql("AVG(CASE WHEN predicted_signal = 'Sell' THEN confidence END)")} AS avg_sell_confidence,
       CAST(COUNT_IF(high_confidence) AS BIGINT) AS high_confidence_count
FROM o_export""", ctes=("o_export",))
def q_export_summary(fx):
    rows = sig.export_predictions(dv.signals(fx))
    return rows.agg(
        F.count_if(c_("predicted_signal") == "Buy").cast("bigint").alias("buy_count"),
        F.count_if(c_("predicted_signal") == "Sell").cast("bigint").alias("sell_count"),
        r4(F.avg("confidence")).alias("avg_confidence"),
        r4(F.avg(F.when(c_("predicted_signal") == "Buy", c_("confidence")))).alias("avg_buy_confidence"),
        r4(F.avg(F.when(c_("predicted_signal") == "Sell", c_("confidence")))).alias("avg_sell_confidence"),
        F.count_if("high_confidence").cast("bigint").alias("high_confidence_count"))


@register("display_tiers", """
SELECT tier, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN NOT is_actionable THEN NULL WHEN confidence >= 58e-2 THEN 'high'
              WHEN confidence >= 55e-2 THEN 'medium' ELSE 'low' END AS tier FROM o_signals) q
GROUP BY tier""", ctes=("o_signals",))
def q_display_tiers(fx):
    return sig.display_tiers(dv.signals(fx)).groupBy("tier").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("export_segments", """
SELECT segment, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN confidence > 7e-1 THEN 'high_confidence' WHEN confidence >= 6e-1 THEN 'medium_confidence'
              WHEN confidence > 58e-2 THEN 'above_threshold' ELSE 'other' END AS segment FROM o_signals) q
GROUP BY segment""", ctes=("o_signals",))
def q_export_segments(fx):
    return sig.export_segments(dv.signals(fx)).groupBy("segment").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# ------------------------------------------------------------- 2.12 loop
@register("realized_prices", f"""
SELECT ticker, trading_date, {r4_sql('close_price')} AS entry_close,
       {r4_sql('LEAD(close_price, 5) OVER (PARTITION BY ticker ORDER BY trading_date)')} AS realized_close_5d,
       LEAD(trading_date, 5) OVER (PARTITION BY ticker ORDER BY trading_date) AS realized_date
FROM bars""", ctes=("bars",))
def q_realized(fx):
    p = out.realized_prices(fx.bars)
    return p.select("ticker", "trading_date", r4("entry_close").alias("entry_close"),
                    r4("realized_close_5d").alias("realized_close_5d"), "realized_date")


@register("pending_predictions", f"""
SELECT prediction_id, ticker, trading_date, predicted_signal, {r4_sql('confidence')} AS confidence,
       is_actionable, {r4_sql('entry_close')} AS entry_close, {r4_sql('realized_close_5d')} AS realized_close_5d,
       realized_date
FROM o_pending""", ctes=("o_pending",))
def q_pending(fx):
    p = out.pending_predictions(dv.stored_predictions(fx), out.realized_prices(fx.bars), dv.prior_outcome_ids(fx))
    return p.select("prediction_id", "ticker", "trading_date", "predicted_signal", r4("confidence").alias("confidence"),
                    "is_actionable", r4("entry_close").alias("entry_close"),
                    r4("realized_close_5d").alias("realized_close_5d"), "realized_date")


@register("classify_signal", f"""
SELECT predicted_signal AS signal, {dv.CLASSIFY_SQL.format(s='predicted_signal')} AS direction,
       CAST(COUNT(*) AS BIGINT) AS n
FROM o_stored GROUP BY predicted_signal""", ctes=("o_stored",))
def q_classify(fx):
    s = dv.stored_predictions(fx)
    return s.groupBy(c_("predicted_signal").alias("signal")).agg(
        F.first(out.classify_signal("predicted_signal")).alias("direction"),
        F.count(F.lit(1)).cast("bigint").alias("n"))


_OUT_D = ("confidence", "entry_close", "realized_close_5d", "realized_return_5d")


@register("score_outcomes", f"""
SELECT prediction_id, ticker, trading_date, predicted_signal, {', '.join(f'{r4_sql(c)} AS {c}' for c in _OUT_D)},
       realized_date, correct, model_version, is_actionable, suppression_reason
FROM o_outcomes""", ctes=("o_outcomes",))
def q_score_outcomes(fx):
    o = dv.outcomes(fx)
    return o.select("prediction_id", "ticker", "trading_date", "predicted_signal", *[r4(c).alias(c) for c in _OUT_D],
                    "realized_date", "correct", "model_version", "is_actionable", "suppression_reason")


def _rolling_sql(n: int) -> str:
    band = ("CASE WHEN confidence >= 0e0 AND confidence < 55e-2 THEN '<55%' "
            "WHEN confidence >= 55e-2 AND confidence < 6e-1 THEN '55-60%' "
            "WHEN confidence >= 6e-1 AND confidence < 67e-2 THEN '60-67%' "
            "WHEN confidence >= 67e-2 AND confidence < 1.01e0 THEN '>=67%' END")
    return f"""
WITH recent AS (SELECT DISTINCT trading_date FROM o_outcomes ORDER BY trading_date DESC LIMIT {n}),
o AS (
  SELECT o.*, s.sector, {dv.CLASSIFY_SQL.format(s='o.predicted_signal')} AS direction, {band} AS band
  FROM o_outcomes o JOIN recent r ON r.trading_date = o.trading_date
  LEFT JOIN securities s ON s.ticker = o.ticker),
k AS (
  SELECT 'overall' AS metric, 'all' AS key, correct FROM o WHERE is_actionable
  UNION ALL SELECT 'side', direction, correct FROM o WHERE is_actionable AND direction IS NOT NULL
  UNION ALL SELECT 'band', band, correct FROM o WHERE is_actionable AND band IS NOT NULL
  UNION ALL SELECT 'sector', sector, correct FROM o WHERE is_actionable AND sector IS NOT NULL
  UNION ALL SELECT 'suppressed', 'all', correct FROM o WHERE NOT is_actionable)
SELECT {n} AS window_trading_days, metric, key, CAST(COUNT(*) AS BIGINT) AS n, {r4_sql('AVG(correct)')} AS accuracy
FROM k GROUP BY metric, key HAVING metric <> 'sector' OR COUNT(*) >= 10"""


@register("rolling_accuracy", f"SELECT * FROM ({_rolling_sql(20)}) a UNION ALL SELECT * FROM ({_rolling_sql(60)}) b",
          ctes=("o_outcomes", "securities"))
def q_rolling(fx):
    parts = [out.rolling_accuracy(dv.outcomes(fx), fx.securities, n) for n in (20, 60)]
    df = parts[0].unionByName(parts[1])
    return df.withColumn("accuracy", r4("accuracy"))


@register("recent_outcomes", f"""
SELECT o.prediction_id, o.ticker, o.trading_date, s.sector, o.correct
FROM o_outcomes o
JOIN (SELECT DISTINCT trading_date FROM o_outcomes ORDER BY trading_date DESC LIMIT 20) r
  ON r.trading_date = o.trading_date
LEFT JOIN securities s ON s.ticker = o.ticker""", ctes=("o_outcomes", "securities"))
def q_recent(fx):
    return out.recent_outcomes(dv.outcomes(fx), fx.securities, 20).select(
        "prediction_id", "ticker", "trading_date", "sector", "correct")


@register("retrain_decision", f"""
WITH r AS ({_rolling_sql(20)})
SELECT n, accuracy, CAST(15 AS INT) AS days_since_training,
       n >= 100 AND accuracy < 5e-1 AND TRUE AS retrain,
       CASE WHEN n < 100 THEN 'insufficient outcomes' WHEN accuracy >= 5e-1 THEN 'accuracy above floor'
            ELSE 'live accuracy below floor' END AS reason
FROM r WHERE metric = 'overall'""", ctes=("o_outcomes", "securities"))
def q_retrain(fx):
    r = out.rolling_accuracy(dv.outcomes(fx), fx.securities, 20).withColumn("accuracy", r4("accuracy"))
    return out.retrain_decision(r, run_date="2001-11-19", last_trained="2001-11-04")


@register("calendar_gate", """
WITH b AS (SELECT MIN(calendar_date) AS s, MAX(calendar_date) AS e FROM market_calendar),
d AS (SELECT CAST(UNNEST(generate_series(b.s, b.e, INTERVAL 1 DAY)) AS DATE) AS check_date FROM b),
c AS (SELECT calendar_date AS check_date, is_trading_day, holiday_name FROM market_calendar WHERE market = 'NASDAQ')
SELECT d.check_date, COALESCE(c.is_trading_day, TRUE) AS is_open,
       CASE WHEN c.is_trading_day IS NULL THEN 'no calendar row: assume open'
            WHEN c.is_trading_day THEN 'trading day'
            WHEN COALESCE(c.holiday_name, '') <> '' THEN 'holiday: ' || c.holiday_name
            ELSE 'market closed' END AS reason,
       CAST(ISODOW(d.check_date) - 1 AS INT) AS day_of_week
FROM d LEFT JOIN c ON c.check_date = d.check_date""", ctes=("market_calendar",))
def q_calendar_gate(fx):
    """Every calendar day between the first and last calendar row."""
    cal = fx.market_calendar
    bounds = cal.agg(F.min("calendar_date").alias("s"), F.max("calendar_date").alias("e"))
    dates = bounds.select(F.explode(F.sequence("s", "e")).alias("check_date"))
    return out.calendar_gate(dates, cal)
