"""Prediction post-processing (2.11): direction, reliability rules, export rows
and run summaries. All row-wise rules are ``CASE`` chains; summaries are one-row
conditional aggregates (partial aggregation, no shuffle of rows)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c_ = F.col


@dataclass(frozen=True)
class SignalConfig:
    """Decision and reliability parameters (reference defaults)."""
    p_up_threshold: float = 0.54
    high_confidence: float = 0.58
    medium_confidence: float = 0.55
    buy_min_confidence: float = 0.55
    sell_max_confidence: float = 0.99
    rsi_overbought_buy_block: float = 70.0
    energy_sector_excluded: bool = True
    min_stock_price: float = 5.0
    sector_overrides: dict = field(default_factory=lambda: {"Technology": 0.57, "Healthcare": 0.57})


RULES = ("penny_stock", "buy_dead_zone", "sell_high_conf", "rsi_overbought_buy", "energy_sector",
         "sector_override")


def decide_direction(pred: DataFrame, cfg: SignalConfig = SignalConfig(), prob: str = "up_probability") -> DataFrame:
    """L1: Up when P(Up) >= threshold; confidence is the called side's probability."""
    p = c_(prob)
    is_up = p >= F.lit(cfg.p_up_threshold)
    conf = F.when(is_up, p).otherwise(F.lit(1.0) - p)
    return pred.select(
        "*",
        F.when(is_up, F.lit("Up")).otherwise(F.lit("Down")).alias("predicted_signal"),
        (F.lit(1.0) - p).alias("down_probability"),
        conf.alias("confidence"),
        (conf > F.lit(cfg.high_confidence)).alias("high_confidence"),
    )


def rule_masks(cfg: SignalConfig) -> dict[str, Column]:
    """The six reliability rules, in their fixed order. NULL compares as false."""
    up, down = c_("predicted_signal") == "Up", c_("predicted_signal") == "Down"
    conf = c_("confidence")
    override = F.lit(False)
    for sector, t in cfg.sector_overrides.items():
        override = override | (up & (c_("sector") == F.lit(sector)) & (conf < F.lit(t)))
    masks = {
        "penny_stock": c_("close_price") < F.lit(cfg.min_stock_price),
        "buy_dead_zone": up & (conf < F.lit(cfg.buy_min_confidence)),
        "sell_high_conf": down & (conf > F.lit(cfg.sell_max_confidence)),
        "rsi_overbought_buy": up & c_("RSI").isNotNull() & (c_("RSI") > F.lit(cfg.rsi_overbought_buy_block)),
        "energy_sector": (c_("sector") == F.lit("Energy")) if cfg.energy_sector_excluded else F.lit(False),
        "sector_override": override,
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in masks.items()}


def reliability_filter(df: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """L2 (+B12): first matching rule names the suppression reason."""
    masks = rule_masks(cfg)
    reason = F.coalesce(*[F.when(m, F.lit(name)) for name, m in masks.items()])
    out = df.withColumn("suppression_reason", reason)
    out = out.withColumn("is_actionable", c_("suppression_reason").isNull())
    return out.withColumn("high_confidence", c_("high_confidence") & c_("is_actionable"))


def suppression_counts(df: DataFrame, cfg: SignalConfig = SignalConfig()) -> DataFrame:
    """L3: rows matching each rule (not exclusive), plus the total suppressed."""
    masks = rule_masks(cfg)
    any_rule = F.lit(False)
    for m in masks.values():
        any_rule = any_rule | m
    return df.agg(*[F.count_if(m).cast("bigint").alias(n) for n, m in masks.items()],
                  F.count_if(any_rule).cast("bigint").alias("total_suppressed"),
                  F.count(F.lit(1)).cast("bigint").alias("total"))


def export_predictions(df: DataFrame) -> DataFrame:
    """L4: prediction rows as stored."""
    conf = c_("confidence")
    strength = (F.when(~c_("is_actionable"), F.lit("Suppressed"))
                .when(conf >= 0.67, F.lit("Strong")).when(conf >= 0.55, F.lit("Moderate"))
                .otherwise(F.lit("Weak")))
    rsi_cat = (F.when(c_("RSI") < 30, F.lit("Oversold")).when(c_("RSI") > 70, F.lit("Overbought"))
               .otherwise(F.lit("Neutral")))
    signal = (F.when(c_("predicted_signal") == "Up", F.lit("Buy"))
              .when(c_("predicted_signal") == "Down", F.lit("Sell")).otherwise(c_("predicted_signal")))
    return df.select(
        "prediction_id", "run_timestamp", "trading_date", "ticker", "company",
        signal.alias("predicted_signal"), conf.alias("confidence"),
        (conf * 100).alias("confidence_percentage"), strength.alias("signal_strength"),
        "close_price", "RSI", rsi_cat.alias("rsi_category"),
        (c_("high_confidence") & c_("is_actionable")).alias("high_confidence"),
        c_("down_probability").alias("sell_probability"), c_("up_probability").alias("buy_probability"),
        "is_actionable", "suppression_reason",
    )


def technical_rows(latest: DataFrame) -> DataFrame:
    """Technical indicator rows over the latest non-null values per ticker."""
    return latest.select(
        "trading_date", "ticker", "sma_20", "sma_50", "macd", "macd_signal",
        F.when(c_("macd") > c_("macd_signal"), F.lit("Bullish")).otherwise(F.lit("Bearish")).alias("macd_trend"),
        "price_vs_sma20", ((c_("price_vs_sma20") - 1) * 100).alias("price_vs_sma20_pct"),
        "price_vs_sma50", ((c_("price_vs_sma50") - 1) * 100).alias("price_vs_sma50_pct"),
        F.when(c_("price_vs_sma50") > 1.02, F.lit("Uptrend")).when(c_("price_vs_sma50") < 0.98, F.lit("Downtrend"))
        .otherwise(F.lit("Sideways")).alias("trend_direction"),
    )


def run_summary(pred_rows: DataFrame, tech_rows: DataFrame | None = None,
                group: str | None = None) -> DataFrame:
    """L6 + L7: run summary counters over actionable rows, with the zero-buy
    guardrail. One row per ``group`` (e.g. run date) or one row overall."""
    act = c_("is_actionable")
    conf = c_("confidence")
    buy = c_("predicted_signal").rlike("Buy|Up")
    sell = c_("predicted_signal").rlike("Sell|Down")
    aggs = [
        F.count(F.lit(1)).cast("bigint").alias("total_predictions"),
        F.count_if(act & (conf > 0.7)).cast("bigint").alias("high_confidence_count"),
        F.count_if(act & (conf > 0.6) & (conf <= 0.7)).cast("bigint").alias("medium_confidence_count"),
        F.count_if(act & buy).cast("bigint").alias("buy_signals"),
        F.count_if(act & sell).cast("bigint").alias("sell_signals"),
        F.avg(F.when(act, conf)).alias("avg_confidence"),
        F.avg(F.when(act, c_("RSI"))).alias("avg_rsi"),
    ]
    out = pred_rows.groupBy(group).agg(*aggs) if group else pred_rows.agg(*aggs)
    out = out.withColumn("zero_buy_alert", (c_("total_predictions") > 50) & (c_("buy_signals") == 0))
    if tech_rows is not None:
        t = tech_rows.agg(
            F.count_if(c_("macd_trend") == "Bullish").cast("bigint").alias("bullish_macd_count"),
            F.count_if(c_("macd_trend") == "Bearish").cast("bigint").alias("bearish_macd_count"),
            F.count_if(c_("trend_direction") == "Uptrend").cast("bigint").alias("uptrend_count"),
            F.count_if(c_("trend_direction") == "Downtrend").cast("bigint").alias("downtrend_count"),
            F.count_if(c_("trend_direction") == "Sideways").cast("bigint").alias("sideways_count"),
        ).first()
        out = out.select("*", *[F.lit(v).cast("bigint").alias(k) for k, v in t.asDict().items()])
    return out


def display_tiers(df: DataFrame, high: float = 0.58, medium: float = 0.55) -> DataFrame:
    """Tier of actionable rows (high >= .58, medium >= .55, else low)."""
    conf = c_("confidence")
    return df.withColumn("tier", F.when(~c_("is_actionable"), F.lit(None).cast("string"))
                         .when(conf >= high, F.lit("high")).when(conf >= medium, F.lit("medium"))
                         .otherwise(F.lit("low")))


def export_segments(df: DataFrame, threshold: float = 0.58) -> DataFrame:
    """Disjoint output segments: > .7 high, .6-.7 medium, others above the
    threshold, rest. One column, written with ``partitionBy('segment')``."""
    conf = c_("confidence")
    seg = (F.when(conf > 0.7, F.lit("high_confidence")).when(conf >= 0.6, F.lit("medium_confidence"))
           .when(conf > threshold, F.lit("above_threshold")).otherwise(F.lit("other")))
    return df.withColumn("segment", seg)


def _ts_text(col: str = "run_timestamp"):
    return F.date_format(c_(col), "yyyy-MM-dd HH:mm:ss")


def _conf_level():
    conf = c_("confidence")
    return F.when(conf > 0.7, F.lit("High")).when(conf > 0.6, F.lit("Medium")).otherwise(F.lit("Low"))


def _strength65():
    conf = c_("confidence")
    return F.when(conf >= 0.65, F.lit("Strong")).when(conf >= 0.55, F.lit("Moderate")).otherwise(F.lit("Weak"))


def format_standard(res: DataFrame) -> DataFrame:
    """L8 standard CSV rows; the export time is the run's timestamp."""
    return res.select(_ts_text().alias("export_timestamp"), "trading_date", "ticker", "company", "predicted_signal",
                      "confidence", _conf_level().alias("confidence_level"), "close_price", "RSI", "high_confidence")


def format_enhanced(res: DataFrame) -> DataFrame:
    """L8 enhanced CSV rows (strength at .65 / .55, price risk at 500 / 100)."""
    px = c_("close_price")
    rsi_cat = (F.when(c_("RSI") < 30, F.lit("Oversold")).when(c_("RSI") > 70, F.lit("Overbought"))
               .otherwise(F.lit("Neutral")))
    return res.select(_ts_text().alias("export_timestamp"), "trading_date", "ticker", "company", "predicted_signal",
                      _strength65().alias("signal_strength"), "confidence",
                      (c_("confidence") * 100).alias("confidence_percentage"), _conf_level().alias("confidence_level"),
                      "close_price", F.when(px > 500, "High").when(px > 100, "Medium").otherwise("Low")
                      .alias("price_risk"), "RSI", rsi_cat.alias("rsi_category"),
                      c_("down_probability").alias("sell_probability"), c_("up_probability").alias("buy_probability"),
                      "high_confidence")


def format_summary(res: DataFrame) -> DataFrame:
    return res.select(_ts_text().alias("export_timestamp"), "ticker", "company", "predicted_signal",
                      (c_("confidence") * 100).alias("confidence_pct"), "close_price", "RSI")


def format_trading(res: DataFrame) -> DataFrame:
    """L8 trading rows: action from the signal classifier (accepts Up/Down and
    Buy/Sell), priority and risk level by confidence."""
    from barloom.operators.outcomes import classify_signal
    side = classify_signal("predicted_signal")
    conf = c_("confidence")
    return res.select(
        _ts_text().alias("export_timestamp"), "ticker",
        F.when(side == "bearish", "SELL").when(side == "bullish", "BUY").otherwise("HOLD").alias("action"),
        F.when(conf > 0.8, 1).when(conf > 0.7, 2).when(conf > 0.6, 3).otherwise(4).alias("priority"),
        F.when(conf > 0.8, "Low").when(conf > 0.6, "Medium").otherwise("High").alias("risk_level"),
        "confidence", "close_price", "RSI", "predicted_signal")


def format_technical(res: DataFrame, feats: DataFrame) -> DataFrame:
    """L8 technical rows: prediction joined to the same day's indicators."""
    f = feats.select("ticker", "trading_date", "sma_20", "ema_20", "macd", "macd_signal", "price_vs_sma50")
    j = res.join(f, ["ticker", "trading_date"], "left")
    return j.select(
        _ts_text().alias("export_timestamp"), "trading_date", "ticker", "predicted_signal", "confidence",
        _strength65().alias("signal_strength"), "sma_20", "ema_20", "macd", "macd_signal",
        F.when(c_("macd") > c_("macd_signal"), "Bullish").otherwise("Bearish").alias("macd_trend"),
        ((c_("price_vs_sma50") - 1) * 100).alias("price_vs_sma50_pct"),
        F.when(c_("price_vs_sma50") > 1.02, "Uptrend").when(c_("price_vs_sma50") < 0.98, "Downtrend")
        .otherwise("Sideways").alias("trend_direction"))
