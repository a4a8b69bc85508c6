"""Catalogue entries for 2.1 (scans, sinks), 2.2 (filters) and 2.3 (joins)."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.functions.sizing import checked_broadcast
from barloom.functions.columns import r4, r4_sql
from barloom.operators import features as feat
from barloom.operators import outcomes as out
from barloom.operators import signals as sig
from barloom.plans import derived as dv
from barloom.plans import q_signals
from barloom.plans.catalog import REGISTRY, oracle_cte, register
from barloom.plans.q_features import features
from barloom.plans.q_sentiment import sector_sentiment
from barloom.session import scratch_path
from barloom.sources import io

c_ = F.col
ASOF = "2001-11-04"

# raw bars with text prices and bad values (FIXTURES 1, A1 test)
_BAD = ("CASE WHEN volume % 97 = 0 THEN 'N/A' WHEN volume % 89 = 0 THEN '' WHEN volume % 83 = 0 THEN NULL "
        "WHEN volume % 79 = 0 THEN 'NaN' WHEN volume % 73 = 0 THEN 'Infinity' ELSE CAST(close_price AS VARCHAR) END")
oracle_cte("o_raw_bars", ("bars",), f"""
SELECT ticker, trading_date, CAST(open_price AS VARCHAR) AS open_price, CAST(high_price AS VARCHAR) AS high_price,
       CAST(low_price AS VARCHAR) AS low_price, {_BAD} AS close_price, CAST(volume AS VARCHAR) AS volume
FROM bars""")


def raw_bars(fx):
    v = c_("volume")
    bad = (F.when(v % 97 == 0, F.lit("N/A")).when(v % 89 == 0, F.lit("")).when(v % 83 == 0, F.lit(None))
           .when(v % 79 == 0, F.lit("NaN")).when(v % 73 == 0, F.lit("Infinity"))
           .otherwise(c_("close_price").cast("string")))
    return fx.bars.select("ticker", "trading_date", *[c_(p).cast("string").alias(p) for p in
                                                      ("open_price", "high_price", "low_price")],
                          bad.alias("close_price"), v.cast("string").alias("volume"))


@register("bars_scan", f"""
SELECT ticker, trading_date, {r4_sql('CASE WHEN ISFINITE(TRY_CAST(close_price AS DOUBLE)) THEN TRY_CAST(close_price AS DOUBLE) END')}
       AS close_price, TRY_CAST(volume AS BIGINT) AS volume FROM o_raw_bars""", ctes=("o_raw_bars",))
def q_bars_scan(fx):
    t = io.typed_bars(raw_bars(fx))
    return t.select("ticker", "trading_date", r4("close_price").alias("close_price"), "volume")


@register("filter_valid_bars", """
SELECT ticker, trading_date FROM o_raw_bars
WHERE ISFINITE(TRY_CAST(close_price AS DOUBLE)) AND TRY_CAST(close_price AS DOUBLE) >= 5e3
  AND TRY_CAST(volume AS BIGINT) > 0""", ctes=("o_raw_bars",))
def q_valid(fx):
    return io.valid_bars(io.typed_bars(raw_bars(fx)), 5000.0).select("ticker", "trading_date")


@register("param_query", f"""
SELECT ticker, trading_date, {r4_sql('close_price')} AS close_price FROM bars
WHERE ticker = '17' AND trading_date >= DATE '2000-01-01'""", ctes=("bars",))
def q_param(fx):
    df = io.param_query(fx.spark, "SELECT ticker, trading_date, close_price FROM {bars} "
                        "WHERE ticker = :ticker AND trading_date >= :since",
                        {"ticker": "17", "since": datetime.date(2000, 1, 1)}, bars=fx.bars)
    return df.withColumn("close_price", r4("close_price"))


_BAR_COLUMNS = (("ticker", "string"), ("company", "string"), ("trading_date", "date"), ("open_price", "double"),
                ("high_price", "double"), ("low_price", "double"), ("close_price", "double"), ("volume", "bigint"))


@register("table_schema", " UNION ALL ".join(
    f"SELECT 'bars' AS table_name, CAST({i} AS INT) AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
    f"CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT({c}) AS BIGINT) AS n_values FROM bars"
    for i, (c, t) in enumerate(_BAR_COLUMNS)), ctes=("bars",))
def q_schema(fx):
    return io.table_schema(fx.bars, "bars")


@register("filter_window", """
SELECT ticker, trading_date FROM bars
WHERE trading_date >= DATE '2001-11-04' - INTERVAL 365 DAY AND trading_date <= DATE '2001-11-04'""",
          ctes=("bars",))
def q_window(fx):
    return io.date_window(fx.bars, ASOF, 365).select("ticker", "trading_date")


@register("filter_ticker_date", """
SELECT ticker, trading_date, 'ticker' AS filter FROM bars WHERE ticker = '17'
UNION ALL SELECT ticker, trading_date, 'date' FROM bars WHERE trading_date = DATE '2000-06-15'""",
          ctes=("bars",))
def q_ticker_date(fx):
    b = fx.bars.select("ticker", "trading_date")
    return (b.filter(c_("ticker") == "17").withColumn("filter", F.lit("ticker"))
            .unionByName(b.filter(c_("trading_date") == F.lit("2000-06-15").cast("date"))
                         .withColumn("filter", F.lit("date"))))


@register("filter_labels", """
SELECT ticker, trading_date, direction_5d FROM o_labels
WHERE direction_5d IS NOT NULL AND direction_5d IN ('Up', 'Down')""", ctes=("o_labels",))
def q_labels(fx):
    lab_ = dv.bar_labels(fx)
    return lab_.filter(c_("direction_5d").isNotNull() & c_("direction_5d").isin("Up", "Down")).select(
        "ticker", "trading_date", "direction_5d")


@register("query_predictions", f"""
SELECT prediction_id, trading_date, ticker, {r4_sql('confidence')} AS confidence FROM o_export
WHERE trading_date >= DATE '2001-01-01' AND trading_date <= DATE '2001-06-30' AND confidence >= 6e-1
ORDER BY trading_date DESC, confidence DESC""", ctes=("o_export",))
def q_query_predictions(fx, start="2001-01-01", end="2001-06-30", ticker=None, min_conf=0.6):
    """Optional conjunctive filters, newest and most confident first."""
    rows = sig.export_predictions(dv.signals(fx))
    conds = [c for c in (
        (c_("trading_date") >= F.lit(start).cast("date")) if start else None,
        (c_("trading_date") <= F.lit(end).cast("date")) if end else None,
        (c_("ticker") == ticker) if ticker else None,
        (c_("confidence") >= min_conf) if min_conf is not None else None) if c is not None]
    cond = F.lit(True)
    for c in conds:
        cond = cond & c
    return (rows.filter(cond).orderBy(c_("trading_date").desc(), c_("confidence").desc())
            .select("prediction_id", "trading_date", "ticker", r4("confidence").alias("confidence")))


@register("export_filters", f"""
SELECT 'all' AS filter, CAST(COUNT(*) AS BIGINT) AS n FROM o_export
UNION ALL SELECT 'high-confidence', CAST(COUNT_IF(high_confidence) AS BIGINT) FROM o_export
UNION ALL SELECT 'buy-signals', CAST(COUNT_IF({dv.CLASSIFY_SQL.format(s='predicted_signal')} = 'bullish') AS BIGINT)
  FROM o_export
UNION ALL SELECT 'sell-signals', CAST(COUNT_IF({dv.CLASSIFY_SQL.format(s='predicted_signal')} = 'bearish') AS BIGINT)
  FROM o_export
UNION ALL SELECT 'medium-high', CAST(COUNT_IF(confidence > 6e-1) AS BIGINT) FROM o_export""", ctes=("o_export",))
def q_export_filters(fx):
    """The five named export filters (buy/sell use the signal classifier,
    which accepts both Buy/Sell and Up/Down)."""
    rows = sig.export_predictions(dv.signals(fx))
    side = out.classify_signal("predicted_signal")
    conds = {"all": F.lit(True), "high-confidence": c_("high_confidence"), "buy-signals": side == "bullish",
             "sell-signals": side == "bearish", "medium-high": c_("confidence") > 0.6}
    agg = rows.agg(*[F.count_if(v).cast("bigint").alias(k) for k, v in conds.items()])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(k).alias("filter"), c_(f"`{k}`").alias("n"))
                                          for k in conds])).alias("x")).select("x.*")


@register("filter_min_history", """
SELECT ticker, CAST(COUNT(*) AS BIGINT) AS n_rows FROM bars GROUP BY ticker HAVING COUNT(*) >= 50""",
          ctes=("bars",))
def q_min_history(fx):
    b = fx.bars.withColumn("n_rows", F.count(F.lit(1)).over(Window.partitionBy("ticker")))
    return b.filter(c_("n_rows") >= 50).groupBy("ticker").agg(F.first("n_rows").cast("bigint").alias("n_rows"))


@register("drop_incomplete", """
SELECT ticker, trading_date FROM o_feat
WHERE return_10d IS NOT NULL AND price_volatility_20 IS NOT NULL AND regime_sma20_slope IS NOT NULL""",
          ctes=("o_feat",))
def q_drop_incomplete(fx):
    gaps = ["return_10d", "price_volatility_20", "regime_sma20_slope"]
    return features(fx, *gaps).dropna(subset=gaps).select(
        "ticker", "trading_date")


@register("project_contract", f"""
SELECT trading_date, ticker, predicted_signal, {r4_sql('confidence')} AS confidence, signal_strength
FROM o_export""", ctes=("o_export",))
def q_project(fx):
    rows = sig.export_predictions(dv.signals(fx)).withColumn("confidence", r4("confidence"))
    order = ["run_timestamp_missing", "trading_date", "ticker", "predicted_signal", "confidence", "price_target",
             "signal_strength"]
    return io.ordered_projection(rows, order)


@register("contract_violations", """
SELECT 'duplicate_key' AS check_name, CAST(COUNT(*) AS BIGINT) AS violations FROM (
  SELECT trading_date, sector FROM o_sector_sent GROUP BY trading_date, sector HAVING COUNT(*) > 1) d
UNION ALL SELECT 'null_sector', CAST(COUNT_IF(sector IS NULL) AS BIGINT) FROM o_sector_sent
UNION ALL SELECT 'null_score', CAST(COUNT_IF(sentiment_score IS NULL) AS BIGINT) FROM o_sector_sent
UNION ALL SELECT 'ratio_out_of_range',
  CAST(COUNT_IF(positive_ratio < 0 OR positive_ratio > 1 OR negative_ratio < 0 OR negative_ratio > 1) AS BIGINT)
  FROM o_sector_sent""", ctes=("o_sector_sent",))
def q_contract(fx):
    """NOT NULL, range and unique (trading_date, sector) checks as counts."""
    t = sector_sentiment(fx)
    dup = t.groupBy("trading_date", "sector").count().filter(c_("count") > 1)
    checks = t.agg(F.count_if(c_("sector").isNull()).cast("bigint").alias("null_sector"),
                   F.count_if(c_("sentiment_score").isNull()).cast("bigint").alias("null_score"),
                   F.count_if((c_("positive_ratio") < 0) | (c_("positive_ratio") > 1) | (c_("negative_ratio") < 0)
                              | (c_("negative_ratio") > 1)).cast("bigint").alias("ratio_out_of_range"))
    long = checks.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), c_(k).alias("violations"))
                                             for k in ("null_sector", "null_score", "ratio_out_of_range")]))
                         .alias("x")).select("x.*")
    d = dup.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit("duplicate_key").alias("check_name"), "violations")
    return d.unionByName(long)


@register("schema_merge", f"""
SELECT * FROM (
  SELECT prediction_id, ticker, trading_date, correct FROM o_outcomes WHERE prediction_id % 2 = 0
  UNION ALL BY NAME
  SELECT prediction_id, ticker, trading_date, correct, model_version, is_actionable, suppression_reason
  FROM o_outcomes WHERE prediction_id % 2 = 1) u""", ctes=("o_outcomes",))
def q_schema_merge(fx):
    """A10: an older batch without the later columns unions with a newer one."""
    o = dv.outcomes(fx)
    old = o.filter(c_("prediction_id") % 2 == 0).select("prediction_id", "ticker", "trading_date", "correct")
    new = o.filter(c_("prediction_id") % 2 == 1).select("prediction_id", "ticker", "trading_date", "correct",
                                                        "model_version", "is_actionable", "suppression_reason")
    return old.unionByName(new, allowMissingColumns=True)


@register("sink_append", """
SELECT trading_date, CAST(COUNT(*) AS BIGINT) AS count FROM o_outcomes GROUP BY trading_date""",
          ctes=("o_outcomes",))
def q_sink_append(fx):
    """Append outcomes partitioned by date, then read back the row count per date."""
    path = scratch_path(fx.spark, f"sink_append_{uuid.uuid4().hex}")
    io.append_partitioned(dv.outcomes(fx), path)
    return fx.spark.read.parquet(path).groupBy("trading_date").agg(F.count(F.lit(1)).cast("bigint").alias("count"))


@register("sentiment_upsert", """
WITH last2 AS (SELECT DISTINCT trading_date FROM o_sector_sent ORDER BY trading_date DESC LIMIT 2)
SELECT s.trading_date, CAST(COUNT(*) AS BIGINT) AS n,
       CASE WHEN s.trading_date IN (SELECT trading_date FROM last2) THEN 'rerun' ELSE MAX(s.sources) END AS max_sources
FROM o_sector_sent s GROUP BY s.trading_date""", ctes=("o_sector_sent",))
def q_upsert(fx):
    """Write the sentiment table, then replace two dates; other dates stay."""
    path = scratch_path(fx.spark, f"sentiment_{uuid.uuid4().hex}")
    t = sector_sentiment(fx)
    io.replace_dates(t, path)
    last2 = t.select("trading_date").distinct().orderBy(c_("trading_date").desc()).limit(2)
    io.replace_dates(t.join(last2, "trading_date", "left_semi").withColumn("sources", F.lit("rerun")), path)
    return fx.spark.read.parquet(path).groupBy("trading_date").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.max("sources").alias("max_sources"))


@register("sink_csv", f"SELECT * EXCLUDE (run_timestamp) FROM ({REGISTRY['export_predictions'].oracle}) e", ctes=("o_export",))
def q_sink_csv(fx):
    """CSV export of the prediction rows, read back."""
    path = scratch_path(fx.spark, f"export_csv_{uuid.uuid4().hex}")
    rows = sig.export_predictions(dv.signals(fx)).drop("run_timestamp")
    io.write_csv(rows, path)
    back = fx.spark.read.schema(rows.schema).option("header", True).csv(path)
    kept = [f.name for f in q_signals.q_export_predictions(fx).schema.fields if f.name != "run_timestamp"]
    doubles = {f.name for f in rows.schema.fields if f.dataType.typeName() == "double"}
    return back.select(*[r4(c).alias(c) if c in doubles else c_(c) for c in kept])


# ------------------------------------------------------------------ joins
@register("join_bars_rsi", f"""
SELECT b.ticker, b.trading_date, {r4_sql('b.close_price')} AS close_price, {r4_sql('r.RSI')} AS RSI
FROM bars b JOIN rsi r ON r.ticker = b.ticker AND r.trading_date = b.trading_date""", ctes=("bars", "rsi"))
def q_join_bars_rsi(fx):
    j = feat.bars_with_rsi(fx.bars, fx.rsi)
    return j.select("ticker", "trading_date", r4("close_price").alias("close_price"), r4("RSI").alias("RSI"))


@register("latest_fundamentals", f"""
SELECT ticker, fetch_date, {r4_sql('forward_pe')} AS forward_pe FROM (
  SELECT *, RANK() OVER (PARTITION BY ticker ORDER BY fetch_date DESC) AS rk FROM fundamentals) q WHERE rk = 1""",
          ctes=("fundamentals",))
def q_latest_fund(fx):
    f = feat.latest_per_key(fx.fundamentals, "ticker", "fetch_date")
    return f.select("ticker", "fetch_date", r4("forward_pe").alias("forward_pe"))


@register("join_fundamentals", f"""
SELECT ticker, trading_date, sector, {r4_sql('beta')} AS beta, {r4_sql('forward_pe')} AS forward_pe FROM o_enriched""",
          ctes=("o_enriched",))
def q_join_fund(fx):
    b = feat.base_frame(fx)
    return b.select("ticker", "trading_date", "sector", r4("beta").alias("beta"), r4("forward_pe").alias("forward_pe"))


@register("join_indicators", f"""
SELECT ticker, trading_date, {r4_sql('db_atr_14')} AS db_atr_14, Trend_Status, {r4_sql('fib_distance_pct')} AS
       fib_distance_pct, pattern_signal, has_doji FROM o_enriched""", ctes=("o_enriched",))
def q_join_ind(fx):
    f = feat.join_indicators(feat.base_frame(fx), feat.indicator_inputs(fx))
    return f.select("ticker", "trading_date", r4("db_atr_14").alias("db_atr_14"), "Trend_Status",
                    r4("fib_distance_pct").alias("fib_distance_pct"), "pattern_signal", "has_doji")


@register("join_market_context", f"""
SELECT ticker, trading_date, {r4_sql('vix_close')} AS vix_close, {r4_sql('nasdaq_comp_return_1d * 1e4')}
       AS nasdaq_return_bp FROM o_enriched""", ctes=("o_enriched",))
def q_join_ctx(fx):
    f = feat.join_market_context(feat.base_frame(fx), fx.market_context)
    return f.select("ticker", "trading_date", r4("vix_close").alias("vix_close"),
                    r4(c_("nasdaq_comp_return_1d") * 1e4).alias("nasdaq_return_bp"))


@register("join_calendar", """
SELECT ticker, trading_date, is_pre_holiday, is_month_end, days_until_next_holiday FROM o_enriched""",
          ctes=("o_enriched",))
def q_join_cal(fx):
    f = feat.join_calendar(feat.base_frame(fx), fx.calendar_features)
    return f.select("ticker", "trading_date", "is_pre_holiday", "is_month_end", "days_until_next_holiday")


@register("join_sentiment", f"""
SELECT e.ticker, e.trading_date, e.sector, {r4_sql('e.sector_sentiment_score')} AS sector_sentiment_score,
       {r4_sql('e.sector_news_volume')} AS sector_news_volume FROM o_enriched e""", ctes=("o_enriched",))
def q_join_sent(fx):
    """C7 on the bars' own keys."""
    j = feat.join_sentiment(feat.base_frame(fx).select("ticker", "trading_date", "sector"), sector_sentiment(fx))
    return j.select("ticker", "trading_date", "sector", r4("sector_sentiment_score").alias("sector_sentiment_score"),
                    r4("sector_news_volume").alias("sector_news_volume"))


@register("semi_tickers", """
SELECT b.ticker, b.trading_date FROM bars b
WHERE b.ticker IN (SELECT ticker FROM securities WHERE sector IN ('Technology', 'Energy'))""",
          ctes=("bars", "securities"))
def q_semi(fx):
    keep = fx.securities.filter(c_("sector").isin("Technology", "Energy")).select("ticker")
    return fx.bars.join(checked_broadcast(keep), "ticker", "left_semi").select("ticker", "trading_date")


@register("export_technical", f"""
WITH b AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trading_date DESC) AS rn
                          FROM o_export) q WHERE rn = 1),
t AS (SELECT ticker, ARG_MAX(RSI, trading_date) FILTER (WHERE RSI IS NOT NULL) AS RSI,
             ARG_MAX(sma_20, trading_date) FILTER (WHERE sma_20 IS NOT NULL) AS sma_20 FROM o_feat GROUP BY ticker)
SELECT b.ticker, b.trading_date, {r4_sql('COALESCE(t.RSI, b.RSI)')} AS RSI, {r4_sql('t.sma_20')} AS sma_20
FROM b LEFT JOIN t ON t.ticker = b.ticker""", ctes=("o_export", "o_feat"))
def q_export_tech(fx):
    """Latest prediction per ticker joined to latest technical values;
    the technical value wins where both exist."""
    from barloom.plans.q_signals import latest_nonnull
    rows = sig.export_predictions(dv.signals(fx))
    w = Window.partitionBy("ticker").orderBy(c_("trading_date").desc())
    base = rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").alias("b")
    tech = latest_nonnull(features(fx, "RSI", "sma_20"), ["RSI", "sma_20"]).drop("trading_date").alias("t")
    j = base.join(tech, c_("b.ticker") == c_("t.ticker"), "left")
    return j.select(c_("b.ticker").alias("ticker"), c_("b.trading_date").alias("trading_date"),
                    r4(F.coalesce(c_("t.RSI"), c_("b.RSI"))).alias("RSI"), r4(c_("t.sma_20")).alias("sma_20"))


@register("top_buy_latest", f"""
SELECT p.ticker, s.sector, {r4_sql('p.up_probability')} AS up_probability FROM o_signals p
LEFT JOIN securities s ON s.ticker = p.ticker
WHERE p.trading_date = (SELECT MAX(trading_date) FROM o_signals) AND p.predicted_signal = 'Up'
ORDER BY p.up_probability DESC, p.ticker LIMIT 20""", ctes=("o_signals", "securities"))
def q_top_buy(fx):
    """Top 20 buys on the latest date (scalar subquery for the date)."""
    s = dv.signals(fx)
    latest = s.select(F.max("trading_date")).scalar()
    top = (s.filter((c_("trading_date") == latest) & (c_("predicted_signal") == "Up"))
           .orderBy(c_("up_probability").desc(), c_("ticker")).limit(20))
    return top.join(checked_broadcast(fx.securities.select("ticker", c_("sector").alias("sec"))), "ticker", "left") \
        .select("ticker", c_("sec").alias("sector"), r4("up_probability").alias("up_probability"))


@register("align_frames", """
SELECT f.ticker, f.trading_date FROM o_feat f
WHERE EXISTS (SELECT 1 FROM o_labels l WHERE l.ticker = f.ticker AND l.trading_date = f.trading_date)""",
          ctes=("o_feat", "o_labels"))
def q_align(fx):
    """Rows present in both the feature frame and the label frame."""
    return features(fx, "ticker", "trading_date").join(
        dv.bar_labels(fx).select("ticker", "trading_date"), ["ticker", "trading_date"], "left_semi")
