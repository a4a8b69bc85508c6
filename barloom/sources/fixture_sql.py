"""Fixture SQL: derives the pipeline's input tables from the test tables.

Each text runs unchanged in Spark SQL and in DuckDB. Table references are
written ``{name}`` so Spark can bind DataFrames (``spark.sql(text, name=df)``)
and the oracle can bind CTE names. Fixed values (sector names, signal labels,
keywords, lexicon) are part of the fixture specification in FIXTURES.md.
"""

from __future__ import annotations


BARS_SQL = """
WITH t AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS trading_date, l_quantity, l_extendedprice AS o,
         l_extendedprice * (1 + l_tax) AS h, l_extendedprice * (1 - l_discount) AS l,
         l_extendedprice * (1 + (l_tax - l_discount) / 2) AS c,
         ROW_NUMBER() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
           ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_tax, l_discount) AS rn_a,
         ROW_NUMBER() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
           ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC,
                    l_quantity DESC, l_tax DESC, l_discount DESC) AS rn_d
  FROM {lineitem})
SELECT CAST(l_suppkey AS STRING) AS ticker, CONCAT('Company ', CAST(l_suppkey AS STRING)) AS company, trading_date,
       MAX(CASE WHEN rn_a = 1 THEN o END) AS open_price, MAX(h) AS high_price, MIN(l) AS low_price,
       MAX(CASE WHEN rn_d = 1 THEN c END) AS close_price, CAST(SUM(l_quantity) AS BIGINT) AS volume
FROM t GROUP BY l_suppkey, trading_date
"""

RSI_SQL = """
WITH d AS (
  SELECT ticker, trading_date,
         close_price - LAG(close_price) OVER (PARTITION BY ticker ORDER BY trading_date) AS ch FROM {bars}),
g AS (
  SELECT ticker, trading_date, AVG(CASE WHEN ch > 0 THEN ch ELSE 0e0 END) OVER w AS ag,
         AVG(CASE WHEN ch < 0 THEN -ch ELSE 0e0 END) OVER w AS al, COUNT(ch) OVER w AS n
  FROM d WINDOW w AS (PARTITION BY ticker ORDER BY trading_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
r AS (
  SELECT ticker, trading_date,
         CASE WHEN n < 14 THEN NULL WHEN ag + al = 0 THEN 5e1
              ELSE FLOOR(1e2 * ag / (ag + al) * 1e4 + 0.501) / 1e4 END AS RSI FROM g)
SELECT ticker, trading_date, RSI,
       CASE WHEN RSI < 30 THEN 'Oversold (Buy)' WHEN RSI > 70 THEN 'Overbought (Sell)' END AS rsi_trade_signal
FROM r
"""

SECURITIES_SQL = """
SELECT CAST(s_suppkey AS STRING) AS ticker,
       CASE s_nationkey % 12 WHEN 0 THEN 'Technology' WHEN 1 THEN 'Financial Services' WHEN 2 THEN 'Energy'
         WHEN 3 THEN 'Healthcare' WHEN 4 THEN 'Industrials' WHEN 5 THEN 'Communication Services'
         WHEN 6 THEN 'Consumer Cyclical' WHEN 7 THEN 'Consumer Defensive' WHEN 8 THEN 'Basic Materials'
         WHEN 9 THEN 'Real Estate' WHEN 10 THEN 'Utilities' END AS sector
FROM {supplier}
"""

FUNDAMENTALS_SQL = """
SELECT CAST(l_suppkey AS STRING) AS ticker, MAX(CAST(l_shipdate AS DATE)) AS fetch_date,
       CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE MAX(l_discount) * 2e1 - MIN(l_tax) * 1e1 END AS beta,
       CASE WHEN l_suppkey % 7 = 0 THEN 0e0 ELSE MAX(l_quantity) - MIN(l_discount) * 1e2 END AS forward_pe,
       MAX(l_quantity) AS trailing_pe, MAX(l_tax) AS profit_margin, MIN(l_tax) AS revenue_growth,
       MIN(l_discount) AS earnings_growth, MIN(l_quantity) AS debt_to_equity,
       CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE MAX(l_discount) END AS return_on_equity,
       COUNT(*) / 1e1 AS current_ratio, MIN(l_discount) / 2e0 AS dividend_yield,
       MAX(l_extendedprice) AS fifty_two_week_high, MIN(l_extendedprice) AS fifty_two_week_low,
       (MAX(l_extendedprice) + MIN(l_extendedprice)) / 2e0 AS two_hundred_day_avg
FROM {lineitem} GROUP BY l_suppkey, EXTRACT(YEAR FROM l_shipdate)
"""

MARKET_CONTEXT_SQL = """
WITH d AS (
  SELECT trading_date, MAX(close_price) AS c, MIN(low_price) AS l, MAX(high_price) AS h, CAST(SUM(volume) AS BIGINT) AS v
  FROM {bars} GROUP BY trading_date),
r AS (
  SELECT trading_date, c, l, h, v, c / LAG(c) OVER (ORDER BY trading_date) - 1 AS rc,
         l / LAG(l) OVER (ORDER BY trading_date) - 1 AS rl, h / LAG(h) OVER (ORDER BY trading_date) - 1 AS rh FROM d)
SELECT trading_date, 12e0 + 3e1 * l / h AS vix_close, rh / 1e1 AS vix_change_pct, l AS sp500_close, rl / 1e2 AS sp500_return_1d,
       c AS nasdaq_comp_close, rc / 1e2 AS nasdaq_comp_return_1d, v / 1e2 AS dxy_close, (rl - rc) / 1e3 AS dxy_return_1d,
       4e0 + l / h AS us_10y_yield_close, rl / 1e3 AS us_10y_yield_change,
       rc / 9e1 AS xlk_return_1d, rc / 1.1e2 AS xlf_return_1d, rl / 9e1 AS xle_return_1d, rl / 1.1e2 AS xlv_return_1d,
       rh / 9e1 AS xli_return_1d, rh / 1.1e2 AS xlc_return_1d, rc / 1.2e2 AS xly_return_1d, rl / 1.2e2 AS xlp_return_1d,
       rh / 1.2e2 AS xlb_return_1d, rc / 1.3e2 AS xlre_return_1d, rl / 1.3e2 AS xlu_return_1d
FROM r
"""

CALENDAR_FEATURES_SQL = """
WITH d AS (SELECT DISTINCT trading_date FROM {bars}),
e AS (
  SELECT trading_date, ROW_NUMBER() OVER (ORDER BY trading_date) AS rn, EXTRACT(MONTH FROM trading_date) AS m,
         EXTRACT(MONTH FROM LEAD(trading_date) OVER (ORDER BY trading_date)) AS m_next,
         EXTRACT(MONTH FROM LAG(trading_date) OVER (ORDER BY trading_date)) AS m_prev,
         EXTRACT(DAY FROM trading_date) AS dd FROM d),
x AS (SELECT e.*, 'NASDAQ' AS market, 0 AS off FROM e UNION ALL SELECT e.*, 'NSE' AS market, 1 AS off FROM e)
SELECT trading_date AS calendar_date, market, CAST(CASE WHEN (rn + off) % 40 = 39 THEN 1 ELSE 0 END AS INT) AS is_pre_holiday,
       CAST(CASE WHEN (rn + off) % 40 = 1 THEN 1 ELSE 0 END AS INT) AS is_post_holiday,
       CAST(CASE WHEN (rn + off) % 40 IN (38, 39, 1, 2) THEN 1 ELSE 0 END AS INT) AS is_short_week,
       CAST(CASE WHEN (rn + off) % 40 IN (38, 39, 1, 2) THEN 4 ELSE 5 END AS INT) AS trading_days_in_week,
       CAST(CASE WHEN m <> m_next THEN 1 ELSE 0 END AS INT) AS is_month_end,
       CAST(CASE WHEN m <> m_prev THEN 1 ELSE 0 END AS INT) AS is_month_start,
       CAST(CASE WHEN m <> m_next AND m % 3 = 0 THEN 1 ELSE 0 END AS INT) AS is_quarter_end,
       CAST(CASE WHEN dd BETWEEN 15 AND 21 THEN 1 ELSE 0 END AS INT) AS is_options_expiry,
       CAST(40 - (rn + off) % 40 AS INT) AS days_until_next_holiday, CAST((rn + off) % 40 AS INT) AS days_since_last_holiday,
       CAST(CASE WHEN (rn + off) % 40 = 5 THEN 1 ELSE 0 END AS INT) AS other_market_closed
FROM x
"""

MARKET_CALENDAR_SQL = """
WITH d AS (SELECT trading_date, ROW_NUMBER() OVER (ORDER BY trading_date) AS rn FROM (SELECT DISTINCT trading_date FROM {bars}) q)
SELECT trading_date AS calendar_date, 'NASDAQ' AS market, rn % 40 <> 0 AS is_trading_day, rn % 40 = 0 AS is_holiday,
       CASE WHEN rn % 80 = 0 THEN 'Fixture Day' WHEN rn % 40 = 0 THEN '' END AS holiday_name
FROM d WHERE rn % 50 <> 0
"""

BANDS_ATR_MACD_STOCH_SQL = """
SELECT ticker, trading_date, 1 AS load_seq, close_price * 1.1e0 AS Upper_Band, close_price * 9e-1 AS Lower_Band,
       close_price AS SMA_20, high_price - low_price AS ATR_14, close_price - open_price AS MACD,
       (close_price - open_price) / 2e0 AS Signal_Line,
       CASE WHEN volume % 5 = 0 THEN NULL ELSE CAST(volume % 100 AS DOUBLE) END AS stoch_14d_k,
       CAST(volume % 90 AS DOUBLE) AS stoch_14d_d, CAST(volume % 10 AS DOUBLE) - 5e0 AS momentum_strength
FROM {bars} WHERE CAST(ticker AS INT) % 2 = 0
"""

SMA_MACD_SIGNALS_SQL = """
WITH b AS (
  SELECT ticker, trading_date, close_price, volume, 1 AS load_seq FROM {bars}
  UNION ALL
  SELECT ticker, trading_date, close_price, volume, 2 AS load_seq FROM {bars} WHERE volume % 10 = 0)
SELECT ticker, trading_date, load_seq, close_price * 9.9e-1 AS EMA_100, close_price * 9.8e-1 AS EMA_200,
       CASE (volume + load_seq) % 6 WHEN 0 THEN 'STRONG_UPTREND' WHEN 1 THEN 'UPTREND' WHEN 2 THEN 'NEUTRAL'
         WHEN 3 THEN 'DOWNTREND' WHEN 4 THEN 'STRONG_DOWNTREND' ELSE 'UNLISTED' END AS Trend_Status,
       CASE volume % 3 WHEN 0 THEN 'GOLDEN_CROSS_ZONE' WHEN 1 THEN 'DEATH_CROSS_ZONE' ELSE 'NEUTRAL' END AS SMA_Cross_Status,
       CASE volume % 8 WHEN 0 THEN 'Golden Cross' WHEN 1 THEN 'Death Cross' END AS sma_trade_signal,
       CASE volume % 4 WHEN 0 THEN 'Bullish Crossover' WHEN 1 THEN 'Bearish Crossover' ELSE 'No Signal' END AS macd_trade_signal
FROM b
"""

FIB_SR_PATTERNS_SQL = """
WITH b AS (
  SELECT ticker, trading_date, open_price, high_price, low_price, close_price, volume, 1 AS load_seq FROM {bars}
  UNION ALL
  SELECT ticker, trading_date, open_price, high_price, low_price, close_price, volume, 2 AS load_seq FROM {bars}
  WHERE volume % 12 = 0)
SELECT ticker, trading_date, load_seq, CAST(volume % 50 AS DOUBLE) / 1e1 AS distance_to_nearest_fib_pct,
       CASE volume % 7 WHEN 0 THEN 'BUY_FIB_500' WHEN 1 THEN 'BUY_FIB_382' WHEN 2 THEN 'SELL' WHEN 3 THEN 'STRONG_BUY'
         WHEN 4 THEN 'STRONG_SELL' ELSE 'NEUTRAL_WAIT' END AS fib_trade_signal,
       (close_price - low_price) / close_price * 1e2 AS distance_to_s1_pct,
       (high_price - close_price) / close_price * 1e2 AS distance_to_r1_pct,
       CASE WHEN close_price > open_price THEN 'ABOVE_PIVOT' WHEN close_price < open_price THEN 'BELOW_PIVOT' END AS pivot_status,
       CASE (volume + load_seq) % 5 WHEN 0 THEN 'NEAR_SUPPORT_BUY' WHEN 1 THEN 'BULLISH_ZONE' WHEN 2 THEN 'BEARISH_ZONE'
         WHEN 3 THEN 'NEAR_RESISTANCE_SELL' END AS sr_trade_signal,
       CASE volume % 4 WHEN 0 THEN 'BULLISH' WHEN 1 THEN 'BUY' WHEN 2 THEN 'SELL' END AS pattern_signal,
       CASE WHEN volume % 9 = 0 THEN 'Doji' END AS doji, CASE WHEN volume % 11 = 0 THEN 'Hammer' END AS hammer,
       CASE WHEN volume % 13 = 0 THEN 'Shooting Star' END AS shooting_star,
       CASE WHEN volume % 17 = 0 THEN 'Bullish Engulfing' END AS bullish_engulfing,
       CASE WHEN volume % 19 = 0 THEN 'Bearish Engulfing' END AS bearish_engulfing,
       CASE WHEN volume % 23 = 0 THEN 'Morning Star' END AS morning_star,
       CASE WHEN volume % 29 = 0 THEN 'Evening Star' END AS evening_star
FROM b
"""

ARTICLES_SQL = """
SELECT doc_id AS seq, SPLIT_PART(text, CHR(10), 1) AS title,
       CASE WHEN doc_id % 9 = 0 THEN '' ELSE SUBSTRING(text, LENGTH(SPLIT_PART(text, CHR(10), 1)) + 2) END AS summary,
       DATE '2001-10-01' + CAST(doc_id % 30 AS INT) AS published, source,
       CASE WHEN doc_id % 16 = 0 THEN 'Energy' WHEN doc_id % 16 = 4 THEN 'Technology' WHEN doc_id % 16 = 8 THEN 'Utilities' END AS sector_hint,
       doc_id % 13 = 0 AS is_market
FROM {documents}
"""

SECTOR_KEYWORDS_SQL = """
SELECT sector, keyword FROM (VALUES ('Technology', 'Tha'), ('Technology', 'her'), ('Financial Services', 'ing'), ('Energy', 'ou'),
  ('Healthcare', 'sch'), ('Industrials', 'ein'), ('Communication Services', 'ment'), ('Consumer Cyclical', 'eaux'),
  ('Consumer Defensive', 'ado'), ('Basic Materials', 'ción'), ('Real Estate', 'whou'), ('Utilities', 'zzqx')) AS t(sector, keyword)
"""

LEXICON_SQL = """
SELECT token, weight FROM (VALUES ('the', 1.5e0), ('that', -1.2e0), ('and', 5e-1), ('le', 9e-1), ('la', -7e-1), ('un', -1.1e0),
  ('ein', 1e0), ('der', -8e-1), ('el', 6e-1), ('in', -4e-1)) AS t(token, weight)
"""

PREDICTIONS_SQL = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY b.ticker, b.trading_date) AS BIGINT) AS prediction_id,
       CAST(b.trading_date AS TIMESTAMP) + INTERVAL '18' HOUR AS run_timestamp, b.trading_date, b.ticker, b.company,
       CASE WHEN b.high_price > b.low_price
            THEN 5e-1 + 3e-1 * (b.close_price - b.open_price) / (b.high_price - b.low_price) ELSE 5e-1 END AS up_probability,
       b.close_price, r.RSI, s.sector
FROM {bars} b LEFT JOIN {rsi} r ON r.ticker = b.ticker AND r.trading_date = b.trading_date
            LEFT JOIN {securities} s ON s.ticker = b.ticker
"""

FIXTURE_SQL = {
    "bars": BARS_SQL,
    "rsi": RSI_SQL,
    "securities": SECURITIES_SQL,
    "fundamentals": FUNDAMENTALS_SQL,
    "market_context": MARKET_CONTEXT_SQL,
    "calendar_features": CALENDAR_FEATURES_SQL,
    "market_calendar": MARKET_CALENDAR_SQL,
    "bands_atr_macd_stoch": BANDS_ATR_MACD_STOCH_SQL,
    "sma_macd_signals": SMA_MACD_SIGNALS_SQL,
    "fib_sr_patterns": FIB_SR_PATTERNS_SQL,
    "articles": ARTICLES_SQL,
    "sector_keywords": SECTOR_KEYWORDS_SQL,
    "lexicon": LEXICON_SQL,
    "predictions": PREDICTIONS_SQL,
}

FIXTURE_DEPS = {
    "bars": ['lineitem'],
    "rsi": ['bars'],
    "securities": ['supplier'],
    "fundamentals": ['lineitem'],
    "market_context": ['bars'],
    "calendar_features": ['bars'],
    "market_calendar": ['bars'],
    "bands_atr_macd_stoch": ['bars'],
    "sma_macd_signals": ['bars'],
    "fib_sr_patterns": ['bars'],
    "articles": ['documents'],
    "sector_keywords": [],
    "lexicon": [],
    "predictions": ['bars', 'rsi', 'securities'],
}
