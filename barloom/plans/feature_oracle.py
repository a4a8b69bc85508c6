"""DuckDB oracle SQL for the enriched frame and the feature table.

Written independently of the DataFrame code, straight from the feature
definitions, so the two sides check each other.
"""

from __future__ import annotations

from barloom.functions.codes import (
    CROSS_STATUS_CODES, MACD_SIGNAL_CODES, POSITION_CODES, SMA_SIGNAL_CODES, TRADE_SIGNAL_CODES,
    TREND_STATUS_CODES, code_sql, sector_etf_sql,
)
from barloom.functions.ema import ema_sql
from barloom.operators.features import CALENDAR_COLUMNS, CONTEXT_COLUMNS, PATTERN_FLAGS, SENTIMENT_RENAMES
from barloom.plans import q_sentiment  # noqa: F401  (registers o_sector_sent)
from barloom.plans.catalog import oracle_cte

W = "PARTITION BY ticker ORDER BY trading_date"


def rw(n_back: int) -> str:
    return f"({W} ROWS BETWEEN {n_back} PRECEDING AND CURRENT ROW)"


def clip_sql(x: str, lo: str | None = None, hi: str | None = None) -> str:
    """pandas clip: NULL stays NULL (DuckDB GREATEST/LEAST skip NULLs)."""
    e = x
    if lo is not None:
        e = f"GREATEST({e}, {lo})"
    if hi is not None:
        e = f"LEAST({e}, {hi})"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE {e} END"


def ratio(num: str, den: str, default: str) -> str:
    return f"CASE WHEN {den} > 0 THEN {num} / {den} ELSE {default} END"


ENRICHED_SQL = f"""
WITH b AS (SELECT * FROM bars WHERE close_price >= 5e0 AND volume > 0),
br AS (
  SELECT b.ticker, b.trading_date, b.open_price, b.high_price, b.low_price, b.close_price, b.volume,
         r.RSI, r.rsi_trade_signal
  FROM b JOIN rsi r ON r.ticker = b.ticker AND r.trading_date = b.trading_date),
fl AS (
  SELECT * EXCLUDE (fetch_date, rk) FROM (
    SELECT *, RANK() OVER (PARTITION BY ticker ORDER BY fetch_date DESC) AS rk FROM fundamentals) q
  WHERE rk = 1),
bam AS (
  SELECT ticker, trading_date, Upper_Band AS db_bb_upper, Lower_Band AS db_bb_lower, SMA_20 AS db_bb_sma20,
         ATR_14 AS db_atr_14, MACD AS db_macd, Signal_Line AS db_macd_signal, stoch_14d_k AS db_stoch_k,
         stoch_14d_d AS db_stoch_d, momentum_strength AS db_stoch_momentum
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, trading_date ORDER BY load_seq DESC) AS rn
        FROM bands_atr_macd_stoch) q WHERE rn = 1),
sm AS (
  SELECT ticker, trading_date, EMA_100 AS db_ema_100, EMA_200 AS db_ema_200, Trend_Status, SMA_Cross_Status,
         sma_trade_signal, macd_trade_signal AS macd_crossover_signal
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, trading_date ORDER BY load_seq DESC) AS rn
        FROM sma_macd_signals) q WHERE rn = 1),
fs AS (
  SELECT ticker, trading_date, distance_to_nearest_fib_pct AS fib_distance_pct, fib_trade_signal,
         distance_to_s1_pct AS sr_distance_to_support_pct, distance_to_r1_pct AS sr_distance_to_resistance_pct,
         pivot_status, sr_trade_signal, pattern_signal,
         {", ".join(f"CAST({p} IS NOT NULL AS INT) AS has_{p}" for p in PATTERN_FLAGS)}
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, trading_date ORDER BY load_seq DESC) AS rn
        FROM fib_sr_patterns) q WHERE rn = 1),
cal AS (SELECT calendar_date, {", ".join(CALENDAR_COLUMNS)} FROM calendar_features WHERE market = 'NASDAQ')
SELECT br.*, fl.* EXCLUDE (ticker), s.sector,
       bam.* EXCLUDE (ticker, trading_date), sm.* EXCLUDE (ticker, trading_date),
       fs.* EXCLUDE (ticker, trading_date),
       {", ".join(f"mc.{c}" for c in CONTEXT_COLUMNS)},
       {", ".join(f"cal.{c}" for c in CALENDAR_COLUMNS)},
       {", ".join(f"COALESCE({'LN(1 + ss.news_count)' if k == 'news_count' else f'ss.{k}'}, 0e0) AS {v}"
                  for k, v in SENTIMENT_RENAMES.items())},
       COALESCE(ss.market_sentiment_score, 0e0) AS market_sentiment_score
FROM br
LEFT JOIN fl ON fl.ticker = br.ticker
LEFT JOIN securities s ON s.ticker = br.ticker
LEFT JOIN bam ON bam.ticker = br.ticker AND bam.trading_date = br.trading_date
LEFT JOIN sm ON sm.ticker = br.ticker AND sm.trading_date = br.trading_date
LEFT JOIN fs ON fs.ticker = br.ticker AND fs.trading_date = br.trading_date
LEFT JOIN market_context mc ON mc.trading_date = br.trading_date
LEFT JOIN cal ON cal.calendar_date = br.trading_date
LEFT JOIN o_sector_sent ss ON ss.trading_date = br.trading_date AND ss.sector = s.sector
"""

oracle_cte("o_enriched", ("bars", "rsi", "fundamentals", "securities", "bands_atr_macd_stoch",
                          "sma_macd_signals", "fib_sr_patterns", "market_context", "calendar_features", "o_sector_sent"),
           ENRICHED_SQL)

_ANY = "(SELECT MAX(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END) FROM o_enriched) = 1"
HAS_BANDS, HAS_ATR, HAS_STOCH = (_ANY.format(c=c) for c in ("db_bb_upper", "db_atr_14", "db_stoch_k"))

L0 = f"""
SELECT e.*,
  ROW_NUMBER() OVER ({W}) - 1 AS i,
  LAG(close_price, 1) OVER ({W}) AS c1, LAG(close_price, 2) OVER ({W}) AS c2,
  LAG(close_price, 3) OVER ({W}) AS c3, LAG(close_price, 5) OVER ({W}) AS c5,
  LAG(close_price, 10) OVER ({W}) AS c10, LAG(close_price, 20) OVER ({W}) AS c20,
  LAG(open_price, 1) OVER ({W}) AS o1, LAG(high_price, 1) OVER ({W}) AS h1,
  LAG(low_price, 1) OVER ({W}) AS l1, LAG(volume, 1) OVER ({W}) AS v1,
  LAG(RSI, 1) OVER ({W}) AS rsi1, LAG(RSI, 5) OVER ({W}) AS rsi5,
  LEAD(close_price, 1) OVER ({W}) AS next_1d_close, LEAD(close_price, 3) OVER ({W}) AS next_3d_close,
  LEAD(close_price, 5) OVER ({W}) AS next_5d_close,
  {", ".join(f"AVG(close_price) OVER {rw(n - 1)} AS sma_{n}" for n in (5, 10, 20, 50, 100, 200))},
  {", ".join(f"COUNT(close_price) OVER {rw(n - 1)} AS n{n}" for n in (5, 10, 20, 50, 100, 200))},
  STDDEV_SAMP(close_price) OVER {rw(19)} AS sd20,
  MIN(low_price) OVER {rw(13)} AS low14, MAX(high_price) OVER {rw(13)} AS high14,
  AVG(volume) OVER {rw(19)} AS volume_sma_20,
  FIRST_VALUE(close_price) OVER {rw(9)} AS first10, COUNT(*) OVER {rw(9)} AS cnt10,
  STDDEV_SAMP(close_price) OVER {rw(9)} AS sd10c,
  {sector_etf_sql()} AS sector_etf_return_1d,
  SUM({sector_etf_sql()}) OVER {rw(4)} AS etf5,
  AVG((high_price - low_price) / close_price) OVER {rw(4)} AS hl5,
  COUNT((high_price - low_price) / close_price) OVER {rw(4)} AS hl5n
FROM o_enriched e
"""

RET1 = "(close_price / CASE WHEN c1 <> 0 THEN c1 END - 1e0)"
TR = ("CASE WHEN c1 IS NOT NULL THEN GREATEST(high_price - low_price, ABS(high_price - c1), "
      "ABS(low_price - c1)) END")
UP, DOWN = "(high_price - h1)", "(l1 - low_price)"
POS_DM = f"CASE WHEN COALESCE({UP} > {DOWN} AND {UP} > 0, FALSE) THEN {UP} ELSE 0e0 END"
NEG_DM = f"CASE WHEN COALESCE({DOWN} > {UP} AND {DOWN} > 0, FALSE) THEN {DOWN} ELSE 0e0 END"
K_CALC = ("CASE WHEN high14 - low14 > 0 THEN (close_price - low14) / (high14 - low14) * 100 ELSE 5e1 END")
STOCH_K = f"CASE WHEN {HAS_STOCH} THEN COALESCE(db_stoch_k, {K_CALC}) ELSE {K_CALC} END"
CONSIST = ("CAST(COALESCE(SIGN(close_price - c1) = SIGN(close_price - c20), FALSE) AS DOUBLE)")

L1 = f"""
SELECT a.*,
  STDDEV_SAMP({RET1}) OVER {rw(9)} AS price_volatility_10,
  STDDEV_SAMP({RET1}) OVER {rw(19)} AS price_volatility_20,
  STDDEV_SAMP({RET1}) OVER {rw(59)} AS vol60,
  AVG({TR}) OVER {rw(13)} AS atr_calc,
  AVG({POS_DM}) OVER {rw(13)} AS pdm14, AVG({NEG_DM}) OVER {rw(13)} AS ndm14,
  AVG({CONSIST}) OVER {rw(19)} AS regime_trend_consistency,
  LAG(sma_20, 5) OVER ({W}) AS sma20_5,
  {STOCH_K} AS stochastic_k,
  AVG({STOCH_K}) OVER {rw(2)} AS stoch_d_calc,
  {ema_sql("close_price", 5)} AS ema_5, {ema_sql("close_price", 10)} AS ema_10,
  {ema_sql("close_price", 20)} AS ema_20, {ema_sql("close_price", 50)} AS ema_50,
  {ema_sql("close_price", 12)} - {ema_sql("close_price", 26)} AS macd
FROM l0 a
"""

DX = "CASE WHEN pdm14 + ndm14 > 0 THEN ABS(pdm14 - ndm14) / (pdm14 + ndm14) * 100 ELSE 0e0 END"
L2 = f"""
SELECT a.*, AVG({DX}) OVER {rw(13)} AS regime_adx, {ema_sql("macd", 9)} AS macd_signal
FROM l1 a
"""

BB_UP = f"CASE WHEN {HAS_BANDS} THEN db_bb_upper ELSE sma_20 + 2 * sd20 END"
BB_LO = f"CASE WHEN {HAS_BANDS} THEN db_bb_lower ELSE sma_20 - 2 * sd20 END"
BB_RNG = f"(({BB_UP}) - ({BB_LO}))"
ATR = f"(CASE WHEN {HAS_ATR} THEN COALESCE(db_atr_14, atr_calc) ELSE atr_calc END)"
RET = "(close_price / CASE WHEN {l} <> 0 THEN {l} END - 1e0)"
RET5 = RET.format(l="c5")
RNG = "(high_price - low_price)"
DAILY_RET = "((close_price - open_price) / open_price * 100)"

L3 = f"""
SELECT a.*,
  {RNG} / close_price * 100 AS daily_volatility,
  {DAILY_RET} AS daily_return,
  volume / 1e6 AS volume_millions,
  {RNG} AS price_range,
  CASE WHEN {RNG} > 0 THEN (close_price - low_price) / {RNG} ELSE 5e-1 END AS price_position,
  CASE WHEN close_price > 0 THEN ((open_price - o1) - c1) / close_price * 100 ELSE 0e0 END AS gap_pct,
  open_price - c1 AS gap,
  volume * {DAILY_RET} AS volume_price_trend,
  CAST(COALESCE(RSI < 30, FALSE) AS INT) AS rsi_oversold,
  CAST(COALESCE(RSI > 70, FALSE) AS INT) AS rsi_overbought,
  RSI - rsi1 AS rsi_momentum,
  CAST(ISODOW(trading_date) - 1 AS INT) AS day_of_week,
  CAST(EXTRACT(MONTH FROM trading_date) AS INT) AS month,
  {", ".join(f"CASE WHEN n{n} >= {n} THEN sma_{n} END AS sma_{n}_strict" for n in (5, 10, 20, 50))},
  macd - macd_signal AS macd_histogram,
  {ratio("close_price", "sma_20", "1e0")} AS price_vs_sma20,
  {ratio("close_price", "sma_50", "1e0")} AS price_vs_sma50,
  {ratio("close_price", "ema_20", "1e0")} AS price_vs_ema20,
  {ratio("sma_20", "sma_50", "1e0")} AS sma20_vs_sma50,
  {ratio("ema_20", "ema_50", "1e0")} AS ema20_vs_ema50,
  {ratio("sma_5", "sma_20", "1e0")} AS sma5_vs_sma20,
  {ratio("close_price", "sma_100", "1e0")} AS price_vs_sma100,
  {ratio("close_price", "sma_200", "1e0")} AS price_vs_sma200,
  {code_sql("Trend_Status", TREND_STATUS_CODES)} AS sma_trend_strength,
  {code_sql("SMA_Cross_Status", CROSS_STATUS_CODES)} AS sma_cross_signal,
  {code_sql("sma_trade_signal", SMA_SIGNAL_CODES)} AS sma_trade_strength,
  {code_sql("macd_crossover_signal", MACD_SIGNAL_CODES)} AS macd_signal_strength,
  {ratio("volume", "volume_sma_20", "1e0")} AS volume_sma_ratio,
  (volume / CASE WHEN v1 <> 0 THEN v1 END - 1e0) AS vol_change_ratio,
  {RET5} AS price_momentum_5,
  {RET.format(l="c10")} AS price_momentum_10,
  CASE WHEN cnt10 > 1 AND sd10c <> 0 THEN (close_price - first10) / sd10c ELSE 0e0 END AS trend_strength_10,
  CASE WHEN {BB_RNG} > 0 THEN (close_price - ({BB_LO})) / {BB_RNG} ELSE 5e-1 END AS bollinger_pctb,
  CASE WHEN close_price > 0 THEN {BB_RNG} / close_price ELSE 0e0 END AS bollinger_bandwidth,
  CASE WHEN {HAS_STOCH} THEN COALESCE(db_stoch_d, stoch_d_calc) ELSE stoch_d_calc END AS stochastic_d,
  CASE WHEN {HAS_STOCH} THEN COALESCE(db_stoch_momentum, 0e0) ELSE stochastic_k - stoch_d_calc END
    AS stochastic_momentum,
  {ATR} AS atr_14,
  CASE WHEN close_price > 0 THEN {ATR} / close_price ELSE 0e0 END AS atr_ratio,
  CASE WHEN close_price > 0 THEN macd / close_price * 100 ELSE 0e0 END AS macd_normalized,
  CASE WHEN close_price > 0 THEN macd_signal / close_price * 100 ELSE 0e0 END AS macd_signal_normalized,
  CASE WHEN close_price > 0 THEN (macd - macd_signal) / close_price * 100 ELSE 0e0 END
    AS macd_histogram_normalized,
  {RET.format(l="c1")} AS return_1d, {RET.format(l="c2")} AS return_2d, {RET.format(l="c3")} AS return_3d,
  {RET5} AS return_5d, {RET.format(l="c10")} AS return_10d, {RET.format(l="c20")} AS ret20,
  CAST(COALESCE(SIGN({RET5}) <> SIGN(RSI - rsi5), TRUE) AS INT) AS rsi_price_divergence,
  {ratio("high_price", "low_price", "1e0")} AS high_low_ratio,
  {ratio("close_price", "open_price", "1e0")} AS close_open_ratio,
  CASE WHEN {RNG} > 0 THEN (high_price - GREATEST(open_price, close_price)) / {RNG} ELSE 0e0 END AS upper_shadow,
  CASE WHEN {RNG} > 0 THEN (LEAST(open_price, close_price) - low_price) / {RNG} ELSE 0e0 END AS lower_shadow,
  {code_sql("fib_trade_signal", TRADE_SIGNAL_CODES)} AS fib_signal_strength,
  {code_sql("pivot_status", POSITION_CODES)} AS sr_pivot_position,
  {code_sql("sr_trade_signal", TRADE_SIGNAL_CODES)} AS sr_signal_strength,
  {code_sql("pattern_signal", TRADE_SIGNAL_CODES)} AS pattern_signal_strength,
  {", ".join(f"COALESCE(CAST(has_{p} AS DOUBLE), 0e0) AS has_{p}_f" for p in PATTERN_FLAGS)},
  (sma_20 / sma20_5 - 1e0) * 100 AS regime_sma20_slope,
  CASE WHEN vol60 > 0 THEN price_volatility_10 / vol60 ELSE 1e0 END AS regime_vol_ratio,
  CASE WHEN {ATR} > 0 THEN (close_price - sma_50) / {ATR} ELSE 0e0 END AS regime_mean_reversion,
  CASE WHEN close_price > 0 THEN {RNG} / close_price END AS hl_spread,
  CASE WHEN hl5n >= 5 THEN hl5 END AS hl_spread_5,
  (next_5d_close - close_price) / close_price * 100 AS next_5d_return,
  {ratio("close_price", "fifty_two_week_high", "0e0")} AS price_vs_52wk_high,
  {ratio("close_price", "fifty_two_week_low", "0e0")} AS price_vs_52wk_low,
  {ratio("close_price", "two_hundred_day_avg", "0e0")} AS price_vs_200d_avg,
  {RET5} - etf5 AS alpha_vs_sector_5d
FROM l2 a
"""

ALPHA = """
SELECT a.*, a.return_5d - m.mkt5 AS alpha_vs_nasdaq_5d, a.ret20 - m.mkt20 AS alpha_vs_nasdaq_20d
FROM l3 a LEFT JOIN (
  SELECT trading_date,
         SUM(r) OVER (ORDER BY trading_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS mkt5,
         SUM(r) OVER (ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS mkt20
  FROM (SELECT trading_date, ANY_VALUE(nasdaq_comp_return_1d) AS r FROM o_enriched GROUP BY trading_date) d
) m ON m.trading_date = a.trading_date
"""

SECTOR_ENC = """
SELECT a.*, CAST(s.code AS INT) AS sector_encoded
FROM alpha a LEFT JOIN (
  SELECT sec, DENSE_RANK() OVER (ORDER BY sec) - 1 AS code
  FROM (SELECT DISTINCT COALESCE(sector, 'Unknown') AS sec FROM o_enriched) q
) s ON s.sec = COALESCE(a.sector, 'Unknown')
"""

Q_COLS = ("return_on_equity", "profit_margin", "current_ratio")
_Z = [f"CASE WHEN {q} IS NOT NULL THEN ({q} - (SELECT CAST(AVG(CAST({q} AS DECIMAL(38,18))) AS DOUBLE) FROM o_enriched)) / "
      f"((SELECT STDDEV_SAMP({q}) FROM o_enriched) + 1e-9) END" for q in Q_COLS]
STATS = f"""
SELECT a.*,
  CASE WHEN ({_Z[0]}) IS NULL AND ({_Z[1]}) IS NULL AND ({_Z[2]}) IS NULL THEN 0e0
       ELSE COALESCE({_Z[0]}, 0e0) + COALESCE({_Z[1]}, 0e0) + COALESCE({_Z[2]}, 0e0) END
    AS fundamental_quality_score,
  CASE WHEN COALESCE(p.med > 0 AND a.forward_pe > 0, FALSE) THEN a.forward_pe / p.med ELSE 1e0 END
    AS pe_vs_sector_median
FROM senc a LEFT JOIN (
  SELECT sector, MEDIAN(forward_pe) AS med FROM o_enriched
  WHERE sector IS NOT NULL AND forward_pe <> 0 GROUP BY sector
) p ON p.sector = a.sector
"""

XSEC = f"""
SELECT a.*,
  (RANK() OVER (PARTITION BY trading_date ORDER BY price_vs_52wk_high ASC NULLS LAST)
   + (COUNT(*) OVER (PARTITION BY trading_date, price_vs_52wk_high) - 1) / 2e0)
   / COUNT(*) OVER (PARTITION BY trading_date) AS rs_rank_52wk,
  CASE WHEN sector IS NOT NULL THEN RSI - AVG(RSI) OVER (PARTITION BY trading_date, sector) END
    AS rsi_vs_sector_avg,
  CASE WHEN sector IS NOT NULL THEN (volume_sma_ratio - AVG(volume_sma_ratio) OVER (PARTITION BY trading_date, sector))
    / {clip_sql("STDDEV_SAMP(volume_sma_ratio) OVER (PARTITION BY trading_date, sector)", lo="1e-2")} END AS volume_anomaly
FROM stats a
"""

VIX = "COALESCE(vix_close, 2e1)"
RSI_S = "((RSI - 50) / 5e1)"
INTER = f"""
SELECT a.*,
  {RSI_S} AS rsi_strength,
  alpha_vs_nasdaq_5d / COALESCE({clip_sql("beta", "2e-1", "5e0")}, 1e0) AS beta_adjusted_alpha,
  alpha_vs_nasdaq_5d * LEAST({VIX} / 15e0, 4e0) AS outperformance_in_fear,
  {RSI_S} * {clip_sql("volume_anomaly", "-3e0", "3e0")} AS sector_leader_conviction,
  COALESCE({clip_sql("beta", "-3e0", "5e0")}, 1e0) * LEAST({VIX} / 2e1, 3e0) AS defensive_risk_score,
  CASE WHEN sp500_return_1d < 0 THEN alpha_vs_nasdaq_5d ELSE 0e0 END AS contrarian_strength,
  {RSI_S} * GREATEST(0e0, {VIX} - 20) AS quality_in_volatility,
  alpha_vs_sector_5d * COALESCE(nasdaq_comp_return_1d, 0e0) AS sector_momentum_confirmed,
  CASE WHEN COALESCE(SIGN(return_5d) <> SIGN(sector_sentiment_score), TRUE)
        AND COALESCE(SIGN(sector_sentiment_score) <> 0, TRUE)
       THEN ABS(sector_sentiment_score) * 2 ELSE 0e0 END AS sentiment_price_divergence
FROM xsec a
"""

FEAT_SQL = f"""
WITH l0 AS ({L0}), l1 AS ({L1}), l2 AS ({L2}), l3 AS ({L3}), alpha AS ({ALPHA}),
senc AS ({SECTOR_ENC}), stats AS ({STATS}), xsec AS ({XSEC})
{INTER}
"""

oracle_cte("o_feat", ("o_enriched",), FEAT_SQL)
