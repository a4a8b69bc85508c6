"""Catalogue entries for 2.14 (profiling, diagnostics, monitoring)."""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.sizing import checked_broadcast
from barloom.functions.columns import r4, r4_sql
from barloom.functions.wide import column_moments, column_quantiles, counts_at, distinct_counts, packed
from barloom.operators import outcomes as out
from barloom.operators import profile as prof
from barloom.operators import signals as sig
from barloom.operators.features import PATTERN_FLAGS
from barloom.plans import derived as dv
from barloom.plans.catalog import register
from barloom.plans.q_features import NUMERIC, features, features_once, stored_features
from barloom.plans.q_prep import selected_features, SELECTED_SQL
from barloom.plans.q_sentiment import sector_sentiment
from barloom.session import scratch_path
from barloom.sources import io

c_ = F.col
ASOF = "2001-11-04"
BAR_NUMERIC = ("open_price", "high_price", "low_price", "close_price", "volume")

# FIXED VALUES: the features that the selection is checked for
EXPECTED_FEATURES = (
    "alpha_vs_nasdaq_5d", "alpha_vs_nasdaq_20d", "alpha_vs_sector_5d", "rs_rank_52wk",
    "fundamental_quality_score", "pe_vs_sector_median",
)


@register("table_summary", """
SELECT CAST(COUNT(*) AS BIGINT) AS total_records, MIN(trading_date) AS earliest_date, MAX(trading_date) AS latest_date,
       CAST(COUNT(DISTINCT ticker) AS BIGINT) AS unique_tickers, CAST(COUNT(DISTINCT trading_date) AS BIGINT)
       AS trading_days FROM bars""", ctes=("bars",))
def q_table_summary(fx):
    return fx.bars.agg(F.count(F.lit(1)).cast("bigint").alias("total_records"),
                       F.min("trading_date").alias("earliest_date"), F.max("trading_date").alias("latest_date"),
                       F.countDistinct("ticker").cast("bigint").alias("unique_tickers"),
                       F.countDistinct("trading_date").cast("bigint").alias("trading_days"))


@register("signal_counts", """
SELECT CAST(COUNT(*) AS BIGINT) AS total_signals,
       CAST(COUNT_IF(COALESCE(rsi_trade_signal = 'Oversold (Buy)', FALSE)) AS BIGINT) AS buy_signals,
       CAST(COUNT_IF(COALESCE(rsi_trade_signal = 'Overbought (Sell)', FALSE)) AS BIGINT) AS sell_signals,
       MAX(trading_date) AS latest_signal_date,
       CAST((SELECT COUNT(*) FROM bars WHERE trading_date >= DATE '2001-11-04' - INTERVAL 7 DAY) AS BIGINT)
         AS records_7d
FROM rsi WHERE trading_date >= DATE '2001-11-04' - INTERVAL 30 DAY""", ctes=("rsi", "bars"))
def q_signal_counts(fx):
    r = fx.rsi.filter(c_("trading_date") >= F.date_sub(F.lit(ASOF).cast("date"), 30))
    rec7 = fx.bars.filter(c_("trading_date") >= F.date_sub(F.lit(ASOF).cast("date"), 7)).select(
        F.count(F.lit(1))).scalar()
    return r.agg(F.count(F.lit(1)).cast("bigint").alias("total_signals"),
                 F.count_if(c_("rsi_trade_signal") == "Oversold (Buy)").cast("bigint").alias("buy_signals"),
                 F.count_if(c_("rsi_trade_signal") == "Overbought (Sell)").cast("bigint").alias("sell_signals"),
                 F.max("trading_date").alias("latest_signal_date")).withColumn("records_7d", rec7.cast("bigint"))


@register("freshness", """
SELECT t, CAST(age AS INT) AS days_old,
       CASE WHEN age = 0 THEN 'current' WHEN age <= 3 THEN 'recent' WHEN age <= 7 THEN 'somewhat old'
            ELSE 'stale' END AS band
FROM (SELECT 'bars' AS t, DATE '2001-11-19' - MAX(trading_date) AS age FROM bars
      UNION ALL SELECT 'rsi', DATE '2001-11-19' - MAX(trading_date) FROM rsi) q""", ctes=("bars", "rsi"))
def q_freshness(fx, run_date="2001-11-19"):
    """Data age against a run date (a parameter) and its band."""
    def age(df, name):
        return df.agg(F.datediff(F.lit(run_date).cast("date"), F.max("trading_date")).alias("days_old")) \
            .select(F.lit(name).alias("t"), "days_old")
    a = age(fx.bars, "bars").unionByName(age(fx.rsi, "rsi"))
    d = c_("days_old")
    return a.withColumn("band", F.when(d == 0, "current").when(d <= 3, "recent").when(d <= 7, "somewhat old")
                        .otherwise("stale"))


# Oracle side of the whole feature table: text and date columns by name, all others are numeric.
_TEXT = ("ticker", "sector", "rsi_trade_signal", "Trend_Status", "SMA_Cross_Status", "sma_trade_signal", "macd_crossover_signal",
         "fib_trade_signal", "pivot_status", "sr_trade_signal", "pattern_signal")
_HELPERS = ("i", "c1", "c2", "c3", "c5", "c10", "c20", "o1", "h1", "l1", "v1", "rsi1", "rsi5", "n5", "n10", "n20", "n50", "n100",
            "n200", "sd20", "low14", "high14", "first10", "cnt10", "sd10c", "etf5", "hl5", "hl5n", "vol60", "atr_calc", "pdm14",
            "ndm14", "sma20_5", "stoch_d_calc", "ret20")
_PATTERNS = tuple(f"has_{p}" for p in PATTERN_FLAGS)
_ALL_COLUMNS = (f"SELECT * EXCLUDE ({', '.join((*_HELPERS, *(f'{p}_f' for p in _PATTERNS)))}) "
                f"REPLACE ({', '.join(f'{p}_f AS {p}' for p in _PATTERNS)}) FROM o_feat")
_NUMBERS = f"SELECT CAST(COLUMNS(* EXCLUDE ({', '.join((*_TEXT, 'trading_date'))})) AS DOUBLE) FROM a"
_ROUNDED = f"SELECT FLOOR(CAST(COLUMNS(* EXCLUDE ({', '.join((*_TEXT, 'trading_date'))})) AS DOUBLE) * 1e4 + 0.501) / 1e4 FROM a"
_WORDS = f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in (*_TEXT, 'trading_date'))} FROM a"
_PROFILE_STATS = ("mean", "std", "min", "q1", "median", "q3", "max")


@register("profile_columns", f"""
WITH a AS MATERIALIZED ({_ALL_COLUMNS}),
nl AS (FROM ({_ROUNDED}) UNPIVOT INCLUDE NULLS (v FOR column_name IN (*))),
tl AS (FROM ({_WORDS}) UNPIVOT INCLUDE NULLS (v FOR column_name IN (*))),
ns AS (SELECT column_name, COUNT(v) AS n, COUNT(*) - COUNT(v) AS n_null, COUNT(DISTINCT v) AS n_distinct, AVG(v) AS mean,
              STDDEV_SAMP(v) AS std, MIN(v) AS min, QUANTILE_CONT(v, 25e-2) AS q1, QUANTILE_CONT(v, 5e-1) AS median,
              QUANTILE_CONT(v, 75e-2) AS q3, MAX(v) AS max FROM nl GROUP BY column_name),
tc AS (SELECT column_name, v, COUNT(*) AS k FROM tl WHERE v IS NOT NULL GROUP BY ALL),
tt AS (SELECT column_name, ARG_MIN(v, (-k, v)) AS top, MAX(k) AS top_n FROM tc GROUP BY column_name),
ts AS (SELECT column_name, COUNT(v) AS n, COUNT(*) - COUNT(v) AS n_null, COUNT(DISTINCT v) AS n_distinct, MIN(v) AS first,
              MAX(v) AS last FROM tl GROUP BY column_name)
SELECT column_name, 'numeric' AS type_class, n, n_null, n_distinct, {', '.join(f'{r4_sql(c)} AS {c}' for c in _PROFILE_STATS)},
       NULL AS first, NULL AS last, NULL AS top, NULL AS top_n FROM ns
UNION ALL SELECT ts.column_name, CASE WHEN ts.column_name = 'trading_date' THEN 'date' ELSE 'text' END, n, n_null, n_distinct,
       {', '.join('NULL' for _ in _PROFILE_STATS)}, first, last, top, top_n
FROM ts LEFT JOIN tt ON tt.column_name = ts.column_name""", ctes=("o_feat",))
def q_profile_columns(fx):
    """Every column of the feature table, by the classes of its schema; numbers as exported, with 4 decimals."""
    f = features_once(fx)
    numeric = prof.columns_of(f, "numeric")
    return prof.profile(f.select(*[r4(c).alias(c) if c in numeric else c_(c) for c in f.columns]), decimals=4).select(
        "column_name", "type_class", "n", "n_null", "n_distinct", *[r4(c).alias(c) for c in _PROFILE_STATS],
        "first", "last", "top", "top_n")


_TABLES = ("bars", "rsi", "bands_atr_macd_stoch", "documents", "customer")


def _row_columns(name: str) -> str:
    return {"bands_atr_macd_stoch": "* EXCLUDE (load_seq)", "documents": "lang, source, n_chars", "customer": "c_nationkey, c_mktsegment"}.get(name, "*")


@register("duplicate_rows", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS n_rows, (SELECT COUNT(*) FROM {t}) - "
    f"(SELECT COUNT(*) FROM (SELECT DISTINCT {_row_columns(t)} FROM {t})) AS n_duplicates" for t in _TABLES),
    ctes=("bars", "rsi", "bands_atr_macd_stoch"))
def q_duplicate_rows(fx):
    """P5: whole-row duplicates of several tables (for some of them, of some columns)."""
    parts = []
    for t in _TABLES:
        df = fx.get(t)
        chosen = {"bands_atr_macd_stoch": [c for c in df.columns if c != "load_seq"], "documents": ["lang", "source", "n_chars"],
                  "customer": ["c_nationkey", "c_mktsegment"]}.get(t)
        parts.append(prof.duplicate_rows(df, chosen).select(F.lit(t).alias("table_name"), "n_rows", "n_duplicates"))
    out_ = parts[0]
    for p in parts[1:]:
        out_ = out_.unionByName(p)
    return out_


@register("distinct_sketches", f"""
WITH a AS MATERIALIZED ({_ALL_COLUMNS}),
tl AS (UNPIVOT ({_WORDS}) ON * INTO NAME column_name VALUE v)
SELECT column_name, COUNT(DISTINCT v) AS n_distinct, TRUE AS within_5_pct FROM tl GROUP BY column_name""", ctes=("o_feat",))
def q_distinct_sketches(fx):
    """Distinct values of the text and date columns, exact and merged from one sketch per month."""
    f = stored_features(fx, *_TEXT, "trading_date")
    columns = prof.columns_of(f, "text", "date")
    monthly = prof.distinct_sketches(f.withColumn("_month", F.trunc("trading_date", "MM")), columns, ["_month"])
    exact = prof.stacked(f, columns, "string").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    off = F.abs(c_("n_distinct_estimate") - c_("n_distinct")) <= 0.05 * c_("n_distinct")
    return exact.join(prof.merged_distinct(monthly), "column_name").select("column_name", "n_distinct", off.alias("within_5_pct"))


_QI_COLS = tuple(NUMERIC)


@register("quality_issues", f"""
WITH l AS MATERIALIZED (
  UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _QI_COLS)} FROM o_feat) ON * INTO NAME column_name VALUE v),
n AS (SELECT COUNT(*) AS n FROM o_feat),
s AS (SELECT column_name, COUNT(*) AS k, VAR_SAMP(v) < 1e-2 AS low_variance, COUNT(DISTINCT v) AS d,
             QUANTILE_CONT(v, 25e-2) AS q1, QUANTILE_CONT(v, 75e-2) AS q3 FROM l GROUP BY column_name),
o AS (SELECT s.column_name, COUNT_IF(v < q1 - 1.5e0 * (q3 - q1) OR v > q3 + 1.5e0 * (q3 - q1)) AS iqr_outliers
      FROM l JOIN s ON s.column_name = l.column_name GROUP BY s.column_name)
SELECT s.column_name, {r4_sql('100e0 * (n.n - s.k) / n.n')} AS missing_pct, s.low_variance,
       s.d > 9e-1 * n.n AS high_cardinality, CAST(o.iqr_outliers AS BIGINT) AS iqr_outliers
FROM s JOIN o ON o.column_name = s.column_name, n
UNION ALL SELECT 'ticker', 0e0, NULL, NULL,
  CAST((SELECT COUNT(*) - COUNT(DISTINCT (ticker, trading_date)) FROM o_feat) AS BIGINT)""", ctes=("o_feat",))
def q_quality(fx):
    """P5 / H8: missing share, low variance, distinct values above 90 % of the rows, IQR outliers
    (exact quartiles without collecting a column) of every numeric feature with values, and
    duplicate keys. The features are read once and kept packed by column (``functions.wide``)."""
    d = len(_QI_COLS)
    f = packed(features(fx, *_QI_COLS), _QI_COLS)
    n = f.where("i = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    moments, samples = column_moments(f, d)
    quartiles = column_quantiles(f, [0.25, 0.75], moments, samples)
    fences = [[q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)] if q1 is not None else [] for q1, q3 in quartiles]
    beyond = counts_at(f, [np.unique([x for x in b if not math.isnan(x)]) for b in fences])
    distinct = distinct_counts(f, d)
    rows = []
    for c, m, fence, (below, upto), many in zip(_QI_COLS, moments, fences, beyond, distinct):
        if not m["n"]:
            continue
        # NaN is a value here, above all others
        k, values = m["n"] + m["nan"], m["n"]
        outliers = values if any(math.isnan(x) for x in fence) else int(below[0] + values - upto[-1])
        low = None if k < 2 else bool(not m["nan"] and m["m2"] / (k - 1) < 0.01)
        rows.append((c, 100.0 * (n - k) / n, low, many + bool(m["nan"]) > 0.9 * n, outliers + m["nan"]))
    res = fx.spark.createDataFrame(rows, "column_name string, missing_pct double, low_variance boolean, high_cardinality boolean, "
                                         "iqr_outliers long").withColumn("missing_pct", r4("missing_pct"))      # a row per column
    dup = features(fx, "close_price").groupBy("ticker", "trading_date").count().filter(c_("count") > 1).agg(
        F.coalesce(F.sum(c_("count") - 1), F.lit(0)).cast("bigint").alias("iqr_outliers"))
    return res.unionByName(dup.select(
        F.lit("ticker").alias("column_name"), F.lit(0.0).alias("missing_pct"), F.lit(None).cast("boolean").alias("low_variance"),
        F.lit(None).cast("boolean").alias("high_cardinality"), "iqr_outliers"))


@register("correlation_pairs", f"""
WITH a AS MATERIALIZED ({_ALL_COLUMNS}),
r AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS rid, * FROM ({_NUMBERS})),
l AS MATERIALIZED (UNPIVOT r ON COLUMNS(* EXCLUDE (rid)) INTO NAME column_name VALUE v),
c AS (SELECT x.column_name AS col_a, y.column_name AS col_b, COUNT(*) AS n,
             CASE WHEN STDDEV_POP(x.v) > 1e-9 * ABS(AVG(x.v)) AND STDDEV_POP(y.v) > 1e-9 * ABS(AVG(y.v)) THEN CORR(x.v, y.v) END AS c
      FROM l x JOIN l y ON x.rid = y.rid AND x.column_name < y.column_name GROUP BY ALL)
SELECT col_a, col_b, n, {r4_sql('c')} AS corr, COALESCE(ABS(c) > 8e-1, FALSE) AS high FROM c""", ctes=("o_feat",))
def q_corr(fx):
    """The correlations of all numeric columns of the feature table (pairs that occur together); the
    pairs with ``next_5d_return`` are the correlations with the target."""
    found = prof.correlations(features_once(fx)).where("n > 0")
    a, b = F.least("col_a", "col_b"), F.greatest("col_a", "col_b")
    return found.select(a.alias("col_a"), b.alias("col_b"), "n", r4("corr").alias("corr"),
                        F.coalesce(F.abs("corr") > 0.8, F.lit(False)).alias("high"))


@register("value_distribution", f"""
SELECT COALESCE(rsi_trade_signal, 'None') AS value, CAST(COUNT(*) AS BIGINT) AS n,
       {r4_sql('100e0 * COUNT(*) / SUM(COUNT(*)) OVER ()')} AS pct,
       100e0 * COUNT(*) / SUM(COUNT(*)) OVER () < 10 AS severe_imbalance,
       100e0 * COUNT(*) / SUM(COUNT(*)) OVER () < 15 AS imbalance
FROM rsi GROUP BY 1""", ctes=("rsi",))
def q_value_distribution(fx):
    """Value counts with share and imbalance flags (share window over the
    handful of distinct values)."""
    g = fx.rsi.groupBy(F.coalesce(c_("rsi_trade_signal"), F.lit("None")).alias("value")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    share = 100.0 * c_("n") / F.sum("n").over(Window.partitionBy())
    return g.select("value", "n", r4(share).alias("pct"), (share < 10).alias("severe_imbalance"),
                    (share < 15).alias("imbalance"))


@register("histogram", f"""
WITH b AS (SELECT MIN(daily_return) AS lo, MAX(daily_return) AS hi FROM o_feat),
x AS (SELECT CAST(LEAST(FLOOR((daily_return - lo) / (hi - lo) * 30), 29) AS INT) AS bin, lo, hi
      FROM o_feat, b WHERE daily_return IS NOT NULL)
SELECT bin, {r4_sql('lo + bin * (hi - lo) / 30')} AS bin_start, CAST(COUNT(*) AS BIGINT) AS n
FROM x GROUP BY bin, lo, hi""", ctes=("o_feat",))
def q_histogram(fx):
    """30 equal-width bins between the column's min and max."""
    f = stored_features(fx, "daily_return").filter(c_("daily_return").isNotNull())
    lo, hi = f.select(F.min("daily_return")).scalar(), f.select(F.max("daily_return")).scalar()
    b = F.least(F.floor((c_("daily_return") - lo) / (hi - lo) * 30), F.lit(29)).cast("int")
    g = f.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return g.select("bin", r4(lo + c_("bin") * (hi - lo) / 30).alias("bin_start"), "n")


@register("daily_average", f"""
SELECT trading_date, {r4_sql('AVG(RSI)')} AS avg_rsi, CAST(COUNT(RSI) AS BIGINT) AS n FROM rsi GROUP BY trading_date""",
          ctes=("rsi",))
def q_daily_avg(fx):
    return fx.rsi.groupBy("trading_date").agg(r4(F.avg("RSI")).alias("avg_rsi"),
                                              F.count("RSI").cast("bigint").alias("n"))


_LAST7 = "trading_date >= (SELECT MAX(trading_date) FROM o_export) - INTERVAL 7 DAY"


def _last_days(df, n=7):
    last = df.select(F.max("trading_date")).scalar()
    return df.filter(c_("trading_date") >= F.date_sub(last, n))


@register("diag_probability", f"""
SELECT trading_date, CAST(COUNT(*) AS BIGINT) AS total_stocks,
  CAST(COUNT_IF(predicted_signal IN ('Buy', 'Up')) AS BIGINT) AS buy_signals,
  CAST(COUNT_IF(predicted_signal IN ('Sell', 'Down')) AS BIGINT) AS sell_signals,
  {r4_sql('AVG(buy_probability * 100)')} AS avg_buy_prob_pct, {r4_sql('MIN(buy_probability * 100)')}
  AS min_buy_prob_pct, {r4_sql('MAX(buy_probability * 100)')} AS max_buy_prob_pct,
  CAST(COUNT_IF(buy_probability >= 5e-1) AS BIGINT) AS above_50pct,
  CAST(COUNT_IF(buy_probability >= 6e-1) AS BIGINT) AS above_60pct,
  CAST(COUNT_IF(buy_probability >= 67e-2) AS BIGINT) AS above_67pct,
  CAST(COUNT_IF(buy_probability >= 72e-2) AS BIGINT) AS above_72pct
FROM o_export WHERE {_LAST7} GROUP BY trading_date""", ctes=("o_export",))
def q_diag_prob(fx):
    e = _last_days(sig.export_predictions(dv.signals(fx)))
    bp = c_("buy_probability")
    return e.groupBy("trading_date").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_stocks"),
        F.count_if(c_("predicted_signal").isin("Buy", "Up")).cast("bigint").alias("buy_signals"),
        F.count_if(c_("predicted_signal").isin("Sell", "Down")).cast("bigint").alias("sell_signals"),
        r4(F.avg(bp * 100)).alias("avg_buy_prob_pct"), r4(F.min(bp * 100)).alias("min_buy_prob_pct"),
        r4(F.max(bp * 100)).alias("max_buy_prob_pct"),
        *[F.count_if(bp >= t).cast("bigint").alias(f"above_{n}pct") for t, n in
          ((0.5, 50), (0.6, 60), (0.67, 67), (0.72, 72))])


@register("diag_sector", f"""
SELECT e.trading_date, s.sector, CAST(COUNT(*) AS BIGINT) AS n,
       CAST(COUNT_IF(e.predicted_signal = 'Buy') AS BIGINT) AS buys, {r4_sql('AVG(e.confidence)')} AS avg_confidence
FROM o_export e LEFT JOIN securities s ON s.ticker = e.ticker WHERE e.{_LAST7} GROUP BY 1, 2""",
          ctes=("o_export", "securities"))
def q_diag_sector(fx):
    """Sector x day (sector joined from the securities table)."""
    e = _last_days(sig.export_predictions(dv.signals(fx)))
    j = e.join(checked_broadcast(fx.securities.select("ticker", "sector")), "ticker", "left")
    return j.groupBy("trading_date", "sector").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.count_if(c_("predicted_signal") == "Buy").cast("bigint")
        .alias("buys"), r4(F.avg("confidence")).alias("avg_confidence"))


_RSI_BANDS = (("rsi_oversold", "RSI < 30"), ("rsi_30_50", "RSI BETWEEN 30 AND 50"),
              ("rsi_50_60", "RSI BETWEEN 50 AND 60"), ("rsi_60_70", "RSI BETWEEN 60 AND 70"),
              ("rsi_70_75", "RSI BETWEEN 70 AND 75"), ("rsi_above_75", "RSI > 75"))


@register("diag_rsi_bands", f"""
SELECT trading_date, {', '.join(f'CAST(COUNT_IF({cond}) AS BIGINT) AS {name}' for name, cond in _RSI_BANDS)},
       {r4_sql('AVG(RSI)')} AS avg_rsi, {r4_sql('MAX(RSI)')} AS max_rsi, {r4_sql('MIN(RSI)')} AS min_rsi
FROM o_export WHERE {_LAST7} GROUP BY trading_date""", ctes=("o_export",))
def q_diag_rsi(fx):
    """RSI bands per day with inclusive BETWEEN (bands overlap at edges)."""
    e = _last_days(sig.export_predictions(dv.signals(fx)))
    return e.groupBy("trading_date").agg(
        *[F.count_if(F.expr(cond)).cast("bigint").alias(name) for name, cond in _RSI_BANDS],
        r4(F.avg("RSI")).alias("avg_rsi"), r4(F.max("RSI")).alias("max_rsi"), r4(F.min("RSI")).alias("min_rsi"))


_CTX = (("vix_close", "vix_close"), ("vix_chg_pct", "vix_change_pct"), ("sp500_ret_pct", "sp500_return_1d * 100"),
        ("nasdaq_ret_pct", "nasdaq_comp_return_1d * 100"), ("dxy_ret_pct", "dxy_return_1d * 100"),
        ("us_10y_yield", "us_10y_yield_close"), ("xlk_tech_pct", "xlk_return_1d * 100"))


@register("diag_context", f"""
SELECT trading_date, {', '.join(f'{r4_sql(e)} AS {n}' for n, e in _CTX)} FROM market_context
WHERE trading_date >= (SELECT MAX(trading_date) FROM market_context) - INTERVAL 7 DAY""", ctes=("market_context",))
def q_diag_context(fx):
    m = _last_days(fx.market_context)
    return m.select("trading_date", *[r4(F.expr(e)).alias(n) for n, e in _CTX])


@register("diag_sentiment", f"""
SELECT sector, CAST(COUNT(*) AS BIGINT) AS days, {r4_sql('AVG(sentiment_score)')} AS avg_score,
       {r4_sql('AVG(news_count)')} AS avg_news, CAST(COUNT_IF(news_count = 0) AS BIGINT) AS empty_days
FROM o_sector_sent GROUP BY sector""", ctes=("o_sector_sent",))
def q_diag_sentiment(fx):
    t = sector_sentiment(fx)
    return t.groupBy("sector").agg(F.count(F.lit(1)).cast("bigint").alias("days"),
                                   r4(F.avg("sentiment_score")).alias("avg_score"),
                                   r4(F.avg("news_count")).alias("avg_news"),
                                   F.count_if(c_("news_count") == 0).cast("bigint").alias("empty_days"))


@register("diag_coverage", """
SELECT STRFTIME(trading_date, '%Y-%m') AS month, CAST(COUNT(DISTINCT trading_date) AS BIGINT) AS days,
       CAST(SUM(news_count) AS BIGINT) AS articles FROM o_sector_sent GROUP BY 1""", ctes=("o_sector_sent",))
def q_diag_coverage(fx):
    t = sector_sentiment(fx)
    return t.groupBy(F.date_format("trading_date", "yyyy-MM").alias("month")).agg(
        F.countDistinct("trading_date").cast("bigint").alias("days"), F.sum("news_count").cast("bigint")
        .alias("articles"))


@register("audit_daily", """
WITH d AS (SELECT DISTINCT trading_date FROM o_export ORDER BY trading_date DESC LIMIT 10)
SELECT e.trading_date, CAST(COUNT(*) AS BIGINT) AS total, CAST(COUNT_IF(predicted_signal = 'Buy') AS BIGINT) AS buys,
       CAST(COUNT_IF(predicted_signal = 'Sell') AS BIGINT) AS sells,
       CAST(COUNT_IF(is_actionable) AS BIGINT) AS actionable,
       COUNT_IF(predicted_signal = 'Buy' AND is_actionable) = 0 AS zero_buy_alert
FROM o_export e JOIN d ON d.trading_date = e.trading_date GROUP BY e.trading_date""", ctes=("o_export",))
def q_audit(fx):
    """Daily audit over the last 10 run dates with the zero-buy alert."""
    e = sig.export_predictions(dv.signals(fx))
    recent = out.last_n_dates(e, 10)
    j = e.join(F.broadcast(recent), "trading_date", "left_semi")
    g = j.groupBy("trading_date").agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if(c_("predicted_signal") == "Buy").cast("bigint").alias("buys"),
        F.count_if(c_("predicted_signal") == "Sell").cast("bigint").alias("sells"),
        F.count_if("is_actionable").cast("bigint").alias("actionable"),
        (F.count_if((c_("predicted_signal") == "Buy") & c_("is_actionable")) == 0).alias("zero_buy_alert"))
    return g


@register("threshold_impact", f"""
WITH d AS (SELECT trading_date, COUNT_IF(confidence > 7e-1) AS old_high, COUNT_IF(confidence > 58e-2) AS new_high
           FROM o_export WHERE is_actionable GROUP BY trading_date)
SELECT CAST(SUM(old_high) AS BIGINT) AS old_high_count, CAST(SUM(new_high) AS BIGINT) AS new_high_count,
       CAST(SUM(new_high - old_high) AS BIGINT) AS unlocked, {r4_sql('AVG(new_high - old_high)')} AS mean_daily_unlocked,
       {r4_sql('MEDIAN(new_high - old_high)')} AS median_daily_unlocked FROM d""", ctes=("o_export",))
def q_threshold_impact(fx, old=0.70, new=0.58):
    """Effect of moving the high-confidence cut from .70 to .58."""
    e = sig.export_predictions(dv.signals(fx)).filter("is_actionable")
    d = e.groupBy("trading_date").agg(F.count_if(c_("confidence") > old).alias("o"),
                                      F.count_if(c_("confidence") > new).alias("n"))
    d = d.withColumn("u", c_("n") - c_("o"))
    med = d.groupBy("u").count().agg(F.expr("percentile(u, 0.5, count)").alias("m")).select("m").scalar()
    return d.agg(F.sum("o").cast("bigint").alias("old_high_count"), F.sum("n").cast("bigint").alias("new_high_count"),
                 F.sum("u").cast("bigint").alias("unlocked"), r4(F.avg("u")).alias("mean_daily_unlocked")) \
        .withColumn("median_daily_unlocked", r4(med))


@register("volume_compare", f"""
WITH a AS (SELECT COUNT_IF(trading_date >= DATE '2001-11-04' - INTERVAL 365 DAY) AS n365,
                  COUNT_IF(trading_date >= DATE '2001-11-04' - INTERVAL 730 DAY) AS n730 FROM bars)
SELECT CAST(n365 AS BIGINT) AS rows_365d, CAST(n730 AS BIGINT) AS rows_730d,
       {r4_sql('100e0 * (n730 - n365) / n730')} AS reduction_pct FROM a""", ctes=("bars",))
def q_volume_compare(fx):
    """Rows in two training windows and the reduction."""
    d = F.lit(ASOF).cast("date")
    a = fx.bars.agg(F.count_if(c_("trading_date") >= F.date_sub(d, 365)).alias("a"),
                    F.count_if(c_("trading_date") >= F.date_sub(d, 730)).alias("b"))
    return a.select(c_("a").cast("bigint").alias("rows_365d"), c_("b").cast("bigint").alias("rows_730d"),
                    r4(100.0 * (c_("b") - c_("a")) / c_("b")).alias("reduction_pct"))


@register("feature_membership", f"""
WITH k AS ({SELECTED_SQL})
SELECT v.feature, v.feature IN (SELECT feature FROM k) AS present FROM (VALUES """ + ", ".join(
    f"('{f}')" for f in EXPECTED_FEATURES) + ") v(feature)", ctes=("o_prep",))
def q_membership(fx):
    """Whether the features expected of the selection (H6) are among those selected."""
    expected = fx.spark.createDataFrame([(f,) for f in EXPECTED_FEATURES], "feature string")
    chosen = selected_features(fx).select("feature", F.lit(True).alias("present"))
    return expected.join(chosen, "feature", "left").select("feature", F.coalesce("present", F.lit(False)).alias("present"))


# ---------------------------------------------------------- run reports
WINDOWS = (20, 60)
SECTOR_MIN = 10


def live_accuracy(outcomes: DataFrame, securities: DataFrame) -> DataFrame:
    """Live accuracy as known on each realisation date: actionable outcomes realised on the last 20 and
    60 such dates up to it, overall, by confidence band and by sector (at least 10 outcomes). Long rows
    (realized_date, window, metric, key, n, accuracy). Outcomes are counted per date first; every daily
    count then joins the windows that it lies in."""
    o = outcomes.filter("is_actionable").join(checked_broadcast(securities.select("ticker", "sector")), "ticker", "left")
    band = F.coalesce(*[F.when((c_("confidence") >= lo) & (c_("confidence") < hi), F.lit(k))
                        for lo, hi, k in out.CONFIDENCE_BANDS])
    cells = F.explode(F.array(F.struct(F.lit("overall").alias("metric"), F.lit("all").alias("key")),
                              F.struct(F.lit("by_confidence").alias("metric"), band.alias("key")),
                              F.struct(F.lit("by_sector").alias("metric"), c_("sector").alias("key"))))
    daily = o.select("realized_date", "correct", cells.alias("c")).filter("c.key IS NOT NULL").groupBy(
        "realized_date", "c.metric", "c.key").agg(F.count(F.lit(1)).alias("n"), F.sum("correct").alias("hits"))
    index = o.select("realized_date").distinct().withColumn("i", F.row_number().over(Window.orderBy("realized_date")))
    spans = F.explode(F.array(*[F.struct(F.lit(w).alias("window"), F.lit(w - 1).alias("back")) for w in WINDOWS]))
    spread = daily.join(F.broadcast(index), "realized_date").select("*", spans.alias("w")).select(
        "metric", "key", "n", "hits", "w.window", F.explode(F.expr("sequence(i, i + w.back)")).alias("i"))
    sums = spread.groupBy("i", "window", "metric", "key").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return sums.join(F.broadcast(index), "i").filter(f"metric <> 'by_sector' OR n >= {SECTOR_MIN}").select(
        "realized_date", "window", "metric", "key", "n", (c_("hits") / c_("n")).alias("accuracy"))


def daily_reports(fx) -> DataFrame:
    """One run document per trading date: data status from the bars so far, and the live accuracy
    last known on that date (the newest realisation date up to it)."""
    b = fx.bars.groupBy("trading_date").agg(F.count(F.lit(1)).alias("n"))
    sofar = Window.orderBy("trading_date").rowsBetween(Window.unboundedPreceding, 0)     # a row per calendar date
    status = b.select("trading_date", F.sum("n").over(sofar).cast("bigint").alias("total_records"))
    live = live_accuracy(dv.outcomes(fx), fx.securities)
    cell = F.struct(c_("n").cast("bigint").alias("n"), "accuracy")
    entries = lambda m: F.map_from_entries(F.collect_list(F.when(c_("metric") == m, F.struct("key", cell.alias("v")))))
    per_window = live.groupBy("realized_date", "window").agg(
        F.max(F.when(c_("metric") == "overall", c_("n"))).cast("bigint").alias("n_predictions"),
        F.max(F.when(c_("metric") == "overall", c_("accuracy"))).alias("accuracy"),
        entries("by_confidence").alias("by_confidence"), entries("by_sector").alias("by_sector"))
    doc = F.struct(c_("window").alias("window_trading_days"), "n_predictions", "accuracy", "by_confidence", "by_sector")
    docs = per_window.groupBy("realized_date").agg(
        F.map_from_entries(F.collect_list(F.struct(c_("window").cast("string").alias("k"), doc.alias("v")))).alias("live"))
    known = status.join(docs.withColumnRenamed("realized_date", "trading_date"), "trading_date", "full")
    known = known.withColumn("live", F.last("live", ignorenulls=True).over(sofar)).filter("total_records IS NOT NULL")
    return known.select(
        F.date_format("trading_date", "yyyy-MM-dd'T'18:00:00").alias("date"),
        F.concat(F.lit("daily_"), F.date_format("trading_date", "yyyyMMdd"), F.lit(".log")).alias("log_file"),
        F.struct((c_("total_records") > 0).alias("connected"), F.lit(0).alias("age_days"),
                 F.date_format("trading_date", "yyyy-MM-dd").alias("latest_date"),
                 c_("total_records").alias("total_records")).alias("data_status"),
        F.struct(F.lit(False).alias("performed"), F.lit(None).cast("boolean").alias("success"),
                 F.lit(None).cast("double").alias("duration_minutes"), F.lit("not scheduled").alias("reason"))
        .alias("retraining"),
        F.struct(F.lit(True).alias("success"), F.array().cast("array<string>").alias("files_created"))
        .alias("csv_exports"),
        F.struct(F.lit(True).alias("success"), F.lit(None).cast("bigint").alias("records_inserted"))
        .alias("database_export"),
        c_("live").alias("live_accuracy"), F.year("trading_date").alias("year"))


_LIVE_SQL = """
o AS (SELECT o.realized_date, o.correct, s.sector, CASE WHEN o.confidence < 55e-2 THEN '<55%' WHEN o.confidence < 60e-2
             THEN '55-60%' WHEN o.confidence < 67e-2 THEN '60-67%' WHEN o.confidence < 101e-2 THEN '>=67%' END AS band
      FROM o_outcomes o LEFT JOIN securities s ON s.ticker = o.ticker WHERE o.is_actionable),
ix AS (SELECT realized_date, ROW_NUMBER() OVER (ORDER BY realized_date) AS i FROM (SELECT DISTINCT realized_date FROM o) q),
cells AS (SELECT realized_date, correct, 'overall' AS metric, 'all' AS key FROM o
          UNION ALL SELECT realized_date, correct, 'by_confidence', band FROM o WHERE band IS NOT NULL
          UNION ALL SELECT realized_date, correct, 'by_sector', sector FROM o WHERE sector IS NOT NULL),
daily AS (SELECT i, metric, key, COUNT(*) AS n, SUM(correct) AS h FROM cells JOIN ix USING (realized_date) GROUP BY ALL),
live AS (SELECT ix.realized_date, w.w AS win, d.metric, d.key, SUM(d.n) AS n, SUM(d.h) AS h
         FROM ix, (SELECT UNNEST([20, 60]) AS w) w JOIN daily d ON d.i BETWEEN ix.i - w.w + 1 AND ix.i GROUP BY ALL
         HAVING d.metric <> 'by_sector' OR SUM(d.n) >= 10),
b AS (SELECT trading_date, SUM(COUNT(*)) OVER (ORDER BY trading_date) AS total_records FROM bars GROUP BY trading_date),
st AS (SELECT b.*, (SELECT MAX(realized_date) FROM ix WHERE realized_date <= b.trading_date) AS known FROM b)"""


@register("daily_summary", f"""
WITH {_LIVE_SQL}
SELECT STRFTIME(st.trading_date, '%Y-%m-%dT18:00:00') AS date, CAST(st.total_records AS BIGINT) AS total_records,
       live.win AS window_trading_days, live.metric, live.key, CAST(live.n AS BIGINT) AS n,
       {r4_sql('live.h * 1e0 / live.n')} AS accuracy
FROM st JOIN live ON live.realized_date = st.known""", ctes=("bars", "o_outcomes", "securities"))
def q_daily_summary(fx):
    """P23, flattened: one row per report, window, metric and cell of its live accuracy."""
    r = daily_reports(fx).select("date", "data_status.total_records", F.explode("live_accuracy").alias("w", "d"))
    overall = r.select("date", "total_records", "d.window_trading_days", F.lit("overall").alias("metric"),
                       F.lit("all").alias("key"), c_("d.n_predictions").alias("n"), c_("d.accuracy").alias("accuracy"))
    parts = [r.select("date", "total_records", "d.window_trading_days", F.lit(m).alias("metric"),
                      F.explode(f"d.{m}").alias("key", "v")).select(
        "date", "total_records", "window_trading_days", "metric", "key", "v.n", "v.accuracy")
        for m in ("by_confidence", "by_sector")]
    rows = overall.unionByName(parts[0]).unionByName(parts[1])
    return rows.withColumn("accuracy", r4("accuracy"))


def _written_reports(fx):
    path = scratch_path(fx.spark, f"reports_{uuid.uuid4().hex}")
    daily_reports(fx).write.mode("overwrite").partitionBy("year").json(path)
    return io.read_reports(fx.spark, f"{path}/year=*/*.json")


@register("report_history", f"""
WITH {_LIVE_SQL}
SELECT STRFTIME(st.trading_date, '%Y-%m-%dT18:00:00') AS date, CAST(st.total_records AS BIGINT) AS total_records,
       'ok' AS status, CAST(NULL AS DOUBLE) AS duration_minutes, {r4_sql('a.h * 1e0 / a.n')} AS accuracy_20d,
       {r4_sql('c.h * 1e0 / c.n')} AS accuracy_60d
FROM st LEFT JOIN live a ON a.realized_date = st.known AND a.win = 20 AND a.metric = 'overall'
        LEFT JOIN live c ON c.realized_date = st.known AND c.win = 60 AND c.metric = 'overall'
ORDER BY date DESC LIMIT 7""", ctes=("bars", "o_outcomes", "securities"))
def q_report_history(fx):
    """Read every written run report back with one schema; status and the live accuracy over 20
    and 60 dates for the last 7 reports."""
    r = _written_reports(fx)
    recent = r.orderBy(c_("date").desc()).limit(7)
    return recent.select("date", c_("data_status.total_records").alias("total_records"),
                         F.when(c_("data_status.connected"), F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
                         c_("retraining.duration_minutes").alias("duration_minutes"),
                         r4(c_("live_accuracy")["20"]["accuracy"]).alias("accuracy_20d"),
                         r4(c_("live_accuracy")["60"]["accuracy"]).alias("accuracy_60d"))


def report_alerts(reports: DataFrame, now: str) -> DataFrame:
    """P20: alerts for the latest of ``reports`` at the time ``now``, one row each (one row with NULL if
    there are none): no run for over 30 h, no connection, failed retraining, failed export, data older
    than 5 days. Without any report the alert says so."""
    latest = reports.orderBy(c_("date").desc()).limit(1)
    fmt = "\"yyyy-MM-dd'T'HH:mm:ss\""
    # wall-clock timestamps without time zone: independent of the session zone
    hours = F.expr(f"timestampdiff(SECOND, to_timestamp_ntz(date, {fmt}), "
                   f"to_timestamp_ntz('{now}', {fmt}))") / 3600.0
    alerts = F.array_compact(F.array(
        F.when(hours > 30, F.format_string("automation has not run in %.1f hours", hours)),
        F.when(~F.coalesce(c_("data_status.connected"), F.lit(False)), F.lit("database connection failed")),
        F.when(c_("retraining.performed") & ~F.coalesce(c_("retraining.success"), F.lit(False)),
               F.lit("model retraining failed")),
        F.when(~F.coalesce(c_("csv_exports.success"), F.lit(False)), F.lit("csv export failed")),
        F.when(c_("data_status.age_days") > 5, F.format_string("data is %d days old", c_("data_status.age_days")))))
    found = latest.select("date", F.explode_outer(alerts).alias("alert"))
    none = reports.agg(F.count("date").alias("n")).where("n = 0").select(
        F.lit(None).cast("string").alias("date"), F.lit("no automation reports found").alias("alert"))
    return found.unionByName(none)


@register("report_alerts", """
WITH d AS (SELECT MAX(trading_date) AS t FROM bars),
h AS (SELECT t, (EPOCH(TIMESTAMP '2001-11-06 06:00:00') - EPOCH(CAST(t AS TIMESTAMP) + INTERVAL 18 HOUR)) / 3600e0
             AS hours FROM d)
SELECT STRFTIME(t, '%Y-%m-%dT18:00:00') AS date,
       CASE WHEN hours > 30 THEN PRINTF('automation has not run in %.1f hours', hours) END AS alert FROM h""",
          ctes=("bars",))
def q_report_alerts(fx, now="2001-11-06T06:00:00"):
    return report_alerts(_written_reports(fx), now)


@register("eda_summary", f"""
WITH a AS MATERIALIZED ({_ALL_COLUMNS}),
m AS (SELECT column_name, COUNT(*) - COUNT(v) AS n_missing FROM (FROM ({_NUMBERS}) UNPIVOT INCLUDE NULLS (v FOR column_name IN (*))) GROUP BY 1
      UNION ALL SELECT column_name, COUNT(*) - COUNT(v) FROM (FROM ({_WORDS}) UNPIVOT INCLUDE NULLS (v FOR column_name IN (*))) GROUP BY 1)
SELECT m.column_name, m.n_missing, (SELECT COUNT(*) FROM a) AS n_rows, (SELECT COUNT(*) FROM m) AS n_cols,
       (SELECT MIN(trading_date) FROM a) AS first_date, (SELECT MAX(trading_date) FROM a) AS last_date,
       (SELECT COUNT(DISTINCT ticker) FROM a) AS n_tickers FROM m""", ctes=("o_feat",))
def q_eda(fx):
    """Shape, date range, tickers and the missing values of every column, a row per column."""
    f = features_once(fx)
    one = f.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(f.columns)).cast("long").alias("n_cols"),
                F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"),
                F.countDistinct("ticker").alias("n_tickers"),
                F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_if(c_(c).isNull()).alias("n_missing")) for c in f.columns]).alias("m"))
    return one.select("n_rows", "n_cols", "first_date", "last_date", "n_tickers", F.explode("m").alias("x")).select(
        "x.column_name", "x.n_missing", "n_rows", "n_cols", "first_date", "last_date", "n_tickers")
