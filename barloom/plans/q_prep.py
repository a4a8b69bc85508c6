"""Catalogue entries for 2.7 (preprocessing and feature selection)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.columns import r4, r4_sql
from barloom.functions.wide import packed
from barloom.operators import labels as lab
from barloom.operators import prep
from barloom.plans import derived as dv
from barloom.plans.catalog import oracle_cte, register
from barloom.operators.features import CALENDAR_COLUMNS, CONTEXT_COLUMNS, DROP_AFTER_FEATURES
from barloom.plans.q_features import NUMERIC, features, stored_features

c_ = F.col
IMPUTE_COLS = ("RSI", "return_10d")
SCALE_COLS = ("daily_return", "volume_sma_ratio")
OUTLIER_COLS = ("daily_return", "volume_sma_ratio", "gap_pct")

# Candidates are the numeric columns of the feature table (B11) that are neither keys, labels nor
# values of later days; their category follows from where they come from.
MARKET_CONTEXT = tuple(c for c in CONTEXT_COLUMNS if c not in DROP_AFTER_FEATURES) + CALENDAR_COLUMNS + ("sector_etf_return_1d",)
# FIXED VALUES: columns of the relative and interaction layers, and the most that selection keeps of a category
RELATIVE = ("alpha_vs_nasdaq_5d", "alpha_vs_nasdaq_20d", "alpha_vs_sector_5d", "rs_rank_52wk", "fundamental_quality_score",
            "pe_vs_sector_median", "beta_adjusted_alpha", "rsi_vs_sector_avg", "rsi_strength", "volume_anomaly")
INTERACTION = ("outperformance_in_fear", "sector_leader_conviction", "defensive_risk_score", "contrarian_strength",
               "quality_in_volatility", "sector_momentum_confirmed", "sentiment_price_divergence")
CAPS = {"market": 4, "relative": 8, "interaction": 4, "stock": 10}
STOCK = ("daily_return", "return_5d", "price_position", "RSI", "atr_ratio", "volume_sma_ratio", "macd_normalized",
         "bollinger_bandwidth", "stochastic_k", "regime_adx", "regime_vol_ratio", "trend_strength_10")
MI_COLS = tuple(dict.fromkeys(c for c in (*MARKET_CONTEXT, *RELATIVE, *INTERACTION, *NUMERIC, *STOCK)
                              if not c.startswith("next_")))
CATEGORY_OF = {**{f: "market" for f in MARKET_CONTEXT}, **{f: "relative" for f in RELATIVE},
               **{f: "interaction" for f in INTERACTION}}

oracle_cte("o_prep", ("o_feat", "o_split"), """
SELECT f.*, CAST(s.direction_5d = 'Up' AS INT) AS y, s.split
FROM o_feat f JOIN o_split s ON s.ticker = f.ticker AND s.trading_date = f.trading_date""")


def _labelled(fx, frame):
    s = lab.split_purged(dv.bar_labels(fx)).select(
        "ticker", "trading_date", (c_("direction_5d") == "Up").cast("int").alias("y"), "split")
    return frame.join(s, ["ticker", "trading_date"], "inner")


def prep_frame(fx, *columns: str):
    return _labelled(fx, stored_features(fx, *columns))


def train_rows(fx, *columns: str):
    """The train slice of ``prep_frame`` for a query that reads it once: its features are not written."""
    return _labelled(fx, features(fx, *columns)).filter(c_("split") == "train")


def mi_rows(fx):
    """The candidates of the train slice as the mutual information reads them, kept packed once per data directory."""
    return fx.kept("mi_rows", lambda f: packed(prep.snapped(train_rows(f, *MI_COLS), MI_COLS, "y"), MI_COLS, label="y"))


def _imputed(strategy, fill_sql, first=""):
    cols_sql = ", ".join(f"{r4_sql(f'COALESCE({c}, {fill_sql.format(c=c)})')} AS {c}" for c in IMPUTE_COLS)
    sql = f"{first}SELECT ticker, trading_date, {cols_sql} FROM o_feat"

    def build(fx):
        f = stored_features(fx, *IMPUTE_COLS).select("ticker", "trading_date", *IMPUTE_COLS)
        out = prep.impute(f, IMPUTE_COLS, strategy)
        return out.select("ticker", "trading_date", *[r4(c).alias(c) for c in IMPUTE_COLS])
    register(f"impute_{strategy if strategy != 'forward_fill' else 'ffill'}", sql, ctes=("o_feat",))(build)


_imputed("mean", "AVG({c}) OVER ()")
_imputed("median", "(SELECT MEDIAN({c}) FROM o_feat)")
_imputed("mode", "(SELECT {c} FROM o_feat WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)")
_imputed("forward_fill", "LAST_VALUE({c} IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY trading_date "
                         "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


@register("impute_drop", f"""
SELECT ticker, trading_date, {', '.join(f'{r4_sql(c)} AS {c}' for c in IMPUTE_COLS)} FROM o_feat
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in IMPUTE_COLS)}""", ctes=("o_feat",))
def q_impute_drop(fx):
    f = prep.impute(features(fx, *IMPUTE_COLS).select("ticker", "trading_date", *IMPUTE_COLS), IMPUTE_COLS, "drop")
    return f.select("ticker", "trading_date", *[r4(c).alias(c) for c in IMPUTE_COLS])




@register("encode_onehot", """
WITH s AS (SELECT ticker, COALESCE(sector, 'Unknown') AS sector FROM securities),
c AS (SELECT sector, ROW_NUMBER() OVER (ORDER BY sector) AS k FROM (SELECT DISTINCT sector FROM s) d)
SELECT s.ticker, c.sector AS category, CAST(s.sector = c.sector AS DOUBLE) AS indicator
FROM s, c WHERE c.k > 1""", ctes=("securities",))
def q_onehot(fx):
    """H2 one-hot with the first sorted category dropped; shown long
    (ticker, category, indicator) so the column set is data-independent."""
    s = fx.securities.select("ticker", F.coalesce(c_("sector"), F.lit("Unknown")).alias("sector"))
    wide = prep.one_hot(s, "sector")
    cats = [c for c in wide.columns if c.startswith("sector_")]
    arr = F.array(*[F.struct(F.lit(c[len("sector_"):]).alias("category"), c_(f"`{c}`").alias("indicator"))
                    for c in cats])
    return wide.select("ticker", F.explode(arr).alias("x")).select("ticker", "x.category", "x.indicator")


@register("encode_label", """
SELECT ticker, CAST(DENSE_RANK() OVER (ORDER BY COALESCE(sector, 'None')) - 1 AS INT) AS sector_code FROM securities""",
          ctes=("securities",))
def q_label(fx):
    return prep.label_encode(fx.securities, "sector", "sector_code").select("ticker", "sector_code")


def _scale_sql(kind):
    pair = ("AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" if kind == "standard"
            else "MIN({c}) AS m_{c}, MAX({c}) - MIN({c}) AS s_{c}")
    stats = ", ".join(pair.format(c=c) for c in SCALE_COLS)
    scaled = ", ".join(f"{r4_sql(f'CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0e0 END')} AS {c}" for c in SCALE_COLS)
    return (f"WITH st AS MATERIALIZED (SELECT {stats} FROM o_prep WHERE split = 'train') "
            f"SELECT ticker, trading_date, {scaled} FROM o_prep, st")


@register("scale_standard", _scale_sql("standard"), ctes=("o_prep",))
def q_scale_standard(fx):
    p = prep_frame(fx, *SCALE_COLS)
    s = prep.standard_scale(p, SCALE_COLS, fit=p.filter(c_("split") == "train"))
    return s.select("ticker", "trading_date", *[r4(c).alias(c) for c in SCALE_COLS])


@register("scale_minmax", _scale_sql("minmax"), ctes=("o_prep",))
def q_scale_minmax(fx):
    p = prep_frame(fx, *SCALE_COLS)
    s = prep.minmax_scale(p, SCALE_COLS, fit=p.filter(c_("split") == "train"))
    return s.select("ticker", "trading_date", *[r4(c).alias(c) for c in SCALE_COLS])


def _outlier_sql(method, threshold):
    steps, prev = [], "o_feat"
    for i, c in enumerate(OUTLIER_COLS):
        if method == "iqr":
            cond = (f"{c} >= q1 - {threshold!r}e0 * (q3 - q1) AND {c} <= q3 + {threshold!r}e0 * (q3 - q1)")
            stats = f"(SELECT QUANTILE_CONT({c}, 25e-2) AS q1, QUANTILE_CONT({c}, 75e-2) AS q3 FROM {prev})"
        else:
            cond = f"ABS(({c} - m) / s) <= {threshold!r}e0"
            stats = f"(SELECT AVG({c}) AS m, STDDEV_SAMP({c}) AS s FROM {prev})"
        steps.append(f"s{i} AS (SELECT t.* FROM {prev} t, {stats} b WHERE {cond})")
        prev = f"s{i}"
    return f"WITH {', '.join(steps)} SELECT ticker, trading_date FROM {prev}"


@register("outliers_iqr", _outlier_sql("iqr", 1.5), ctes=("o_feat",))
def q_outliers_iqr(fx):
    f = stored_features(fx, *OUTLIER_COLS).select("ticker", "trading_date", *OUTLIER_COLS)
    return prep.remove_outliers(f, OUTLIER_COLS, "iqr", 1.5).select("ticker", "trading_date")


@register("outliers_zscore", _outlier_sql("zscore", 3.0), ctes=("o_feat",))
def q_outliers_z(fx):
    f = stored_features(fx, *OUTLIER_COLS).select("ticker", "trading_date", *OUTLIER_COLS)
    return prep.remove_outliers(f, OUTLIER_COLS, "zscore", 3.0).select("ticker", "trading_date")


_MI_SQL = f"""
WITH t AS (SELECT * FROM o_prep WHERE split = 'train'),
l AS (SELECT y, UNNEST([{', '.join(f"{{'feature': '{c}', 'value': CAST({c} AS DOUBLE)}}" for c in MI_COLS)}]) AS s
      FROM t),
v AS (SELECT y, s.feature AS feature, FLOOR(s.value * 1e9 + 0.501) / 1e9 AS value FROM l WHERE s.value IS NOT NULL),
r AS (SELECT feature, value, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY value) - 1 AS rk,
             COUNT(*) OVER (PARTITION BY feature) AS n FROM v),
h AS (SELECT feature, n, q, q * (n - 1) AS hq FROM (SELECT DISTINCT feature, n FROM r),
      (SELECT UNNEST([{', '.join(f'{i / 10!r}e0' for i in range(1, 10))}]) AS q) qq),
e0 AS (SELECT h.feature, h.q, lo.value + (hi.value - lo.value) * (h.hq - FLOOR(h.hq)) AS edge
       FROM h JOIN r lo ON lo.feature = h.feature AND lo.rk = CAST(FLOOR(h.hq) AS BIGINT)
              JOIN r hi ON hi.feature = h.feature AND hi.rk = CAST(CEIL(h.hq) AS BIGINT)),
e AS (SELECT feature, LIST(edge ORDER BY q) AS edges FROM e0 GROUP BY feature),
b AS (SELECT v.feature, v.y, LEN(LIST_FILTER(e.edges, lambda x: v.value > x)) AS bin FROM v JOIN e USING (feature)),
c AS (SELECT feature, bin, y, COUNT(*) AS n_by FROM b GROUP BY feature, bin, y),
d AS (SELECT *, SUM(n_by) OVER (PARTITION BY feature) AS n, SUM(n_by) OVER (PARTITION BY feature, bin) AS n_b,
             SUM(n_by) OVER (PARTITION BY feature, y) AS n_y FROM c)
SELECT feature, SUM((n_by / n) * LN((n_by * n) / (n_b * n_y))) AS mi FROM d GROUP BY feature"""

_CAT_SQL = ("CASE " + " ".join(f"WHEN feature = '{f}' THEN '{c}'" for f, c in CATEGORY_OF.items())
            + " ELSE 'stock' END")
_CAP_SQL = "CASE category " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in CAPS.items()) + " END"


@register("mi_ranking", f"SELECT feature, {r4_sql('mi')} AS mi FROM ({_MI_SQL}) q", ctes=("o_prep",))
def q_mi(fx):
    return prep.mutual_information(mi_rows(fx), MI_COLS).withColumn("mi", r4("mi"))


SELECTED_SQL = f"""
SELECT feature, category, CAST(rank AS INT) AS rank FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY mi DESC, feature) AS rank
  FROM (SELECT feature, mi, {_CAT_SQL} AS category FROM (SELECT feature, {r4_sql('mi')} AS mi FROM ({_MI_SQL}) q) m) k) r
WHERE rank <= {_CAP_SQL}"""


def selected_features(fx):
    """H6 on MI rounded to 4 places (so near-equal MI ties break by name in both engines)."""
    mi = prep.mutual_information(mi_rows(fx), MI_COLS).withColumn("mi", r4("mi"))
    return prep.capped_selection(mi, CATEGORY_OF, CAPS).select("feature", "category", "rank")


@register("select_capped", SELECTED_SQL, ctes=("o_prep",))
def q_capped(fx):
    return selected_features(fx)
