"""Categorical code maps (C16, C17) as literal map columns.

FIXED VALUES: these labels and codes must equal the reference pipeline's
encodings for the features to mean the same thing. Unknown labels map to 0.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (reference encodings) ---------------------------------
TREND_STATUS_CODES = {
    "STRONG_UPTREND": 2, "UPTREND": 1, "NEUTRAL": 0, "DOWNTREND": -1, "STRONG_DOWNTREND": -2,
}
CROSS_STATUS_CODES = {"GOLDEN_CROSS_ZONE": 1, "NEUTRAL": 0, "DEATH_CROSS_ZONE": -1}
SMA_SIGNAL_CODES = {"Golden Cross": 1, "Death Cross": -1}
MACD_SIGNAL_CODES = {
    "Bullish Crossover": 1, "Bearish Crossover": -1, "BUY": 1, "SELL": -1, "NEUTRAL": 0, "No Signal": 0,
}
TRADE_SIGNAL_CODES = {
    "STRONG_BUY": 2, "BUY": 1, "BUY_FIB_500": 1, "BUY_FIB_382": 1, "BUY_FIB_236": 1,
    "BUY_BULLISH_CROSS": 1, "NEUTRAL": 0, "NEUTRAL_WAIT": 0, "No Signal": 0, "SELL": -1,
    "SELL_BEARISH_CROSS": -1, "STRONG_SELL": -2, "NEAR_SUPPORT_BUY": 1, "BULLISH_ZONE": 1,
    "NEAR_RESISTANCE_SELL": -1, "BEARISH_ZONE": -1, "Bullish Crossover": 1, "Bearish Crossover": -1,
}
POSITION_CODES = {
    "ABOVE_PIVOT": 1, "BELOW_PIVOT": -1, "Above": 1, "Below": -1, "BULLISH": 1, "BEARISH": -1,
}
SECTOR_TO_ETF = {
    "Technology": "xlk_return_1d", "Financial Services": "xlf_return_1d", "Energy": "xle_return_1d",
    "Healthcare": "xlv_return_1d", "Industrials": "xli_return_1d",
    "Communication Services": "xlc_return_1d", "Consumer Cyclical": "xly_return_1d",
    "Consumer Defensive": "xlp_return_1d", "Basic Materials": "xlb_return_1d",
    "Real Estate": "xlre_return_1d", "Utilities": "xlu_return_1d",
}
ETF_FALLBACK = "sp500_return_1d"
# -------------------------------------------------------------------------


def code_of(column: str | Column, codes: dict[str, int]) -> Column:
    """``coalesce(codes[c], 0.0)``; NULL and unknown labels give 0."""
    c = F.col(column) if isinstance(column, str) else column
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in codes.items()))
    return F.coalesce(F.try_element_at(m, c), F.lit(0.0))


def code_sql(column: str, codes: dict[str, int]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {float(v)!r}e0".replace(".0e0", "e0") for k, v in codes.items())
    return f"COALESCE(CASE {column} {whens} END, 0e0)"


def sector_etf_return(sector: str = "sector") -> Column:
    """The sector's ETF return column; other or NULL sectors use the S&P return."""
    expr = F.col(ETF_FALLBACK)
    for name, etf in reversed(list(SECTOR_TO_ETF.items())):
        expr = F.when(F.col(sector) == F.lit(name), F.col(etf)).otherwise(expr)
    return expr


def sector_etf_sql(sector: str = "sector") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in SECTOR_TO_ETF.items())
    return f"CASE {sector} {whens} ELSE {ETF_FALLBACK} END"
