"""Column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Window over one ticker's history; every per-ticker feature layer uses it, so
# all of them share one shuffle by ticker and one sort.
def wt():
    return Window.partitionBy("ticker").orderBy("trading_date")


def rows(n_back: int, n_fwd: int = 0):
    """Frame of the last ``n_back`` rows (pandas ``rolling(n_back + 1, min_periods=1)``)."""
    return wt().rowsBetween(-n_back, n_fwd)


def running():
    """Frame from the first row of the ticker to the current row (computed
    incrementally by Spark, unlike sliding frames)."""
    return wt().rowsBetween(Window.unboundedPreceding, 0)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r4(c) -> Column:
    """Portable rounding to 4 decimals, identical in Spark and DuckDB:
    ``FLOOR(x * 1e4 + 0.501) / 1e4``. Used only at outputs."""
    return (F.floor(col(c) * F.lit(1e4) + F.lit(0.501)) / F.lit(1e4)).cast("double")


def r4_sql(expr: str) -> str:
    return f"FLOOR(({expr}) * 1e4 + 0.501) / 1e4"


def ratio_or(num, den, default) -> Column:
    """``num / den`` when ``den > 0`` else ``default`` (numpy ``where`` form)."""
    d = col(den)
    return F.when(d > 0, F.try_divide(col(num), d)).otherwise(F.lit(default))


def clip(c, lo=None, hi=None) -> Column:
    """pandas ``clip``: bounds applied only to non-NULL values."""
    x = col(c)
    if lo is not None:
        x = F.when(x.isNull(), x).otherwise(F.greatest(x, F.lit(lo)))
    if hi is not None:
        x = F.when(x.isNull(), x).otherwise(F.least(x, F.lit(hi)))
    return x


def nan_to_null(c) -> Column:
    x = col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def sign_ne(a, b) -> Column:
    """pandas ``sign(a) != sign(b)``: a NULL on either side counts as different."""
    return F.coalesce(F.signum(col(a)) != F.signum(col(b)), F.lit(True))


def eq_or_false(a, b) -> Column:
    """pandas ``a == b``: a NULL on either side counts as not equal."""
    return F.coalesce(col(a) == col(b), F.lit(False))


def pct_change(c, lagged) -> Column:
    """``c / lag - 1`` with a NULL for a missing or zero base (pandas gives inf;
    the pipeline turns inf into NULL before it is used)."""
    return F.try_divide(col(c), F.when(col(lagged) != 0, col(lagged))) - F.lit(1.0)
