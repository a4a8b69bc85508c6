"""Exponentially weighted means as native window expressions.

pandas ``ewm(span, adjust=True).mean()`` at row t is
``sum_j r^j x_j / sum_j r^j`` over the rows so far, ``r = 1 / (1 - alpha)``,
``alpha = 2 / (span + 1)``, with NULL ``x`` left out of both sums.
``adjust=False`` is the same ratio with weights ``1, alpha, alpha, ...``.

``r^j`` overflows a double after ``709 / ln r`` rows (about 1,750 rows for
span 5), so the sums are taken per block of ``B`` rows with exponents relative
to the block start (``r^B <= e^650``). The previous block's total carries over
scaled by ``r^-B <= e^-40``; blocks further back contribute below ``e^-80``
relative and vanish in double precision, so the result is exact to rounding
for histories of any length. Work per EMA: one cumulative window inside
``(ticker, block)`` (same shuffle as the ticker window) and one carry window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


MAX_LOG_BLOCK = 650.0     # r^B stays below e^650
MIN_LOG_CARRY = 40.0      # r^-B at most e^-40, so two blocks back is below e^-80


@dataclass(frozen=True)
class EmaSpec:
    name: str
    source: str
    span: float
    adjust: bool = True

    @property
    def alpha(self) -> float:
        return 2.0 / (self.span + 1.0)

    @property
    def log_r(self) -> float:
        return -math.log(1.0 - self.alpha)


def block_size(specs: Sequence[EmaSpec]) -> int:
    hi = max(s.log_r for s in specs)
    lo = min(s.log_r for s in specs)
    b = int(MAX_LOG_BLOCK / hi)
    if b * lo < MIN_LOG_CARRY:
        raise ValueError("spans too far apart for one block size; split the EMA layer")
    return b


def with_ema_block(df: DataFrame, specs: Sequence[EmaSpec], index_col: str = "_i") -> DataFrame:
    """``df`` with ``_ema_blk``, the block that all of ``specs`` can share. Several calls of ``add_ema`` on
    such a frame sort it once: their windows are all in the order of partition, block and ``order``."""
    return df.withColumn("_ema_blk", F.floor(F.col(index_col) / F.lit(block_size(specs))))


def add_ema(df: DataFrame, specs: Sequence[EmaSpec], index_col: str = "_i",
            partition: Sequence[str] = ("ticker",), order: str = "trading_date", size: int | None = None) -> DataFrame:
    """Add one column per spec. ``index_col`` is the 0-based row number within
    ``partition`` in ``order`` (pandas' position, counting NULL rows). A frame of
    ``with_ema_block`` keeps its blocks, whose ``size`` must be given."""
    specs = list(specs)
    shared = "_ema_blk" in df.columns
    if shared != (size is not None):
        raise ValueError("blocks made before and their size go together")
    b = size or block_size(specs)
    part = list(partition)
    if not shared:
        df = with_ema_block(df, specs, index_col)
    # blocks follow the order, so that both windows need the same sort
    w_blk = Window.partitionBy(*part, "_ema_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    w_prev = Window.partitionBy(*part).orderBy("_ema_blk", order).rowsBetween(Window.unboundedPreceding, -1)
    i = F.col(index_col)
    df = df.withColumn("_ema_k", i - F.col("_ema_blk") * F.lit(b))
    k = F.col("_ema_k")
    sums = []
    for s in specs:
        x = F.col(s.source)
        weight = F.pow(F.lit(1.0 / (1.0 - s.alpha)), k)
        if not s.adjust:
            weight = weight * F.when(i == 0, F.lit(1.0)).otherwise(F.lit(s.alpha))
        sums.append(F.sum(F.when(x.isNotNull(), weight * x)).over(w_blk).alias(f"_{s.name}_p"))
        sums.append(F.sum(F.when(x.isNotNull(), weight)).over(w_blk).alias(f"_{s.name}_q"))
    df = df.select("*", *sums)
    carries = []
    for s in specs:
        for part_name in ("p", "q"):
            c = F.col(f"_{s.name}_{part_name}")
            carries.append(
                F.last(F.when(k == F.lit(b - 1), c), ignorenulls=True).over(w_prev).alias(f"_{s.name}_{part_name}c")
            )
    df = df.select("*", *carries)
    outs = []
    for s in specs:
        scale = F.lit(math.exp(-b * s.log_r))
        num = F.col(f"_{s.name}_p") + F.coalesce(F.col(f"_{s.name}_pc"), F.lit(0.0)) * scale
        den = F.col(f"_{s.name}_q") + F.coalesce(F.col(f"_{s.name}_qc"), F.lit(0.0)) * scale
        outs.append(F.try_divide(num, den).alias(s.name))
    drop = ["_ema_k"] + ["_ema_blk"] * (not shared) + [f"_{s.name}_{p}" for s in specs for p in ("p", "q", "pc", "qc")]
    return df.select("*", *outs).drop(*drop)


def ema_sql(x: str, span: float, index: str = "i", partition: str = "ticker",
            order: str = "trading_date", adjust: bool = True) -> str:
    """Reference SQL form for the oracle (plain cumulative sums, short histories)."""
    alpha = 2.0 / (span + 1.0)
    r = repr(1.0 / (1.0 - alpha))
    w = f"(PARTITION BY {partition} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    wt = f"POW({r}, {index})"
    if not adjust:
        wt = f"{wt} * (CASE WHEN {index} = 0 THEN 1e0 ELSE {alpha!r} END)"
    return (f"(SUM(CASE WHEN {x} IS NOT NULL THEN {wt} * {x} END) OVER {w} / "
            f"SUM(CASE WHEN {x} IS NOT NULL THEN {wt} END) OVER {w})")
