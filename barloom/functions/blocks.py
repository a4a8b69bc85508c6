"""Long histories in blocks of rows, so that no ticker is one task's work.

A ticker with more than ``BLOCK_ROWS`` rows is cut into blocks by position. Each
block takes along the rows before and after it that the longest frame reaches
(the halo), is worked on as if it were a ticker of its own, and gives only its
own rows. Positions come from counts per month: a prefix sum over the months and
a row number within a month. Frames with no such ticker keep their plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.sizing import checked_broadcast

BLOCK_ROWS = 1 << 14
#: Rows that the layers of ``operators.features`` look back: 200 for means; an EMA of span 50
#: forgets all but e^-46 of what lies further back. They look ahead 5 rows.
BEFORE, AFTER = 1200, 5
_MARK = "\x01"


def long_tickers(frame: DataFrame, block_rows: int | None = None) -> DataFrame | None:
    """Tickers with more than a block's rows, or None where there are none."""
    many = frame.groupBy("ticker").count().where(F.col("count") > (block_rows or BLOCK_ROWS)).select("ticker")
    return many if many.limit(1).count() else None


def with_block(frame: DataFrame, block_rows: int | None = None) -> DataFrame:
    """``frame`` with ``_pos`` (0-based row number of the ticker by date) and ``_blk``."""
    month = F.trunc("trading_date", "MM")
    frame = frame.withColumn("_month", month)
    before = Window.partitionBy("ticker").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    months = frame.groupBy("ticker", "_month").agg(F.count(F.lit(1)).alias("_n"))
    offsets = months.select("ticker", "_month", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("ticker", "_month").orderBy("trading_date")) - 1
    frame = frame.join(checked_broadcast(offsets), ["ticker", "_month"])
    frame = frame.withColumn("_pos", F.col("_off") + inside).drop("_off", "_month")
    return frame.withColumn("_blk", F.expr(f"_pos div {block_rows or BLOCK_ROWS}"))


def in_blocks(frame: DataFrame, layers: Callable[[DataFrame], DataFrame], block_rows: int | None = None,
              before: int = BEFORE, after: int = AFTER, counted: DataFrame | None = None) -> DataFrame:
    """``layers(frame)``, which adds or picks columns by windows over (ticker, trading_date) that
    reach ``before`` rows back and ``after`` rows ahead, with long tickers in blocks. ``counted`` is a
    narrower frame with the same rows, from which the long tickers are known at less cost."""
    size = block_rows or BLOCK_ROWS
    if before + after > size:
        raise ValueError("a block must be longer than its halo")
    many = long_tickers(frame if counted is None else counted, size)
    if many is None:
        return layers(frame)
    many = checked_broadcast(many)
    plain = layers(frame.join(many, "ticker", "left_anti").select(frame.columns))
    at = F.expr(f"_pos % {size}")
    copies = F.filter(F.array(
        F.struct(F.col("_blk").alias("blk"), F.lit(True).alias("own")),
        F.struct(F.when(at >= size - before, F.col("_blk") + 1).alias("blk"), F.lit(False).alias("own")),
        F.struct(F.when((at < after) & (F.col("_blk") > 0), F.col("_blk") - 1).alias("blk"), F.lit(False).alias("own")),
    ), lambda c: c["blk"].isNotNull())
    rows = with_block(frame.join(many, "ticker", "left_semi").select(frame.columns), size).withColumn("_copy", F.explode(copies))
    # a block's name takes the ticker's place while the layers run
    named = F.concat_ws(_MARK, "ticker", F.col("_copy.blk"))
    bounds = checked_broadcast(rows.where("_copy.own").groupBy(named.alias("_name")).agg(
        F.min("trading_date").alias("_from"), F.max("trading_date").alias("_to")))
    worked = layers(rows.withColumn("ticker", named).drop("_copy", "_pos", "_blk"))
    worked = worked.join(bounds, F.col("ticker") == F.col("_name")).where("trading_date BETWEEN _from AND _to")
    worked = worked.withColumn("ticker", F.substring_index("ticker", _MARK, 1)).select(plain.columns)
    return plain.unionByName(worked)


def filled_forward(frame: DataFrame, values: dict[str, Column], block_rows: int | None = None) -> DataFrame:
    """``frame`` with each column of ``values`` set to its last non-NULL value so far, per ticker by
    date. A long ticker's blocks hand their last values on through a table with a row per block."""
    def fill(part: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy("trading_date").rowsBetween(Window.unboundedPreceding, 0)
        return part.select(*[F.last(values[c], ignorenulls=True).over(w).alias(c) if c in values else F.col(c)
                             for c in part.columns])

    if not values:
        return frame
    many = long_tickers(frame, block_rows)
    if many is None:
        return fill(frame, ["ticker"])
    many = checked_broadcast(many)
    rows = with_block(frame.join(many, "ticker", "left_semi"), block_rows)
    last = rows.groupBy("ticker", "_blk").agg(
        *[F.max_by(v, F.when(v.isNotNull(), F.col("trading_date"))).alias(c) for c, v in values.items()])
    so_far = Window.partitionBy("ticker").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select("ticker", "_blk", *[F.last(c, ignorenulls=True).over(so_far).alias(f"_carry_{c}") for c in values])
    worked = fill(rows, ["ticker", "_blk"]).join(checked_broadcast(carry), ["ticker", "_blk"])
    worked = worked.select(*[F.coalesce(c, f"_carry_{c}").alias(c) if c in values else F.col(c) for c in frame.columns])
    return fill(frame.join(many, "ticker", "left_anti"), ["ticker"]).select(frame.columns).unionByName(worked)
