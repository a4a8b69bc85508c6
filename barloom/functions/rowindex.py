"""A stable global row index without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.sizing import checked_broadcast


def exact_row_index(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                    name: str = "row_index", start: int = 1) -> DataFrame:
    """Number rows in the total order ``(group_cols, order_cols)``.

    Equals ``ROW_NUMBER() OVER (ORDER BY group_cols, order_cols) - 1 + start``
    when that order is total. Work: one aggregate to per-group counts, a prefix
    sum over the distinct groups (a small table, checked before broadcast) and
    a ``row_number`` inside each group.
    """
    group_cols = list(group_cols)
    counts = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_grp_n"))
    w_all = Window.orderBy(*group_cols).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, F.coalesce(F.sum("_grp_n").over(w_all), F.lit(0)).alias("_grp_off"))
    offsets = checked_broadcast(offsets)
    w_in = Window.partitionBy(*group_cols).orderBy(*order_cols)
    out = df.join(offsets, group_cols, "inner")
    return out.withColumn(
        name, (F.col("_grp_off") + F.row_number().over(w_in) - 1 + start).cast("bigint")
    ).drop("_grp_off")
