"""Preprocessing and feature selection (2.7).

Statistics (means, exact medians and quartiles, modes, min/max) are one-row
aggregates used as scalar subqueries, so applying them never joins or
collects rows. Sequential outlier removal is inherently one pass per column
(each bound depends on the rows kept so far).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.columns import wt
from barloom.functions.quantiles import exact_quantiles
from barloom.functions.sizing import checked_broadcast
from barloom.functions.wide import column_moments, column_quantiles, packed
from barloom.session import stored

c_ = F.col


def column_median(df: DataFrame, col: str) -> Column:
    return exact_quantiles(df, col, [0.5]).select(F.max("quantile")).scalar()


def column_mode(df: DataFrame, col: str) -> Column:
    """Most frequent non-NULL value; ties go to the smallest value."""
    counts = df.filter(c_(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.agg(F.max(F.struct(c_("_n").alias("n"), (-c_(col)).alias("neg"))).alias("b"))
    return best.select(-c_("b.neg")).scalar()


def impute(df: DataFrame, cols: Sequence[str], strategy: str) -> DataFrame:
    """H1: mean / median / mode / forward (per ticker, by date) / drop."""
    if strategy == "drop":
        return df.dropna(subset=list(cols))
    out = df
    for col in cols:
        if strategy == "mean":
            fill = df.select(F.avg(col)).scalar()
        elif strategy == "median":
            fill = column_median(df, col)
        elif strategy == "mode":
            fill = column_mode(df, col)
        elif strategy == "forward_fill":
            fill = F.last(col, ignorenulls=True).over(wt().rowsBetween(Window.unboundedPreceding, 0))
        else:
            raise ValueError(strategy)
        out = out.withColumn(col, F.coalesce(c_(col), fill))
    return out


def categories(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct categories; the wide form has a column for each, so their
    number is bounded by the width a caller wants."""
    return [r[0] for r in df.select(col).distinct().orderBy(col).collect()]


def one_hot(df: DataFrame, col: str, drop_first: bool = True) -> DataFrame:
    """H2: one indicator column per category, the first (sorted) dropped."""
    cats = categories(df, col)
    keep = cats[1:] if drop_first else cats
    return df.select(*[c for c in df.columns if c != col],
                     *[(c_(col) == F.lit(k)).cast("double").alias(f"{col}_{k}") for k in keep])


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """H2: codes over sorted distinct string values; NULL is the text 'None'."""
    out = out or col
    s = F.coalesce(c_(col).cast("string"), F.lit("None"))
    codes = df.select(s.alias("_v")).distinct().select(
        "_v", (F.dense_rank().over(Window.orderBy("_v")) - 1).alias("_code"))
    j = df.withColumn("_v", s).join(checked_broadcast(codes), "_v", "left")
    return j.withColumn(out, c_("_code").cast("int")).drop("_v", "_code")


def standard_scale(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None) -> DataFrame:
    """H3: (x - mean) / population sd, statistics from ``fit`` (the train slice)."""
    fit = df if fit is None else fit
    stats = fit.select(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols],
                                *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])).scalar()
    out = df
    for c in cols:
        sd = stats[f"s_{c}"]
        out = out.withColumn(c, F.when(sd > 0, (c_(c) - stats[f"m_{c}"]) / sd).otherwise(F.lit(0.0)))
    return out


def minmax_scale(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None) -> DataFrame:
    """H3: (x - min) / (max - min), statistics from ``fit``."""
    fit = df if fit is None else fit
    stats = fit.select(F.struct(*[F.min(c).alias(f"lo_{c}") for c in cols],
                                *[F.max(c).alias(f"hi_{c}") for c in cols])).scalar()
    out = df
    for c in cols:
        lo, hi = stats[f"lo_{c}"], stats[f"hi_{c}"]
        out = out.withColumn(c, F.when(hi > lo, (c_(c) - lo) / (hi - lo)).otherwise(F.lit(0.0)))
    return out


def remove_outliers(df: DataFrame, cols: Sequence[str], method: str = "iqr", threshold: float = 1.5) -> DataFrame:
    """H4: sequential removal; bounds are recomputed on the rows kept so far.
    Rows with NULL in a processed column are removed (NaN compares false)."""
    out = df
    for c in cols:
        if method == "iqr":
            q = exact_quantiles(out, c, [0.25, 0.75])
            q1 = q.filter(c_("q") == 0.25).select(F.max("quantile")).scalar()
            q3 = q.filter(c_("q") == 0.75).select(F.max("quantile")).scalar()
            iqr = q3 - q1
            out = out.filter((c_(c) >= q1 - threshold * iqr) & (c_(c) <= q3 + threshold * iqr))
        elif method == "zscore":
            m = out.select(F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s"))).scalar()
            out = out.filter(F.abs((c_(c) - m["m"]) / m["s"]) <= threshold)
        else:
            raise ValueError(method)
        # each step's bounds depend on the previous filter: a written table keeps
        # later scalar subqueries from running every earlier step again
        out = stored(out, f"kept-{c}")
    return out


def stack(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(*keep, feature, value)``."""
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), c_(c).cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.explode(arr).alias("_s")).select(*keep, "_s.feature", "_s.value")


def snapped(df: DataFrame, cols: Sequence[str], *keep: str) -> DataFrame:
    """``keep`` and the columns snapped to 1e-9, so that last-bit differences in computed features never move a tied
    block of rows across a bin edge."""
    return df.select(*keep, *[(F.floor(c_(c).cast("double") * 1e9 + 0.501) / 1e9).alias(c) for c in cols])


def bin_counts(rows: DataFrame, cols: Sequence[str], edges: list[list[float]], y: str) -> DataFrame:
    """(feature, bin, y, n_by) of a packed table with its label: rows by bin (how many of the column's sorted edges are
    below the value) and label. Every task counts its batches; its counts meet in one small aggregate."""
    many = max((len(e) for e in edges), default=0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x, labels in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                v, codes = np.frombuffer(x.as_buffer(), float), np.frombuffer(labels.as_buffer(), np.int32)
                there = ~np.isnan(v)
                at = np.searchsorted(edges[i], v[there], "left")
                for code in np.unique(codes):
                    n = total.setdefault(int(code), np.zeros((len(cols), many), np.int64))
                    n[i] += np.bincount(at[codes[there] == code], minlength=many)
        for code, n in total.items():
            i, j = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(
                np.full(len(i), code), pa.int32()), pa.array(n[i, j], pa.int64())], names=["i", "bin", "y", "n"])

    parts = rows.where("x IS NOT NULL").select("i", "x", "y").mapInArrow(run, "i int, bin int, y int, n long")
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), c_("i") + 1)
    return parts.groupBy("i", "bin", "y").agg(F.sum("n").alias("n_by")).select(name.alias("feature"), "bin", c_("y").alias(y), "n_by")


def binned_mutual_information(df: DataFrame, cols: Sequence[str], y: str = "y", bins: int = 10) -> DataFrame:
    """H5 (re-aimed): mutual information (nats) between each feature's
    equal-frequency bin (exact quantile edges) and the label (a whole number), from contingency
    counts: sum p(b,y) ln(p(b,y) / (p(b) p(y))). The rows are read once and kept packed by column."""
    return mutual_information(packed(snapped(df, cols, y), cols, label=y), cols, y, bins)


def mutual_information(rows: DataFrame, cols: Sequence[str], y: str = "y", bins: int = 10) -> DataFrame:
    """``binned_mutual_information`` of packed, ``snapped`` rows with their label (``functions.wide``)."""
    edges = column_quantiles(rows, [i / bins for i in range(1, bins)], *column_moments(rows, len(cols)))
    cnt = bin_counts(rows, cols, [[x for x in e if x is not None] for e in edges], y)
    wf = Window.partitionBy("feature")
    cnt = cnt.select("feature", "bin", y, "n_by", F.sum("n_by").over(wf).alias("n"),
                     F.sum("n_by").over(Window.partitionBy("feature", "bin")).alias("n_b"),
                     F.sum("n_by").over(Window.partitionBy("feature", y)).alias("n_y"))
    term = (c_("n_by") / c_("n")) * F.log((c_("n_by") * c_("n")) / (c_("n_b") * c_("n_y")))
    return cnt.groupBy("feature").agg(F.sum(term).alias("mi"))


def capped_selection(mi: DataFrame, category_of: dict[str, str], caps: dict[str, int]) -> DataFrame:
    """H6: top features per category by MI (ties by name), each category capped."""
    m = mi.withColumn("category", F.coalesce(
        F.element_at(F.create_map(*[x for k, v in category_of.items() for x in (F.lit(k), F.lit(v))]), c_("feature")),
        F.lit("stock")))
    w = Window.partitionBy("category").orderBy(c_("mi").desc(), c_("feature"))
    m = m.withColumn("rank", F.row_number().over(w))
    cap = F.element_at(F.create_map(*[x for k, v in caps.items() for x in (F.lit(k), F.lit(v))]), c_("category"))
    return m.filter(c_("rank") <= cap)
