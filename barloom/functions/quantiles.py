"""Exact linear-interpolation quantiles without collecting a group in one task.

``percentile`` / ``median`` keep a value->count map per group and merge it in
one task, which does not scale for a large continuous group. Here every wanted
order statistic is narrowed down by counting:

1. a range of values (at first from the group's least to its greatest) is cut
   into ``buckets`` equal steps, and rows are counted per step with the least
   and greatest value in it (partial aggregation, a small result);
2. the step that holds the wanted rank becomes the next range. After a far
   outlier the first step may hold nearly all rows, so this is done ``LEVELS``
   times, each on the values actually present;
3. the rows of the last range are counted by distinct value.

The answer equals numpy / pandas / DuckDB ``quantile_cont`` (linear).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c_ = F.col
#: Times that a range is cut into steps before its values are counted one by one.
LEVELS = 3


def _one_group(df: DataFrame) -> DataFrame:
    """A grouping column with one value; generated, so that joins on it stay hash joins."""
    return df.select("*", F.explode(F.array(F.lit(0))).alias("_g"))


def _step(value: Column, lo: Column, hi: Column, buckets: int) -> Column:
    width = hi - lo
    return F.when(width > 0, F.least(F.floor((value - lo) / width * buckets), F.lit(buckets - 1))).otherwise(
        F.lit(0)).cast("int")


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], group: Sequence[str] = (),
                    buckets: int = 4096) -> DataFrame:
    """One row per group and quantile: ``(*group, q, quantile)``. NULLs are ignored."""
    group = list(group)
    synthetic = not group
    if synthetic:
        df, group = _one_group(df), ["_g"]
    v = df.select(*group, c_(value).cast("double").alias("_v")).filter(c_("_v").isNotNull() & ~F.isnan("_v"))
    stats = v.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    # ranks (0-based) around q * (n - 1), each with the range of values that holds it
    at = F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q")
    wanted = stats.select(*group, "_n", "_lo", "_hi", at).withColumn("_h", c_("q") * (c_("_n") - 1))
    sides = F.explode(F.array(F.struct(F.lit("lo").alias("side"), F.floor("_h").cast("long").alias("r")),
                              F.struct(F.lit("hi").alias("side"), F.ceil("_h").cast("long").alias("r"))))
    wanted = wanted.select(*group, "q", "_h", "_lo", "_hi", sides.alias("t")).select(
        *group, "q", "_h", "_lo", "_hi", "t.side", "t.r")
    span = [*group, "_lo", "_hi"]

    def inside(ranges: DataFrame) -> DataFrame:
        # at most two ranges per group and quantile
        return v.join(F.broadcast(ranges.select(*span).distinct()), group).filter(c_("_v").between(c_("_lo"), c_("_hi")))

    for _ in range(LEVELS):
        steps = inside(wanted).groupBy(*span, _step(c_("_v"), c_("_lo"), c_("_hi"), buckets).alias("_b")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi"))
        upto = F.sum("_c").over(Window.partitionBy(*span).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
        steps = steps.withColumn("_upto", upto)
        wanted = wanted.join(steps, span).filter((c_("r") < c_("_upto")) & (c_("r") >= c_("_upto") - c_("_c"))).select(
            *group, "q", "_h", "side", (c_("r") - (c_("_upto") - c_("_c"))).alias("r"), c_("_blo").alias("_lo"),
            c_("_bhi").alias("_hi"))
    values = inside(wanted).groupBy(*span, "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*span).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    values = values.withColumn("_upto", upto)
    picked = wanted.join(values, span).filter((c_("r") < c_("_upto")) & (c_("r") >= c_("_upto") - c_("_c")))
    res = picked.groupBy(*group, "q").agg(
        F.max("_h").alias("_h"), F.max(F.when(c_("side") == "lo", c_("_v"))).alias("_vlo"),
        F.max(F.when(c_("side") == "hi", c_("_v"))).alias("_vhi"))
    res = res.select(*group, "q", (c_("_vlo") + (c_("_h") - F.floor("_h")) * (c_("_vhi") - c_("_vlo"))).alias("quantile"))
    return res.drop("_g") if synthetic else res


def ordered_prefix(counts: DataFrame, value: str, measures: Sequence[str], group: Sequence[str] = (),
                   descending: bool = False, buckets: int = 4096) -> DataFrame:
    """For a table with one row per distinct ``value`` (per group) and additive
    ``measures``, add ``<m>_before``: the measure summed over all values that
    come strictly earlier in the order. Three levels: prefixes over equal steps
    of the group's range, over equal steps of the values present in each step,
    and an ordered window inside the last; a far outlier that leaves one step
    with nearly all values is evened out by the second level."""
    group = list(group)
    synthetic = not group
    if synthetic:
        counts, group = _one_group(counts), ["_g"]

    def cut(x: DataFrame, keys: list[str], name: str) -> DataFrame:
        """Add the step ``name`` within ``keys`` and, per measure, what lies in earlier steps of the same keys."""
        stats = x.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
        b = _step(c_(value), c_("_lo"), c_("_hi"), buckets)
        x = x.join(stats, keys).withColumn(name, F.lit(buckets - 1) - b if descending else b).drop("_lo", "_hi")
        per = x.groupBy(*keys, name).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
        before = Window.partitionBy(*keys).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        per = per.select(*keys, name, *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"{name}_{m}")
                                        for m in measures])
        return x.join(per, [*keys, name])

    x = cut(cut(counts, group, "_b1"), [*group, "_b1"], "_b2")
    order = c_(value).desc() if descending else c_(value).asc()
    inner = Window.partitionBy(*group, "_b1", "_b2").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    names = [c for c in counts.columns if c != "_g" or not synthetic]
    return x.select(*names, *[(c_(f"_b1_{m}") + c_(f"_b2_{m}") + F.coalesce(F.sum(m).over(inner), F.lit(0))).alias(f"{m}_before")
                              for m in measures])
