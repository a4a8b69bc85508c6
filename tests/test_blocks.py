"""Long histories in blocks give what one window gives."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.functions.blocks import filled_forward, in_blocks, with_block
from barloom.functions.columns import wt
from barloom.operators import features as feat
from barloom.session import plan_session
from barloom.sources.fixtures import Fixtures

DIR = "/root/testdata/sf0.001"


def one_ticker(frame, name="LONG"):
    """The rows of all tickers as one history, a day each."""
    order = Window.orderBy("ticker", "trading_date")
    day = F.date_add(F.lit(dt.date(1900, 1, 1)), F.row_number().over(order))
    return frame.withColumn("trading_date", day).withColumn("ticker", F.lit(name))


def assert_same(a, b, skip=()):
    a, b = (x.drop(*skip).orderBy("ticker", "trading_date").toPandas() for x in (a, b))
    assert len(a) == len(b) and list(a.columns) == list(b.columns)
    for c in a.columns:
        x, y = a[c], b[c]
        assert (x.isna() == y.isna()).all(), c
        if x.dtype.kind == "f":
            assert np.allclose(x.fillna(0), y.fillna(0), rtol=1e-9, atol=1e-9), c
        else:
            assert (x[x.notna()] == y[y.notna()]).all(), c


def test_feature_layers_in_blocks(spark):
    fx = Fixtures(plan_session(spark), DIR)
    frame = feat.enriched_frame(fx)
    few = frame.where(F.col("ticker") == frame.agg(F.min("ticker")).first()[0])
    frame = feat.stored(one_ticker(frame).unionByName(few), "long")
    assert frame.count() > 4 * 1400
    flags = feat.supplied_flags(fx)
    drop = [c for c in feat.ticker_layers(frame, flags).columns if c.startswith("_")]

    def layers(f):
        return feat.ticker_layers(f, flags)

    assert_same(in_blocks(frame, layers, 1400), layers(frame), drop)
    enhanced = in_blocks(frame, feat.enhanced_features, 1400)
    assert_same(enhanced, feat.enhanced_features(frame))


def test_a_long_ticker_is_many_tasks(spark):
    frame = spark.range(60_000).select(F.lit("X").alias("ticker"), F.date_add(F.lit(dt.date(1900, 1, 1)), F.col("id").cast("int")).alias(
        "trading_date"), F.rand(1).alias("close_price"))
    frame = feat.stored(frame, "long")
    out = in_blocks(frame, lambda f: f.select("*", F.avg("close_price").over(wt().rowsBetween(-199, 0)).alias("m")), 4000)
    assert out.count() == 60_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_blk" in plan
    blocks = with_block(frame, 4000).groupBy("_blk").count().collect()
    assert len(blocks) == 15 and all(r["count"] == 4000 for r in blocks)


def test_fill_carries_over_blocks(spark):
    draw = np.random.default_rng(2)
    rows = [("X", dt.date(2000, 1, 1) + dt.timedelta(days=int(i)), float(i) if draw.random() < 0.01 else None,
             "s" if draw.random() < 0.002 else None) for i in range(3000)]
    rows += [("Y", dt.date(2000, 1, 1) + dt.timedelta(days=i), None if i % 3 else 1.0 * i, None) for i in range(20)]
    frame = feat.stored(spark.createDataFrame(rows, "ticker string, trading_date date, a double, b string"), "fill")
    values = {"a": F.col("a"), "b": F.col("b")}
    assert_same(filled_forward(frame, values, 100), filled_forward(frame, values))
    clean = feat.forward_fill_clean(frame, gaps=feat.columns_with_gaps(frame))
    assert_same(clean, feat.forward_fill_clean(frame))


def test_stored_buckets_need_no_exchange(spark):
    fx = Fixtures(plan_session(spark), DIR)
    joined = feat.join_indicators(feat.bars_with_rsi(fx.bars, fx.rsi), feat.indicator_inputs(fx))
    plan = joined.select("*", F.avg("close_price").over(wt()).alias("m"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ticker" not in plan


@pytest.mark.parametrize("before", [1500])
def test_halo_must_fit(spark, before):
    frame = spark.createDataFrame([("X", dt.date(2000, 1, 1))], "ticker string, trading_date date")
    with pytest.raises(ValueError):
        in_blocks(frame, lambda f: f, 1000, before)
