"""Unit tests on tiny frames for the semantics that must be exact (survey 4.3)."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.functions.ema import EmaSpec, add_ema
from barloom.functions.quantiles import exact_quantiles
from barloom.functions.rowindex import exact_row_index
from barloom.operators import labels as lab
from barloom.operators import outcomes as out
from barloom.operators import signals as sig
from barloom.operators import thresholds as thr


def _series_frame(spark, values, ticker="T"):
    base = pd.Timestamp("2000-01-03")
    rows = [(ticker, (base + pd.Timedelta(days=i)).date(), None if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "ticker string, trading_date date, x double")
    return df.withColumn("_i", F.row_number().over(Window.partitionBy("ticker").orderBy("trading_date")) - 1)


def test_ema_adjusted_matches_pandas_across_blocks(spark):
    rnd = random.Random(1)
    vals = [100 + rnd.gauss(0, 5) for _ in range(3600)]
    vals[10] = None
    vals[2000] = None
    df = _series_frame(spark, vals)
    got = add_ema(df, [EmaSpec("e5", "x", 5), EmaSpec("e50", "x", 50)]).orderBy("trading_date").toPandas()
    s = pd.Series([np.nan if v is None else v for v in vals])
    for name, span in (("e5", 5), ("e50", 50)):
        exp = s.ewm(span=span, adjust=True, min_periods=1).mean().to_numpy()
        assert np.allclose(got[name].to_numpy(dtype=float), exp, rtol=1e-12, atol=1e-9)


def test_ema_recursive_matches_pandas(spark):
    rnd = random.Random(2)
    vals = [50 + rnd.gauss(0, 2) for _ in range(2500)]
    df = _series_frame(spark, vals)
    got = add_ema(df, [EmaSpec("e12", "x", 12, adjust=False)]).orderBy("trading_date").toPandas()
    exp = pd.Series(vals).ewm(span=12, adjust=False).mean().to_numpy()
    assert np.allclose(got["e12"].to_numpy(dtype=float), exp, rtol=1e-12)


def test_rank_pct_ties_and_nulls_like_pandas(spark):
    vals = [0.5, None, 0.2, 0.5, 0.9, None, 0.2, 0.5]
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate(vals)], "d string, i int, x double")
    w = Window.partitionBy("d")
    rk = F.rank().over(w.orderBy(F.col("x").asc_nulls_last()))
    ties = F.count(F.lit(1)).over(Window.partitionBy("d", "x"))
    got = df.select("i", ((rk + (ties - 1) / 2.0) / F.count(F.lit(1)).over(w)).alias("r")).orderBy("i").toPandas()
    exp = pd.Series([np.nan if v is None else v for v in vals]).rank(pct=True, na_option="bottom")
    assert np.allclose(got["r"].to_numpy(), exp.to_numpy())


def test_reliability_rules_first_match_and_actionable(spark):
    rows = [
        (1, 0.80, 4.0, 50.0, "Technology"),   # penny stock first
        (2, 0.56, 100.0, 50.0, "Energy"),     # Up, dead zone (0.56 >= .55 no) -> energy
        (3, 0.54, 100.0, 50.0, None),         # Up 0.54 -> dead zone
        (4, 0.60, 100.0, 75.0, "Healthcare"),  # RSI block before sector override
        (5, 0.56, 100.0, None, "Technology"),  # sector override (0.56 < .57)
        (6, 0.30, 100.0, 50.0, None),         # Down, actionable
    ]
    df = spark.createDataFrame(rows, "id int, up_probability double, close_price double, RSI double, sector string")
    cfg = sig.SignalConfig()
    r = sig.reliability_filter(sig.decide_direction(df, cfg), cfg).orderBy("id").collect()
    assert [x.suppression_reason for x in r] == ["penny_stock", "energy_sector", "buy_dead_zone",
                                                 "rsi_overbought_buy", "sector_override", None]
    assert all(x.is_actionable == (x.suppression_reason is None) for x in r)
    assert not any(x.high_confidence and not x.is_actionable for x in r)


def test_classify_signal(spark):
    df = spark.createDataFrame([("Buy",), ("Down",), ("sell-up",), ("hold",), (None,)], "s string")
    got = [r[0] for r in df.select(out.classify_signal("s")).collect()]
    assert got == ["bullish", "bearish", "bullish", None, None]


def test_exact_row_index_equals_global_row_number(spark):
    rnd = random.Random(3)
    rows = [(f"t{rnd.randint(0, 9)}", rnd.randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, o int, k int").dropDuplicates(["g", "o"])
    got = exact_row_index(df, ["g"], ["o"], "ri").orderBy("g", "o").select("ri").toPandas()["ri"].tolist()
    assert got == list(range(1, len(got) + 1))


def test_exact_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(4)
    vals = np.concatenate([rnd.normal(size=3000), np.repeat(0.25, 400), rnd.exponential(size=1000)])
    grp = np.array(["a", "b"])[rnd.integers(0, 2, size=len(vals))]
    df = spark.createDataFrame(pd.DataFrame({"g": grp, "v": vals}))
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, "v", qs, ["g"], buckets=64).toPandas()
    for g in ("a", "b"):
        for q in qs:
            exp = np.percentile(vals[grp == g], q * 100)
            val = got[(got.g == g) & (got.q == q)]["quantile"].iloc[0]
            assert math.isclose(val, exp, rel_tol=1e-12, abs_tol=1e-12)


def test_purged_split_properties(spark):
    rows = [(f"t{t}", pd.Timestamp("2001-01-01").date() + pd.Timedelta(days=d)) for t in range(3) for d in range(100)]
    df = spark.createDataFrame(rows, "ticker string, trading_date date")
    s = lab.split_purged(df).toPandas()
    per_date = s.groupby("trading_date")["split"].nunique(dropna=False)
    assert (per_date == 1).all()
    d = s.dropna(subset=["split"]).groupby("split")["trading_date"].agg(["min", "max"])
    gap_train = (d.loc["calibration", "min"] - d.loc["train", "max"]).days
    gap_cal = (d.loc["test", "min"] - d.loc["calibration", "max"]).days
    assert gap_train > 5 and gap_cal > 5


def test_sample_weights_average_to_one(spark):
    rows = [(f"t{i % 7}", pd.Timestamp("2001-01-01").date() + pd.Timedelta(days=i // 7), "Up" if i % 3 else "Down")
            for i in range(700)]
    df = spark.createDataFrame(rows, "ticker string, trading_date date, direction_5d string")
    w = lab.sample_weights(df).toPandas()
    assert math.isclose(w["sample_weight"].mean(), 1.0, rel_tol=1e-12)
    assert w.sort_values(["trading_date", "ticker"])["pos"].tolist() == list(range(700))


def test_cutoff_searches_match_brute_force(spark):
    rnd = random.Random(5)
    rows = [(round(rnd.uniform(0.5, 0.8), 5), int(rnd.random() < 0.45 + 0.3 * k / 2000)) for k in range(2000)]
    df = spark.createDataFrame(rows, "confidence double, correct int")
    pdf = pd.DataFrame(rows, columns=["confidence", "correct"])
    cands = np.sort(np.unique(np.floor(pdf.confidence * 1e4 + 0.501) / 1e4))
    for target in (0.5, 0.55):
        ok = [c for c in cands if (pdf.confidence >= c).sum() >= 100 and pdf[pdf.confidence >= c].correct.mean() >= target]
        got = thr.cutoff_lowest(df, [], target, 100).collect()
        assert (got[0].cutoff if got else None) == (min(ok) if ok else None)
    ok = [c for c in cands if (pdf.confidence <= c).sum() >= 100 and pdf[pdf.confidence <= c].correct.mean() >= 0.5]
    got = thr.cutoff_highest(df, [], 0.5, 100).collect()
    assert (got[0].cutoff if got else None) == (max(ok) if ok else None)


def test_tune_threshold_matches_brute_force(spark):
    rnd = random.Random(6)
    rows = [(rnd.random(), int(rnd.random() < 0.5)) for _ in range(3000)]
    rows = [(p, int(rnd.random() < p)) for p, _ in rows]
    df = spark.createDataFrame(rows, "p double, y int")
    best, best_thr = -1.0, None
    for k in range(82):
        t = (300 + 5 * k) / 1000
        tp = sum(1 for p, y in rows if p >= t and y == 1)
        fn = sum(1 for p, y in rows if p < t and y == 1)
        tn = sum(1 for p, y in rows if p < t and y == 0)
        fp = sum(1 for p, y in rows if p >= t and y == 0)
        bal = ((tp / (tp + fn) if tp + fn else 0) + (tn / (tn + fp) if tn + fp else 0)) / 2
        if bal > best:
            best, best_thr = bal, t
    got = thr.tune_threshold(df).collect()[0]
    assert got.threshold == best_thr and math.isclose(got.balanced_accuracy, best, rel_tol=1e-12)


def test_quantiles_and_prefixes_with_a_far_outlier(spark):
    import numpy as np
    from barloom.functions.quantiles import exact_quantiles, ordered_prefix
    draw = np.random.default_rng(1)
    values = [float(x) for x in draw.normal(0, 1, 3000)] + [1e12, -1e9, 0.5, 0.5, 0.5]
    df = spark.createDataFrame([(g, v) for g in ("a", "b") for v in values[: 3005 if g == "a" else 7]] + [("c", None)],
                               "g string, v double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["q"]): r["quantile"] for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    assert set(got) == {(g, q) for g in "ab" for q in qs}
    for (g, q), x in got.items():
        assert x == pytest.approx(np.quantile(values[: 3005 if g == "a" else 7], q), rel=1e-12)
    whole = {r["q"]: r["quantile"] for r in exact_quantiles(df.where("g = 'a'"), "v", qs).collect()}
    assert whole[0.5] == pytest.approx(np.quantile(values, 0.5), rel=1e-12)
    counts = df.where("v IS NOT NULL").groupBy("g", "v").agg(F.count("*").alias("n"))
    for descending in (False, True):
        rows = ordered_prefix(counts, "v", ["n"], ["g"], descending).where("g = 'a'").collect()
        for r in rows[::97] + [x for x in rows if abs(x["v"]) > 1e8]:
            assert r["n_before"] == sum(x > r["v"] if descending else x < r["v"] for x in values)


def test_each_report_alert(spark):
    import json
    from barloom.plans.q_profile import report_alerts
    from barloom.sources.io import REPORT_SCHEMA
    good = {"date": "2001-05-05T18:00:00", "data_status": {"connected": True, "age_days": 0}, "retraining": {"performed": True, "success": True},
            "csv_exports": {"success": True}}
    cases = {
        None: {}, "database connection failed": {"data_status": {"connected": False}},
        "model retraining failed": {"retraining": {"performed": True, "success": False}},
        "csv export failed": {"csv_exports": {"success": False}}, "data is 6 days old": {"data_status": {"connected": True, "age_days": 6}},
        "automation has not run in 31.0 hours": {"date": "2001-05-04T18:00:00"},
    }
    for want, change in cases.items():
        lines = [json.dumps({**good, **change}), json.dumps({"date": "2001-05-01T18:00:00"})]
        rows = spark.createDataFrame([(x,) for x in lines], "v string").select(F.from_json("v", REPORT_SCHEMA).alias("r")).select("r.*")
        assert [r["alert"] for r in report_alerts(rows, "2001-05-06T01:00:00").collect()] == [want]
    none = report_alerts(rows.where("false"), "2001-05-06T01:00:00").collect()
    assert [r["alert"] for r in none] == ["no automation reports found"]


def test_scored_bars_are_the_newest(spark):
    from barloom.plans.pipelines import newest_bars
    from barloom.sources.fixtures import Fixtures
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    newest = {r["ticker"]: r["d"] for r in fx.bars.where("close_price >= 5 AND volume > 0").groupBy("ticker").agg(
        F.max("trading_date").alias("d")).collect()}
    got = {r["ticker"]: r["trading_date"] for r in newest_bars(fx).collect()}
    assert got and all(got[t] == newest[t] for t in got)
