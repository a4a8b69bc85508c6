"""Rule sentiment in context, keywords by grams, the stratified split, calibration and profiles on hand-made rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import calibration, labels, profile
from barloom.operators import sentiment as sen


def test_negation_boosters_and_but(spark):
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, weight double")
    texts = {1: "a good day", 2: "not a good day", 3: "very good", 4: "not very good", 5: "slightly bad", 6: "isn’t so bad",
             7: "good but bad", 8: "never in all my life good", 9: "VERY, very GOOD!", 10: "nothing here"}
    rows = sen.token_scores(spark.createDataFrame(list(texts.items()), "seq long, text string"), lexicon).collect()
    got = {}
    for r in rows:
        got[r["seq"]] = got.get(r["seq"], 0.0) + r["score"]
    want = {1: 2.0, 2: -0.74 * 2, 3: 2.293, 4: -0.74 * 2.293, 5: -(2 - 0.293), 6: 0.74 * 2, 7: 2 * 0.5 - 2 * 1.5, 8: 2.0,
            9: 2 + 0.293 * 1.95}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)


def test_keywords_by_grams(spark):
    articles = [(1, "Chip makers rally", "AI demand"), (2, None, "oil and gas"), (3, "x", None), (4, "Biotechnology", "fda"), (5, None, None)]
    words = [("Tech", "chip"), ("Tech", "AI"), ("Energy", "oil"), ("Energy", "natural gas"), ("Health", "biotech"), ("Health", "F"), ("None", "")]
    a = spark.createDataFrame(articles, "seq long, title string, summary string")
    k = spark.createDataFrame(words, "sector string, keyword string")
    want = set()
    for seq, title, summary in articles:
        text = " ".join([title or "", summary or ""]).lower()
        want |= {(seq, s) for s, w in words if w and w.lower() in text}
    assert {(r["seq"], r["sector"]) for r in sen.keyword_matches(a, k).collect()} == want
    assert {r["seq"]: r["matched_sectors"] for r in sen.match_sectors(a, k).collect()}[3] == []


def test_few_and_many_keywords_match_alike(spark, monkeypatch):
    articles = [(1, "Chip makers", "AI"), (2, None, "oil, Öl und Gas"), (3, "x", None), (None, "biotech", "AI"), (1, "oil", ""), (5, None, None)]
    words = [("Tech", "chip"), ("Tech", "AI"), ("Tech", "ai"), ("Energy", "öl"), ("Health", "Biotech"), (None, "oil"), ("None", ""), ("None", None)]
    a = spark.createDataFrame(articles, "seq long, title string, summary string")
    k = spark.createDataFrame(words, "sector string, keyword string")
    many = sorted(map(repr, sen.keyword_matches(a, k, few=0).collect()))
    monkeypatch.setattr(sen, "_grams", None)                    # few keywords need no grams of the texts
    few = sorted(map(repr, sen.keyword_matches(a, k).collect()))
    assert few == many and len(few) == 4


@pytest.mark.parametrize("prefix", [1, 4])
def test_stratified_split_has_exact_shares(spark, prefix):
    rows = [(str(i), f"2020-01-{1 + i % 28:02d}", "Up" if i % 7 else "Down") for i in range(1000)] + [("z", "2020-01-01", None)] * 3
    df = spark.createDataFrame(rows, "ticker string, trading_date string, y string")
    out = labels.split_stratified(df, "y", prefix=prefix).groupBy("y", "split").count().collect()
    got = {(r["y"], r["split"]): r["count"] for r in out}
    assert got[("Up", "test")] == (857 * 20 + 50) // 100 and got[("Down", "test")] == (143 * 20 + 50) // 100
    assert sum(got.values()) == 1003 and got[(None, "test")] == 1
    assert labels.split_stratified(df.where("false"), "y").count() == 0


def plain_isotonic(points):
    pools = []
    for x, s, n in sorted(points):
        pools.append([x, x, s, n])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, hi, s, n = pools.pop()
            pools[-1][1:] = [hi, pools[-1][2] + s, pools[-1][3] + n]
    return pools


@pytest.mark.parametrize("shape", ["noisy", "falling", "rising", "one", "two values"])
def test_isotonic_by_plain_pooling(spark, shape):
    draw = np.random.default_rng(3)
    p = {"one": np.full(50, 0.4), "two values": draw.integers(0, 2, 400) / 2}.get(shape, draw.random(600))
    chance = {"falling": 1 - p, "rising": np.round(p)}.get(shape, p)
    y = (draw.random(len(p)) < chance).astype(int)
    cal = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)] + [(None, 1)], "p double, y int")
    grid = [0.0, 0.1, 0.25, 0.4, 0.5, 0.77, 1.0, 2.0, float(p[0])]
    got = {r["p"]: r["p_calibrated"] for r in calibration.isotonic(cal, spark.createDataFrame([(g,) for g in grid] + [(None,)], "p double"), ranges=7).collect()}
    sums = {}
    for a, b in zip(p.tolist(), y.tolist()):
        s, n = sums.get(a, (0, 0))
        sums[a] = (s + b, n + 1)
    xs, vs = [], []
    for lo, hi, s, n in plain_isotonic([(x, *v) for x, v in sums.items()]):
        xs += [lo, hi]
        vs += [s / n] * 2
    for g in grid:
        assert math.isclose(got[g], float(np.interp(g, xs, vs)), abs_tol=1e-9)
    assert got[None] is None


def test_isotonic_works_no_frame_out_anew_per_row(spark):
    rows = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.3, 0)], "p double, y int")
    plan = calibration.isotonic(rows, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "RangeFrame" in plan and "RangeFrame, currentrow$(), unboundedfollowing$()" not in plan


def test_platt_against_direct_newton(spark):
    draw = np.random.default_rng(4)
    p = draw.random(500)
    y = (draw.random(500) < 0.3 + 0.4 * p).astype(int)
    model = calibration.fit_platt(spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, y int"))
    x = np.log(np.clip(p, 1e-6, 1 - 1e-6) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))
    q = 1 / (1 + np.exp(-(model.slope * x + model.intercept)))
    assert abs(((q - y) * x).sum() + model.slope) < 1e-6 and abs((q - y).sum()) < 1e-6       # the gradient vanishes
    only = calibration.fit_platt(spark.createDataFrame([(0.2, 1), (0.9, 1)], "p double, y int"))
    assert only.slope == 0 and only.intercept > 10
    assert calibration.fit_platt(spark.createDataFrame([], "p double, y int")) == (0.0, 0.0, 0)


def test_profile_of_odd_columns(spark):
    rows = [(1.0, "a", None, 5, True), (float("nan"), "b", None, 5, None), (3.0, "a", None, 5, False), (None, None, None, 5, True)]
    df = spark.createDataFrame(rows, "x double, t string, nothing double, same long, flag boolean")
    got = {r["column_name"]: r for r in profile.profile(df).collect()}
    assert (got["x"]["n"], got["x"]["n_null"], got["x"]["mean"], got["x"]["median"]) == (2, 2, 2.0, 2.0)
    assert (got["t"]["top"], got["t"]["top_n"], got["t"]["n_distinct"], got["t"]["type_class"]) == ("a", 2, 2, "text")
    assert (got["nothing"]["n"], got["nothing"]["n_distinct"], got["nothing"]["mean"]) == (0, 0, None)
    assert got["same"]["std"] == 0.0 and got["flag"]["type_class"] == "boolean"
    assert {r["n"] for r in profile.profile(df.where("false")).collect()} == {0}
    assert profile.duplicate_rows(df.unionByName(df.limit(2))).first()["n_duplicates"] == 2
    assert profile.duplicate_rows(df.where("false")).first().asDict() == {"n_rows": 0, "n_duplicates": 0}
    corr = {(r["col_a"], r["col_b"]): r for r in profile.correlations(df).collect()}
    assert corr[("x", "same")]["corr"] is None and corr[("x", "same")]["n"] == 2


@pytest.mark.parametrize("block", [2, 256])
def test_correlations_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(profile, "BLOCK", block)
    draw = np.random.default_rng(5)
    x = draw.normal(0, 1, (300, 5)) + 1e6
    x[:, 1] += 2 * x[:, 0]
    x[draw.random((300, 5)) < 0.2] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"c{i} double" for i in range(5)))
    got = {(r["col_a"], r["col_b"]): (r["n"], r["corr"]) for r in profile.correlations(df.repartition(4)).collect()}
    for i in range(5):
        for j in range(i + 1, 5):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            n, c = got[f"c{i}", f"c{j}"]
            assert n == both.sum() and abs(c - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-7
    assert len(got) == 10


def test_distinct_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 5000).cast("string").alias("v"))
    got = profile.merged_distinct(profile.distinct_sketches(df, ["v"], ["day"])).first()
    assert abs(got["n_distinct_estimate"] - 5000) < 250
