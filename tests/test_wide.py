"""Statistics of many columns: packed by column, in a few passes, without writing or stacking the wide rows."""

import numpy as np
import pytest

from barloom.functions import wide
from barloom.operators import prep, profile
from barloom.plans import catalog
from barloom.sources import fixtures
from barloom.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def odd(spark):
    draw, n = np.random.default_rng(6), 3000
    x = {"a": draw.normal(size=n), "b": np.round(draw.normal(size=n) * 100, 1), "c": np.where(draw.random(n) < 0.3, np.nan, draw.integers(0, 5, n)),
         "d": np.full(n, 0.1), "e": np.full(n, np.nan), "f": np.r_[1e300, -1e300, draw.normal(size=n - 2)],
         "g": np.where(draw.random(n) < 0.6, 7.125, 7 + draw.normal(size=n) * 1e-9)}
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in zip(*x.values())]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in x)).repartition(5), x


@pytest.mark.parametrize("gathered", [None, 100, 0])
def test_quantiles_of_packed_columns(odd, gathered):
    df, x = odd
    rows = wide.packed(df, [*x])
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    moments, samples = wide.column_moments(rows, len(x))
    for v, got, m in zip(x.values(), wide.column_quantiles(rows, qs, moments, samples, gathered), moments):
        v = v[~np.isnan(v)]
        assert m["n"] == len(v)
        assert got == [None] * len(qs) if not len(v) else np.allclose(got, np.quantile(v, qs), rtol=1e-14, atol=0)
    assert moments[3]["m2"] == 0.0 and moments[3]["mean"] == 0.1


@pytest.mark.parametrize("held", [500, 4_000_000])
def test_distinct_values_of_packed_columns(odd, monkeypatch, held):
    monkeypatch.setattr(wide, "HELD", held)
    df, x = odd
    rows = wide.packed(df, [*x])
    want = [len(np.unique(v[~np.isnan(v)])) for v in x.values()]
    assert wide.distinct_counts(rows, len(x)) == want
    assert wide.distinct_counts(rows, len(x), 1) == want


def test_profile_stacks_no_numbers(odd, monkeypatch):
    df, x = odd

    def stacked(*_):
        raise AssertionError("a row of every value")
    monkeypatch.setattr(profile, "stacked", stacked)
    got = {r["column_name"]: r for r in profile.profile(df).collect()}
    for c, v in x.items():
        v = v[~np.isnan(v)]
        assert (got[c]["n"], got[c]["n_null"], got[c]["n_distinct"]) == (len(v), 3000 - len(v), len(np.unique(v)))
        assert not len(v) or np.isclose(got[c]["median"], np.median(v), rtol=1e-14)


def test_mutual_information_stacks_nothing(spark, monkeypatch):
    monkeypatch.setattr(prep, "stack", lambda *_: pytest.fail("a row of every value"))
    draw = np.random.default_rng(7)
    y = draw.integers(0, 2, 400)
    x = y + draw.normal(size=400)
    got = prep.binned_mutual_information(spark.createDataFrame([(int(a), float(b), None) for a, b in zip(y, x)], "y int, x double, none double"),
                                         ["x", "none"]).collect()
    bins = np.searchsorted(np.quantile(x, np.arange(1, 10) / 10), x, "left")
    p = np.array([[((bins == b) & (y == v)).mean() for v in (0, 1)] for b in range(10)])
    want = sum(p[b, v] * np.log(p[b, v] / (p[b].sum() * p[:, v].sum())) for b in range(10) for v in (0, 1) if p[b, v])
    assert [r["feature"] for r in got] == ["x"] and abs(got[0]["mi"] - want) < 1e-12


@pytest.mark.parametrize("key", ["mi_ranking", "quality_issues", "eda_summary", "select_importance"])
def test_statistics_write_no_feature_table(spark, key):
    catalog.load_all()
    fx = Fixtures(spark, SF_SMALL, tag=f"-wide-{key}")
    assert catalog.REGISTRY[key].build(fx).count() > 0
    assert not [n for _, at, n in fixtures._STORE if at == fx.sf_dir + fx.tag and n.startswith("features")]


def test_correlations_of_parts_with_other_levels(spark):
    x = [(1e9 + i, 5.0, float(i), None) for i in range(40)] + [(3e9 + 2 * i, 5.0, float(i * i), 1.0 * i) for i in range(40)]
    df = spark.createDataFrame(x, "a double, same double, b double, late double").repartitionByRange(2, "a")
    got = {(r["col_a"], r["col_b"]): (r["n"], r["corr"]) for r in profile.correlations(df).collect()}
    a, same, b, _ = np.array([[np.nan if v is None else v for v in r] for r in x]).T
    assert got["a", "same"] == (80, None) and got["same", "b"] == (80, None)
    assert abs(got["a", "b"][1] - np.corrcoef(a, b)[0, 1]) < 1e-9
    assert got["a", "late"][0] == 40 and abs(got["a", "late"][1] - 1) < 1e-9


def test_training_rows_write_the_features_once(spark):
    from barloom.plans.q_ml import ml_frame
    fx = Fixtures(spark, SF_SMALL, tag="-train")
    rows = ml_frame(fx)
    assert rows.where("split = 'train'").count() > 0
    written = {n for _, at, n in fixtures._STORE if at == fx.sf_dir + fx.tag}
    assert "ml_frame" in written and not [n for n in written if n == "ml_base" or n.startswith("features")]
    assert not [n for _, at, n in fixtures._STORE if at == fx.sf_dir + fx.tag and n.startswith("ml_base")]


def test_walk_forward_writes_no_rows_of_a_fold(spark, monkeypatch):
    from barloom.plans import q_ml
    fx, kept, store = Fixtures(spark, SF_SMALL, tag="-walk"), [], q_ml.stored

    def noted(df, name, *more):
        kept.append((name, df.columns))
        return store(df, name, *more)
    monkeypatch.setattr(q_ml, "stored", noted)
    got = q_ml.walk_forward(q_ml.ml_base(fx), ("RSI", "daily_return"), q_ml.mdl.classifier_zoo()["logistic"], folds=2).collect()
    assert {r["fold"] for r in got} == {0, 1}
    assert [sorted(c) for n, c in kept if n == "fold"] == [["sample_weight", "ticker", "trading_date"]] * 2


def test_grid_rows_reach_a_pass_as_arrays(spark):
    from barloom.operators import logistic_path as lp
    x = np.random.default_rng(8).normal(size=(200, 3))
    df = spark.createDataFrame([(str(i), *map(float, r), int(r[0] > 0)) for i, r in enumerate(x)], "ticker string, a double, b double, c double, y int")
    rows = lp.packed_rows(lp.standardised(df, ["a", "b", "c"], folds=3, keys=("ticker",)))
    assert lp.packed_rows(rows) is rows and rows.columns == ["fold", "d", "y", "x"]
    assert sum(len(r["y"]) for r in rows.collect()) == 200 * 8
    best = {(r["penalty"], r["strength"]): r["cv_f1"] for r in lp.grid_scores(rows, 3, lp.path(rows, 3, strengths=(1.0,))).collect()}
    assert len(best) == 2 and min(best.values()) > 0.9
