"""Features of a few columns against the whole table."""

import datetime

import pytest

from barloom.operators import features as feat
from barloom.plans.q_sentiment import sector_sentiment
from barloom.sources import fixtures
from barloom.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL


def shown(v):
    return float(f"{v:.9g}") + 0.0 if isinstance(v, float) else v


def test_few_columns_equal_those_of_the_whole_table(spark):
    fx = Fixtures(spark, SF_SMALL)
    whole = feat.feature_frame(fx, sector_sentiment)
    expected = whole.collect()
    groups = {}
    for c in whole.columns:
        groups.setdefault(frozenset(feat.sources_of((c,))), []).append(c)
    assert len(groups) > 8
    for needed, columns in groups.items():
        names = tuple(dict.fromkeys(("ticker", "trading_date", *columns)))
        few = feat.feature_frame(fx, sector_sentiment, columns=names)
        assert {f.name: f.dataType for f in few.schema} == {f.name: f.dataType for f in whole.select(*names).schema}, needed
        got = sorted(repr([shown(r[c]) for c in names]) for r in few.collect())
        assert got == sorted(repr([shown(r[c]) for c in names]) for r in expected), (needed, names)


def test_few_columns_read_no_other_source(spark):
    plan = feat.feature_frame(Fixtures(spark, SF_SMALL), sector_sentiment, columns=("ticker", "trading_date", "sma_5"))
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert "Join" not in text and "stddev" not in text and "Exchange" not in text


LINES = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate date, l_quantity double, "
         "l_extendedprice double, l_discount double, l_tax double")


def own_tables(spark, path, suppliers):
    """A few lines a day of two suppliers, and one without key or date."""
    d = datetime.date(2000, 1, 3)
    lines = [(10 * i + s, 1, 7, s, d + datetime.timedelta(days=i), 5.0 + (i * s) % 9, 100.0 + (i * i * s) % 37, 0.01 * (i % 5), 0.02)
             for s in (1, 2) for i in range(70)] + [(1, 1, 1, None, d, 5.0, 90.0, 0.0, 0.0), (2, 1, 1, 1, None, 5.0, 90.0, 0.0, 0.0)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int").write.parquet(f"{path}/supplier.parquet")
    return Fixtures(spark, str(path))


@pytest.mark.parametrize("suppliers", [[(1, 3), (2, 5)], [(1, 3), (1, 3), (2, 5), (None, 4)]])
def test_few_columns_write_only_bars(spark, tmp_path, suppliers):
    fx = own_tables(spark, tmp_path, suppliers)
    names = ("ticker", "trading_date", "hl_spread", "RSI", *(("ema_10", "macd_signal") if len(suppliers) == 2 else ()))
    few = feat.feature_frame(fx, columns=names)
    got = sorted(repr([shown(r[c]) for c in names]) for r in few.collect())
    built = {name for _, at, name in fixtures._STORE if at == fx.sf_dir}
    assert built == {"bars", "fundamentals", "securities"}
    whole = feat.feature_frame(fx).collect()
    assert got == sorted(repr([shown(r[c]) for c in names]) for r in whole)
    assert len(got) == (140 if len(suppliers) == 2 else 70 * 4 + 70)


@pytest.mark.parametrize("suppliers", [[(1, 3), (2, 3)], [(1, 3), (1, 3), (2, 3)]])
def test_wide_rows_are_not_shuffled_by_date(spark, tmp_path, suppliers):
    fx = own_tables(spark, tmp_path, suppliers)
    cross = ("ticker", "trading_date", *feat.CROSS_SECTION, "sector_leader_conviction")
    frame = feat.feature_frame(fx)
    got = sorted(repr([shown(r[c]) for c in cross]) for r in frame.collect())
    # few columns are ranked in place
    assert got == sorted(repr([shown(r[c]) for c in cross]) for r in feat.feature_frame(fx, columns=cross).collect())
    text = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    wide = [part for part in text.split("\n\n") if "Exchange" in part.split("\n")[0] and "hashpartitioning(trading_date" in part and "sma_200" in part]
    assert bool(wide) == (len(suppliers) > 2)
