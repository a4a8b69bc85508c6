"""What the EMA windows and the enhanced features sort, join and shuffle."""

import pytest

from barloom.functions.blocks import in_blocks
from barloom.operators import features as feat
from tests.test_columns_of_features import own_tables, shown

UNIQUE, REPEATED = [(1, 3), (2, 5)], [(1, 3), (1, 3), (2, 5)]


def plan(df, mode="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def values(df):
    return sorted(repr([shown(v) for v in row]) for row in df.collect())


def test_emas_of_bars_are_sorted_once(spark, tmp_path):
    fx = own_tables(spark, tmp_path, UNIQUE)
    text = plan(feat.ema_layers(fx.bars.select("ticker", "trading_date", "close_price")))
    assert "Exchange" not in text and text.count(" Sort [") == 1


@pytest.mark.parametrize("suppliers", [UNIQUE, REPEATED])
def test_enhanced_features_are_made_of_bars(spark, tmp_path, suppliers):
    fx = own_tables(spark, tmp_path, suppliers)
    frame = feat.enhanced_frame(fx)
    whole = in_blocks(feat.base_frame(fx), feat.enhanced_features)
    assert frame.columns == whole.columns
    text = plan(frame)
    got = values(frame)
    assert got == values(whole) and len(got) == (140 if suppliers is UNIQUE else 210)
    if suppliers is UNIQUE:
        assert "Join" not in text and "Exchange" not in text and text.count(" Sort [") == 2
