"""What the derived tables write and shuffle."""

from barloom.operators import outcomes as out
from barloom.plans import catalog
from barloom.plans import derived as dv
from barloom.sources import fixtures
from tests.test_columns_of_features import own_tables
from tests.test_ema_sorts import REPEATED, UNIQUE, plan, values


def test_row_wise_rules_are_not_written(spark, tmp_path):
    fx = own_tables(spark, tmp_path, UNIQUE)
    catalog.load_all()
    rows = catalog.REGISTRY["format_enhanced"].build(fx)
    assert rows.count() == 141      # one has no date
    assert dv.stored_predictions(fx).count() == 141
    assert not {"signals", "stored_predictions"} & {name for _, at, name in fixtures._STORE if at == fx.sf_dir}


def test_scored_outcomes_meet_their_predictions_by_ticker(spark, tmp_path):
    fx = own_tables(spark, tmp_path, REPEATED)
    stored, prices, done = dv.stored_predictions(fx), out.realized_prices(fx.bars), dv.prior_outcome_ids(fx)
    pending = out.pending_predictions(stored, prices, done)
    by_id = out.pending_predictions(stored, prices, done.select("prediction_id"))
    assert pending.columns[:2] == ["ticker", "trading_date"] and {*pending.columns} == {*by_id.columns}
    got = values(pending.select(*by_id.columns))
    assert got == values(by_id) and 0 < len(got) < stored.count()
    assert "hashpartitioning(prediction_id" not in plan(pending)
