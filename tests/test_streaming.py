"""The streaming scorer writes the same outcomes as the batch operator, and a
second run over the same input writes nothing more."""

import tempfile

from barloom.operators import outcomes as out
from barloom.plans import derived as dv
from barloom.sources.fixtures import Fixtures
from barloom.streaming import outcome_stream
from tests.conftest import SF_SMALL


def test_stream_matches_batch_and_is_idempotent(spark):
    fx = Fixtures(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="barloom-stream-")
    bars_path, out_path, ckpt = f"{base}/bars", f"{base}/outcomes", f"{base}/ckpt"
    fx.bars.write.parquet(bars_path)
    stored = dv.stored_predictions(fx)
    q = outcome_stream.start(spark, bars_path, fx.bars.schema, stored, out_path, ckpt,
                             trained_at=dv.TRAINED_AT, version=dv.MODEL_VERSION)
    q.awaitTermination()
    written = spark.read.parquet(out_path)
    none_scored = stored.select("prediction_id").limit(0)
    batch = out.score_outcomes(out.pending_predictions(stored, out.realized_prices(fx.bars), none_scored),
                               dv.TRAINED_AT, dv.MODEL_VERSION)
    assert written.count() == batch.count()
    assert written.join(batch, "prediction_id", "left_anti").count() == 0
    n_before = written.count()
    # replay over the same input: the anti-join keeps the output unchanged
    outcome_stream.score_batch(spark, stored, bars_path, out_path, dv.TRAINED_AT, dv.MODEL_VERSION)
    assert spark.read.parquet(out_path).count() == n_before
