"""What a Python worker is handed and holds at a time."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import helpers as h  # noqa: E402
import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pytest  # noqa: E402

from barloom.llm import jaccard_join, language_kernel, packing  # noqa: E402
from barloom.llm.common import BATCH_BYTES, map_batches  # noqa: E402

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_waiting_pieces_do_not_keep_their_documents():
    packer = packing._Packer(1024, 0)
    for i in range(50):
        packer.add(i, np.arange(20 * 1024 + 7 + i, dtype="<u4"))
    waiting = [p[2] for pieces in packer.pool.values() for p in pieces]
    assert len(waiting) == 50 and all(ids.base is None for ids in waiting)
    assert sorted(ids.nbytes for ids in waiting) == [4 * (7 + i) for i in range(50)]


def test_pieces_are_returned_in_small_batches_in_order():
    packer = packing._Packer(1024, 5)
    packer.add(1, np.arange(1300 * 1024, dtype="<u4"))
    got = list(packer.batches())
    assert [b.num_rows for b in got] == [512, 512, 276] and not packer.rows
    assert [s for b in got for s in b.column("start").to_pylist()] == [1024 * i for i in range(1300)]
    assert not list(packer.batches())


def test_batches_are_bounded_by_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    spark.conf.unset(LIMIT)
    rows = spark.range(3000).selectExpr("id", "repeat('ab', 5000) AS text").coalesce(1)
    got = map_batches(rows, sizes, "n long, size long").collect()
    assert sum(r["n"] for r in got) == 3000
    assert max(r["size"] for r in got) < 1.5 * BATCH_BYTES


@pytest.mark.parametrize("operator", [
    packing.pack, lambda docs: language_kernel.identify(docs, None), language_kernel.training_set,
    lambda docs: jaccard_join.shingle_points(docs, 80, 5)])
def test_operators_of_the_pipeline_bound_their_batches(spark, operator):
    docs = h.frame(spark, h.odd_rows())
    spark.conf.unset(LIMIT)
    operator(docs)
    assert spark.conf.get(LIMIT) == str(BATCH_BYTES)
