"""Helpers shared by the corpus operators: table access, written intermediates
and 64-bit text hashing on numpy arrays."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import scratch_path

#: Bytes of the Arrow batches that Spark hands a Python worker (a longer row is a batch of its own).
BATCH_BYTES = 4 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    The folder is the one the cluster names in ``spark.checkpoint.dir``, so a
    lost executor never takes an intermediate result with it. ``parts`` is the
    largest number of files, for tables known to be small.
    """
    spark = df.sparkSession
    if parts:
        df = df.coalesce(parts)
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(docs: DataFrame, name: str = "row") -> Column:
    """All columns of ``docs`` as one struct, so that no name among them can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` on batches of some ``BATCH_BYTES``, whatever the length of the rows: Spark's own batches
    (10,000 rows, 64 MB) lie in the executor and in each worker besides what the task makes of them. Spark reads
    the limit when the plan runs, so it stays set for the session; it changes no results."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):     # glibc only
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces, so that a task holds Python objects and results of few rows at a time.
    After each batch, freed memory goes back to the system."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        give_back()


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def prior_shift(marks: DataFrame, label: str, per_label: int) -> float:
    """What a sample of at most ``per_label`` rows of each of the labels 0 and 1 takes from the log odds of 1."""
    n = {r[label]: r["count"] for r in marks.groupBy(label).count().collect()}
    lost = [np.log(n[k] / min(n[k], per_label)) if n.get(k) else 0.0 for k in (0, 1)]
    return float(lost[1] - lost[0]) if n.get(0) and n.get(1) else 0.0


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that nearby inputs give unrelated outputs."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_A
    h = (h ^ (h >> np.uint64(27))) * _MIX_B
    return h ^ (h >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
    values[65:91] = values[97:123]          # A-Z hash like a-z
    values[SPACES] = 0
    return values


SPACES = np.array([9, 10, 11, 12, 13, 32])
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[SPACES] = True
#: Everything in ASCII that is neither a letter nor a digit.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_VALUE = _byte_values()
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers of an odd base; grown by doubling to the longest word seen."""
    global _POWERS
    while len(_POWERS) < n:
        step = _POWERS[-1:] * _ODD
        _POWERS = np.concatenate([_POWERS, _POWERS * step])
    return _POWERS


def word_hashes(text: bytes, separator: np.ndarray = _IS_SPACE, prefixes: tuple[int, ...] = ()) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 ``text``, in order; A-Z count as a-z.

    ``separator`` marks the bytes between words (ASCII white space if not
    given). The hash of a word is a polynomial of its bytes, summed for all
    words at once with ``reduceat``. With ``prefixes``, the hashes of the first
    so many bytes of each longer word follow, marked by their size.
    """
    data = np.frombuffer(text, np.uint8)
    solid = ~separator[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lead = starts[0]
    ends = np.append(starts[1:], len(data))
    place = np.arange(lead, len(data)) - np.repeat(starts, ends - starts)
    if lead:
        data, starts, solid = data[lead:], starts - lead, solid[lead:]
    part = _VALUE[data] * _powers(int(place.max()) + 1)[place]
    if separator is not _IS_SPACE:
        part *= solid
    out = [mix64(np.add.reduceat(part, starts))]
    for size in prefixes:
        inside = solid & (place < size)
        long = np.add.reduceat(solid, starts, dtype=np.int64) > size
        out.append(mix64(np.add.reduceat(part * inside, starts)[long] + np.uint64(size)))
    return np.concatenate(out) if prefixes else out[0]


def shingle_hashes(text: bytes, width: int = 5) -> np.ndarray:
    """Hashes of all runs of ``width`` words; with fewer words, of the whole sequence."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    total = words[:n] + np.uint64(width)
    for k in range(1, width):
        total = total * _ODD + words[k:k + n]
    return mix64(total)
