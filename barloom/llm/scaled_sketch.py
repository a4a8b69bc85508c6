"""Threshold-scaled sketches of documents.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so
its size follows the document, sketches of parts merge by union, and two
documents of very unequal size can still be compared: below the common
threshold both sketches are complete. Short documents also keep their
``LEAST`` smallest hashes (all of them if there are fewer), whose largest then
is the threshold up to which that sketch is complete.

Shingles are all runs of 16 bytes of the UTF-8 text (a shorter text is one).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import mix64, slices, table

WIDTH = 16
#: One shingle in so many is kept.
FRACTION = 64
LEAST = 16
LIMIT = np.uint64((1 << 64) // FRACTION)
#: Text bytes that one sorted bucket of documents should hold, and the most buckets.
BUCKET_BYTES, MAX_BUCKETS = 8 << 20, 4096
#: Cells of the id range whose counts bound the buckets.
CELLS = 1 << 14


def shingles(data: bytes) -> np.ndarray:
    """Hashes of the distinct shingles of a text, unordered when there are many."""
    n = len(data) - WIDTH + 1
    if n < 1:
        return np.frombuffer(hashlib.blake2b(data, digest_size=8).digest(), np.uint64) if data else np.zeros(0, np.uint64)
    eight = np.empty(n + WIDTH - 8, np.uint64)
    for k in range(8):
        at = np.frombuffer(data, "<u8", (len(data) - k) // 8, k)
        eight[k::8] = at[:len(eight[k::8])]
    return mix64(mix64(eight[:n]) + eight[WIDTH - 8:WIDTH - 8 + n])


def sketch(text: str | bytes | None) -> np.ndarray:
    """Sorted retained hashes of a text."""
    data = text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")
    hashes = shingles(data)
    kept = np.unique(hashes[hashes < LIMIT])
    if len(kept) < LEAST:
        kept = np.unique(hashes)[:LEAST]
    return kept


def _complete_to(s: np.ndarray) -> np.uint64:
    """Up to this hash (inclusive) the sketch holds all hashes of its document."""
    if len(s) < LEAST:
        return np.uint64(2 ** 64 - 1)
    return max(s[-1], LIMIT - np.uint64(1))


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two documents' shingles."""
    both = np.union1d(a, b)
    upto = min(_complete_to(a), _complete_to(b))
    return both[both <= max(upto, LIMIT - np.uint64(1))]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; 1 for two empty documents, 0 for one."""
    upto = min(_complete_to(a), _complete_to(b))
    a, b = a[a <= upto], b[b <= upto]
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the first document's shingles that the second holds; 1 for an empty first."""
    upto = min(_complete_to(a), _complete_to(b))
    a, b = a[a <= upto], b[b <= upto]
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def as_text(s: np.ndarray) -> str:
    return s.astype(">u8").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, sketch array<long>) of the whole text of every row. NULL and empty
    texts have empty sketches; repeated rows and NULL ids are kept."""
    def run(batches):
        for b in slices(batches):
            found = [sketch(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                                             ["doc_id", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, sketch array<long>")


def in_order(docs: DataFrame) -> DataFrame:
    """(bucket, last, doc_id, text), sorted by bucket and doc_id within partitions,
    with the first row of the next bucket at the end of each (``last``), so that
    every row finds its successor behind it. Each text is shuffled once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    span = rows.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    lo, step = span["lo"] or 0, max(1, -(-((span["hi"] or 0) - (span["lo"] or 0) + 1) // CELLS))
    cell = F.coalesce(F.expr(f"CAST((doc_id - {lo}L) div {step}L AS int)"), F.lit(0))
    sizes = {r["cell"]: r["bytes"] for r in rows.groupBy(cell.alias("cell")).agg(
        F.sum(F.octet_length("text") + 64).alias("bytes")).collect()}           # at most CELLS rows
    per = max(BUCKET_BYTES, -(-sum(sizes.values()) // MAX_BUCKETS))
    bucket_of, upto = [], 0
    for c in range(max(sizes, default=0) + 1):
        bucket_of.append(str(upto // per))
        upto += sizes.get(c, 0)
    bucket = F.element_at(F.split(F.lit(",".join(bucket_of)), ","), cell + 1).cast("int")
    keyed = rows.withColumn("bucket", bucket)
    order = F.struct("doc_id", F.xxhash64("text").alias("h"))
    first = keyed.groupBy("bucket").agg(F.min(order).alias("f"))                 # at most MAX_BUCKETS rows
    whole = Window.orderBy("bucket")
    wrap = F.first("f").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = first.select("bucket", F.coalesce(F.lead("f").over(whole), wrap).alias("f"))
    after = after.select(F.col("bucket").alias("to"), F.col("f.doc_id").alias("fid"), F.col("f.h").alias("fh"))
    ends = rows.join(F.broadcast(after), F.col("doc_id").eqNullSafe(F.col("fid")) & (F.xxhash64("text") == F.col("fh")))
    ends = ends.groupBy(F.col("to").alias("bucket")).agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    both = keyed.select("bucket", F.lit(False).alias("last"), "doc_id", "text").unionByName(
        ends.select("bucket", F.lit(True).alias("last"), "doc_id", "text"))
    return both.repartition(max(1, upto // per + 1), "bucket").sortWithinPartitions(
        "bucket", "last", "doc_id", F.xxhash64("text"))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the following text."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The next document is the one with
    the next doc_id (after the last, the first; NULL ids come first, equal ids by
    text), and a single document follows itself."""
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def run(batches):
        held = None
        for b in slices(batches):
            out = []
            for bucket, last, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                now = sketch(text)
                if held is not None and held[0] == bucket:
                    _, of, was, s = held
                    new = edited(was, text).encode("utf-8", "replace")
                    e = s if len(was) < 4 else sketch(new)
                    out.append((of, len(was), hashlib.sha256(new).hexdigest(), as_text(s), as_text(e),
                                likeness(s, e), likeness(s, now)))
                held = None if last else (bucket, doc_id, text, now)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], arrow)

    names = [c.split()[0] for c in schema.split(", ")]
    arrow = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]])
                       for c in schema.split(", ")])
    return in_order(docs).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents"))
