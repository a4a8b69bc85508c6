"""Near-duplicates by SimHash, linked through pivot distance tables.

A fingerprint's row of the table holds its Hamming distances to fixed reference
fingerprints. Two fingerprints that differ in d bits have distances that differ
by at most d in every coordinate (triangle inequality), so a pair with a larger
difference is discarded; only survivors are compared bit by bit.

The references come in 16 families, one for every four bits of a fingerprint: a
pseudo-random base, and the base with some of those four bits turned. How far a
fingerprint's distances to the members of a family lie from that to the base
depends on those four bits alone. Fingerprints that differ in at most two bits
therefore agree in the coordinates of at least two of four quarters of the
families, and meet in one of the six groups made by two quarters. A group too
large to be compared row by row is divided again by quarters of what is open,
twice at most: then only eight bits are open, and a group has 256 members at most.
Equal fingerprints are one row before all this, and a group gives links to its
members of least rank, not pairs, so no step grows with the squares of groups.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import mix64, slices, table, written
from barloom.llm.components import components

#: Fingerprints that differ in at most so many bits are linked. The quarters above are made for two.
WITHIN = 2
SEED = 42
#: Groups with more fingerprints are divided again, while bits are open.
GROUP = 256
LEVELS = 3
#: Up to so many keys of large groups, labels or fingerprints (8 to 24 bytes each) are broadcast; beyond, joins shuffle.
MAX_BROADCAST = 1_000_000
#: A fingerprint of so many rows is joined by broadcast.
HOT_ROWS = 10_000
_TURNED = (0b0101, 0b0011, 0b0110, 0b1111)
_BASES = mix64((np.arange(16, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
#: The 16 bases, then for each base its turned forms.
REFERENCES = np.concatenate([_BASES, *[[b ^ np.uint64(m << 4 * f) for m in _TURNED] for f, b in enumerate(_BASES)]]).astype(np.uint64)


def simhash(text: bytes | None, width: int = 3) -> int:
    """64-bit fingerprint: a bit is 1 if it is set in over half the hashes of the
    word shingles (A-Z lower-cased, repeats counted). 0 for a text without words."""
    words = (text or b"").lower().split()       # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    width = min(width, len(words))
    joined, ends = b" ".join(words), list(itertools.accumulate(len(w) + 1 for w in words))
    spans = zip([0, *ends], ends[width - 1:])
    ones, n = np.zeros(64, np.int64), 0
    while some := [xxhash.xxh64_intdigest(joined[a:b - 1], SEED) for a, b in itertools.islice(spans, 1 << 15)]:
        h = np.array(some, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(h, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(some)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) of every row of ``docs`` (doc_id, text); fp holds the 64 bits as a long."""
    def run(batches):
        for b in slices(batches):
            fps = np.array([simhash(t.as_py(), width) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")).mapInArrow(
        run, "doc_id long, fp long")


def distance_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of the fingerprints (rows) to all references (columns)."""
    return np.bitwise_count(fps.astype(np.uint64)[:, None] ^ REFERENCES[None, :])


@functools.cache
def _families(path: tuple[int, ...]) -> tuple[list[int], list[int]]:
    """Families that agree, and open ones, after choosing one of the six pairs of quarters at each step."""
    fixed, open_ = [], list(range(16))
    for choice in path:
        step = len(open_) // 4
        quarters = [open_[i * step:(i + 1) * step] for i in range(4)]
        both = list(itertools.combinations(range(4), 4 - WITHIN))[choice]
        fixed += [f for i in both for f in quarters[i]]
        open_ = [f for i in range(4) if i not in both for f in quarters[i]]
    return fixed, open_


def _path(code: int) -> tuple[int, ...]:
    out = []
    while code:
        code, choice = divmod(code - 1, 6)
        out.append(choice)
    return tuple(reversed(out))


def _keys(fps: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, key, fp): for each row the six groups that divide its present one, named by the
    coordinates of their families relative to the bases."""
    out = []
    for code in np.unique(codes):
        own = fps[codes == code]
        t = distance_table(own).astype(np.int64)
        relative = t[:, 16:].reshape(len(own), 16, 4) - t[:, :16, None] + 4
        marks = (relative * 9 ** np.arange(4)).sum(axis=2).astype(np.uint64)
        for choice in range(6):
            child = int(code) * 6 + choice + 1
            key = np.full(len(own), child, np.uint64)
            for f in _families(_path(child))[0]:
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + marks[:, f])
            out.append((np.full(len(own), child, np.int32), key, own))
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(map(np.concatenate, zip(*out)))


def _grouped(rows: DataFrame) -> DataFrame:
    """(code, key, fp) of rows (code, fp): the groups that each fingerprint is a member of."""
    def run(batches):
        for b in slices(batches, 4096):
            code, key, fp = _keys(b.column(1).to_numpy().view(np.uint64), b.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))],
                                             ["code", "key", "fp"])

    return rows.select("code", "fp").mapInArrow(run, "code int, key long, fp long")


def nearest_of_groups(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) for rows sorted by key: b is the first row of a's component of links within a's key,
    for all rows but those first ones. Pairs are discarded by their largest coordinate difference."""
    t = distance_table(fps).astype(np.int8)
    left, right = [], []
    step, at = 1, np.flatnonzero(keys[1:] == keys[:-1])
    while len(at):
        near = at[np.abs(t[at, :16] - t[at + step, :16]).max(axis=1) <= WITHIN]
        near = near[np.abs(t[near, 16:] - t[near + step, 16:]).max(axis=1, initial=0) <= WITHIN]
        near = near[np.bitwise_count(fps[near] ^ fps[near + step]) <= WITHIN]
        left.append(near)
        right.append(near + step)
        step += 1
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(keys))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    a = np.flatnonzero(label != np.arange(len(keys)))
    return a, label[a]


def _linked(groups: DataFrame) -> DataFrame:
    """Edges (a, b) between fingerprints that join what is linked within each group of (key, fp)."""
    def edges(keys, fps):
        a, b = nearest_of_groups(keys, fps)
        return pa.RecordBatch.from_arrays([pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))], ["a", "b"])

    def run(batches):
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for b in slices(batches, 1 << 14):
            keys = np.concatenate([keys, b.column(0).to_numpy()])
            fps = np.concatenate([fps, b.column(1).to_numpy().view(np.uint64)])
            whole = np.searchsorted(keys, keys[-1]) if len(keys) else 0     # the last group may go on
            yield edges(keys[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
        yield edges(keys, fps)

    return groups.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect just the distinct fingerprints (column fp) within ``WITHIN`` bits."""
    rows, found = fps.select(F.lit(0).cast("int").alias("code"), "fp"), None
    for level in range(LEVELS):
        groups = _grouped(rows)
        small = groups
        if last := level == LEVELS - 1:
            large = None        # what is open has 2^8 values at most
        else:
            large = written(groups.groupBy("key").count().where(F.col("count") > GROUP).select("key"), "large-groups")
            n_large = large.count()
            if last := not n_large:
                large = None
        if large is not None:
            side = F.broadcast(large) if n_large <= MAX_BROADCAST else large
            small = groups.join(side, "key", "left_anti")
        edges = written(_linked(small).distinct(), "links")
        found = edges if found is None else found.unionByName(edges)
        if last:
            return found
        rows = written(groups.join(side, "key", "left_semi").select("code", "fp"), "large-rows")


def _named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` joined with ``names`` (fp, copies, ...) by fp; fingerprints of very many rows by broadcast."""
    names = written(names, "names")
    if names.count() <= MAX_BROADCAST:
        return rows.join(F.broadcast(names.drop("copies")), "fp", "left")
    hot = names.where(F.col("copies") >= HOT_ROWS).drop("copies")
    if hot.count() > MAX_BROADCAST:
        return rows.join(names.drop("copies"), "fp", "left")
    hot = hot.withColumn("is_hot", F.lit(True))
    marked = rows.join(F.broadcast(hot), "fp", "left")
    done = marked.where("is_hot").drop("is_hot")
    rest = marked.where("is_hot IS NULL").select(*rows.columns)
    return done.unionByName(rest.join(names.drop("copies"), "fp", "left").select(done.columns))


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id,
    fp (fingerprint as a long), component_id.

    Rows whose fingerprints differ in at most ``WITHIN`` bits are linked;
    ``component_id`` is the least doc_id reachable. NULL, empty and blank texts have
    the fingerprint 0 and are linked like any other. Repeated rows and equal texts
    share a component. A NULL doc_id keeps its row and gets the least known id of
    its component, or NULL. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, width), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "distinct")
    labels = written(components(links(distinct)), "labels")
    member = distinct.join(labels.withColumnRenamed("node", "fp"), "fp")
    least = member.groupBy("label").agg(F.min("least").alias("component"))
    linked = member.join(least, "label").select("fp", "component")
    # only what is linked, repeated or without an id of its own needs a lookup
    names = distinct.join(linked, "fp", "left").where("component IS NOT NULL OR copies > 1").select(
        "fp", "copies", F.coalesce("component", "least").alias("component"))
    return _named(rows, names).select("doc_id", "fp", F.coalesce("component", "doc_id").alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
