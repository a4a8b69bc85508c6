"""Periodic runs in texts, found by internal pattern matching.

A run is a stretch of words with smallest period q that no neighbouring word
extends, at least ``max(LEAST, TIMES * q)`` words long. Texts are handled a
batch at a time, as one sequence of word ids in which no match crosses texts:

1. Prefix doubling sorts the suffixes and keeps the rank of every substring of
   2^k words. The occurrences of such a substring are a range of the suffix
   array.
2. A run with period q holds an aligned (dyadic) block of 2^k words, about as
   long as q, together with the same words q further on. For every block a
   wavelet tree over the suffix array answers range-successor queries: the next
   place, within the window where such a period can lie, at which the block
   occurs again.
3. Occurrences less than half a block apart continue as an arithmetic
   progression, whose end one longest-common-extension query gives, so a block
   takes a few queries at most. Progressions that only continue the block's own
   repetition give no new period; every other distance is a candidate.
4. A candidate is extended to both sides by the ranks; what is long enough is a
   run, and of several periods of one stretch the smallest counts.

Time and memory are O(n log n) in the words of a batch; nothing is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import slices, table

#: A run has at least so many words, and so many times its period.
LEAST, TIMES = 6, 4
#: Words that are sorted together (one longer text is sorted on its own).
BATCH_WORDS = 1 << 17
SCHEMA = "doc_id long, n long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


class Ranks:
    """Suffix array of several sequences, with the ranks of all substrings of 2^k symbols.

    ``ends[i]`` is the end of the sequence that holds position i; ``starts`` alike.
    ``level[k][i]`` is the first place, in the suffix array, of the suffixes of the
    same sequence that share the 2^k symbols at i: equal ranks mean equal substrings.
    A substring that would pass the end of its sequence has a rank of its own.
    """

    def __init__(self, symbols: np.ndarray, sequence: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        n = len(symbols)
        self.n, self.starts, self.ends = n, starts, ends
        self.order, rank, self.size = self._sorted(sequence.astype(np.int64) * (int(symbols.max(initial=0)) + 1) + symbols)
        self.level, self.sizes = [rank.astype(np.int32)], [self.size.astype(np.int32)]
        half = 1
        while (open_ := np.flatnonzero(self.size[rank] > 1)).size:
            follow = open_ + half
            key = rank[open_] * (n + 1) + np.where(follow < ends[open_], rank[np.minimum(follow, n - 1)] + 1, 0)
            order, first, size = self._sorted(key)
            # the open suffixes fill the same places of the suffix array as before
            places = np.sort(rank[open_], kind="stable")
            begin = np.flatnonzero(np.diff(places, prepend=-1))
            at = places + np.arange(len(places)) - np.repeat(begin, np.diff(begin, append=len(places)))
            self.order[at] = open_[order]
            rank, self.size = rank.copy(), self.size.copy()
            rank[open_] = at[first]
            self.size[at] = size
            self.level.append(rank.astype(np.int32))
            self.sizes.append(self.size.astype(np.int32))
            half *= 2

    @staticmethod
    def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted order, per element the first place of its value, and at such places how many there are (else 0)."""
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.diff(key[order], prepend=-1))       # keys are never negative
        count = np.diff(new, append=len(key))
        first, size = np.empty(len(key), np.int64), np.zeros(len(key), np.int64)
        first[order] = np.repeat(new, count)
        size[new] = count
        return order, first, size

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j (j > i, same sequence) are equal."""
        at, to = i.copy(), j.copy()
        for k in range(len(self.level) - 2, -1, -1):        # on the last level all substrings differ
            fits = np.flatnonzero(to + (1 << k) <= self.ends[j])
            same = fits[self.level[k][at[fits]] == self.level[k][to[fits]]]
            at[same] += 1 << k
            to[same] += 1 << k
        return at - i

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j (j > i, same sequence) are equal."""
        at, to = i.copy(), j.copy()
        for k in range(len(self.level) - 2, -1, -1):
            fits = np.flatnonzero(at - (1 << k) >= self.starts[i])
            same = fits[self.level[k][at[fits] - (1 << k)] == self.level[k][to[fits] - (1 << k)]]
            at[same] -= 1 << k
            to[same] -= 1 << k
        return i - at


class WaveletTree:
    """Rank structure over a sequence of distinct non-negative numbers, for successor queries in ranges."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for b in range(self.bits - 1, -1, -1):
            is_zero = (values >> b & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(is_zero)]).astype(np.int32))
            values = np.concatenate([values[is_zero], values[~is_zero]])

    def successor(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest of values[lo:hi] that is at least ``least``, or -1."""
        below = self._below(lo, hi, least)
        found = np.full(len(lo), -1, np.int64)
        some = np.flatnonzero(below < hi - lo)
        found[some] = self._nth(lo[some], hi[some], below[some])
        return found

    def _below(self, lo, hi, bound):
        """How many of values[lo:hi] are less than ``bound``."""
        count = np.where(bound >= 1 << self.bits, hi - lo, 0)
        bound = np.minimum(bound, (1 << self.bits) - 1)
        inside = count == 0
        for depth, zeros in enumerate(self.zeros):
            a, b, total = zeros[lo], zeros[hi], zeros[-1]
            one = (bound >> self.bits - 1 - depth & 1) == 1
            count = count + np.where(one & inside, b - a, 0)
            lo, hi = np.where(one, total + lo - a, a), np.where(one, total + hi - b, b)
        return count

    def _nth(self, lo, hi, nth):
        """The value with ``nth`` smaller ones in values[lo:hi]."""
        value = np.zeros(len(lo), np.int64)
        for depth, zeros in enumerate(self.zeros):
            a, b, total = zeros[lo], zeros[hi], zeros[-1]
            one = nth >= b - a
            nth = np.where(one, nth - (b - a), nth)
            value |= np.where(one, np.int64(1) << self.bits - 1 - depth, 0)
            lo, hi = np.where(one, total + lo - a, a), np.where(one, total + hi - b, b)
        return value


def _candidates(ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance): a block at the place occurs again at this distance, which may be the period of a run."""
    block, length, lo, hi, near, far = [], [], [], [], [], []
    for k in range(1, len(ranks.level)):
        size = 1 << k
        # blocks of 2^k words serve the periods q with 2^(k+1) - 1 <= 3q that no longer block serves
        least, most = -(-(2 * size - 1) // 3), (4 * size - 2) // 3
        at = np.arange(0, ranks.n, dtype=np.int64)
        at = at[(at - ranks.starts) % size == 0]
        rank = ranks.level[k][at].astype(np.int64)
        count = ranks.sizes[k][rank]
        keep = (count > 1) & (at + least < ranks.ends[at])
        at, rank, count = at[keep], rank[keep], count[keep]
        block.append(at)
        length.append(np.full(len(at), size))
        lo.append(rank)
        hi.append(rank + count)
        near.append(at + least)
        far.append(at + most)
    if not block or not sum(map(len, block)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    block, length, lo, hi, near, far = map(np.concatenate, (block, length, lo, hi, near, far))
    # the tree holds only suffixes that share two words with another of their text
    shared = ranks.sizes[1][ranks.level[1][ranks.order]] > 1
    packed = np.concatenate([[0], np.cumsum(shared)])
    tree = WaveletTree(ranks.order[shared])
    lo, hi = packed[lo], packed[hi]
    places, distances = [], []
    rows, head = np.arange(len(block)), np.full(len(block), -1, np.int64)     # head: an occurrence found before
    least = near.copy()
    while len(rows):
        found = tree.successor(lo[rows], hi[rows], least[rows])
        hit = (found >= 0) & (found <= far[rows])
        rows, found = rows[hit], found[hit]
        places.append(block[rows])
        distances.append(found - block[rows])
        step = np.where(head[rows] >= 0, found - head[rows], 0)
        chain = np.flatnonzero((step > 0) & (2 * step <= length[rows]))
        after = found + 1
        if len(chain):
            r, e, d = rows[chain], found[chain], step[chain]
            # the block occurs every d words as long as the words from the head go on with that period
            reach = ranks.forward(head[r], head[r] + d)
            last = head[r] + d * (1 + (reach - length[r]) // d)
            last = np.maximum(e, np.minimum(last, far[r] - (far[r] - e) % d))
            after[chain] = np.maximum(last, e) + 1
            # a progression that the block's own repetition reaches has the smaller period d
            own = ((e - block[r]) % d == 0) & (ranks.forward(block[r], block[r] + d) >= last - block[r] + length[r] - d)
            many = np.where(own, 0, (last - e) // d)
            base = np.repeat(e, many)
            nth = np.arange(len(base)) - np.repeat(np.cumsum(many) - many, many) + 1
            places.append(np.repeat(block[r], many))
            distances.append(base + nth * np.repeat(d, many) - np.repeat(block[r], many))
        head[rows] = found
        if len(chain):
            head[rows[chain]] = -1          # what follows is no longer part of this progression
        least[rows] = after
        rows = rows[after <= far[rows]]
    return np.concatenate(places), np.concatenate(distances)


def find(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of sequences of ``lengths`` symbols that
    follow each other in ``symbols``, ordered by start, then period. Starts count
    from the beginning of ``symbols``."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(symbols):
        return none
    first = np.cumsum(lengths) - lengths
    sequence = np.repeat(np.arange(len(lengths)), lengths)
    ranks = Ranks(symbols, sequence, first[sequence], (first + lengths)[sequence])
    place, period = _candidates(ranks)
    if not len(place):
        return none
    start = place - ranks.backward(place, place + period)
    length = place + period + ranks.forward(place, place + period) - start
    keep = length >= np.maximum(LEAST, TIMES * period)
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _batch_runs(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    names: dict[bytes, int] = {}
    symbols = np.array([names.setdefault(w, len(names)) for words in texts for w in words], np.int64)
    lengths = np.array([len(words) for words in texts], np.int64)
    start, length, period = find(symbols, lengths)
    first = np.cumsum(lengths) - lengths
    owner = np.searchsorted(first, start, "right") - 1     # of texts that begin at one place the last has the words
    drop = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, start + length, -1)
    keep = np.cumsum(drop)[:-1] == 0
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    runs, collapsed = [], []
    for i, words in enumerate(texts):
        a, b = bounds[i], bounds[i + 1]
        if a < b:
            runs.append([{"start": s - first[i], "length": n, "period": q} for s, n, q in zip(start[a:b], length[a:b], period[a:b])])
            stays = keep[first[i]:first[i] + len(words)]
            words = [w for w, k in zip(words, stays.tolist()) if k]
        else:
            runs.append([])
        collapsed.append(b" ".join(words))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths), pa.array(runs, kind),
                                       pa.array(collapsed, pa.binary())], ["doc_id", "n", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n
    (words, ``[^\\x20\\x09-\\x0D]+``), runs (start, length, period in words, by start,
    then period) and collapsed: the words that no run holds after its first period,
    joined by one space.

    NULL, empty and blank texts have no words, no runs and an empty collapsed text.
    Repeated rows are handled once each, a NULL doc_id is kept, an empty table gives
    no rows. A task holds one batch of about ``BATCH_WORDS`` words, or one text.
    """
    def run(batches):
        ids, texts, held = [], [], 0
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").split()      # splits at the ASCII white space of the pattern
                if held and held + len(words) > BATCH_WORDS:
                    yield _batch_runs(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
        if ids:
            yield _batch_runs(ids, texts)

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")).mapInArrow(run, SCHEMA)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_repetitions(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs`` where, by a hash of the id, one text in ten goes on
    with repetitions of some of its words. A NULL id leaves its text as it is."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    rows = rows.selectExpr("doc_id", "text", "w", "h div 10 AS g", "nullif(size(w), 0) AS n")
    rows = rows.selectExpr("doc_id", "text", "w", "g", "n", "CAST(g % n AS int) AS a")
    rows = rows.selectExpr("doc_id", "text", "w", "n", "a", "CAST(1 + (n - a) div (3 + g % 8) AS int) AS p")
    repeated = F.expr("array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), "
                      "CAST((n - a + p - 1) div p AS int))), 1, n - a)), ' ')")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def query(spark, sf_dir: str) -> DataFrame:
    """Runs of every document, some of which are made to repeat themselves, as digests."""
    found = periodic_runs(with_repetitions(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("least"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("m"),
                         _digest(lines).alias("runs_sha256"), _digest(F.col("collapsed")).alias("collapsed_sha256"))
    return found.select(
        "doc_id", "n_runs", F.col("m.start").alias("start"), (-F.col("m.least")).alias("length"),
        F.col("m.period").alias("period"), F.expr("(-m.least * 1000) div m.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
