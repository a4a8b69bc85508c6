"""Minimum-bin-slack packing of tokenised documents into fixed windows.

Documents become token ids; whole windows are cut off their front, and the
remainders wait in a pool held as counts by length. A window takes the longest
remainder and the multiset of further lengths that comes closest to the
capacity: a bitset of reachable sums (one shift per power of two of a length's
count), traced back to how many pieces of each length it uses. A multiset is
reused as often as the counts allow. What a window still lacks is cut off
another piece, and the last tokens of a partition go into windows whose size is
a power of two, so no padding is left.

Every task packs its own partition, pool by pool: there is no shuffle, and a
task holds one pool (not the documents its pieces come from) and one document at
a time. Sequence ids join the partition number and a counter, so a task that
runs again after a lost executor gives the same rows.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm.common import give_back, map_batches, slices, table

CAPACITY = 1024
SEPARATOR = 0
#: Remainders that a task gathers before it packs.
POOL = 4096
#: Pieces that a task returns at once.
ROWS = 512
VOCABULARY = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
SPECIAL = "<|endoftext|>"
#: Texts with longer runs of white space or of other characters go through ``tokenizers``.
SPACES = re.compile(r"\s\s")
LONG_RUN = re.compile(r"\s{10000}|\S{10000}")
SCHEMA = ("doc_id long, start long, length long, token_ids binary, doc_tokens long, sequence_id long, "
          "`offset` long")


@functools.cache
def _whole(name: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


@functools.cache
def _ranked(name: str):
    """The same ranks in ``tiktoken``: with the same pattern, and with the pattern without its look-ahead,
    which only matters where two white-space characters meet."""
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    patterns = (public_tokenizers.PATTERN, public_tokenizers.PATTERN.replace(r"\s+(?!\S)|", ""))
    return tuple(tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in patterns)


def token_ids(text: str | None, names: tuple[str, str] = VOCABULARY) -> np.ndarray:
    """Ids that ``tokenizers`` gives a text (none added), then the separator id. NULL is empty."""
    if not text:
        ids = []
    elif SPECIAL in text or len(text) > 10_000 and LONG_RUN.search(text):
        ids = _whole(names[0]).encode(text, add_special_tokens=False).ids
    else:
        ids = _ranked(names[1])[not SPACES.search(text)].encode_ordinary(text)
    ids.append(SEPARATOR)
    return np.frombuffer(array("I", ids), np.uint32).astype("<u4", copy=False)


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length to take so that their sum is as near ``room``
    as possible without passing it. ``counts``: pieces available by length."""
    if not room:
        return {}
    mask, goal = (1 << room + 1) - 1, 1 << room
    reach, trail = 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left and not reach & goal:
            take = min(step, left)
            trail.append((reach, length, take))
            reach |= reach << take * length & mask
            left, step = left - take, step * 2
        if reach & goal:
            break
    at, used = reach.bit_length() - 1, {}
    for before, length, take in reversed(trail):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= take * length
    return used


class _Packer:
    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.rows = capacity, first, []
        self.pool: dict[int, list[tuple]] = {}
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        cut = len(ids) // self.capacity * self.capacity
        for start in range(0, cut, self.capacity):
            self._window([(doc_id, start, ids[start:start + self.capacity], len(ids))])
        if cut < len(ids):
            # a copy: a view would keep the ids of the whole document while the piece waits
            self._put((doc_id, cut, ids[cut:].copy(), len(ids)))

    def _put(self, piece: tuple) -> None:
        self.pool.setdefault(len(piece[2]), []).append(piece)
        self.size += 1

    def _take(self, length: int) -> tuple:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
        self.size -= 1
        return piece

    def _window(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), ids.tobytes(), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def pack(self, down_to: int) -> None:
        """Fill windows until at most ``down_to`` pieces wait, or no window can be filled."""
        while self.size > down_to:
            longest = max(self.pool)
            counts = {n: len(p) for n, p in self.pool.items()}
            counts[longest] -= 1
            used = closest_fill(counts, self.capacity - longest)
            used[longest] = used.get(longest, 0) + 1
            for _ in range(min(len(self.pool[n]) // k for n, k in used.items())):
                pieces = [self._take(n) for n, k in sorted(used.items(), reverse=True) for _ in range(k)]
                lacking = self.capacity - sum(len(p[2]) for p in pieces)
                while lacking and self.pool:
                    doc_id, start, ids, total = self._take(min((n for n in self.pool if n >= lacking), default=max(self.pool)))
                    pieces.append((doc_id, start, ids[:lacking], total))
                    if len(ids) > lacking:
                        self._put((doc_id, start + lacking, ids[lacking:], total))
                    lacking = self.capacity - sum(len(p[2]) for p in pieces)
                if lacking:
                    for p in pieces:
                        self._put(p)
                    return
                self._window(pieces)
                if sum(k * n for n, k in used.items()) < self.capacity:
                    break           # the cut has changed the counts

    def finish(self) -> None:
        self.pack(0)
        rest = [p for n in sorted(self.pool, reverse=True) for p in self.pool[n]]
        left = sum(len(p[2]) for p in rest)
        self.pool, self.size = {}, 0
        while left:
            room = 1 << left.bit_length() - 1
            left -= room
            window = []
            while room:
                doc_id, start, ids, total = rest.pop()
                window.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    rest.append((doc_id, start + room, ids[room:], total))
                room -= len(window[-1][2])
            self._window(window)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The pieces of the windows filled so far, ``ROWS`` at a time."""
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "token_ids", "doc_tokens", "sequence_id", "offset"]
        rows, self.rows = self.rows[::-1], []
        while rows:
            some = rows[:-ROWS - 1:-1]
            del rows[-ROWS:]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: tuple[str, str] = VOCABULARY) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) packed into sequences.

    One row per piece: doc_id, start (ids of its document before it), length,
    token_ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.
    Every id of every document lies in one piece; sequences hold ``capacity``
    ids, or a power of two at the end of a partition. NULL and empty texts are
    the separator alone. Repeated rows are packed once each, a NULL doc_id is
    kept, an empty table gives no rows, other columns are ignored.
    """
    def run(batches):
        packer = _Packer(capacity, TaskContext.get().partitionId() << 36)
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, token_ids(text.as_py(), vocabulary))
                if packer.size >= POOL:
                    packer.pack(POOL // 2)
                if len(packer.rows) >= ROWS:
                    yield from packer.batches()
        packer.finish()
        yield from packer.batches()
        del packer
        give_back()

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
