"""Alignment of two tokenizers' tokens, scored through inverted pair bitmaps.

Both tokenizers cut the same bytes. Where tokens of both end at one offset they
close a group; tokens whose byte ranges overlap are linked. How often an id pair
is linked corpus-wide comes from an inverted index:

1. Every task numbers its documents within chunks and keeps, per linked id pair,
   the documents that hold it as a compressed bitmap (sorted 16-bit numbers while
   there are few, bits when there are many). What a document links more than once
   is held in multiplicity planes: plane j lists the documents whose count less one
   has bit j set. Batches of documents are OR-merged into their chunk; chunks hold
   different documents, so their bitmaps merge side by side.
2. Popcounts of the bitmaps, summed over chunks, are a pair's documents; planes
   add the further links with their weights.
3. The scores of its pairs return to each chunk, whose bitmaps (the postings) and
   planes hand them to the documents, where they are summed.

Only bitmaps, one row per pair and chunk, and per-document sums are shuffled,
never links. A chunk holds at most 65,536 documents and about ``CHUNK_POSTINGS``
(pair, document) entries or one document, which bounds a task's memory.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm.common import slices, table, written

#: Byte-level BPE (as a whole and as ranks of the same ids), and the piece model.
VOCABULARY = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
#: Entries of a chunk's bitmaps after which the next one begins, and most documents (numbers have 16 bits).
CHUNK_POSTINGS, CHUNK_DOCS = 4 << 20, 1 << 16
#: Text bytes that are aligned at once.
SLICE_BYTES = 1 << 20
#: Texts with longer runs of white space or of other characters go through ``tokenizers``.
_LONG_RUN = re.compile(r"\s{10000}|\S{10000}")
_SPACES = re.compile(r"\s\s")
_PLANE = "struct<members:binary,cards:binary,data:binary>"
SEGMENTS = ("chunk long, `at` int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups binary, "
            f"n_docs int, pairs binary, planes array<{_PLANE}>")
_PLANE_ARROW = pa.list_(pa.struct([(n, pa.binary()) for n in ("members", "cards", "data")]))


class Encoders:
    """Ids and token bytes of the two tokenizers."""

    def __init__(self, names: tuple[str, str, str]):
        whole, ranks, pieces = map(public_tokenizers.path, names)
        with open(ranks, "rb") as lines:
            table_a = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # the pattern's look-ahead only matters where two white-space characters meet
        plain = public_tokenizers.PATTERN.replace(r"\s+(?!\S)|", "")
        self._ranked = [tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=table_a, special_tokens={})
                        for p in (public_tokenizers.PATTERN, plain)]
        self._whole_file = whole
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_a = [b""] * (max(table_a.values()) + 1)
        for token, i in table_a.items():
            self.bytes_a[i] = token
        self.bytes_b = []
        for i in range(self._pieces.get_piece_size()):
            piece = self._pieces.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self._pieces.is_byte(i) else piece.replace("▁", " ").encode())
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        most = max(len(self.bytes_a), len(self.bytes_b))
        #: Decimal ids with each of the three marks that may follow them.
        self.names = [f"{i}{mark}" for i in range(most) for mark in ",|;"]

    @functools.cached_property
    def _whole(self) -> Tokenizer:
        tokenizer = Tokenizer.from_file(self._whole_file)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def ids_a(self, text: str) -> list[int]:
        text = " " + text
        if len(text) > 10_000 and _LONG_RUN.search(text):
            return self._whole.encode(text, add_special_tokens=False).ids
        return self._ranked[not _SPACES.search(text)].encode_ordinary(text)

    def ids_b(self, texts: list[str]) -> list[list[int]]:
        return self._pieces.encode(texts, num_threads=1)

    def tokens(self, texts: list[bytes | None]) -> tuple[list, list]:
        """Ids of both tokenizers per text; none where a text is NULL or empty, or tokens do not join to it."""
        read = [t.decode("utf-8", "replace") if t else "" for t in texts]
        a = [self.ids_a(t) if t else [] for t in read]
        b = self.ids_b(read)
        for i, text in enumerate(texts):
            bytes_a, bytes_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
            want = b" " + text if text else None
            if want is None or b"".join(map(bytes_a, a[i])) != want or b"".join(map(bytes_b, b[i])) != want:
                a[i], b[i] = [], []
        return a, b


@functools.cache
def encoders(names: tuple[str, str, str] = VOCABULARY) -> Encoders:
    return Encoders(names)


class Aligned(NamedTuple):
    """Counts per text, the texts' groups as text, and links as (text, id of A, id of B)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    link_text: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs of so many elements."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def align_texts(texts: list[bytes | None], names: tuple[str, str, str] = VOCABULARY) -> Aligned:
    """Groups and links of some texts, whose bytes are laid end to end for the offsets."""
    coder = encoders(names)
    ids_a, ids_b = coder.tokens(texts)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.fromiter((i for x in ids for i in x), np.int64, n.sum()) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
    end_a, end_b = np.cumsum(coder.length_a[a]), np.cumsum(coder.length_b[b])
    start_a, start_b = end_a - coder.length_a[a], end_b - coder.length_b[b]
    text_a = np.repeat(np.arange(len(texts)), n_a)

    closed = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(closed, end_a), np.searchsorted(closed, end_b)
    upto_a, upto_b = np.searchsorted(end_a, closed, "right"), np.searchsorted(end_b, closed, "right")
    n_groups = np.bincount(text_a[upto_a - 1], minlength=len(texts)) if len(closed) else np.zeros(len(texts), np.int64)

    first = np.searchsorted(end_b, start_a, "right")
    count = np.searchsorted(start_b, end_a) - first
    link_a = np.repeat(np.arange(len(a)), count)
    link_b = first[link_a] + _within(count)
    n_links = np.bincount(text_a, weights=count, minlength=len(texts)).astype(np.int64)

    # A's tokens of a group, then B's; the mark after a token says what follows
    begin_b = np.concatenate([[0], upto_b])
    code = np.empty(len(a) + len(b), np.int64)
    code[np.arange(len(a)) + begin_b[group_a]] = 3 * a + (np.arange(len(a)) + 1 == upto_a[group_a])
    code[np.arange(len(b)) + upto_a[group_b]] = 3 * b + 2 * (np.arange(len(b)) + 1 == upto_b[group_b])
    ends = np.cumsum(n_a + n_b)
    groups = ["".join(map(coder.names.__getitem__, code[e - n:e].tolist()))[:-1] for e, n in zip(ends.tolist(), (n_a + n_b).tolist())]
    return Aligned(n_a, n_b, n_groups, n_links, groups, text_a[link_a], a[link_a], b[link_b])


def pack_plane(member: np.ndarray, number: np.ndarray, n_docs: int) -> dict[str, bytes]:
    """Compressed bitmaps of (member, document number), sorted: members, how many documents each
    has, and either its sorted 16-bit numbers or its bits, whichever is shorter."""
    members, cards = np.unique(member, return_counts=True)
    width = -(-n_docs // 8)
    dense = 2 * cards > width
    in_dense = np.repeat(dense, cards)
    bits = np.zeros((int(dense.sum()), 8 * width), bool)
    bits[np.repeat(np.arange(len(bits)), cards[dense]), number[in_dense]] = True
    return {"members": members.astype("<i4").tobytes(), "cards": cards.astype("<i4").tobytes(),
            "data": number[~in_dense].astype("<u2").tobytes() + np.packbits(bits, axis=1, bitorder="little").tobytes()}


def unpack_plane(plane: dict[str, bytes], n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, document number) of a plane."""
    members, cards = np.frombuffer(plane["members"], "<i4"), np.frombuffer(plane["cards"], "<i4")
    width = -(-n_docs // 8)
    dense = 2 * cards > width
    few = int(cards[~dense].sum())
    numbers = np.frombuffer(plane["data"], "<u2", few).astype(np.int64)
    rows = np.frombuffer(plane["data"], np.uint8, offset=2 * few).reshape(int(dense.sum()), width)
    row, bit = np.nonzero(np.unpackbits(rows, axis=1, bitorder="little"))
    return np.concatenate([np.repeat(members[~dense], cards[~dense]), members[dense][row]]), np.concatenate([numbers, bit])


def _segment(keys: list[np.ndarray], counts: list[np.ndarray], n_docs: int) -> tuple[bytes, list[dict]]:
    """A chunk's distinct pairs and planes: the bitmaps of documents, then those of the bits of
    further links. ``keys`` hold pair and document number (low 16 bits)."""
    key, more = np.concatenate(keys), np.concatenate(counts) - 1
    order = np.argsort(key, kind="stable")
    key, more = key[order], more[order]
    pairs, member = np.unique(key >> 16, return_inverse=True)
    number = key & 0xFFFF
    planes = [pack_plane(member, number, n_docs)]
    for j in range(int(more.max(initial=0)).bit_length()):
        has = more >> j & 1 == 1
        planes.append(pack_plane(member[has], number[has], n_docs))
    return pairs.astype("<i8").tobytes(), planes


def _weight(plane: int) -> int:
    """How many links a document in this plane has: one in the first, then 1, 2, 4, ..."""
    return 1 << max(0, plane - 1)


def segments(docs: DataFrame, names: tuple[str, str, str] = VOCABULARY, digest: bool = True) -> DataFrame:
    """Per chunk one row with its pair bitmaps, and one row per document: its number in the chunk
    (``at``), counts and groups (as text, or the sha256 of it)."""
    fields = pa.schema([("chunk", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                        ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.binary()),
                        ("n_docs", pa.int32()), ("pairs", pa.binary()), ("planes", _PLANE_ARROW)])

    def rows(**columns):
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in fields], schema=fields)

    def shown(groups: str) -> bytes:
        return hashlib.sha256(groups.encode()).hexdigest().encode() if digest and groups else groups.encode()

    def run(batches):
        chunk, n_docs, held, keys, counts = TaskContext.get().partitionId() << 32, 0, 0, [], []
        ids, texts, size = [], [], 0

        def align():
            nonlocal n_docs, held
            found = align_texts(texts, names)
            pair = found.link_a << 16 | found.link_b
            key, count = np.unique(pair << 16 | n_docs + found.link_text, return_counts=True)
            keys.append(key)
            counts.append(count)
            at = np.arange(n_docs, n_docs + len(texts))
            n_docs, held = n_docs + len(texts), held + len(key)
            return rows(chunk=[chunk] * len(texts), at=at, doc_id=ids, n_a=found.n_a, n_b=found.n_b, n_groups=found.n_groups,
                        n_links=found.n_links, groups=[shown(g) for g in found.groups])

        def close():
            pairs, planes = _segment(keys, counts, n_docs)
            return rows(chunk=[chunk], n_docs=[n_docs], pairs=[pairs], planes=[planes])

        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                size += len(texts[-1] or b"")
                if size >= SLICE_BYTES or len(texts) == 512:
                    yield align()
                    ids, texts, size = [], [], 0
                    if held >= CHUNK_POSTINGS or n_docs > CHUNK_DOCS - 512:
                        yield close()
                        chunk, n_docs, held, keys, counts = chunk + 1, 0, 0, [], []
        if texts:
            yield align()
        if n_docs:
            yield close()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")).mapInArrow(run, SEGMENTS)


def _chunk_pairs(index: DataFrame) -> DataFrame:
    """(chunk, pair, documents, links) by popcounts of the bitmaps and planes of each chunk."""
    def run(batches):
        for b in slices(batches, 1):
            pairs, planes = np.frombuffer(b.column("pairs")[0].as_py(), "<i8"), b.column("planes")[0].as_py()
            documents, links = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            for j, plane in enumerate(planes):
                members, cards = np.frombuffer(plane["members"], "<i4"), np.frombuffer(plane["cards"], "<i4")
                links[members] += _weight(j) * cards.astype(np.int64)
                if j == 0:
                    documents[members] = cards
            chunk = np.full(len(pairs), b.column("chunk")[0].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (chunk, pairs, documents, links)],
                                             ["chunk", "pair", "documents", "links"])

    only = index.where("pairs IS NOT NULL").select("chunk", "pairs", "planes")
    return only.mapInArrow(run, "chunk long, pair long, documents long, links long")


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, documents, links, best) of all linked id pairs of written ``segments``: in how many documents a
    pair is linked, how many links there are, and whether no pair of this a has more documents."""
    pairs = _chunk_pairs(index).groupBy("pair").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    pairs = written(pairs.selectExpr("pair", "shiftright(pair, 16) AS a", "pair & 65535 AS b", "documents", "links"), "pairs")
    # one row per id of the vocabulary
    most = F.broadcast(pairs.groupBy("a").agg(F.max("documents").alias("most")))
    return pairs.join(most, "a").select("a", "b", "pair", "documents", "links", (F.col("documents") == F.col("most")).alias("best"))


def _sums(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of integers by index; halves of the bits keep the float sums of ``bincount`` exact."""
    low, high = np.bincount(index, values & 0xFFFFFF, n), np.bincount(index, values >> 24, n)
    return low.astype(np.int64) + (high.astype(np.int64) << 24)


def align(docs: DataFrame, names: tuple[str, str, str] = VOCABULARY, digest: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_a, n_b
    (tokens), n_groups, n_links, n_best (links whose pair has the most documents of its A id),
    count_sum (documents of the pair, summed over links), groups (``a1,a2|b1;a3|b2``, or its sha256).

    Every row is a document. NULL and empty texts, and texts that the tokens of one
    of the tokenizers do not give back, have no tokens: zeros and empty groups.
    Repeated rows count once each, a NULL doc_id is kept, an empty table gives no rows.
    """
    index = written(segments(docs, names, digest), "segments")
    pairs = pair_counts(index).select("pair", "documents", "best")
    scores = _chunk_pairs(index).select("chunk", "pair").join(pairs, "pair")
    kinds = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
             "n_best": pa.int64(), "count_sum": pa.int64(), "groups": pa.binary()}

    def hand_out(held: pa.Table, scores: pa.Table) -> pa.Table:
        is_index = np.array(held.column("pairs").is_valid())
        own, rows = held.filter(pa.array(is_index)), held.filter(pa.array(~is_index))
        n_docs, pairs = own.column("n_docs")[0].as_py(), np.frombuffer(own.column("pairs")[0].as_py(), "<i8")
        to = np.searchsorted(pairs, scores.column("pair").to_numpy())
        documents, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        documents[to] = scores.column("documents").to_numpy()
        best[to] = scores.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
        for j, plane in enumerate(own.column("planes")[0].as_py()):
            member, number = unpack_plane(plane, n_docs)
            n_best += _weight(j) * _sums(number, best[member], n_docs)
            count_sum += _weight(j) * _sums(number, documents[member], n_docs)
        at = rows.column("at").to_numpy()
        more = {"n_best": pa.array(n_best[at]), "count_sum": pa.array(count_sum[at])}
        return pa.table({k: more[k] if k in more else rows.column(k) for k in kinds}, pa.schema(kinds.items()))

    names_of = {pa.int64(): "long", pa.binary(): "binary"}
    out = index.groupBy("chunk").cogroup(scores.groupBy("chunk")).applyInArrow(
        hand_out, ", ".join(f"{k} {names_of[v]}" for k, v in kinds.items()))
    return out.withColumn("groups", F.col("groups").cast("string"))


def query(spark, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents")).withColumnRenamed("groups", "groups_sha256")
