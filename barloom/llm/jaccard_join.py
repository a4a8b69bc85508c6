"""Exact Jaccard similarity join of word-shingle sets in metric space.

Jaccard distance (one minus similarity) is a metric. The join works on the
distinct shingle sets ("points"; exact copies collapse into one point first):

1. Points that can be near each other share a shingle among their first few in
   a global order (the prefix bound: two sets with similarity t overlap so much
   that the first common shingle comes early in both). Each shared early
   shingle is a neighbourhood. Any order gives the same links; shingles that a
   hashed share of the points shows to be common come last, which keeps the
   neighbourhoods of common passages and boilerplate small.
2. Each neighbourhood takes as pivot its most central point (the one with the
   fewest rare shingles ahead). Distances to the pivot are computed exactly.
   Points within the radius of a pivot form its Voronoi region and belong to
   its component, so pairs inside a region need no check.
3. By the triangle inequality, a point outside a region can only be linked to
   points whose distance to the pivot differs by at most the radius. Those
   boundary points are replicated into the next, smaller neighbourhood, which
   gets a pivot of its own, and so on until the open neighbourhoods are small
   enough to check the rest pair by pair.

Every step is a shuffle by shingle or by point; a region is never gathered in
one task, and the pairs within a group of near copies are never listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import map_batches, shingle_hashes, slices, table, whole_row, written
from barloom.llm.components import components

#: One point in so many shows which shingles are common. This only orders shingles; links do not depend on it.
ORDER_SHARE = 32
#: A shingle that so many of the points looked at hold counts as common.
COMMON_FROM = 3
#: At most so many common shingles (the most frequent) are sent to the tasks, 8 bytes each.
MAX_COMMON = 2_000_000
#: Up to so many document ids (8 bytes each) are broadcast to pick documents; beyond, the join shuffles.
MAX_BROADCAST_IDS = 2_000_000
#: Rows of the neighbourhoods that later, smaller tables get one file for.
ROWS_PER_FILE = 20_000
#: Regions are split again while the open pairs exceed this multiple of the open rows and new pivots halve them.
OPEN_FACTOR = 64


def _sets(texts, width: int) -> Iterator[np.ndarray]:
    for text in texts:
        yield np.unique(shingle_hashes(text.encode(), width)) if text else np.zeros(0, np.uint64)


def _point(shingles: np.ndarray) -> int:
    """Id of a set: 63 bits of a digest of its sorted shingle hashes."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little") >> 1


def _longs(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _common_shingles(docs: DataFrame, width: int) -> np.ndarray:
    def sets(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), _longs(list(_sets(batch.column("text").to_pylist(), width)))], ["h", "shingles"])

    some = docs.select(F.xxhash64("text").alias("h"), "text").where(f"pmod(h, {ORDER_SHARE}) = 0")
    counts = (map_batches(some, sets, "h long, shingles array<long>").groupBy("h").agg(F.first("shingles").alias("shingles"))
              .select(F.explode("shingles").alias("s")).groupBy("s").count().where(F.col("count") >= COMMON_FROM))
    top = counts.orderBy(F.desc("count"), "s").limit(MAX_COMMON).select("s").toArrow()
    return np.sort(top.column("s").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64))


def _parities(shingles: np.ndarray) -> np.ndarray:
    """Odd sketch: bit i says whether an odd number of shingles falls on i, with at
    least two bits a shingle. Two sketches of one size differ in at most as many
    bits as the sets differ in shingles; a sketch is halved by xor of its halves."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    ones = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(ones.astype(np.uint8)).view(np.uint64)


def shingle_points(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """(doc_id, content, point, n, early, sketch): a hash of the text, the point id, the
    set size, the shingles before the prefix bound in global order, and the odd sketch."""
    common = docs.sparkSession.sparkContext.broadcast(_common_shingles(docs, width))

    def points(batches):
        late = common.value
        for batch in slices(batches):
            ids, n, early, sketches = [], [], [], []
            for s in _sets(batch.column("text").to_pylist(), width):
                ids.append(_point(s))
                n.append(len(s))
                sketches.append(_parities(s))
                if len(late) and len(s):
                    at = np.minimum(np.searchsorted(late, s), len(late) - 1)
                    is_late = late[at] == s
                    s = np.concatenate([s[~is_late], s[is_late]])
                keep = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                early.append(s[:keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), pa.array(ids, pa.int64()), pa.array(n, pa.int32()),
                 _longs(early), _longs(sketches)], ["doc_id", "content", "point", "n", "early", "sketch"])

    text = F.col("text").cast("string")
    out = map_batches(docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("content"), text.alias("text")),
                      points, "doc_id long, content long, point long, n int, early array<long>, sketch array<long>")
    return written(out, "points")


def _far(a: str, b: str, percent: int) -> str:
    """SQL: the first common shingle comes too late in one of the sets for them to be linked."""
    need = f"{percent} * ({a}.n + {b}.n)"
    return f"({100 + percent} * ({a}.n - {a}.pos) < {need} OR {100 + percent} * ({b}.n - {b}.pos) < {need})"


def _measure(pairs: DataFrame, docs: DataFrame, index: DataFrame, width: int, percent: int, parts: int) -> DataFrame:
    """Bounds on the distances of ``pairs`` (a, b): (a, b, low, up, linked).

    Sketches give an exact lower bound; where it leaves a link possible, the
    texts of the two points are read again and the distance is exact."""
    side = [index.select(F.col("point").alias(p), F.col("n").alias(f"n{p}"), F.col("sketch").alias(f"k{p}"),
                         F.struct("doc_id", "content").alias(f"id{p}")) for p in "ab"]
    fold = ("if(size({0}) > size({1}), zip_with(slice({0}, 1, size({0}) div 2), slice({0}, size({0}) div 2 + 1, "
            "size({0}) div 2), (x, y) -> x ^ y), {0})")
    differ = (f"aggregate(zip_with({fold.format('ka', 'kb')}, {fold.format('kb', 'ka')}, (x, y) -> bit_count(x ^ y)), 0, "
              "(s, v) -> s + v)")
    # sizes alone may part a pair; else the sketches are of one size or the double
    apart = F.expr(f"if(100 * least(na, nb) < {percent} * greatest(na, nb), abs(na - nb), {differ})")
    pairs = pairs.join(side[0], "a").join(side[1], "b").withColumn("apart", apart)
    pairs = written(pairs.select("a", "b", "ida", "idb", F.expr("2 * apart / (na + nb + apart)").alias("low"),
                                 F.expr(f"100 * (na + nb - apart) >= {percent} * (na + nb + apart)").alias("maybe")), "pairs", parts)
    maybe = pairs.where("maybe")
    ids = written(maybe.select("ida.*").union(maybe.select("idb.*")).distinct(), "named", parts)

    def build(batches):
        for batch in slices(batches):
            sets = list(_sets(batch.column("text").to_pylist(), width))
            yield pa.RecordBatch.from_arrays([pa.array([_point(s) for s in sets], pa.int64()), _longs(sets)],
                                             ["point", "shingles"])

    wanted = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    # a row is found by id and text: rows without an id take part
    rows, wanted = docs.select("doc_id", "text", F.xxhash64("text").alias("content")).alias("d"), wanted.alias("w")
    found = rows.join(wanted, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.content") == F.col("w.content")), "left_semi")
    sets = written(map_batches(found, build, "point long, shingles array<long>").dropDuplicates(["point"]), "sets", parts)
    a = sets.select(F.col("point").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("point").alias("b"), F.col("shingles").alias("sb"))
    both, union = F.col("both"), F.size("sa") + F.size("sb") - F.col("both")
    exact = (maybe.select("a", "b").join(a, "a").join(b, "b")
             .withColumn("both", F.size(F.array_intersect("sa", "sb")))
             .select("a", "b", (1 - both / union).alias("low"), (1 - both / union).alias("up"),
                     (100 * both >= percent * union).alias("linked")))
    rest = pairs.where("NOT maybe").select("a", "b", "low", F.lit(1.0).alias("up"), F.lit(False).alias("linked"))
    return written(exact.unionByName(rest), "distances", parts)


def _distinct_sets(points: DataFrame) -> DataFrame:
    """One row per point with shingles, with the doc_id and content of one of its rows (the least known id)."""
    one = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "content"))
    return written(points.where("n > 0").groupBy("point").agg(
        one.alias("one"), F.first("n").alias("n"), F.first("early").alias("early"), F.first("sketch").alias("sketch"))
        .select("point", "one.doc_id", "one.content", "n", "early", "sketch"), "index")


def similarity_links(docs: DataFrame, percent: int = 80, width: int = 5) -> tuple[DataFrame, DataFrame]:
    """All links between distinct shingle sets, and how many each row of ``docs`` has.

    Rules are those of ``similarity_components``. The first table has a linked pair
    of sets once: a, b (points, a < b), doc_a, doc_b (their least doc_ids, NULL if
    they have none) and similarity. The second has a row per input row: doc_id,
    content and n_links, the number of other distinct sets linked to that of the
    row (0 without shingles); copies of one set are one set. Pairs within a
    region are listed too, so the result grows with the squares of the groups.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    points = shingle_points(docs, percent, width)
    index = _distinct_sets(points)
    rows = written(index.select("point", "n", F.posexplode("early").alias("pos", "s")), "neighbourhoods")
    parts = max(8, rows.count() // ROWS_PER_FILE)
    x, y = rows.alias("x"), rows.alias("y")
    pairs = x.join(y, F.col("x.s") == F.col("y.s")).where(f"x.point < y.point AND NOT {_far('x', 'y', percent)}").select(
        F.col("x.point").alias("a"), F.col("y.point").alias("b")).distinct()
    found = _measure(pairs, docs, index, width, percent, parts).where("linked")
    ids = [index.select(F.col("point").alias(p), F.col("doc_id").alias(f"doc_{p}")) for p in "ab"]
    links = written(found.select("a", "b", (1 - F.col("low")).alias("similarity")).join(ids[0], "a").join(ids[1], "b")
                    .select("a", "b", "doc_a", "doc_b", "similarity"), "links")
    counts = links.select(F.col("a").alias("point")).union(links.select(F.col("b").alias("point"))).groupBy("point").agg(
        F.count("*").alias("n_links"))
    return links, points.select("doc_id", "content", "point").join(counts, "point", "left").select(
        "doc_id", "content", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def similarity_components(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, label (names
    the component among points; NULL without shingles), content (hash of the text).

    ``docs`` needs doc_id and text; other columns are ignored. Two rows are
    linked when ``100 * intersection >= percent * union`` of their distinct
    ``width``-word shingles (A-Z lower-cased, words split at ASCII white space;
    shorter texts are one shingle). ``component_id`` is the least doc_id
    reachable. Rows with NULL, empty or blank text have no shingles and are
    linked with nothing: their component is their own doc_id. Repeated rows and
    equal texts share a component. A NULL doc_id keeps its row, takes part like any
    other and gets the least known id of its component, or NULL. Radius and windows follow from ``percent``; nothing is capped. An empty table gives an empty result.
    """
    radius = 1 - percent / 100
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    points = shingle_points(docs, percent, width)
    index = _distinct_sets(points)
    by_shingle = Window.partitionBy("s")
    rows = index.select("point", "n", F.posexplode("early").alias("pos", "s"))
    rows = rows.withColumn("size", F.count("*").over(by_shingle)).withColumn(
        "pivot", F.min(F.struct("pos", "point", "n")).over(by_shingle)).where("size > 1")
    rows = written(rows, "neighbourhoods")
    # what follows is smaller than the neighbourhoods, and is written to as many files at most
    parts = max(8, rows.count() // ROWS_PER_FILE)

    known = links = labels = None
    before = None
    while True:
        # regions: the points of each neighbourhood against its pivot
        star = rows.where("point <> pivot.point").select(
            F.struct("n", "pos").alias("x"), "pivot", F.col("point").alias("a"), F.col("pivot.point").alias("b"))
        if known is None:
            star = star.where(f"NOT {_far('x', 'pivot', percent)}").select("a", "b").distinct()
        else:
            either = known.select("a", "b").union(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
            star = star.select("a", "b").distinct().join(either, ["a", "b"], "left_anti")
        found = _measure(star, docs, index, width, percent, parts)
        known = found if known is None else known.union(found)
        links = known.where("linked").select("a", "b")
        labels = written(components(links, parts, rounds=2), "labels", parts)

        # windows: a point of the region leaves when no foreign point is within the radius of its own distance
        name = labels.select(F.col("node").alias("point"), "label")
        of_pivot = labels.select(F.col("node").alias("pp"), F.col("label").alias("pivot_label"))
        to_pivot = known.select(F.col("a").alias("point"), F.col("b").alias("pp"), "low", "up")
        left = (rows.where("size > 2 AND point <> pivot.point").withColumn("pp", F.col("pivot.point"))
                .join(name, "point", "left").join(of_pivot, "pp", "left").join(to_pivot, ["point", "pp"], "left")
                .withColumn("label", F.coalesce("label", "point"))
                .withColumn("own", F.col("label") == F.coalesce("pivot_label", "pp")))
        left = left.withColumn("low", F.coalesce("low", F.lit(0.0))).withColumn("up", F.coalesce("up", F.lit(1.0)))
        left = left.withColumn("nearest", F.min(F.when(~F.col("own"), F.col("low"))).over(by_shingle)).where(
            f"NOT own OR (nearest IS NOT NULL AND up + {radius} + 1e-9 >= nearest)")
        left = left.withColumn("size", F.count("*").over(by_shingle)).withColumn(
            "same", F.count("*").over(Window.partitionBy("s", "label"))).where("same < size")
        left = written(left.select("s", "point", "n", "pos", "size", "same", "label", "own", "low", "up"), "open", parts)
        total = left.agg(F.count("*").alias("rows"), F.sum(F.col("size") - F.col("same")).alias("pairs")).first()
        if not total["rows"]:
            break
        if total["pairs"] > OPEN_FACTOR * total["rows"] and (before is None or 2 * total["pairs"] < before):
            before = total["pairs"]
            first = F.coalesce(F.min(F.when(~F.col("own"), F.struct("pos", "point", "n"))).over(by_shingle),
                               F.min(F.struct("pos", "point", "n")).over(by_shingle))
            rows = written(left.withColumn("pivot", first).select("point", "n", "pos", "s", "size", "pivot"),
                           "neighbourhoods", parts)
            continue
        x, y = left.alias("x"), left.alias("y")
        near = f"y.low <= x.up + {radius} + 1e-9 AND x.low <= y.up + {radius} + 1e-9"
        rest = x.join(y, F.col("x.s") == F.col("y.s")).where(
            f"x.point < y.point AND x.label <> y.label AND {near} AND NOT {_far('x', 'y', percent)}")
        rest = rest.select(F.col("x.point").alias("a"), F.col("y.point").alias("b")).distinct()
        found = _measure(rest, docs, index, width, percent, parts)
        links = links.union(found.where("linked").select("a", "b"))
        break
    labels = written(components(links, parts), "labels", parts)

    least = index.select("point", "doc_id")
    joined = least.join(labels.select(F.col("node").alias("point"), "label"), "point")
    by_label = joined.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = joined.join(by_label, "label").select("point", "label", "component_id")
    names = least.join(linked, "point", "left").select(
        "point", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("label", "point").alias("label"))
    return points.select("doc_id", "content", "n", "point").join(names, "point", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "label", "content")


def keep_one_per_component(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """Rows of ``docs`` with one document of each component kept: the one with the
    least doc_id (of equal ids, the least hash of the text; rows without an id
    come after all others). Of rows without shingles one per doc_id stays, and
    of equal rows one. All columns are returned."""
    rows = similarity_components(docs, percent, width)
    group = F.struct("label", F.when(F.col("label").isNull(), F.col("doc_id")).alias("id"))
    kept = rows.groupBy(group).agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "content")).alias("k"))
    key = F.concat_ws(":", "doc_id", "content").alias("key")
    kept = kept.select("k.doc_id", "k.content").select(key, F.lit(True).alias("stays"))
    # rows that go, and kept ones that are repeated; all others pass without a shuffle of their texts
    special = written(rows.groupBy(key).agg(F.count("*").alias("copies")).join(kept, "key", "left")
                      .where("stays IS NULL OR copies > 1").select("key", "stays"), "special")
    if special.count() <= MAX_BROADCAST_IDS // 4:       # about 40 bytes each
        special = F.broadcast(special)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("content"),
                        whole_row(docs)).select(key, "row")
    once = keyed.join(special.where("stays"), "key").select("key", "row").dropDuplicates(["key"])
    return keyed.join(special, "key", "left_anti").unionByName(once).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return similarity_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, len(g) AS n FROM g),
e AS MATERIALIZED (SELECT doc_id, unnest(g) AS s FROM g),
links AS MATERIALIZED (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM e a JOIN e b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY ALL) JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (
  SELECT doc_id, doc_id AS other FROM n
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT n.doc_id, n.n AS n_shingles, min(other) AS component_id FROM n JOIN reach USING (doc_id) GROUP BY ALL
"""
