"""Merkle fixity audit of web archives.

Every page is a WARC record with a digest, a length and an offset in its file.
Files hold ranges of ids; nodes above the records cover 16 ids, 256, and so on
up to one root, and a node's hash covers its children in order, each with its hash,
its byte offset from the node's start and its bytes. Two replicas are
compared from the root down: only children of differing nodes are looked at, and
at the records the damage is named. Node ranges depend on ids alone, so a lost
record changes one branch and not all that follow it.

Offsets within a node depend on nothing outside it, so they shift no other branch.

Rows are grouped at most ``FANOUT`` children at a time. Equal rows are one record
with a count; the different records of one id, where there are more, are hashed by
prefixes of their digests first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import table, written

FANOUT = 16
#: Records of one file: FANOUT to this power.
FILE_LEVELS = 3
#: Pages without an id are dealt over so many files of their own.
STRAY_FILES = 1 << 16
#: Hexadecimal digits of a digest by which the records of a crowded id are divided.
PREFIX = 4
#: Crowded ids up to this number are broadcast; beyond, joins shuffle.
MAX_BROADCAST = 500_000


def records(pages: DataFrame) -> DataFrame:
    """(file_id, node, page_id, digest, copies, length) of every distinct page.

    The serialised record is the WARC header, the html and two line ends. NULL
    urls and htmls are empty; pages without an id get negative nodes by content;
    repeated rows count as copies; other columns are ignored.
    """
    url, html = F.coalesce(F.col("url").cast("string"), F.lit("")), F.coalesce(F.col("html").cast("string"), F.lit(""))
    page = F.col("page_id").cast("long")
    block = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: "), F.coalesce(page.cast("string"), F.lit("")),
                     F.lit("\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"),
                     F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))
    rows = pages.select(page.alias("page_id"), F.sha2(block, 256).alias("digest"), F.octet_length(block).cast("long").alias("length"))
    stray = -1 - F.pmod(F.xxhash64("digest"), F.lit(STRAY_FILES)) * FANOUT ** FILE_LEVELS
    rows = rows.groupBy("page_id", "digest", "length").agg(F.count("*").alias("copies"))
    node = F.coalesce("page_id", stray)
    return rows.select(_up(node, FILE_LEVELS).alias("file_id"), node.alias("node"), "page_id", "digest", "copies", "length")


def _up(node: Column, levels: int = 1) -> Column:
    return F.shiftright(node, 4 * levels)       # FANOUT is 2 to the power 4; the shift rounds down on either side of 0


def offsets(rows: DataFrame) -> DataFrame:
    """``records`` with the byte offset of each in its file, in order of id and digest."""
    before = Window.partitionBy("file_id").orderBy("node", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum(F.expr("length * copies")).over(before), F.lit(0)))


def _covered(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """Per key a hash over its children in ``order``, and the sums of ``n`` and ``bytes``."""
    child = F.collect_list(F.struct(order, "hash", "bytes"))
    held = df.groupBy(*keys).agg(F.array_sort(child).alias("c"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    ranges = F.expr("transform(c, (x, i) -> concat(x.hash, '@', aggregate(slice(c, 1, i), CAST(0 AS BIGINT), "
                    "(a, y) -> a + y.bytes), '+', x.bytes))")
    return held.withColumn("hash", F.sha2(F.array_join(ranges, ","), 256)).drop("c")


def tree(rows: DataFrame) -> list[DataFrame]:
    """Levels of the tree, ids first, roots last: (node, hash, n, bytes) each.
    There is one root (0), and one more (-1) if there are pages without an id."""
    leaves = rows.select("node", "digest", F.concat("digest", F.lit("*"), F.col("copies").cast("string")).alias("hash"),
                         F.col("copies").alias("n"), F.expr("length * copies").alias("bytes"))
    # records of one id (strays, or pages given twice), in order of their digests
    crowded = written(leaves.groupBy("node").count().where(F.col("count") > FANOUT).select("node"), "crowded")
    many = crowded.count()
    if many:
        side = F.broadcast(crowded) if many <= MAX_BROADCAST else crowded
        full, leaves = leaves.join(side, "node", "left_semi"), leaves.join(side, "node", "left_anti")
        for size in range(PREFIX, -1, -1):
            full = _covered(full, [F.col("node"), F.expr(f"left(digest, {size})").alias("digest")], "digest")
        full = full.drop("digest")
    ids = _covered(leaves, [F.col("node")], "digest")
    levels = [written(ids.unionByName(full) if many else ids, "tree")]
    # ids of either sign end in the two nodes -1 and 0, which the last round keeps apart
    while levels[-1].where("node NOT IN (-1, 0)").limit(1).count():
        up = _covered(levels[-1], [_up(F.col("node")).alias("up")], "node")
        levels.append(written(up.withColumnRenamed("up", "node"), "tree"))
    return levels


def differing(mine: list[DataFrame], other: list[DataFrame]) -> DataFrame:
    """Record nodes whose hashes differ, found by descending from the roots through
    differing branches only. Trees of unequal height are compared from the lower one's roots."""
    height = min(len(mine), len(other))
    wanted = None
    for depth in range(height - 1, -1, -1):
        a, b = mine[depth].select("node", F.col("hash").alias("ha")), other[depth].select("node", F.col("hash").alias("hb"))
        if wanted is not None:
            a, b = (x.withColumn("up", _up(F.col("node"))).join(wanted, "up", "left_semi").drop("up") for x in (a, b))
        # written: both sides of the next depth read it
        bad = written(a.join(b, "node", "full").where("NOT (ha <=> hb)").select("node"), "differing")
        wanted = bad.select(F.col("node").alias("up"))
    return bad


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Every record of ``primary`` and every record only in ``replica``: file_id,
    offset, length, page_id, sha256, status.

    ``intact`` records lie under branches that agree or agree themselves;
    ``corrupt`` ones have another digest in the replica, ``missing`` ones have no
    record with their id there, ``extra`` ones exist in the replica only (offset
    there). Empty replicas make everything missing.
    """
    mine, theirs = written(offsets(records(primary)), "records"), written(offsets(records(replica)), "records")
    bad = differing(tree(mine), tree(theirs))
    key = ["node", "digest"]
    suspect = mine.join(bad, "node", "left_semi")
    there = theirs.join(bad, "node", "left_semi")
    held = there.groupBy("node").agg(F.lit(True).alias("held"))
    status = (suspect.join(there.select(*key, F.col("copies").alias("c")), key, "left").join(held, "node", "left")
              .select(*key, F.expr("CASE WHEN c >= copies THEN 'intact' WHEN c IS NOT NULL OR held IS NULL THEN 'missing' "
                                   "ELSE 'corrupt' END").alias("status")))
    known = suspect.select("node").distinct().withColumn("mine", F.lit(True))
    extra = there.join(known, "node", "left").where("mine IS NULL").withColumn("status", F.lit("extra"))
    out = mine.join(status, key, "left").withColumn("status", F.coalesce("status", F.lit("intact")))
    cols = ["file_id", "offset", "length", "page_id", F.col("digest").alias("sha256"), "copies", "status"]
    return out.select(*cols).unionByName(extra.select(*cols))


def damaged_copy(pages: DataFrame) -> DataFrame:
    """A replica of ``pages`` with faults that depend on the html's size: cut short, altered, or lost."""
    size = F.octet_length("html")
    html = F.when(size % 97 == 0, F.expr("left(html, length(html) div 2)")).when(
        size % 97 == 1, F.expr("concat(substring(html, 2), 'x')")).otherwise(F.col("html"))
    return pages.where(F.coalesce(size % 97 != 2, F.lit(True))).select("page_id", "url", html.alias("html"))


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return audit(pages, damaged_copy(pages)).drop("copies")


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
r AS (
  SELECT page_id, strlen(html) % 97 AS fault, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: ' || page_id || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html
    || chr(13) || chr(10) || chr(13) || chr(10) AS block FROM p)
SELECT page_id // 4096 AS file_id,
  CAST(coalesce(sum(strlen(block)) OVER (PARTITION BY page_id // 4096 ORDER BY page_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
  CAST(strlen(block) AS BIGINT) AS length, page_id, sha256(block) AS sha256,
  CASE fault WHEN 0 THEN 'corrupt' WHEN 1 THEN 'corrupt' WHEN 2 THEN 'missing' ELSE 'intact' END AS status
FROM r
"""
