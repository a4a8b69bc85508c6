"""Benchmark decontamination with DataFrame operations only.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII
characters. A window is 13 consecutive words of a benchmark item, or the whole
item when it is shorter. One pass over the documents generates their word
positions, probes a broadcast hash set of the windows' first words, and only
the positions that pass are compared with whole windows. A broadcast is made
only up to ``MAX_WINDOWS``; a larger benchmark is joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import table, whole_row, written

WIDTH = 13
#: A document is contaminated when its hit words are at least one in so many of its words.
ONE_IN = 20
#: Windows and their hashes (about 200 bytes each), or places hit (8 bytes), are broadcast up to this number.
MAX_WINDOWS = 500_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Lower-cased words of a text; an empty array for NULL."""
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(lowered, SEPARATORS, -1), ""), F.array().cast("array<string>"))


def _anchor(w: str, at: str, size: str) -> Column:
    """Hash of a window's size and its first words, at most three."""
    return F.expr(f"xxhash64({size}, get({w}, {at}), if({size} > 1, get({w}, {at} + 1), ''), "
                  f"if({size} > 2, get({w}, {at} + 2), ''))")


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, size, window, anchor): every window of every item, as text. Items
    without words have none; an item without an id is named ''."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             words(F.col("text").cast("string")).alias("w")).where("size(w) > 0")
    items = items.withColumn("size", F.least(F.size("w"), F.lit(width)))
    at = items.select("item", "size", "w", F.explode(F.expr("sequence(0, size(w) - size)")).alias("at"))
    return at.select("item", "size", F.expr("array_join(slice(w, at + 1, size), ' ')").alias("window"),
                     _anchor("w", "at", "size").alias("anchor")).distinct()


def find_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per document and content (pos -1, with the word count ``n`` and the
    number of equal rows), and one for each place where a window occurs:
    doc_id, content, n, copies, pos, size, window."""
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]     # 1 to the window width
    known = windows.select("size", "window", "anchor").distinct()
    fits = known.count() <= MAX_WINDOWS
    hint = F.broadcast if fits else (lambda df: df)
    text = F.col("text").cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("content"),
                       words(text).alias("w")).withColumn("n", F.size("w"))
    at = base.select("*", F.explode(F.expr("sequence(-1, n - 1)")).alias("pos"))
    if len(sizes) == 1:
        at = at.withColumn("size", F.lit(sizes[0])).where("pos < 0 OR pos + size <= n")
    else:
        at = at.select("*", F.explode(F.array(*map(F.lit, sizes or [0]))).alias("size"))
        at = at.where(f"pos + size <= n AND pos >= 0 OR pos < 0 AND size = {(sizes or [0])[0]}")
    at = at.withColumn("anchor", F.when(F.col("pos") >= 0, _anchor("w", "pos", "size")))
    if fits:
        starts = known.select("anchor", F.lit(True).alias("starts")).distinct()
        at = at.join(hint(starts), "anchor", "left").where("pos < 0 OR starts")
    at = at.withColumn("window", F.when(F.col("pos") >= 0, F.expr("array_join(slice(w, pos + 1, size), ' ')")))
    hit = known.select("size", "window", F.lit(True).alias("hit"))
    at = at.join(hint(hit), ["size", "window"], "left").where("pos < 0 OR hit")
    rows = at.groupBy("doc_id", "content", "n", "pos", "size", "window").agg(F.count("*").alias("copies"))
    return written(rows, "hits")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, content (hash of the text).

    NULL or wordless texts have no words and no hits. Repeated rows each get
    their result, and an empty benchmark or empty table gives zeros or nothing.
    Columns other than doc_id / text and item_id / text are ignored.
    """
    windows = written(benchmark_windows(benchmark, width), "windows")
    rows = find_hits(docs, windows)
    key = ["doc_id", "content"]
    order = Window.partitionBy(*key).orderBy("pos", "size")
    end = F.col("pos") + F.col("size")
    before = F.max(F.when(F.col("pos") >= 0, end)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), end - F.greatest(F.col("pos"), F.coalesce(before, F.lit(0))))
    places = rows.groupBy(*key, "pos", "size").agg(F.first("n").alias("n"), F.max("copies").alias("copies"))
    covered = places.withColumn("new", F.when(F.col("pos") >= 0, new).otherwise(0))
    per_doc = covered.groupBy(*key).agg(
        F.first("n").alias("n"), F.max(F.when(F.col("pos") < 0, F.col("copies"))).alias("copies"),
        F.sum("new").alias("n_hit"))
    named = (rows.where("pos >= 0").select(*key, "window").distinct()
             .join(windows.select("item", "window"), "window").select(*key, "item").distinct()
             .groupBy(*key).agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item")).alias("items")))
    a, b = per_doc.alias("a"), named.alias("b")
    out = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.content").eqNullSafe(F.col("b.content")),
                 "left")
    out = out.select(
        "a.doc_id", "a.content", F.col("n").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.expr(f"n_hit > 0 AND {ONE_IN} * n_hit >= n").alias("contaminated"), "copies")
    return out.select("*", F.explode(F.expr("sequence(1L, copies)")).alias("_copy")).drop("_copy", "copies")


def remove_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without contaminated documents; in the others, the words of
    benchmark windows are cut from the text (with the separators before them)
    and n_chars is set anew. Clean rows come back unchanged."""
    windows = written(benchmark_windows(benchmark, width), "windows")
    places = find_hits(docs, windows).where("pos >= 0")
    spans = (places.groupBy("doc_id", "content")
             .agg(F.collect_set(F.struct("pos", "size")).alias("spans"), F.first("n").alias("n")))
    n_hit = F.expr("size(array_distinct(flatten(transform(spans, v -> sequence(v.pos, v.pos + v.size - 1)))))")
    spans = spans.withColumn("drop", ONE_IN * n_hit >= F.col("n"))
    if places.count() <= MAX_WINDOWS:
        spans = F.broadcast(spans)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("content"),
                       whole_row(docs)).alias("d")
    joined = rows.join(spans.alias("s"), F.col("d.id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.content") == F.col("s.content")),
                       "left").where("drop IS NULL OR NOT drop").select("row", "spans", F.col("row.text").cast("string").alias("text"))
    outside, inside = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]", r"[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
    cut = F.expr(f"concat(array_join(transform(regexp_extract_all(text, '({outside}*{inside}+)', 1), (p, i) -> "
                 "if(exists(spans, v -> i >= v.pos AND i < v.pos + v.size), '', p)), ''), "
                 f"regexp_extract(text, '({outside}*)$', 1))")
    clean = F.col("spans").isNull()
    new = {"text": F.when(clean, F.col("row.text")).otherwise(cut),
           "n_chars": F.when(clean, F.col("row.n_chars") if "n_chars" in docs.columns else None).otherwise(F.length(cut))}
    return joined.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE_SQL = r"""
WITH dw AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS MATERIALIZED (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT item_id, w, least(len(w), 13) AS size, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
        FROM bw WHERE len(w) > 0)),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM dw, (SELECT DISTINCT size FROM items) WHERE len(w) >= size)),
hits AS MATERIALIZED (SELECT doc_id, i, size, item_id FROM places JOIN items USING (size, words)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
