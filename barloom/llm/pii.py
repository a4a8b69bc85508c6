"""Personal data: pattern spans, and information-theoretic sanitisation.

DataFrame operations only. Base spans (e-mail, IP, card, phone) come from
regular expressions; matches and the gaps between them are exploded and their
offsets are running sums, so a text may hold any number of them.

A term discloses an entity when seeing the term says much of what there is to
know about the entity's presence. With document frequencies over all distinct
texts, IC(e) = -log2 p(e) and PMI(t; e) = log2(p(t, e) / (p(t) p(e))); the share
PMI / IC is 1 when the term occurs only with the entity. Terms that stand with an
entity in at least ``support`` distinct texts, anywhere in them, whose share
reaches ``disclosure`` and that stand with it in at least ``confidence`` of their
own texts, are generalised wherever they occur, also in texts that do not name
the entity. (The share alone admits ever weaker terms as the corpus grows.)

Both bounds limit a term's frequency by the entity's, so common words never meet
entities, and entities found in just the same texts count as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import table, whole_row, written

KINDS = ("email", "ip", "card", "phone")
#: Same matches as the plain patterns; runs are entered only at their start, which keeps long runs linear.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Distinct texts in which a term must stand with an entity.
SUPPORT = 3
#: Share of the entity's information that a term may not reach.
DISCLOSURE = 0.85
#: Share of a term's texts that name the entity, from which on the term counts.
CONFIDENCE = 0.75
#: Terms, texts or spans up to this number (about 50 bytes each) are broadcast; beyond, joins shuffle.
MAX_BROADCAST = 500_000
#: One text in so many, step by step, shows which words are too common; all texts are counted for the others.
FIRST_LOOKS = (64, 8)
WORD_GAP = r"[^\p{L}\p{N}]+"


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, content (hash of the text), text; NULL texts are empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("content"),
                       text.alias("text"))


def _digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '')"


VALID = (
    "CASE kind WHEN 'email' THEN true "
    "WHEN 'ip' THEN forall(split(value, '[.]'), p -> length(ltrim('0', p)) <= 3 AND "
    "coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255) "
    f"WHEN 'card' THEN length({_digits('value')}) BETWEEN 12 AND 19 AND luhn_check({_digits('value')}) "
    f"ELSE length({_digits('value')}) BETWEEN 9 AND 15 END")


def base_spans(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, content, kind, start, end, value): valid matches with code point offsets."""
    hints = {"email": "contains(text, '@')", "ip": r"text RLIKE '[0-9][.][0-9]'", "card": "text RLIKE '[0-9]'",
             "phone": "contains(text, '+')"}
    found = [F.when(F.expr(hints[k]), F.struct(
        F.lit(k).alias("kind"), F.expr(f"regexp_extract_all(text, {_sql(PATTERNS[k])}, 0)").alias("values"),
        F.split("text", PATTERNS[k], -1).alias("gaps"))) for k in KINDS]
    rows = _rows(docs).select("doc_id", "content", F.explode(F.array(*found)).alias("f")).where("size(f.values) > 0")
    rows = rows.select("doc_id", "content", "f.kind", F.posexplode(F.expr(
        "transform(f.values, (v, i) -> named_struct('value', v, 'gap', length(f.gaps[i])))")).alias("at", "m"))
    # equal rows have equal matches; one of each is kept before offsets are summed
    rows = rows.groupBy("doc_id", "content", "kind", "at").agg(F.first("m").alias("m"))
    upto = Window.partitionBy("doc_id", "content", "kind").orderBy("at")
    rows = rows.select("*", "m.value", F.sum(F.expr("m.gap + length(m.value)")).over(upto).alias("end"))
    rows = rows.withColumn("start", F.expr("end - length(value)")).where(VALID)
    return rows.select("doc_id", "content", "kind", "start", "end", "value")


def _entity() -> Column:
    return F.when(F.col("kind") == "email", F.lower("value")).when(
        F.col("kind") == "ip", F.col("value")).otherwise(F.expr(_digits("value")))


def _words(texts: DataFrame) -> DataFrame:
    """(content, term) of the distinct words of each text."""
    return texts.select("content", F.explode(F.array_distinct(F.split(F.lower("text"), WORD_GAP))).alias("term")).where("term <> ''")


def disclosing_terms(docs: DataFrame, base: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE,
                     confidence: float = CONFIDENCE) -> DataFrame:
    """(term, kind, share): terms that reveal an entity, with the kind they reveal most.

    All frequencies count distinct texts, however often a row or a text is repeated."""
    rows = _rows(docs)
    texts = rows.groupBy("content").agg(F.count("*").alias("copies"))
    n_texts = texts.count()
    copied = _if_small(written(texts.where("copies > 1").select("content"), "copied"))
    # one row of each text; only texts that occur more than once are grouped
    once = rows.join(copied, "content", "left_anti").select("content", "text").unionByName(
        rows.join(copied, "content", "left_semi").groupBy("content").agg(F.first("text").alias("text")))

    # entities of the very same texts are one class, told by their texts' hashes
    seen = written(base.select("content", F.struct("kind", _entity().alias("value")).alias("entity")).distinct(), "entities")
    n_entity = seen.groupBy("entity").agg(F.count("*").alias("n_e"), F.sum(F.col("content").cast("decimal(38,0)")).alias("s"),
                                          F.bit_xor(F.xxhash64(F.lit(1), "content")).alias("x"))
    n_entity = n_entity.where((F.col("n_e") >= support) & (F.col("n_e") < n_texts)).withColumn("class", F.xxhash64("n_e", "s", "x"))
    n_entity = written(n_entity, "entity-classes")
    classes = n_entity.groupBy("class").agg(F.max("n_e").alias("n_e"), F.max("entity").alias("entity"))
    # n_te is n_e at most, so a term of more texts than this cannot reach either threshold
    least = max(n_texts, 1)
    classes = written(classes.withColumn("most", F.expr(
        f"n_e * least(1 / {confidence}D, pow({least}D / n_e, {1 - disclosure}D)) + 1e-6")), "classes")
    member = seen.join(n_entity.select("entity", "class"), "entity").select("content", "class").distinct()
    member = written(member.join(classes.select("class", "n_e", "most"), "class"), "members")
    carriers = _if_small(written(member.select("content").distinct(), "carriers"))
    with_entity = once.join(carriers, "content", "left_semi")

    # n_c, a term's texts among those, is n_t at most: terms that are spread over them cannot reach the confidence
    frequent = _words(with_entity).groupBy("term").agg(F.count("*").alias("n_c")).where(F.col("n_c") >= support)
    widest = classes.agg(F.max("most")).first()[0] or 0.0
    frequent = _if_small(written(frequent.where(F.col("n_c") <= widest), "frequent"))
    pairs = _words(with_entity).join(frequent, "term").join(member, "content").where("n_c <= most")
    pairs = pairs.groupBy("term", "class").agg(F.count("*").alias("n_te"), F.first("n_c").alias("n_c"), F.first("n_e").alias("n_e"))
    pairs = written(pairs.where((F.col("n_te") >= support) & (F.col("n_te") >= confidence * F.col("n_c"))), "pairs")
    # common words are told by growing shares of the texts: what a share holds of a term is n_t at most
    terms = written(pairs.groupBy("term").agg(F.max("n_te").alias("n_te")), "terms")
    for share_of in FIRST_LOOKS:
        some = _words(once.where(f"pmod(xxhash64(2, content), {share_of}) = 0")).join(_if_small(terms.select("term")), "term", "left_semi")
        terms = written(terms.join(some.groupBy("term").agg(F.count("*").alias("n_some")), "term", "left").where(
            f"n_some IS NULL OR n_te >= {confidence}D * n_some").select("term", "n_te"), "terms")
    terms = _if_small(terms.select("term"))
    n_term = _words(once).join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_t"))
    pairs = pairs.join(n_term, "term")
    share = F.expr(f"log2({n_texts}D * n_te / (n_t * n_e)) / log2({n_texts}D / n_e)")
    scored = pairs.where(F.col("n_te") >= confidence * F.col("n_t")).withColumn("share", share)
    return (scored.where(F.col("share") >= disclosure).join(classes.select("class", "entity"), "class").groupBy("term")
            .agg(F.max("share").alias("share"), F.max_by("entity.kind", F.struct("share", "entity")).alias("kind")))


def term_spans(docs: DataFrame, terms: DataFrame, base: DataFrame) -> DataFrame:
    """(doc_id, content, kind 'term', start, end) of every occurrence of a disclosing
    term in any text, outside base spans."""
    terms = _if_small(terms.select("term"))
    rows = _rows(docs)
    hit = rows.select("doc_id", "content", F.explode(F.array_distinct(F.split(F.lower("text"), WORD_GAP))).alias("term")).join(
        terms, "term", "left_semi")
    # a text's own terms (letters and digits only) are looked for in one pass over it
    hit = hit.groupBy("doc_id", "content").agg(F.array_join(F.sort_array(F.collect_set("term")), "|").alias("any"))
    hit = _if_small(written(hit, "term-docs")).select(F.col("doc_id").alias("h"), F.col("content").alias("hc"), "any")
    with_terms = rows.join(hit, F.col("content").eqNullSafe(F.col("hc")) & F.col("doc_id").eqNullSafe(F.col("h")))
    with_terms = with_terms.withColumn("pattern", F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), "any", F.lit(r")(?![\p{L}\p{N}])")))
    matches = with_terms.select("doc_id", "content", F.expr("regexp_extract_all(text, pattern, 0)").alias("values"),
                                F.expr("split(text, pattern, -1)").alias("gaps"))
    matches = matches.select("doc_id", "content", F.posexplode(F.expr(
        "transform(values, (v, i) -> named_struct('value', v, 'gap', length(gaps[i])))")).alias("at", "m"))
    matches = matches.groupBy("doc_id", "content", "at").agg(F.first("m").alias("m"))
    upto = Window.partitionBy("doc_id", "content").orderBy("at")
    at = matches.select("doc_id", "content", "m.value", F.sum(F.expr("m.gap + length(m.value)")).over(upto).alias("end"))
    found = at.withColumn("term", F.lower("value")).join(terms, "term", "left_semi").select(
        "doc_id", "content", F.lit("term").alias("kind"), F.expr("end - length(value)").alias("start"), "end")
    a, b = found.alias("a"), base.select("doc_id", "content", "start", "end").alias("b")
    return a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.content") == F.col("b.content"))
                  & F.expr("a.start < b.end AND b.start < a.end"), "left_anti")


def find_personal_data(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE,
                       confidence: float = CONFIDENCE) -> DataFrame:
    """All spans: doc_id, content, kind (email, ip, card, phone or term), start, end.

    Repeated rows give their spans once; rows are told apart by doc_id (NULL is
    an id of its own) and text. NULL and empty texts, empty tables and texts
    without matches give no spans; other columns are ignored.
    """
    base = written(base_spans(docs), "base-spans")
    terms = written(disclosing_terms(docs, base, support, disclosure, confidence), "disclosing")
    spans = base.select("doc_id", "content", "kind", "start", "end").unionByName(term_spans(docs, terms, base))
    return written(spans, "spans")


def _ordered(spans: DataFrame) -> DataFrame:
    """Per document the array ``all`` of (start, rank, end, kind), in order."""
    rank = F.expr("array_position(array('email', 'ip', 'card', 'phone', 'term'), kind)")
    return spans.groupBy("doc_id", "content").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("all"))


def _beside(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every row of ``docs`` as ``row``, with its text (NULL is empty) and its spans (``all``, NULL if none)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("content"), text.alias("text"),
                       whole_row(docs)).alias("d")
    by_doc = _ordered(spans)
    by_doc = (F.broadcast(by_doc) if spans.count() <= MAX_BROADCAST else by_doc).alias("s")
    return rows.join(by_doc, F.col("d.id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.content") == F.col("s.content")),
                     "left").select("row", "id", "text", "all")


def report(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts by kind, the digest of the base spans, and all spans."""
    rows = _beside(docs.select("doc_id", "text"), spans).withColumnRenamed("id", "doc_id")
    text = "transform({}, s -> concat(s.kind, ':', s.start, ':', s.end))"
    named = "coalesce(all, CAST(array() AS array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>))"
    counts = [F.expr(f"CAST(size(filter(all, s -> s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in KINDS]
    rows = rows.withColumn("all", F.expr(named))
    base = text.format("filter(all, s -> s.kind <> 'term')")
    return rows.select("doc_id", *counts, F.sha2(F.expr(f"array_join({base}, ',')"), 256).alias("base_sha256"),
                       F.expr(f"array_join({text.format('all')}, ',')").alias("spans"))


def sanitise(docs: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """``docs`` with every span generalised to its kind in brackets, n_chars set
    anew. Overlapping spans become one, named by the first. Rows without spans
    are unchanged."""
    rows = _beside(docs, find_personal_data(docs) if spans is None else spans)
    merged = F.expr(
        "aggregate(all, CAST(array() AS array<struct<start:bigint,end:bigint,kind:string>>), (m, s) -> "
        "if(size(m) > 0 AND s.start < element_at(m, -1).end, concat(slice(m, 1, size(m) - 1), array(named_struct("
        "'start', element_at(m, -1).start, 'end', greatest(s.end, element_at(m, -1).end), 'kind', element_at(m, -1).kind))), "
        "concat(m, array(named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))))")
    rows = rows.withColumn("_m", merged)
    new = F.expr(
        "concat(array_join(transform(_m, (s, i) -> concat(substring(text, if(i = 0, 0, _m[i - 1].end) + 1, "
        "s.start - if(i = 0, 0, _m[i - 1].end)), '[', upper(s.kind), ']')), ''), substring(text, element_at(_m, -1).end + 1))")
    clean = F.col("all").isNull()
    fields = {"text": F.when(clean, F.col("row.text")).otherwise(new),
              "n_chars": F.when(clean, F.col("row.n_chars") if "n_chars" in docs.columns else None).otherwise(F.length(new))}
    return rows.select(*[fields.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return report(docs, find_personal_data(docs))


_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ORACLE_SQL = r"""
WITH t AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS (""" + " UNION ALL ".join(
    f"SELECT doc_id, text, '{k}' AS kind, {i} AS rank, regexp_extract_all(text, '{p}') AS found, "
    f"regexp_split_to_array(text, '{p}') AS gaps FROM t WHERE regexp_matches(text, '{p}')"
    for i, (k, p) in enumerate(_PLAIN.items())) + r"""),
m AS (SELECT *, generate_subscripts(found, 1) AS i, unnest(found) AS v FROM f),
e AS (SELECT *, SUM(length(gaps[i]) + length(v)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop,
  regexp_replace(v, '[^0-9]', '', 'g') AS digits FROM m),
base AS MATERIALIZED (
  SELECT doc_id, text, kind, rank, CAST(stop - length(v) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop,
    CASE kind WHEN 'email' THEN lower(v) WHEN 'ip' THEN v ELSE digits END AS entity
  FROM e
  WHERE CASE kind WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0
    WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda j:
      CASE WHEN j % 2 = 1 THEN CAST(digits[-j] AS INT) ELSE CAST(digits[-j] AS INT) * 2
           - CASE WHEN CAST(digits[-j] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0
    ELSE length(digits) BETWEEN 9 AND 15 END),
texts AS MATERIALIZED (SELECT DISTINCT text FROM t),
n_e AS MATERIALIZED (SELECT kind, entity, COUNT(DISTINCT text) AS n_e FROM base GROUP BY ALL
  HAVING COUNT(DISTINCT text) >= 3 AND COUNT(DISTINCT text) < (SELECT COUNT(*) FROM texts)),
tw AS MATERIALIZED (
  SELECT text, unnest(list_distinct(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'))) AS term FROM texts),
n_t AS MATERIALIZED (SELECT term, COUNT(*) AS n_t FROM tw WHERE term <> '' GROUP BY term),
pairs AS MATERIALIZED (
  SELECT term, kind, entity, ANY_VALUE(n_e) AS n_e, COUNT(*) AS n_te
  FROM (SELECT DISTINCT text, kind, entity, n_e FROM base JOIN n_e USING (kind, entity)) s JOIN tw USING (text)
  GROUP BY term, kind, entity HAVING COUNT(*) >= 3),
terms AS (
  SELECT DISTINCT term FROM pairs JOIN n_t USING (term), (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM texts) c
  WHERE n_te >= 0.75 * n_t AND log2(n * n_te / (n_t * n_e)) / log2(n / n_e) >= 0.85),
words AS (SELECT doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS piece
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\p{L}\p{N}]*[\p{L}\p{N}]+') AS p FROM t)),
ends AS (SELECT doc_id, regexp_replace(piece, '^[^\p{L}\p{N}]+', '') AS word,
  SUM(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM words),
found AS (SELECT doc_id, CAST(stop - length(word) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM ends
  WHERE lower(word) IN (SELECT term FROM terms)),
spans AS (
  SELECT doc_id, kind, rank, start, stop FROM base
  UNION ALL SELECT doc_id, 'term', 4, start, stop FROM found x
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND x.start < b.stop AND b.start < x.stop)),
told AS (
  SELECT doc_id, COUNT_IF(kind = 'email') AS n_email, COUNT_IF(kind = 'ip') AS n_ip, COUNT_IF(kind = 'card') AS n_card,
    COUNT_IF(kind = 'phone') AS n_phone,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE kind <> 'term') AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n_email, 0) AS BIGINT) AS n_email, CAST(coalesce(n_ip, 0) AS BIGINT) AS n_ip,
  CAST(coalesce(n_card, 0) AS BIGINT) AS n_card, CAST(coalesce(n_phone, 0) AS BIGINT) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN told ON told.doc_id = t.doc_id
"""
