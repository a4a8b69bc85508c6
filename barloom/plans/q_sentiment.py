"""Catalogue entries for 2.13 (news sentiment)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.columns import r4, r4_sql
from barloom.operators import sentiment as sen
from barloom.plans.catalog import oracle_cte, register

c_ = F.col
R3 = "FLOOR(({x}) * 1e3 + 0.501) / 1e3"

oracle_cte("o_dedup", ("articles",), """
SELECT * EXCLUDE (rn) FROM (
  SELECT a.*, ROW_NUMBER() OVER (PARTITION BY published, title_key ORDER BY seq) AS rn
  FROM (SELECT *, SUBSTRING(REGEXP_REPLACE(LOWER(COALESCE(title, '')), '[^a-z0-9]', '', 'g'), 1, 80) AS title_key
        FROM articles) a
  WHERE title_key <> '') q
WHERE rn = 1""")

oracle_cte("o_text", ("o_dedup",), """
SELECT *, COALESCE(LENGTH(TRIM(text)), 0) < 10 AS too_short FROM (
  SELECT *, CASE WHEN COALESCE(LENGTH(summary), 0) > 0 THEN title || '. ' || SUBSTRING(summary, 1, 200)
                 ELSE title END AS text
  FROM o_dedup) q""")

def _listed(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


oracle_cte("o_scores", ("o_text", "lexicon"), f"""
WITH p AS (SELECT seq, REGEXP_SPLIT_TO_ARRAY(REPLACE(LOWER(text), '’', CHR(39)), '[^\\p{{L}}' || CHR(39) || ']+') AS a FROM o_text WHERE NOT too_short),
t AS (SELECT * FROM (SELECT seq, GENERATE_SUBSCRIPTS(a, 1) AS pos, UNNEST(a) AS token FROM p) x WHERE token <> ''),
c AS (SELECT t.seq, t.pos, l.weight AS w,
  CASE WHEN t.token IN {_listed(sen.BOOSTERS)} THEN 293e-3 WHEN t.token IN {_listed(sen.DAMPENERS)} THEN -293e-3 ELSE 0e0 END AS b,
  t.token IN {_listed(sen.NEGATIONS)} OR t.token LIKE '%n' || CHR(39) || 't' AS neg,
  MIN(CASE WHEN t.token = 'but' THEN t.pos END) OVER (PARTITION BY t.seq) AS but
  FROM t LEFT JOIN lexicon l ON l.token = t.token),
h AS (SELECT seq, pos, but, w,
  COALESCE(LAG(b, 1) OVER o, 0e0) + 95e-2 * COALESCE(LAG(b, 2) OVER o, 0e0) + 9e-1 * COALESCE(LAG(b, 3) OVER o, 0e0) AS raised,
  COALESCE(LAG(neg, 1) OVER o, FALSE) OR COALESCE(LAG(neg, 2) OVER o, FALSE) OR COALESCE(LAG(neg, 3) OVER o, FALSE) AS turned
  FROM c WINDOW o AS (PARTITION BY seq ORDER BY pos)),
s AS (SELECT seq, SUM((w + SIGN(w) * raised) * CASE WHEN turned THEN -74e-2 ELSE 1e0 END
  * CASE WHEN pos < but THEN 5e-1 WHEN pos > but THEN 15e-1 ELSE 1e0 END) AS s FROM h WHERE w IS NOT NULL GROUP BY seq)
SELECT o.*, CASE WHEN o.too_short THEN 0e0 ELSE COALESCE(s.s, 0e0) / SQRT(COALESCE(s.s, 0e0) * COALESCE(s.s, 0e0) + 15e0)
            END AS lexicon_score
FROM o_text o LEFT JOIN s ON s.seq = o.seq""")

oracle_cte("o_routed", ("o_scores", "sector_keywords"), """
WITH sc AS (SELECT *, lexicon_score AS combined_score,
                   CASE WHEN lexicon_score > 15e-2 THEN 'positive' WHEN lexicon_score < -15e-2 THEN 'negative'
                        ELSE 'neutral' END AS label FROM o_scores),
m AS (SELECT DISTINCT s.seq, k.sector FROM sc s JOIN sector_keywords k
      ON CONTAINS(LOWER(CONCAT_WS(' ', COALESCE(s.title, ''), COALESCE(s.summary, ''))), LOWER(k.keyword))),
r AS (
  SELECT seq, '_MARKET' AS bucket FROM sc WHERE is_market
  UNION ALL SELECT seq, sector_hint FROM sc WHERE NOT is_market AND sector_hint IS NOT NULL
  UNION ALL SELECT m.seq, m.sector FROM m JOIN sc ON sc.seq = m.seq WHERE NOT sc.is_market AND sc.sector_hint IS NULL
  UNION ALL SELECT seq, '_MARKET' FROM sc WHERE NOT is_market AND sector_hint IS NULL
                                         AND seq NOT IN (SELECT seq FROM m))
SELECT sc.*, r.bucket FROM sc JOIN r ON r.seq = sc.seq""")

oracle_cte("o_sector_sent", ("o_routed", "articles", "sector_keywords"), f"""
WITH g AS (
  SELECT published AS trading_date, bucket AS sector, AVG(combined_score) AS cs, AVG(lexicon_score) AS vs,
         COUNT(*) AS n, COUNT_IF(label = 'positive') AS pos, COUNT_IF(label = 'negative') AS neg,
         COUNT_IF(label = 'neutral') AS neu, COUNT(DISTINCT COALESCE(source, '')) AS src_n,
         LIST_SORT(LIST_DISTINCT(LIST(COALESCE(source, '')))) AS srcs
  FROM o_routed GROUP BY published, bucket),
mk AS (SELECT trading_date, {r4_sql('cs')} AS market_sentiment_score, CAST(n AS INT) AS market_news_count
       FROM g WHERE sector = '_MARKET'),
grid AS (SELECT d.published AS trading_date, s.sector FROM (SELECT DISTINCT published FROM articles) d,
         (SELECT DISTINCT sector FROM sector_keywords) s),
x AS (SELECT grid.trading_date, grid.sector, g.cs, g.vs, COALESCE(g.n, 0) AS n, g.pos, g.neg, g.neu, g.src_n, g.srcs,
             mk.market_sentiment_score, mk.market_news_count
      FROM grid LEFT JOIN g ON g.trading_date = grid.trading_date AND g.sector = grid.sector
      LEFT JOIN mk ON mk.trading_date = grid.trading_date),
a AS (
  SELECT trading_date, sector,
         CASE WHEN n > 0 THEN {r4_sql('cs')} ELSE 0e0 END AS sentiment_score,
         CASE WHEN n > 0 THEN {r4_sql('vs')} ELSE 0e0 END AS vader_score, 0e0 AS finbert_score,
         CASE WHEN n > 0 THEN {R3.format(x='pos / n')} ELSE 0e0 END AS positive_ratio,
         CASE WHEN n > 0 THEN {R3.format(x='neg / n')} ELSE 0e0 END AS negative_ratio,
         CASE WHEN n > 0 THEN {R3.format(x='neu / n')} ELSE 0e0 END AS neutral_ratio,
         CAST(n AS INT) AS news_count, CAST(COALESCE(src_n, 0) AS INT) AS source_count,
         LEAST(n / 1e1, 1e0) AS confidence, COALESCE(market_sentiment_score, 0e0) AS market_sentiment_score,
         COALESCE(market_news_count, 0) AS market_news_count,
         COALESCE(SUBSTRING(ARRAY_TO_STRING(LIST_SLICE(srcs, 1, 10), ', '), 1, 500), '') AS sources
  FROM x),
d AS (SELECT a.*, DATEDIFF('day', DATE '1970-01-01', trading_date) AS dn FROM a)
SELECT * EXCLUDE (dn),
  sentiment_score - COALESCE(LAST_VALUE(sentiment_score) OVER (PARTITION BY sector ORDER BY dn
      RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING), 0e0) AS sentiment_momentum_3d,
  sentiment_score - COALESCE(LAST_VALUE(sentiment_score) OVER (PARTITION BY sector ORDER BY dn
      RANGE BETWEEN 10 PRECEDING AND 1 PRECEDING), 0e0) AS sentiment_momentum_7d,
  CASE WHEN COALESCE(STDDEV_SAMP(sentiment_score) OVER w30 > 1e-2, FALSE)
       THEN (sentiment_score - AVG(sentiment_score) OVER w30) / STDDEV_SAMP(sentiment_score) OVER w30
       ELSE 0e0 END AS sentiment_vs_avg_30d
FROM d WINDOW w30 AS (PARTITION BY sector ORDER BY dn RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)""")


def _scored(fx):
    """The scores' tokens, the keywords and the routed rows read the deduplicated articles, written once."""
    a = fx.derived("scoring_text", lambda f: sen.scoring_text(sen.dedup_titles(f.articles)))
    return sen.lexicon_scores(a, fx.lexicon)


def _routed(fx):
    return sen.route(sen.match_sectors(_scored(fx), fx.sector_keywords))


def sector_sentiment(fx):
    return fx.derived("sector_sentiment", lambda f: sen.sentiment_table(f.articles, f.lexicon, f.sector_keywords))


@register("articles_union", """
SELECT seq, source, sector_hint, COALESCE(is_market, FALSE) AS is_market FROM (
  SELECT seq, title, source, sector_hint FROM articles WHERE sector_hint IS NOT NULL AND NOT is_market
  UNION ALL BY NAME SELECT seq, title, source, is_market FROM articles WHERE is_market
  UNION ALL BY NAME SELECT seq, title, source FROM articles WHERE sector_hint IS NULL AND NOT is_market) u""",
          ctes=("articles",))
def q_union(fx):
    a = fx.articles
    feeds = [a.filter(c_("sector_hint").isNotNull() & ~c_("is_market")).select("seq", "title", "source", "sector_hint"),
             a.filter(c_("is_market")).select("seq", "title", "source", "is_market"),
             a.filter(c_("sector_hint").isNull() & ~c_("is_market")).select("seq", "title", "source")]
    return sen.union_feeds(feeds).select("seq", "source", "sector_hint", "is_market")


@register("articles_dedup", "SELECT published, title_key, seq FROM o_dedup", ctes=("o_dedup",))
def q_dedup(fx):
    return sen.dedup_titles(fx.articles).select("published", "title_key", "seq")


@register("article_text", "SELECT seq, text, too_short FROM o_text", ctes=("o_text",))
def q_text(fx):
    return sen.scoring_text(sen.dedup_titles(fx.articles)).select("seq", "text", "too_short")


@register("article_sentiment", f"""
SELECT seq, {r4_sql('lexicon_score')} AS combined_score,
       CASE WHEN lexicon_score > 15e-2 THEN 'positive' WHEN lexicon_score < -15e-2 THEN 'negative'
            ELSE 'neutral' END AS label
FROM o_scores""", ctes=("o_scores",))
def q_article_sentiment(fx):
    return _scored(fx).select("seq", r4("combined_score").alias("combined_score"), "label")


@register("article_sectors", """
SELECT DISTINCT s.seq, k.sector FROM o_dedup s JOIN sector_keywords k
  ON CONTAINS(LOWER(CONCAT_WS(' ', COALESCE(s.title, ''), COALESCE(s.summary, ''))), LOWER(k.keyword))""",
          ctes=("o_dedup", "sector_keywords"))
def q_article_sectors(fx):
    return sen.keyword_matches(sen.dedup_titles(fx.articles), fx.sector_keywords)


@register("article_routing", "SELECT seq, bucket FROM o_routed", ctes=("o_routed",))
def q_routing(fx):
    return _routed(fx).select("seq", "bucket")


_SENT_D = ("sentiment_score", "vader_score", "finbert_score", "positive_ratio", "negative_ratio", "neutral_ratio",
           "confidence", "market_sentiment_score")


@register("sector_sentiment", f"""
SELECT trading_date, sector, {', '.join(f'{r4_sql(c)} AS {c}' for c in _SENT_D)}, news_count, source_count,
       market_news_count, sources
FROM o_sector_sent""", ctes=("o_sector_sent",))
def q_sector_sentiment(fx):
    t = sector_sentiment(fx)
    return t.select("trading_date", "sector", *[r4(c).alias(c) for c in _SENT_D], "news_count", "source_count",
                    "market_news_count", "sources")


@register("sentiment_momentum", f"""
SELECT trading_date, sector, {r4_sql('sentiment_momentum_3d')} AS sentiment_momentum_3d,
       {r4_sql('sentiment_momentum_7d')} AS sentiment_momentum_7d FROM o_sector_sent""", ctes=("o_sector_sent",))
def q_momentum(fx):
    t = sector_sentiment(fx)
    return t.select("trading_date", "sector", r4("sentiment_momentum_3d").alias("sentiment_momentum_3d"),
                    r4("sentiment_momentum_7d").alias("sentiment_momentum_7d"))


@register("sentiment_zscore", f"""
SELECT trading_date, sector, {r4_sql('sentiment_vs_avg_30d')} AS sentiment_vs_avg_30d FROM o_sector_sent""",
          ctes=("o_sector_sent",))
def q_zscore(fx):
    t = sector_sentiment(fx)
    return t.select("trading_date", "sector", r4("sentiment_vs_avg_30d").alias("sentiment_vs_avg_30d"))


@register("backfill_dates", """
SELECT trading_date FROM (
  SELECT CAST(d AS DATE) AS trading_date FROM (
    SELECT UNNEST(generate_series((SELECT MAX(published) FROM articles) - INTERVAL 27 DAY,
                                  CAST((SELECT MAX(published) FROM articles) AS TIMESTAMP), INTERVAL 1 DAY)) AS d) q
  WHERE ISODOW(CAST(d AS DATE)) <= 5
  ORDER BY 1 DESC LIMIT 10) z""", ctes=("articles",))
def q_backfill(fx):
    """The last 10 weekdays up to the latest article date."""
    last = fx.articles.agg(F.max("published").alias("asof"))
    span = last.select(F.explode(F.sequence(F.date_sub("asof", 27), c_("asof"))).alias("trading_date"))
    span = span.filter(F.weekday("trading_date") < 5)
    from pyspark.sql import Window
    w = Window.orderBy(c_("trading_date").desc())
    return span.withColumn("_r", F.row_number().over(w)).filter(c_("_r") <= 10).drop("_r")
