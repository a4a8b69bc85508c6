"""News sentiment (2.13) as one job over any number of dates.

articles -> per-date title dedup (window) -> scoring text -> lexicon score
(positioned tokens x broadcast lexicon, with negation and booster words looked up
behind each hit) -> sector routing (few keywords are looked for in each text; many by
q-grams of texts x q-gram index of the keywords, an equi-join, then verified) -> per (date, sector)
aggregates for every configured sector -> momentum and 30-day z-score as range
windows per sector.

The reference scores text with a rule lexicon plus an optional transformer
model; here the lexicon score uses the published normaliser ``s / sqrt(s^2 +
15)`` and a model score can be supplied as a column (``model_score``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.sizing import checked_broadcast
from barloom.session import stored

c_ = F.col
MARKET = "_MARKET"
# FIXED VALUES: published constants of the rule-based score: a booster's step and its fading over the
# three words before a hit, the factor of a negation there, and the weights around the first "but"
BOOST, FADE, NEGATED, BEFORE_BUT, AFTER_BUT = 0.293, (1.0, 0.95, 0.9), -0.74, 0.5, 1.5
BOOSTERS = ("absolutely", "completely", "considerably", "deeply", "enormously", "especially", "exceptionally", "extremely",
            "greatly", "highly", "hugely", "incredibly", "particularly", "really", "remarkably", "sharply", "significantly",
            "strongly", "substantially", "totally", "very")
DAMPENERS = ("almost", "barely", "hardly", "marginally", "moderately", "partly", "scarcely", "slightly", "somewhat")
NEGATIONS = ("cannot", "neither", "never", "no", "nobody", "none", "nor", "not", "nothing", "nowhere", "without")
TOKEN_GAP = r"[^\p{L}']+"
#: Characters of the grams by which keywords are found in texts.
GRAM = 4
#: Up to so many keywords are looked for in each text one by one, which costs less than its grams.
FEW_KEYWORDS = 256


def r3(x) -> Column:
    return (F.floor(x * F.lit(1e3) + F.lit(0.501)) / F.lit(1e3)).cast("double")


def r4(x) -> Column:
    return (F.floor(x * F.lit(1e4) + F.lit(0.501)) / F.lit(1e4)).cast("double")


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    """Union article feeds by name; missing hint/market columns become NULL,
    a missing market flag counts as false."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if "is_market" not in out.columns:
        out = out.withColumn("is_market", F.lit(False))
    if "sector_hint" not in out.columns:
        out = out.withColumn("sector_hint", F.lit(None).cast("string"))
    return out.withColumn("is_market", F.coalesce(c_("is_market"), F.lit(False)))


def title_key(title: Column) -> Column:
    """lower, keep [a-z0-9], first 80 characters."""
    return F.substring(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), "[^a-z0-9]", ""), 1, 80)


def dedup_titles(articles: DataFrame, date_col: str = "published", order_col: str = "seq") -> DataFrame:
    """First article per (date, title key); empty keys dropped. A ``min_by``
    aggregate: copies of one title combine map-side, so a title repeated
    millions of times never lands whole in one task."""
    a = articles.withColumn("title_key", title_key(c_("title"))).filter(c_("title_key") != "")
    rest = [c for c in a.columns if c not in (date_col, "title_key")]
    g = a.groupBy(date_col, "title_key").agg(F.min_by(F.struct(*rest), c_(order_col)).alias("_first"))
    return g.select(*[c_(f"_first.{c}").alias(c) if c in rest else c_(c) for c in a.columns])


def scoring_text(articles: DataFrame) -> DataFrame:
    """Title + '. ' + first 200 chars of a non-empty summary."""
    summ = c_("summary")
    text = F.when(F.coalesce(F.length(summ), F.lit(0)) > 0,
                  F.concat(c_("title"), F.lit(". "), F.substring(summ, 1, 200))).otherwise(c_("title"))
    return articles.withColumn("text", text).withColumn(
        "too_short", F.coalesce(F.length(F.trim(c_("text"))), F.lit(0)) < 10)


def token_scores(texts: DataFrame, lexicon: DataFrame, key: str = "seq") -> DataFrame:
    """(key, pos, token, score) of the lexicon words of each ``text``, in context.

    A booster (dampener) among the three words before raises (lowers) the word's weight, less
    the further away; a negation there (a listed word, or one that ends in n't) turns it round;
    words before the first "but" count half, words after it one and a half times."""
    tokens = texts.select(key, F.posexplode(F.split(F.regexp_replace(F.lower(c_("text")), "’", "'"), TOKEN_GAP)).alias("pos", "token"))
    tokens = tokens.where("token <> ''").join(F.broadcast(lexicon.select("token", "weight")), "token", "left")
    step = F.when(c_("token").isin(*BOOSTERS), F.lit(BOOST)).when(c_("token").isin(*DAMPENERS), F.lit(-BOOST)).otherwise(F.lit(0.0))
    negates = c_("token").isin(*NEGATIONS) | c_("token").endswith("n't")
    w = Window.partitionBy(key).orderBy("pos")
    raised, turned = F.lit(0.0), F.lit(False)
    for k, fade in enumerate(FADE, 1):
        raised = raised + F.coalesce(F.lag("_step", k).over(w), F.lit(0.0)) * F.lit(fade)
        turned = turned | F.coalesce(F.lag("_neg", k).over(w), F.lit(False))
    first_but = F.min(F.when(c_("token") == "but", c_("pos"))).over(Window.partitionBy(key))
    tokens = tokens.withColumn("_step", step).withColumn("_neg", negates).select(
        key, "pos", "token", "weight", raised.alias("_raised"), turned.alias("_turned"), first_but.alias("_but"))
    side = F.when(c_("pos") < c_("_but"), F.lit(BEFORE_BUT)).when(c_("pos") > c_("_but"), F.lit(AFTER_BUT)).otherwise(F.lit(1.0))
    score = (c_("weight") + F.signum("weight") * c_("_raised")) * F.when(c_("_turned"), F.lit(NEGATED)).otherwise(F.lit(1.0)) * side
    return tokens.where("weight IS NOT NULL").select(key, "pos", "token", score.alias("score"))


def lexicon_scores(articles: DataFrame, lexicon: DataFrame, key: str = "seq",
                   model_weight: float = 0.6) -> DataFrame:
    """Per article lexicon compound, optional model score, combined score
    and label. ``lexicon`` is a bounded word list (broadcast)."""
    hits = token_scores(articles.filter(~c_("too_short")).select(key, "text"), lexicon, key)
    sums = hits.groupBy(key).agg(F.sum("score").alias("_s"))
    a = articles.join(sums, key, "left")
    s = F.coalesce(c_("_s"), F.lit(0.0))
    compound = F.when(c_("too_short"), F.lit(0.0)).otherwise(s / F.sqrt(s * s + F.lit(15.0)))
    a = a.withColumn("lexicon_score", compound).drop("_s")
    if "model_score" in a.columns:
        combined = F.when(c_("too_short"), F.lit(0.0)).otherwise(
            (1 - model_weight) * c_("lexicon_score") + model_weight * F.coalesce(c_("model_score"), F.lit(0.0)))
    else:
        combined = c_("lexicon_score")
    a = a.withColumn("combined_score", combined)
    label = (F.when(c_("combined_score") > 0.15, F.lit("positive"))
             .when(c_("combined_score") < -0.15, F.lit("negative")).otherwise(F.lit("neutral")))
    return a.withColumn("label", label)


def _grams(text: Column, size: int) -> Column:
    """Distinct substrings of ``size`` characters, in one pass over the text; a shorter text has none."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def keyword_index(keywords: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, keyword, sector): every keyword under the one of its grams that is rarest in ``grams`` (gram,
    n_texts), or under itself if it is shorter than a gram."""
    words = keywords.select(F.lower("keyword").alias("keyword"), "sector").where("keyword <> ''").distinct()
    parts = words.select("keyword", "sector", F.explode(F.when(F.length("keyword") < GRAM, F.array("keyword")).otherwise(
        _grams(c_("keyword"), GRAM))).alias("gram"))
    counted = parts.join(grams, "gram", "left").withColumn("n_texts", F.coalesce("n_texts", F.lit(0)))
    return counted.groupBy("keyword", "sector").agg(F.min(F.struct("n_texts", "gram")).alias("m")).select(
        c_("m.gram").alias("gram"), "keyword", "sector")


def keyword_matches(articles: DataFrame, keywords: DataFrame, key: str = "seq", few: int = FEW_KEYWORDS) -> DataFrame:
    """(key, sector) where lower(title + ' ' + summary) contains any keyword of the sector (empty keywords
    match nothing). Up to ``few`` keywords are looked for in each text, in one pass over the texts. Of more, the
    texts' grams meet the keyword index in one hash join, and only those candidates are tested, so that the work
    does not grow with the number of keywords."""
    text = F.lower(F.concat_ws(" ", F.coalesce(c_("title"), F.lit("")), F.coalesce(c_("summary"), F.lit(""))))
    listed = keywords.select(F.lower("keyword").alias("keyword"), "sector").where("keyword <> ''").distinct()
    if listed.limit(few + 1).count() <= few:
        one = listed.agg(F.collect_list(F.struct("keyword", "sector")).alias("_words"))       # at most ``few`` words
        inside = F.filter("_words", lambda w: F.contains(c_("_text"), w["keyword"]))
        found = articles.where(c_(key).isNotNull()).select(key, text.alias("_text")).crossJoin(F.broadcast(one)).select(key, F.explode(inside["sector"]).alias("sector"))
        return found.distinct()
    texts = stored(articles.select(key, text.alias("_text")), "texts")
    words = checked_broadcast(keywords.select("keyword", "sector"))
    short = {r[0] for r in keywords.where((F.length("keyword") < GRAM) & (F.length("keyword") > 0)).select(
        F.length("keyword")).distinct().collect()}         # fewer than GRAM lengths
    grams = [_grams(c_("_text"), size) for size in sorted({*short, GRAM})]
    grams = texts.select(key, F.explode(F.concat(*grams)).alias("gram"))
    wanted = words.select(F.explode(F.when(F.length("keyword") < GRAM, F.array(F.lower("keyword"))).otherwise(
        _grams(F.lower("keyword"), GRAM))).alias("gram")).distinct()
    counts = grams.join(checked_broadcast(wanted), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n_texts"))
    index = checked_broadcast(keyword_index(words, counts))
    candidates = grams.join(index, "gram").select(key, "keyword", "sector").distinct()
    found = candidates.join(texts, key).where(F.expr("instr(_text, keyword) > 0"))
    return found.select(key, "sector").distinct()


def match_sectors(articles: DataFrame, keywords: DataFrame, key: str = "seq") -> DataFrame:
    """``articles`` with ``matched_sectors`` (sorted; empty if none)."""
    found = keyword_matches(articles, keywords, key).groupBy(key).agg(F.sort_array(F.collect_set("sector")).alias("matched_sectors"))
    out = articles.join(found, key, "left")
    return out.withColumn("matched_sectors", F.coalesce("matched_sectors", F.array().cast("array<string>")))


def route(articles: DataFrame) -> DataFrame:
    """Market flag, then hint, then matched sectors, else the market bucket."""
    bucket = (F.when(c_("is_market"), F.array(F.lit(MARKET)))
              .when(c_("sector_hint").isNotNull(), F.array(c_("sector_hint")))
              .when(F.size("matched_sectors") > 0, c_("matched_sectors"))
              .otherwise(F.array(F.lit(MARKET))))
    return articles.withColumn("bucket", F.explode(bucket))


def sector_aggregate(routed: DataFrame, sectors: list[str], dates: DataFrame,
                     date_col: str = "published") -> DataFrame:
    """One row per (date, configured sector); neutral zeros without
    articles; market score of the date on every row."""
    g = routed.groupBy(c_(date_col).alias("trading_date"), c_("bucket").alias("sector")).agg(
        F.avg("combined_score").alias("_cs"), F.avg("lexicon_score").alias("_vs"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if(c_("label") == "positive").alias("_pos"), F.count_if(c_("label") == "negative").alias("_neg"),
        F.count_if(c_("label") == "neutral").alias("_neu"),
        F.countDistinct(F.coalesce(c_("source"), F.lit(""))).alias("_src_n"),
        F.array_sort(F.collect_set(F.coalesce(c_("source"), F.lit("")))).alias("_srcs"))
    market = g.filter(c_("sector") == MARKET).select(
        "trading_date", r4(c_("_cs")).alias("market_sentiment_score"),
        c_("_n").cast("int").alias("market_news_count"))
    grid = dates.select(c_(date_col).alias("trading_date")).distinct().select(
        "trading_date", F.explode(F.array(*[F.lit(x) for x in sorted(set(sectors))])).alias("sector"))
    x = grid.join(g, ["trading_date", "sector"], "left").join(market, "trading_date", "left")
    n = F.coalesce(c_("_n"), F.lit(0))
    has = n > 0
    return x.select(
        "trading_date", "sector",
        F.when(has, r4(c_("_cs"))).otherwise(F.lit(0.0)).alias("sentiment_score"),
        F.when(has, r4(c_("_vs"))).otherwise(F.lit(0.0)).alias("vader_score"),
        F.lit(0.0).alias("finbert_score"),
        F.when(has, r3(c_("_pos") / n)).otherwise(F.lit(0.0)).alias("positive_ratio"),
        F.when(has, r3(c_("_neg") / n)).otherwise(F.lit(0.0)).alias("negative_ratio"),
        F.when(has, r3(c_("_neu") / n)).otherwise(F.lit(0.0)).alias("neutral_ratio"),
        n.cast("int").alias("news_count"),
        F.coalesce(c_("_src_n"), F.lit(0)).cast("int").alias("source_count"),
        F.least(n / 10.0, F.lit(1.0)).alias("confidence"),
        F.coalesce(c_("market_sentiment_score"), F.lit(0.0)).alias("market_sentiment_score"),
        F.coalesce(c_("market_news_count"), F.lit(0)).alias("market_news_count"),
        F.coalesce(F.substring(F.array_join(F.slice(c_("_srcs"), 1, 10), ", "), 1, 500), F.lit(""))
        .alias("sources"),
    )


def momentum_and_zscore(table: DataFrame) -> DataFrame:
    """N10 / N11 (C9, C10): latest prior score within 5 / 10 calendar days and
    the z-score against the prior 30 days, per sector (range windows on the
    day number; the sentiment table is bounded by dates x sectors)."""
    day = F.datediff(c_("trading_date"), F.lit("1970-01-01").cast("date"))
    t = table.withColumn("_day", day)
    w = Window.partitionBy("sector").orderBy("_day")
    prev5 = F.last("sentiment_score").over(w.rangeBetween(-5, -1))
    prev10 = F.last("sentiment_score").over(w.rangeBetween(-10, -1))
    avg30 = F.avg("sentiment_score").over(w.rangeBetween(-30, -1))
    sd30 = F.stddev_samp("sentiment_score").over(w.rangeBetween(-30, -1))
    s = c_("sentiment_score")
    return t.select(
        *[c for c in table.columns if c not in ("sentiment_momentum_3d", "sentiment_momentum_7d",
                                                  "sentiment_vs_avg_30d")],
        (s - F.coalesce(prev5, F.lit(0.0))).alias("sentiment_momentum_3d"),
        (s - F.coalesce(prev10, F.lit(0.0))).alias("sentiment_momentum_7d"),
        F.when(F.coalesce(sd30 > 0.01, F.lit(False)), (s - avg30) / sd30).otherwise(F.lit(0.0))
        .alias("sentiment_vs_avg_30d"),
    )


def backfill_dates(spark, asof: str, n_days: int) -> DataFrame:
    """The last ``n_days`` weekdays up to ``asof`` (one job for all dates)."""
    span = n_days * 2 + 7
    d = spark.range(1).select(F.explode(F.sequence(F.date_sub(F.lit(asof).cast("date"), span),
                                                   F.lit(asof).cast("date"))).alias("trading_date"))
    d = d.filter(F.weekday("trading_date") < 5)
    w = Window.orderBy(c_("trading_date").desc())
    return d.withColumn("_r", F.row_number().over(w)).filter(c_("_r") <= n_days).drop("_r")


def sentiment_table(articles: DataFrame, lexicon: DataFrame, keywords: DataFrame) -> DataFrame:
    """The whole collector run over every published date. The deduplicated articles are written once: the
    tokens, the keywords and the aggregates read them."""
    a = stored(scoring_text(dedup_titles(articles)), "deduplicated")
    a = lexicon_scores(a, lexicon)
    a = route(match_sectors(a, keywords))
    sectors = sorted(r[0] for r in keywords.select("sector").distinct().collect())      # one row per sector
    agg = sector_aggregate(a, sectors, articles.select("published"))
    return momentum_and_zscore(agg)
