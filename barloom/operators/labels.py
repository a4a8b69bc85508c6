"""Labels, splits, folds and weights (2.6).

Date-level logic runs on the distinct-date series (bounded by the calendar,
thousands of rows) and is broadcast back; row-level order uses the distributed
row index of ``functions.rowindex`` (never a single-partition row window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.rowindex import exact_row_index
from barloom.functions.sizing import checked_broadcast

c_ = F.col


def date_index(df: DataFrame, date_col: str = "trading_date") -> DataFrame:
    """Distinct dates with a 0-based index and the total count ``n_dates``."""
    d = df.select(date_col).distinct()
    return d.select(date_col, (F.row_number().over(Window.orderBy(date_col)) - 1).alias("date_idx"),
                    F.count(F.lit(1)).over(Window.partitionBy()).alias("n_dates"))


def split_purged(df: DataFrame, train_frac: float = 0.60, cal_frac: float = 0.80, purge: int = 5,
                 date_col: str = "trading_date", dates_of: DataFrame | None = None) -> DataFrame:
    """Train / calibration / test by date, dropping ``purge`` dates before
    each boundary (NULL split). ``train_frac == cal_frac`` gives two ways. ``dates_of`` is a cheaper
    frame with the dates of ``df``."""
    idx = date_index(df if dates_of is None else dates_of, date_col)
    te = F.floor(c_("n_dates") * F.lit(train_frac))
    ce = F.floor(c_("n_dates") * F.lit(cal_frac))
    i = c_("date_idx")
    split = (F.when(i < F.greatest(te - purge, F.lit(0)), F.lit("train"))
             .when((i >= te) & (i < F.greatest(ce - purge, te)), F.lit("calibration"))
             .when(i >= ce, F.lit("test")))
    dates = idx.select(date_col, split.alias("split"))
    return df.join(F.broadcast(dates), date_col, "left")


def dead_zone(df: DataFrame, ret_col: str = "next_5d_return", pct: float = 1.0) -> DataFrame:
    """Drop |return| < pct from train and calibration only."""
    keep = ~(c_("split").isin("train", "calibration") & (F.abs(c_(ret_col)) < pct))
    return df.filter(F.coalesce(keep, F.lit(True)))


def global_order(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """Stable order by date then ticker, 0-based."""
    return exact_row_index(df, ["trading_date"], ["ticker"], name, start=0)


def sample_weights(train: DataFrame, label_col: str = "direction_5d", down_boost: float = 1.3,
                   decay: float = 1.2) -> DataFrame:
    """Balanced class weight x Down boost x exp(decay * (pos/n - 1)),
    normalised to mean 1; ``pos`` is the G8 position within the train slice."""
    ordered = global_order(train, "pos")
    counts = ordered.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_c"))
    k = counts.count()
    counts = counts.select(label_col, "n_c")
    n_total = F.sum("n_c").over(Window.partitionBy())
    counts = counts.select(label_col, (n_total / (F.lit(k) * c_("n_c"))).alias("cw"),
                           n_total.alias("n"))
    w = ordered.join(F.broadcast(counts), label_col, "inner")
    raw = (c_("cw") * F.when(c_(label_col) == "Down", F.lit(down_boost)).otherwise(F.lit(1.0))
           * F.exp(F.lit(decay) * (c_("pos") / c_("n") - 1)))
    w = w.withColumn("_raw", raw)
    mean_raw = w.select(F.avg("_raw")).scalar()
    return w.withColumn("sample_weight", c_("_raw") / mean_raw).drop("_raw", "cw", "n")


def split_temporal(df: DataFrame, fracs=(0.8,), names=("train", "test")) -> DataFrame:
    """Split by position in the global date order (80/20 or 60/20/20)."""
    ordered = global_order(df, "pos")
    n = df.count()
    bounds = [int(f * n) for f in fracs]
    split = F.lit(names[-1])
    for b, name in reversed(list(zip(bounds, names[:-1]))):
        split = F.when(c_("pos") < b, F.lit(name)).otherwise(split)
    return ordered.withColumn("split", split)


def split_stratified(df: DataFrame, label: str, key_cols=("ticker", "trading_date"), test_pct: int = 20,
                     seed: int = 42, prefix: int = 4) -> DataFrame:
    """Seeded random split with exact class shares.

    Of every class the (rounded) ``test_pct`` percent of rows with the least md5 of seed and key are
    the test rows. That rank is found by counting hash prefixes per class (at most 16^prefix each);
    only the one prefix that holds a class's cut is put in order. A NULL label is a class of its own;
    rows with equal keys are ordered together and may straddle a cut only if they are equal."""
    keyed = df.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), *[c_(k).cast("string") for k in key_cols])))
    keyed = keyed.withColumn("_p", F.substring("_h", 1, prefix)).withColumn("_c", F.coalesce(c_(label).cast("string"), F.lit("")))
    w = Window.partitionBy("_c").orderBy("_p")
    per = keyed.groupBy("_c", "_p").agg(F.count(F.lit(1)).alias("_n"))
    per = per.select("_c", "_p", "_n", (F.sum("_n").over(w) - c_("_n")).alias("_before"),
                     F.sum("_n").over(Window.partitionBy("_c")).alias("_all"))
    per = per.withColumn("_need", F.expr(f"(_all * {test_pct} + 50) div 100"))
    # one row per class: the prefix that holds the cut, and how many of it are still needed
    cut = per.where("_before < _need AND _need <= _before + _n").select(
        "_c", c_("_p").alias("_cut"), (c_("_need") - c_("_before")).alias("_left"))
    keyed = keyed.join(checked_broadcast(cut), "_c", "left")
    inside = F.row_number().over(Window.partitionBy("_c", "_edge").orderBy("_h"))
    edge = keyed.where("_p = _cut").withColumn("_edge", F.lit(1)).withColumn("_r", inside)
    edge = edge.withColumn("split", F.when(c_("_r") <= c_("_left"), "test").otherwise("train")).drop("_edge", "_r")
    rest = keyed.where("NOT (_p <=> _cut)").withColumn("split", F.when(c_("_p") < c_("_cut"), "test").otherwise("train"))
    return rest.unionByName(edge).drop("_h", "_p", "_c", "_cut", "_left")


def label_clip(df: DataFrame, col: str = "next_5d_return", lo: float = -10.0, hi: float = 10.0) -> DataFrame:
    """Clip the regression target."""
    return df.withColumn(f"{col}_clipped", F.least(F.greatest(c_(col), F.lit(lo)), F.lit(hi)))


def split_summary(df: DataFrame, label_col: str = "direction_5d") -> DataFrame:
    """Date range and counts per split and class."""
    return df.filter(c_("split").isNotNull()).groupBy("split").agg(
        F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"),
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(c_(label_col) == "Up").cast("bigint").alias("n_up"),
        F.count_if(c_(label_col) == "Down").cast("bigint").alias("n_down"),
        F.countDistinct("trading_date").cast("bigint").alias("n_dates"))


def cv_folds(df: DataFrame, n_splits: int = 5, purge: int = 5) -> DataFrame:
    """Purged expanding folds by row position (G8 order). Output rows are
    ``(fold, role, <row columns>)`` for rows inside a fold's train or validation
    range; rows are replicated once per fold they belong to (n_splits x)."""
    ordered = global_order(df, "pos")
    n = df.count()
    min_train = max(50, n // (n_splits + 2))
    fold_size = max(20, (n - min_train) // n_splits)
    folds = []
    for i in range(n_splits):
        train_end = min_train + i * fold_size
        val_start = train_end + purge
        val_end = min(val_start + fold_size, n)
        if val_start >= n or val_end <= val_start:
            continue
        folds.append((i, train_end, val_start, val_end))
    specs = F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(te).cast("long").alias("train_end"),
                               F.lit(vs).cast("long").alias("val_start"), F.lit(ve).cast("long").alias("val_end"))
                      for i, te, vs, ve in folds])
    # fold specs as a literal array: each row is repeated once per fold it falls in (<= n_splits)
    j = ordered.select("*", F.explode(specs).alias("_f")).select("*", "_f.*").drop("_f")
    j = j.filter(c_("pos") < c_("val_end"))
    role = (F.when(c_("pos") < c_("train_end"), F.lit("train"))
            .when(c_("pos") >= c_("val_start"), F.lit("validation")))
    return j.withColumn("role", role).filter(c_("role").isNotNull()).drop("train_end", "val_start", "val_end")


def walkforward_folds(df: DataFrame, folds: int = 6, test_window: int = 21, purge: int = 5,
                      selection_frac: float = 0.60) -> DataFrame:
    """Walk-forward folds by date: (fold, trading_date, role) with role in
    train / calibration / test. Fold count shrinks to fit after the feature
    selection date. Works on the distinct-date series only."""
    idx = date_index(df)
    n = idx.select(F.max("n_dates")).first()[0] or 0
    cutoff = int(selection_frac * n)
    available = max(n - 1 - cutoff, 0)
    if folds * test_window > available:
        folds = max(available // test_window, 1)
    rows = []
    for i in range(folds):
        end = n - (folds - 1 - i) * test_window
        test_lo, test_hi = end - test_window, end
        pool_hi = max(end - test_window - purge, 0)
        cal_n = max(int(0.15 * pool_hi), 10)
        cal_lo = max(pool_hi - cal_n, 0)
        train_hi = max(pool_hi - (cal_n + purge), 0)
        rows.append((i, 0, train_hi, cal_lo, pool_hi, test_lo, test_hi))
    names = ("fold", "tr_lo", "tr_hi", "cal_lo", "cal_hi", "te_lo", "te_hi")
    specs = F.array(*[F.struct(*[F.lit(v).cast("int" if k == "fold" else "long").alias(k)
                                 for k, v in zip(names, r)]) for r in rows])
    i = c_("date_idx")
    j = idx.select("*", F.explode(specs).alias("_f")).select("*", "_f.*").drop("_f")
    j = j.filter((i >= c_("tr_lo")) & (i < c_("te_hi")))
    role = (F.when(i < c_("tr_hi"), F.lit("train"))
            .when((i >= c_("cal_lo")) & (i < c_("cal_hi")), F.lit("calibration"))
            .when(i >= c_("te_lo"), F.lit("test")))
    return j.select("fold", "trading_date", role.alias("role")).filter(c_("role").isNotNull())
