"""Target and frequency encodings (inventory G1-G3, G13, T7).

Out-of-fold encoding in one pass ("leave-fold-out by subtraction"): per
(category, fold) counts n and positives s, per category totals N and S; a row
in fold f sees the other folds' statistics (N - n, S - s).  The per-category
tables are small and joined back on the category; AQE broadcasts them when
their measured size allows, else a shuffle join.  The global mean is a single
scalar aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Fixed value: the reference's smoothing weight.
MIN_SAMPLES = 50


def global_mean(df: DataFrame, y: str) -> float:
    """One scalar through the driver."""
    return float(df.agg(F.avg(F.col(y).cast("double"))).first()[0])


def _smooth(pos: Column, cnt: Column, g: float, m: float) -> Column:
    return (pos + F.lit(m * g)) / (cnt + F.lit(float(m)))


def target_encode_oof(train: DataFrame, col: str, y: str = "is_fraud", fold: str = "fold",
                      m: float = MIN_SAMPLES, out: str | None = None, g: float | None = None) -> DataFrame:
    """G1: smoothed out-of-fold target mean; unseen or NULL category -> global mean."""
    out = out or f"{col}_enc"
    g = global_mean(train, y) if g is None else g
    per = (train.filter(F.col(col).isNotNull())
           .groupBy(col, fold).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(y).cast("double")).alias("_s")))
    wc = Window.partitionBy(col)
    per = (per.withColumn("_on", F.sum("_n").over(wc) - F.col("_n"))
              .withColumn("_os", F.sum("_s").over(wc) - F.col("_s"))
              .select(col, fold, "_on", "_os"))
    j = train.join(per, [col, fold], "left")
    enc = F.when(F.col("_on") > 0, _smooth(F.col("_os"), F.col("_on"), g, m)).otherwise(F.lit(g))
    return j.withColumn(out, enc).drop("_on", "_os")


def target_encode_apply(train: DataFrame, test: DataFrame, col: str, y: str = "is_fraud",
                        m: float = MIN_SAMPLES, out: str | None = None, g: float | None = None) -> DataFrame:
    """Encoding fitted on all of ``train`` applied to ``test``."""
    out = out or f"{col}_enc"
    g = global_mean(train, y) if g is None else g
    stats = (train.filter(F.col(col).isNotNull()).groupBy(col)
             .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(y).cast("double")).alias("_s")))
    j = test.join(stats, col, "left")
    return j.withColumn(out, F.coalesce(_smooth(F.col("_s"), F.col("_n"), g, m), F.lit(g))).drop("_n", "_s")


def category_counts(df: DataFrame, cols, y: str, by=()) -> DataFrame:
    """(col, val, by..., n, s), written: rows and positives of every value of every column, from one scan.

    The column named '' stands for all rows.  What is written is a row per value (and ``by``), read once per column
    by the joins back."""
    arr = F.array(F.struct(F.lit("").alias("col"), F.lit("").alias("val")),
                  *[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in cols])
    return cut_lineage(df.select(*by, F.col(y).cast("double").alias("_y"), F.explode(arr).alias("_c"))
                       .filter(F.col("_c.val").isNotNull()).groupBy("_c.col", "_c.val", *by)
                       .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s")))


def _attach(df: DataFrame, table: DataFrame, c: str, by=()) -> DataFrame:
    """``df`` with the rows of ``table`` (col, val, by..., values) of its value in column ``c``."""
    own = table.filter(F.col("col") == c).drop("col").withColumnRenamed("val", "_val")
    match = F.col(c).cast("string") == F.col("_val")
    for k in by:
        own = own.withColumnRenamed(k, f"_by_{k}")
        match &= F.col(k) == F.col(f"_by_{k}")
    return df.join(own, match, "left").drop("_val", *[f"_by_{k}" for k in by])


def target_encode_columns(train: DataFrame, test: DataFrame, cols, y: str = "is_fraud",
                          fold: str = "fold", m: float = MIN_SAMPLES) -> tuple[DataFrame, DataFrame]:
    """G1 on train and G2 on test for each column; the training rows are scanned once for all of them."""
    counts = category_counts(train, cols, y, (fold,))
    value = Window.partitionBy("col", "val")
    totals = counts.groupBy("col", "val").agg(F.sum("n").alias("_n"), F.sum("s").alias("_s"))
    everything = totals.filter("col = ''").first()
    g = everything["_s"] / everything["_n"] if everything else 0.0
    others = counts.select("col", "val", fold, (F.sum("n").over(value) - F.col("n")).alias("_n"),
                           (F.sum("s").over(value) - F.col("s")).alias("_s"))

    def encoded(c: str):
        return F.when(F.col("_n") > 0, _smooth(F.col("_s"), F.col("_n"), g, m)).otherwise(F.lit(g))

    for c in cols:
        test = _attach(test, totals, c).withColumn(f"{c}_enc", encoded(c)).drop("_n", "_s")
        train = _attach(train, others, c, (fold,)).withColumn(f"{c}_enc", encoded(c)).drop("_n", "_s")
    return train, test


def frequency_encode_columns(df: DataFrame, cols) -> DataFrame:
    """G13 for several columns, whose values are counted in one scan."""
    counts = category_counts(df.withColumn("_one", F.lit(1)), cols, "_one").filter("col <> ''")
    share = counts.select("col", "val", (F.col("n") / F.sum("n").over(Window.partitionBy("col"))).alias("_share"))
    for c in cols:
        df = _attach(df, share, c).withColumn(f"{c}_freq", F.coalesce("_share", F.lit(0.0))).drop("_share")
    return df


def frequency_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Share of the value among non-null rows; NULL -> 0."""
    out = out or f"{col}_freq"
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    total = counts.agg(F.sum("_c")).first()[0] or 0
    j = df.join(counts, col, "left")
    return j.withColumn(out, F.coalesce(F.col("_c") / F.lit(float(total)) if total else F.lit(None),
                                        F.lit(0.0))).drop("_c")


def target_mean_encode(df: DataFrame, cols, y: str = "is_fraud", suffix: str = "_te") -> DataFrame:
    """Naive (no folds, no smoothing) target mean per category of each
    column, NULL category -> NULL key -> overall mean of ``y`` over all rows.

    All columns' category rates come from one pass (rows x columns emitted,
    aggregated map-side); each rate table is then joined back on its column.
    """
    g = global_mean(df, y)
    arr = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in cols])
    rates = (df.select(F.col(y).cast("double").alias("_y"), F.explode(arr).alias("_c"))
             .filter(F.col("_c.val").isNotNull())
             .groupBy(F.col("_c.col").alias("col"), F.col("_c.val").alias("val"))
             .agg(F.avg("_y").alias("rate")))
    rates = cut_lineage(rates)          # small; read once per column below
    out = df
    for c in cols:
        r = rates.filter(F.col("col") == c).select(F.col("val").alias(f"_k_{c}"), F.col("rate").alias(f"{c}{suffix}"))
        out = (out.join(r, F.col(c).cast("string") == F.col(f"_k_{c}"), "left").drop(f"_k_{c}")
               .withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(g))))
    return out
