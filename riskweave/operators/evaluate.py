"""Threshold sweep and classification report on scored rows (inventory M5, M6, L5).

The sweep never re-scans the scored rows per threshold: each row is reduced
to the index of the highest grid threshold it clears, counts per (label,
index) are summed from the top of the grid (a 66-row table), and F1 follows
from TP/FP/FN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values from the reference: threshold grid 0.05 .. 0.69 step 0.01.
GRID_START, GRID_STEP, GRID_POINTS = 0.05, 0.01, 65


def grid_value(i) -> F.Column:
    return F.lit(GRID_START) + F.lit(GRID_STEP) * i


def _clear_index(p: F.Column) -> F.Column:
    """Largest i with p >= t_i (or -1); exact against the grid values."""
    i0 = F.floor((p - F.lit(GRID_START)) / F.lit(GRID_STEP)).cast("int")
    i0 = F.least(F.greatest(i0, F.lit(-1)), F.lit(GRID_POINTS - 1))
    i1 = F.when((i0 >= 0) & (p < grid_value(i0)), i0 - 1).otherwise(i0)
    return F.when((i1 < GRID_POINTS - 1) & (p >= grid_value(i1 + 1)), i1 + 1).otherwise(i1)


def threshold_sweep(scored: DataFrame, p: str = "p", y: str = "is_fraud") -> DataFrame:
    """M5: F1 of ``p >= t`` for every grid threshold t."""
    spark: SparkSession = scored.sparkSession
    counts = (scored.select(_clear_index(F.col(p)).alias("i"), F.col(y).cast("int").alias("_y"))
              .groupBy("i").agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") != 1).alias("neg")))
    grid = spark.range(-1, GRID_POINTS).select(F.col("id").cast("int").alias("i"))   # -1: clears none
    g = grid.join(counts, "i", "left").fillna(0, subset=["pos", "neg"])
    w = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)   # 65 rows
    g = (g.withColumn("tp", F.sum("pos").over(w)).withColumn("fp", F.sum("neg").over(w))
         .withColumn("P", F.sum("pos").over(Window.partitionBy())))
    g = g.withColumn("fn", F.col("P") - F.col("tp")).filter(F.col("i") >= 0)
    denom = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    f1 = F.when(denom > 0, 2.0 * F.col("tp") / denom).otherwise(F.lit(0.0))
    return g.select("i", grid_value(F.col("i")).alias("threshold"), "tp", "fp", "fn", f1.alias("f1"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Arg-max F1, smallest threshold on ties; threshold reported to 2 places."""
    return (sweep.orderBy(F.desc("f1"), F.asc("i")).limit(1)
            .select(F.round("threshold", 2).alias("best_threshold"), F.col("f1").alias("best_f1")))


def f1_at(scored: DataFrame, t: float, p: str = "p", y: str = "is_fraud") -> DataFrame:
    pred = F.col(p) >= F.lit(t)
    yy = F.col(y) == 1
    c = scored.agg(F.count_if(pred & yy).alias("tp"), F.count_if(pred & ~yy).alias("fp"),
                   F.count_if(~pred & yy).alias("fn"))
    denom = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return c.select(F.lit(t).alias("threshold"),
                    F.when(denom > 0, 2.0 * F.col("tp") / denom).otherwise(0.0).alias("f1"))


def classification_report(scored: DataFrame, t: float, p: str = "p", y: str = "is_fraud",
                          names=("legit", "fraud")) -> DataFrame:
    """M6: per-class precision/recall/F1/support, accuracy, macro and
    weighted averages (zero division -> 0), as rows."""
    pred = (F.col(p) >= F.lit(t)).cast("int")
    yy = F.col(y).cast("int")
    c = scored.agg(*[F.count_if((pred == a) & (yy == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])

    def prf(cls):
        other = 1 - cls
        tp, fp, fn = F.col(f"c{cls}{cls}"), F.col(f"c{cls}{other}"), F.col(f"c{other}{cls}")
        prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
        rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
        return prec, rec, f1, (tp + fn)

    p0, r0, f0, s0 = prf(0)
    p1, r1, f1, s1 = prf(1)
    n = s0 + s1
    rows = F.array(
        F.struct(F.lit(names[0]).alias("label"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"),
                 s0.cast("double").alias("support")),
        F.struct(F.lit(names[1]).alias("label"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"),
                 s1.cast("double").alias("support")),
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 ((F.col("c00") + F.col("c11")) / n).alias("f1"), n.cast("double").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1"), n.cast("double").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), ((p0 * s0 + p1 * s1) / n).alias("precision"),
                 ((r0 * s0 + r1 * s1) / n).alias("recall"), ((f0 * s0 + f1 * s1) / n).alias("f1"),
                 n.cast("double").alias("support")))
    return c.select(F.explode(rows).alias("r")).select("r.*")
