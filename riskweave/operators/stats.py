"""Descriptive statistics over DataFrames (inventory A27-A37, P13-P15, S9-S11).

All results are small statistics tables computed by aggregates; exact
quantiles use ``percentile`` (linear interpolation, as pandas/numpy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

QUARTILES = [0.25, 0.5, 0.75]


def rate_by_group(df: DataFrame, c: str, y: str = "is_fraud", min_n: int | None = None,
                  max_n: int | None = None) -> DataFrame:
    """Label mean and size per non-null group, optionally filtered by
    group size (HAVING), ordered by rate descending."""
    out = (df.filter(F.col(c).isNotNull()).groupBy(c)
           .agg(F.avg(F.col(y).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n")))
    if min_n is not None:
        out = out.filter(F.col("n") >= min_n)
    if max_n is not None:
        out = out.filter(F.col("n") < max_n)
    return out.orderBy(F.desc("rate"), F.col(c))


def categorical_cols(df: DataFrame, exclude=()) -> list[str]:
    """Text columns of the schema, less a deny-list."""
    return [name for name, kind in df.dtypes if kind == "string" and name not in set(exclude)]


def rates_by_columns(df: DataFrame, cols, y: str = "is_fraud") -> DataFrame:
    """A27 for several columns in one scan: (column, value, rate, n) of every non-null value."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return (df.select(F.col(y).cast("double").alias("_y"), F.explode(arr).alias("_c")).filter(F.col("_c.value").isNotNull())
            .groupBy("_c.column", "_c.value").agg(F.avg("_y").alias("rate"), F.count(F.lit(1)).alias("n"))
            .orderBy("column", F.desc("rate"), "value"))


def fraud_share_by(df: DataFrame, c: str, y: str = "is_fraud") -> DataFrame:
    """Fraud count, total and percent per group having some fraud."""
    return (df.filter(F.col(c).isNotNull()).groupBy(c)
            .agg(F.count_if(F.col(y) == 1).alias("fraud_count"), F.count(F.lit(1)).alias("total_users"))
            .filter(F.col("fraud_count") > 0)
            .withColumn("fraud_percentage", F.col("fraud_count") / F.col("total_users") * 100.0)
            .orderBy(F.desc("fraud_percentage"), F.col(c)))


def mean_group_size(df: DataFrame, c: str) -> DataFrame:
    """Average number of rows per non-null value."""
    return (df.filter(F.col(c).isNotNull()).groupBy(c).count()
            .agg(F.avg("count").alias("mean_group_size"), F.count(F.lit(1)).alias("groups")))


def crosstab_long(df: DataFrame, x: str, y: str) -> DataFrame:
    """Contingency counts in long form (rows with a NULL on either side dropped)."""
    return (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(x, y).agg(F.count(F.lit(1)).alias("n")))


def crosstab_norm(df: DataFrame, x: str, y: str) -> DataFrame:
    """Counts normalised within each column value of ``y``."""
    ct = crosstab_long(df, x, y)
    return ct.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(y)))


def crosstab_margins(df: DataFrame, x: str, y: str, label: str = "All") -> DataFrame:
    """Counts with row/column/grand totals, labelled 'All' (cube)."""
    d = (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
         .select(F.col(x).cast("string").alias(x), F.col(y).cast("string").alias(y)))
    return (d.cube(x, y)
            .agg(F.count(F.lit(1)).alias("n"), F.grouping(x).alias("_gx"), F.grouping(y).alias("_gy"))
            .select(F.when(F.col("_gx") == 1, F.lit(label)).otherwise(F.col(x)).alias(x),
                    F.when(F.col("_gy") == 1, F.lit(label)).otherwise(F.col(y)).alias(y), "n"))


def top_values(df: DataFrame, by: str, c: str, n: int = 20) -> DataFrame:
    """The n most frequent values of ``c`` within each ``by`` class
    (ties broken by value); the partial limit runs before the shuffle."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(by, c).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(by).orderBy(F.desc("count"), F.col(c))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def describe_num(df: DataFrame, c: str, by: str | None = None) -> DataFrame:
    """Count, mean, std (ddof 1), min, quartiles (exact, distributed), max."""
    x = F.col(c)
    keys = [by] if by else []
    aggs = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max")]
    if by:
        df = df.filter(F.col(by).isNotNull())
    g = df.groupBy(*keys).agg(*aggs)
    q = exact_quantiles(df, c, QUARTILES, by=keys).drop("n")
    # a class without a value keeps its row: count 0, null quartiles
    out = g.join(q, keys, "left") if keys else g.withColumn("_k", F.lit(0)).join(q.withColumn("_k", F.lit(0)), "_k")
    return out.select(*keys, "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
                      F.col("q2").alias("p75"), "max")


def describe_cat(df: DataFrame, c: str) -> DataFrame:
    """Count, unique, top (most frequent, ties -> smallest) and its freq."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
                      F.min_by(F.col(c), F.struct(-F.col("n"), F.col(c))).alias("top"),
                      F.max("n").alias("freq"))


def histogram(df: DataFrame, c: str, bins: int = 100, by: str | None = None,
              transform: str | None = "log1p", density: bool = True) -> DataFrame:
    """Equal-width histogram over each class's own [min, max]; the last
    bin is closed on the right, empty bins are listed, a constant class is
    widened by 0.5 on both sides.  Output: class, bin, edges, count, density."""
    val = F.log1p(F.col(c)) if transform == "log1p" else F.col(c)
    if not by:
        df = df.withColumn("_all", F.lit(0))
    keys = [by or "_all"]
    d = df.select(*keys, val.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rng = d.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    # numpy widens the range of a constant class by half a unit on both sides
    flat = F.col("_lo") == F.col("_hi")
    rng = rng.withColumns({"_lo": F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")),
                           "_hi": F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi"))})
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    j = d.join(rng, keys)
    b = F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    h = j.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))      # empty bins count 0
    out = grid.join(h, [*keys, "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0))).select(
        *keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"), "count",
        (F.col("count") / (F.col("_n") * width)).alias("density"))
    out = out if density else out.drop("density")
    return out.drop("_all")


def box_stats(df: DataFrame, c: str, by: str | None = None, whis: float = 1.5) -> DataFrame:
    """Quartiles, IQR, whiskers (furthest data within 1.5 IQR) and the
    number of points beyond them, per class."""
    if not by:
        df = df.withColumn("_all", F.lit(0))
    keys = [by or "_all"]
    d = df.filter(F.col(c).isNotNull())
    q = exact_quantiles(d, c, QUARTILES, by=keys)
    q = q.select(*keys, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"),
                 F.col("q2").alias("q3")).withColumn("iqr", F.col("q3") - F.col("q1"))
    j = d.join(q, keys)
    lo = F.col("q1") - whis * F.col("iqr")
    hi = F.col("q3") + whis * F.col("iqr")
    x = F.col(c)
    return j.groupBy(*keys, "n", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(x >= lo, x)).alias("whisker_lo"),
        F.max(F.when(x <= hi, x)).alias("whisker_hi"),
        F.count_if((x < lo) | (x > hi)).alias("fliers")).drop("_all")


def sample_first(df: DataFrame, n: int, key: str) -> DataFrame:
    """A deterministic fixed-size sample (the n smallest md5 of the key).

    The limit is the feature here (the reference embeds a fixed 50,000-row
    sample); the top-n runs as a partial limit per task, then one merge.
    """
    return (df.withColumn("_h", F.md5(F.col(key).cast("string")))
            .orderBy("_h", key).limit(n).drop("_h"))


def profile_schema(df: DataFrame) -> DataFrame:
    """One row per column: name, type, non-null count (one aggregate pass)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = counts.selectExpr(f"stack({len(df.columns)}, {stack}) as (column, non_null)")
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                            "column string, type string")
    return long.join(F.broadcast(types), "column")


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def class_balance(users: DataFrame, y: str = "is_fraud") -> DataFrame:
    """Users, frauds, fraud percent."""
    return users.agg(F.count(F.lit(1)).alias("users"), F.sum(F.col(y).cast("long")).alias("frauds"),
                     (F.avg(F.col(y).cast("double")) * 100.0).alias("fraud_percent"))
