"""Global ranks without a single-partition window.

``row_number() over (partition by p order by o)`` with a low-cardinality
``p`` (a label) runs in one task per label.  ``bucketed_row_number`` splits
the order into buckets of an order-preserving prefix of the sort key, counts
rows per bucket (a small table), turns counts into running offsets and adds
each row's in-bucket rank.  The result equals the plain window exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def bucketed_row_number(df: DataFrame, partition_cols: list[str], order_cols: list[Column],
                        bucket: Column, out: str = "rn") -> DataFrame:
    """Exact ``row_number()``; ``bucket`` must be monotone in ``order_cols``."""
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy(*partition_cols, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    # counts has at most |partitions| x |buckets| rows: a bounded broadcast side.
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(
        Window.partitionBy(*partition_cols).orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_cnt")
    local = Window.partitionBy(*partition_cols, "_bucket").orderBy(*order_cols)
    return (b.withColumn("_lrn", F.row_number().over(local))
            .join(F.broadcast(offsets), [*partition_cols, "_bucket"])
            .withColumn(out, F.col("_off") + F.col("_lrn"))
            .drop("_bucket", "_off", "_lrn"))


def bucketed_prefix_sums(df: DataFrame, part_cols: list[str], order_col: str, sum_cols: list[str],
                         n_buckets: int | None = None) -> DataFrame:
    """Per row, the sums of ``sum_cols`` over rows of the same partition with a
    strictly smaller ``order_col`` (``df`` must hold distinct order values per
    partition, e.g. a distinct-score table).

    A scan in two phases: rows are dealt by ranges of (partition, order) and written with their range's number, as
    many ranges as the session has shuffle partitions (``n_buckets``, if given).  A row adds up what stands before
    it in its range and the totals of earlier ranges, one row for each range and partition that meet, so no window
    spans a whole partition.
    """
    if not part_cols:
        df, part_cols = df.withColumn("_all", F.lit(0)), ["_all"]
    ranges = [*part_cols, order_col]
    dealt = df.repartitionByRange(n_buckets, *ranges) if n_buckets else df.repartitionByRange(*ranges)
    # written, as the numbers must be the same for the totals and for the rows
    b = cut_lineage(dealt.withColumn("_bucket", F.spark_partition_id()))
    tot = b.groupBy(*part_cols, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    wo = Window.partitionBy(*part_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*part_cols, "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(wo), F.lit(0)).alias(f"_o_{c}")
                                               for c in sum_cols])
    wi = Window.partitionBy(*part_cols, "_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    out = b.join(offs, [*part_cols, "_bucket"])
    for c in sum_cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(wi), F.lit(0)))
    return out.drop("_bucket", "_all", *[f"_o_{c}" for c in sum_cols])
