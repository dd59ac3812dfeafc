"""Ordered-sequence and velocity features per user (inventory W1-W8, A38).

The reference sorts each user's transactions by time and scans them.  A plain
``Window.partitionBy(id_user)`` would put a user that holds a third of all
rows into one task, so the scan is split:

1. rows are cut into *segments* ``(id_user, seg)`` where ``seg`` is the order
   key divided by ``segment_us`` (any monotone function of the order key
   works); the window runs per segment, so one user spreads over many tasks;
2. each segment is summarised (first/last status, leading and trailing fail
   runs, first success, sizes, edge timestamps);
3. the small per-segment table is scanned per user to stitch the boundaries
   (gap across segments, status change across segments, fail runs that span
   segments);
4. gap statistics aggregate the union of in-segment and boundary gaps, so the
   standard deviation is Spark's exact ``stddev_samp`` over all gaps.

First-k / last-k features keep only each segment's first/last k rows as
candidates before the per-user ranking (a bounded number per segment).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import seconds_between

LONG_MAX = 9223372036854775807
HOUR_US = 3_600_000_000


def _ordered(tx: DataFrame, tiebreak, segment_us: int) -> tuple[DataFrame, list]:
    ts_key = F.coalesce(F.unix_micros("timestamp_tr"), F.lit(LONG_MAX))   # NaT sorts last
    df = tx.withColumn("_ok", ts_key).withColumn("_seg", F.expr(f"_ok div {int(segment_us)}"))
    return df, [F.col("_ok")] + [F.col(t) for t in tiebreak]


def user_sequences(tx: DataFrame, tiebreak=("id_tx",), k_first: int = 5, k_last: int = 10,
                   segment_us: int = HOUR_US, with_burst: bool = False) -> DataFrame:
    """W1-W8 and A38 for every user that has transactions.

    One row-level window pass per segment feeds one per-segment summary; all
    user-level results come from that (small) table.  With ``with_burst`` and
    clock-hour segments, ``max_hourly_burst`` (A18) comes for free.
    """
    df, order = _ordered(tx, list(tiebreak), segment_us)
    w = Window.partitionBy("id_user", "_seg").orderBy(*order)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_fail = F.coalesce((F.col("status") == "fail").cast("int"), F.lit(0))
    rows = (df.select("id_user", "_seg", "_ok", *tiebreak, "timestamp_tr", "status",
                      "card_mask_hash", "error_group", is_fail.alias("_fail"))
            .withColumn("_rn", F.row_number().over(w))
            .withColumn("_gap", seconds_between(F.col("timestamp_tr"), F.lag("timestamp_tr").over(w)))
            .withColumn("_chg", F.when(F.col("_rn") > 1, (~F.col("status").eqNullSafe(
                F.lag("status").over(w))).cast("int")).otherwise(0))
            .withColumn("_lastok", F.max(F.when(F.col("_fail") == 0, F.col("_rn"))).over(w_run))
            .withColumn("_run", F.when(F.col("_fail") == 1, F.col("_rn") - F.coalesce("_lastok", F.lit(0)))))

    cvv = F.coalesce(F.col("error_group") == "cvv error", F.lit(False))
    seg = rows.groupBy("id_user", "_seg").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_fail").alias("nfail"),
        F.min("timestamp_tr").alias("ts_first"),
        F.max("timestamp_tr").alias("ts_last"),
        F.min_by(F.struct("status"), F.col("_rn")).alias("first_status"),
        F.max_by(F.struct("status"), F.col("_rn")).alias("last_status"),
        F.count_if((F.col("_fail") == 1) & F.col("_lastok").isNull()).alias("pre"),
        F.max_by(F.coalesce("_run", F.lit(0)), F.col("_rn")).alias("suf"),
        F.coalesce(F.max("_run"), F.lit(0)).alias("inner"),
        F.min(F.when(F.col("status") == "success", F.col("_rn"))).alias("fs_rn"),
        F.min(F.when(F.col("status").isNotNull(), F.struct("_rn", "status"))).alias("first_nn"),
        F.sum("_chg").alias("chg_in"),
        # in-segment gap moments (Chan et al. combine them exactly below)
        F.count("_gap").alias("g_n"), F.avg("_gap").alias("g_mean"),
        (F.coalesce(F.var_pop("_gap"), F.lit(0.0)) * F.count("_gap")).alias("g_m2"),
        F.min("_gap").alias("g_min"),
        # cards of the first k rows, the last cvv row; no collected lists: the rows lie sorted by segment, and an aggregate
        # with lists would be hashed and sorted again
        *[F.max(F.when(F.col("_rn") == i, F.col("card_mask_hash"))).alias(f"head_{i}") for i in range(1, k_first + 1)],
        F.max(F.when(cvv, F.col("_rn"))).alias("last_cvv_rn"),
    )
    ws = Window.partitionBy("id_user").orderBy("_seg")
    wu = Window.partitionBy("id_user")
    prev_last = F.lag("ts_last").over(ws)
    seg = (seg
           .withColumn("b_gap", seconds_between(F.col("ts_first"), prev_last))
           .withColumn("b_chg", F.when(F.lag("n").over(ws).isNotNull(),
                                       (~F.col("first_status.status").eqNullSafe(
                                           F.lag("last_status").over(ws).getField("status"))).cast("int"))
                       .otherwise(0))
           .withColumn("before", F.coalesce(F.sum("n").over(
               ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           # not a frame up to the last row, which Spark adds up anew for each row
           .withColumn("after", F.sum("n").over(wu) - F.col("before") - F.col("n"))
           .withColumn("all_fail", F.col("nfail") == F.col("n"))
           .withColumn("g", F.sum(F.when(F.col("all_fail"), 0).otherwise(1)).over(
               ws.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    # boundary gap folded into the segment's gap moments: one more value
    bg = F.col("b_gap")
    has_b = bg.isNotNull()
    n1 = F.col("g_n") + has_b.cast("long")
    mean1 = F.when(has_b, (F.coalesce(F.col("g_mean") * F.col("g_n"), F.lit(0.0)) + bg) / n1).otherwise(F.col("g_mean"))
    m2_1 = F.when(has_b & (F.col("g_n") > 0),
                  F.col("g_m2") + F.pow(bg - F.col("g_mean"), 2) * F.col("g_n") / n1) \
        .when(has_b, F.lit(0.0)).otherwise(F.col("g_m2"))
    seg = seg.withColumn("gn", n1).withColumn("gmean", mean1).withColumn("gm2", m2_1).withColumn(
        "gmin", F.least("g_min", "b_gap"))
    # first k overall: the card at each place, which is row place - before of one segment
    first_k = [F.max(F.coalesce(*[F.when(F.col("before") + i == place, F.col(f"head_{i}")) for i in range(1, place + 1)]))
               for place in range(1, k_first + 1)]
    # last k overall: a cvv row among the last k iff after + (n - rn) < k
    seg = seg.withColumn("cvv_tail", (F.col("last_cvv_rn").isNotNull()
                                      & (F.col("after") + F.col("n") - F.col("last_cvv_rn") < k_last)).cast("int"))

    gm = F.try_divide(F.sum(F.col("gmean") * F.col("gn")).over(wu), F.sum("gn").over(wu).cast("double"))
    seg = seg.withColumn("_um", gm)
    per_user = seg.groupBy("id_user").agg(
        (F.sum("chg_in") + F.sum("b_chg")).alias("status_changes"),
        F.coalesce(
            F.min(F.when(F.col("fs_rn").isNotNull(),
                         F.struct("_seg", (F.col("before") + F.col("fs_rn") - 1).alias("v")))).getField("v"),
            F.sum("n")).alias("fails_before_first_success"),
        F.coalesce((F.min(F.when(F.col("first_nn").isNotNull(), F.struct("_seg", "first_nn")))
                    .getField("first_nn").getField("status") == "fail").cast("int"),
                   F.lit(0)).alias("first_tx_failed"),
        F.min("gmin").alias("min_time_between_tx"),
        F.try_divide(F.sum(F.col("gmean") * F.col("gn")), F.sum("gn")).alias("avg_time_between_tx"),
        F.sqrt(F.try_divide(
            F.sum(F.when(F.col("gn") > 0, F.col("gm2") + F.col("gn") * F.pow(F.col("gmean") - F.col("_um"), 2))),
            (F.sum("gn") - 1).cast("double"))).alias("_std"),
        F.sum("gn").alias("_gn"),
        F.size(F.array_distinct(F.filter(F.array(*first_k), lambda c: c.isNotNull()))).alias(f"unique_cards_first_{k_first}"),
        F.max("cvv_tail").alias("is_cvv_error"),
        *([F.max(F.when(F.col("ts_first").isNotNull(), F.col("n"))).alias("max_hourly_burst")]
          if with_burst and segment_us == HOUR_US else []),
    )
    per_user = (per_user.withColumn("std_time_between_tx", F.when(F.col("_gn") > 1, F.col("_std")))
                .drop("_std", "_gn"))

    # fail runs that cross segment boundaries
    groups = seg.groupBy("id_user", "g").agg(
        F.max(F.when(~F.col("all_fail"), F.col("suf"))).alias("start_suf"),
        F.max(F.when(~F.col("all_fail"), F.col("pre"))).alias("start_pre"),
        F.sum(F.when(F.col("all_fail"), F.col("n")).otherwise(0)).alias("fill"),
        F.max("inner").alias("inner_max"))
    wg = Window.partitionBy("id_user").orderBy("g")
    runs = (groups.withColumn("cross", F.coalesce("start_suf", F.lit(0)) + F.col("fill")
                              + F.coalesce(F.lead("start_pre").over(wg), F.lit(0)))
            .groupBy("id_user")
            .agg(F.max(F.greatest("cross", "inner_max")).alias("max_consecutive_fails")))
    return per_user.join(runs, "id_user", "left")
