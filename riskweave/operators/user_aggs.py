"""Per-user aggregates over transactions (inventory A1-A18, A22-A26, A38 via sequences).

Design: one fused ``groupBy(id_user).agg(...)`` for every row-grain statistic,
plus three two-level aggregations for statistics defined on a finer grain
((user, clock hour), (user, amount), (user, card country)).  Each level
pre-aggregates map-side, so a user holding a third of all rows is reduced to
one partial row per map task before any shuffle.  Results are keyed by
``id_user`` and hash-partitioned on it, so attaching them to ``users`` is a
chain of co-partitioned joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import (EPS, clip_lower, eps_ratio, error_rate_name, first_token_lower,
                               neq_null_true, rate_of, seconds_between, word_count)

# Fixed values from the reference: error groups scored by the pipeline, and the
# full list used by the exploratory notebook; transaction types seen there.
PIPELINE_ERROR_GROUPS = ["antifraud", "3ds error", "card problem"]
ALL_ERROR_GROUPS = ["antifraud", "do not honor", "fraud", "cvv error",
                    "insufficient funds error", "3ds error", "card problem"]
TX_TYPES = ["card_init", "resign", "card_recurring", "apple-pay", "google-pay"]
SMALL_AMOUNT = 5.0

# Columns filled with 0 for users without transactions (E5); everything else
# produced here stays NULL until the model-matrix step.
ZERO_FILL = [
    "tx_count", "unique_cards_per_user", "unique_card_holders", "unique_error_types",
    "unique_card_brands", "unique_card_types", "unique_card_countries",
    "fail_status_coefficient", "fraud_error_rate", "fraud_error_count", "cvv_error_coef",
    "country_CP_missmatch_coef", "country_CReg_missmatch", "tx_type_card_init_rate",
    "resign_count", "unique_amounts", "hour_std", "holder_name_length", "holder_name_words",
    "max_hourly_burst", "amount_entropy", "amount_mode_concentration", "small_amount_rate",
    "unique_first_names",
] + [error_rate_name(g) for g in ALL_ERROR_GROUPS]


def _status_is(v: str) -> Column:
    return F.col("status") == F.lit(v)


DISTINCT_COUNTS = {
    "unique_cards_per_user": "card_mask_hash", "unique_card_holders": "card_holder",
    "unique_error_types": "error_group", "unique_card_brands": "card_brand",
    "unique_card_types": "card_type", "unique_card_countries": "card_country",
}


def distinct_counts(tx: DataFrame) -> DataFrame:
    """Distinct counts per user (NULL ignored), kept apart from the
    other aggregates so the distinct rewrite does not drag them along."""
    aggs = [F.count_distinct(c).alias(name) for name, c in DISTINCT_COUNTS.items()]
    aggs.append(F.count_distinct(first_token_lower("card_holder")).alias("unique_first_names"))
    return tx.groupBy("id_user").agg(*aggs)


def row_grain_aggregates(tx: DataFrame, error_groups=ALL_ERROR_GROUPS) -> DataFrame:
    """A1-A9, A11, A12, A14 (first time), A16, A24, A26 per user (the median
    comes from ``amount_median``, the main holder from ``main_holder``)."""
    aggs = [
        F.count(F.lit(1)).alias("tx_count"),
        F.avg("amount").alias("amount_mean"),
        F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("amount_std"),
        F.max("amount").alias("amount_max"),
        F.min("amount").alias("amount_min"),
        F.sum("amount").alias("amount_sum"),
        rate_of(_status_is("fail")).alias("fail_status_coefficient"),
        rate_of(F.col("error_group") == "fraud").alias("fraud_error_rate"),
        F.count_if(F.col("error_group") == "fraud").alias("fraud_error_count"),
        rate_of(F.col("error_group") == "cvv error").alias("cvv_error_coef"),
        rate_of(neq_null_true("card_country", "payment_country")).alias("country_CP_missmatch_coef"),
        rate_of(F.col("transaction_type") == "card_init").alias("tx_type_card_init_rate"),
        F.count_if(F.col("transaction_type") == "resign").alias("resign_count"),
        F.min("timestamp_tr").alias("first_timestamp_tr"),
        F.coalesce(F.stddev_samp(F.hour("timestamp_tr")), F.lit(0.0)).alias("hour_std"),
        rate_of(F.col("amount") <= F.lit(SMALL_AMOUNT)).alias("small_amount_rate"),
    ]
    for g in error_groups:
        if g == "cvv error":
            continue
        aggs.append(rate_of(F.col("error_group") == g).alias(error_rate_name(g)))
    out = tx.groupBy("id_user").agg(*aggs).join(distinct_counts(tx), "id_user")
    extra = {
        "amount_range": F.col("amount_max") - F.col("amount_min"),
        "amount_cv": F.col("amount_std") / (F.col("amount_mean") + F.lit(EPS)),
    }
    if "cvv error" in error_groups:
        extra[error_rate_name("cvv error")] = F.col("cvv_error_coef")
    return out.withColumns(extra)


def hourly_burst(tx: DataFrame) -> DataFrame:
    """Most transactions in any one clock hour (UTC)."""
    per_hour = (tx.filter(F.col("timestamp_tr").isNotNull())
                .groupBy("id_user", F.date_trunc("hour", "timestamp_tr").alias("hour_bucket"))
                .agg(F.count(F.lit(1)).alias("n")))
    return per_hour.groupBy("id_user").agg(F.max("n").alias("max_hourly_burst"))


#: Bins per doubling of an amount: what ``amount_bin`` tells apart.
BINS_PER_OCTAVE = 64


def amount_bin(c: str = "amount") -> Column:
    """A number that never falls as the amount grows: its sign and ``BINS_PER_OCTAVE`` steps per doubling.

    All doubles fall into some 270,000 bins, so what is counted per (user, bin) is bounded whatever the rows are."""
    x = F.col(c)

    def steps(v: Column) -> Column:
        return F.floor(F.least(F.log2(v) * BINS_PER_OCTAVE, F.lit(70_000.0))) + 100_000

    return (F.when(F.isnan(x), F.lit(300_000)).when(x > 0, steps(x)).when(x < 0, -steps(-x)).otherwise(F.lit(0))).cast("long")


def _amount_counts(tx: DataFrame) -> DataFrame:
    return tx.groupBy("id_user", "amount").agg(F.count(F.lit(1)).alias("n"))


def amount_median(tx: DataFrame) -> DataFrame:
    """A2 median: linear interpolation between the order statistics at floor/ceil of 0.5 (N - 1).

    A radix selection: the user's rows are counted per amount bin, the bins that hold the two ranks are found by
    running counts over at most a bounded number of bins, and only these bins' distinct amounts are
    ranked, each bin in a window of its own.  No window holds all amounts of a user.
    """
    per_amount = _amount_counts(tx.filter(F.col("amount").isNotNull())).withColumn("_bin", amount_bin())
    by_user = Window.partitionBy("id_user")
    run = by_user.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (per_amount.groupBy("id_user", "_bin").agg(F.sum("n").alias("_in"))
            .withColumn("_start", F.coalesce(F.sum("_in").over(run), F.lit(0)))
            .withColumn("_pos", (F.sum("_in").over(by_user) - 1) * 0.5))
    r0, r1 = F.floor("_pos"), F.ceil("_pos")
    end = F.col("_start") + F.col("_in")
    held = bins.filter(((F.col("_start") <= r0) & (r0 < end)) | ((F.col("_start") <= r1) & (r1 < end)))
    order = Window.partitionBy("id_user", "_bin").orderBy("amount").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (per_amount.join(held.drop("_in"), ["id_user", "_bin"])
              .withColumn("_end", F.col("_start") + F.sum("n").over(order)))

    def order_stat(r: Column) -> Column:
        return F.max(F.when((F.col("_end") - F.col("n") <= r) & (r < F.col("_end")), F.col("amount")))

    two = ranked.groupBy("id_user").agg(order_stat(r0).alias("_v0"), order_stat(r1).alias("_v1"), F.first("_pos").alias("_p"))
    return two.select("id_user", (F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col("_p") - F.floor("_p"))).alias("amount_median"))


def amount_profile(tx: DataFrame) -> DataFrame:
    """A15, A22, A23 from (user, amount) counts, which reach the user as partial sums.

    entropy (nats) = ln(N) - sum(n ln n)/N over non-null amounts;
    mode concentration = largest non-null count / all rows (nulls included).
    """
    nn = F.col("amount").isNotNull()
    n = F.col("n").cast("double")
    prof = _amount_counts(tx).groupBy("id_user").agg(
        F.sum("n").alias("_rows"),
        F.sum(F.when(nn, n)).alias("_nn"),
        F.sum(F.when(nn, n * F.ln(n))).alias("_nlogn"),
        F.max(F.when(nn, F.col("n"))).alias("_top"),
        F.count(F.when(nn, F.lit(1))).alias("unique_amounts"),
    )
    return prof.select(
        "id_user", "unique_amounts",
        F.coalesce(F.ln("_nn") - F.col("_nlogn") / F.col("_nn"), F.lit(0.0)).alias("amount_entropy"),
        (F.col("_top") / F.col("_rows")).alias("amount_mode_concentration"),
    )


def main_holder(tx: DataFrame) -> DataFrame:
    """The user's most frequent non-null card holder (ties: the smallest
    name), its length and word count.  (user, holder) counts combine map-side;
    ``min_by`` over (-count, name) is a bounded aggregate, so no group's
    distinct holders are gathered into one buffer."""
    per_holder = (tx.filter(F.col("card_holder").isNotNull())
                  .groupBy("id_user", "card_holder").agg(F.count(F.lit(1)).alias("n")))
    top = per_holder.groupBy("id_user").agg(
        F.min_by("card_holder", F.struct((-F.col("n")).alias("k"), F.col("card_holder").alias("h")))
        .alias("main_card_holder"))
    return top.withColumns({"holder_name_length": F.length("main_card_holder"),
                            "holder_name_words": word_count("main_card_holder")})


def card_reg_mismatch(tx: DataFrame, users: DataFrame) -> DataFrame:
    """A10: share of a user's transactions whose card country differs from the
    registration country (NULL on either side counts as a mismatch).

    Transactions are first reduced to (user, card_country, n), so the join with
    ``users`` sees one row per distinct country per user, never raw rows.
    """
    per_cc = tx.groupBy("id_user", "card_country").agg(F.count(F.lit(1)).alias("n"))
    j = per_cc.join(users.select("id_user", "reg_country"), "id_user")
    return j.groupBy("id_user").agg(
        (F.sum(F.when(neq_null_true("card_country", "reg_country"), F.col("n")).otherwise(0))
         / F.sum("n")).alias("country_CReg_missmatch"))


def type_shares(tx: DataFrame, types=TX_TYPES) -> DataFrame:
    """Each transaction type's share of the user's typed transactions,
    one column per listed type; a type outside the list counts in the total."""
    t = F.col("transaction_type")
    return tx.filter(t.isNotNull()).groupBy("id_user").agg(
        *[(F.count_if(t == x) / F.count(t)).alias(f"tx_type_{x}_rate") for x in types])


def registration_time_features(users: DataFrame) -> DataFrame:
    """Registration hour, day of week (Mon=0), night (0-5h) and weekend flags."""
    ts = F.col("timestamp_reg")
    h = F.hour(ts)
    return users.select("id_user", h.alias("reg_hour"), F.weekday(ts).alias("reg_dayofweek"),
                        ((h >= 0) & (h < 6)).cast("int").alias("reg_is_night"),
                        (F.weekday(ts) >= 5).cast("int").alias("reg_is_weekend"))


def time_to_first(first_col="first_timestamp_tr", reg_col="timestamp_reg",
                  clip: bool = True, floor_seconds: bool = False) -> Column:
    """Seconds from registration to first transaction.

    Pipeline form clips at 0; notebook form floors both sides to the second
    and does not clip (E20).
    """
    a, b = F.col(first_col), F.col(reg_col)
    if floor_seconds:
        a, b = F.date_trunc("second", a), F.date_trunc("second", b)
    d = seconds_between(a, b)
    return clip_lower(d, 0.0) if clip else d


def per_tx_ratios() -> dict[str, Column]:
    """P7 ratios with the reference's epsilon guard."""
    return {
        "countries_per_tx": eps_ratio("unique_card_countries", "tx_count"),
        "errors_per_tx": eps_ratio("unique_error_types", "tx_count"),
        "holders_per_card": eps_ratio("unique_card_holders", "unique_cards_per_user"),
        "holders_per_tx": eps_ratio("unique_card_holders", "tx_count"),
        "cards_per_tx": eps_ratio("unique_cards_per_user", "tx_count"),
        "unique_amounts_per_tx": eps_ratio("unique_amounts", "tx_count"),
        "transaction_type_resign_rate": eps_ratio("resign_count", "tx_count"),
    }


def interactions() -> dict[str, Column]:
    """P6 interaction products."""
    c = F.col
    return {
        "errors_x_cards": c("unique_error_types") * c("unique_cards_per_user"),
        "holders_x_cards": c("unique_card_holders") * c("unique_cards_per_user"),
        "consec_fails_x_cards": c("max_consecutive_fails") * c("unique_cards_per_user"),
        "burst_x_cards": c("max_hourly_burst") * c("unique_cards_per_user"),
        "burst_x_errors": c("max_hourly_burst") * c("unique_error_types"),
        "consec_fails_x_holders": c("max_consecutive_fails") * c("unique_card_holders"),
        "burst_x_fail_rate": c("max_hourly_burst") * c("fail_status_coefficient"),
    }
