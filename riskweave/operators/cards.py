"""User-card graph rollups (inventory A19-A21).

Transactions are reduced to distinct edges ``(id_user, card, n, n_fail)``
first.  Card statistics are aggregated from the edges (one partial row per
map task even for a hot card), joined back to the edges (AQE splits a hot
card's edge partition) and rolled up per user with transaction weights:
``mean over rows = sum(n * v) / sum(n)``.  Null cards are left out, like the
reference's group-by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def card_edges(tx: DataFrame, card: str = "card_mask_hash") -> DataFrame:
    return (tx.filter(F.col(card).isNotNull())
            .groupBy("id_user", card)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col("status") == "fail").alias("n_fail")))


def card_stats(edges: DataFrame, card: str = "card_mask_hash") -> DataFrame:
    return edges.groupBy(card).agg(
        F.count(F.lit(1)).alias("users_per_card"),
        F.sum("n").alias("card_total_tx"),
        (F.sum("n_fail") / F.sum("n")).alias("card_fail_rate"))


def card_rollups(tx: DataFrame, card: str = "card_mask_hash") -> DataFrame:
    """Per user: max and transaction-weighted mean of users-per-card, card fail
    rate and card activity, over the user's non-null cards."""
    edges = card_edges(tx, card)
    j = edges.join(card_stats(edges, card), card)
    n = F.col("n")
    return j.groupBy("id_user").agg(
        F.max("users_per_card").cast("double").alias("max_users_sharing_card"),
        (F.sum(n * F.col("users_per_card")) / F.sum(n)).alias("avg_users_sharing_card"),
        F.max("card_fail_rate").alias("worst_card_fail_rate"),
        (F.sum(n * F.col("card_fail_rate")) / F.sum(n)).alias("avg_card_fail_rate"),
        F.max("card_total_tx").cast("double").alias("most_active_card_tx"),
        (F.sum(n * F.col("card_total_tx")) / F.sum(n)).alias("avg_card_tx"))
