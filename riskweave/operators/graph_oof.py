"""Leakage-safe user-card graph features (inventory G4-G6).

G4 fraud-card exposure: share of a user's distinct cards (a NULL card counts
as one card) that some fraud user of *another* fold also used.
G5 card fraud rate: per transaction, the label mean over other folds'
transactions on the same card (NULL or unseen card -> 0); per user max and
mean over transactions.
G6: the same for test users, fitted on all train users.

Everything runs on pre-aggregated edges ``(id_user, card, n)``; per (card,
fold) sums are subtracted from per-card totals, so the five folds cost one
pass.  A hot card is one partial row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NULL_CARD = "\u0000null-card"


def _edges(tx: DataFrame, card: str) -> DataFrame:
    return (tx.groupBy("id_user", F.coalesce(F.col(card), F.lit(NULL_CARD)).alias("_card"))
            .agg(F.count(F.lit(1)).alias("_n")))


def graph_features_oof(train_users: DataFrame, train_tx: DataFrame, y: str = "is_fraud",
                       fold: str = "fold", card: str = "card_mask_hash") -> DataFrame:
    """G4 + G5 for train users (needs ``fold``); users without transactions get 0."""
    labels = train_users.select("id_user", F.col(y).cast("int").alias("_y"), fold)
    e = _edges(train_tx, card).join(labels, "id_user")
    real = F.col("_card") != F.lit(NULL_CARD)
    per = (e.groupBy("_card", fold).agg(
        F.sum(F.col("_n") * F.col("_y")).alias("_fs"),          # fraud users' tx on the card in this fold
        F.sum("_n").alias("_ns")))
    wc = Window.partitionBy("_card")
    per = (per.withColumn("_ofs", F.sum("_fs").over(wc) - F.col("_fs"))
              .withColumn("_ons", F.sum("_ns").over(wc) - F.col("_ns"))
              .select("_card", fold, "_ofs", "_ons"))
    j = e.join(per, ["_card", fold], "left")
    flag = (F.coalesce(F.col("_ofs"), F.lit(0)) > 0).cast("double")
    rate = F.when(real & (F.col("_ons") > 0), F.col("_ofs") / F.col("_ons")).otherwise(F.lit(0.0))
    per_user = (j.withColumn("_flag", flag).withColumn("_rate", rate)
                .groupBy("id_user").agg(
                    F.avg("_flag").alias("fraud_card_exposure"),
                    F.max("_rate").alias("worst_card_fraud_rate"),
                    (F.sum(F.col("_n") * F.col("_rate")) / F.sum("_n")).alias("avg_card_fraud_rate")))
    cols = ["fraud_card_exposure", "worst_card_fraud_rate", "avg_card_fraud_rate"]
    return (train_users.select("id_user", fold).join(per_user, "id_user", "left")
            .fillna(0.0, subset=cols))


def graph_features_apply(train_users: DataFrame, train_tx: DataFrame, test_users: DataFrame,
                         test_tx: DataFrame, y: str = "is_fraud", card: str = "card_mask_hash") -> DataFrame:
    """Test users scored against all train labels."""
    labels = train_users.select("id_user", F.col(y).cast("int").alias("_y"))
    tr = _edges(train_tx, card).join(labels, "id_user")
    cards = tr.groupBy("_card").agg(
        F.sum(F.col("_n") * F.col("_y")).alias("_fs"), F.sum("_n").alias("_ns"))
    te = _edges(test_tx, card).join(cards, "_card", "left")
    real = F.col("_card") != F.lit(NULL_CARD)
    flag = (F.coalesce(F.col("_fs"), F.lit(0)) > 0).cast("double")
    rate = F.when(real & (F.col("_ns") > 0), F.col("_fs") / F.col("_ns")).otherwise(F.lit(0.0))
    per_user = (te.withColumn("_flag", flag).withColumn("_rate", rate)
                .groupBy("id_user").agg(
                    F.avg("_flag").alias("fraud_card_exposure"),
                    F.max("_rate").alias("worst_card_fraud_rate"),
                    (F.sum(F.col("_n") * F.col("_rate")) / F.sum("_n")).alias("avg_card_fraud_rate")))
    cols = ["fraud_card_exposure", "worst_card_fraud_rate", "avg_card_fraud_rate"]
    return test_users.select("id_user").join(per_user, "id_user", "left").fillna(0.0, subset=cols)
