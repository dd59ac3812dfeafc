"""End-to-end pipeline (inventory M9): features -> encodings -> graph ->
anomaly score -> model -> threshold -> predictions and metrics.

One lazy plan per stage; lineage is cut (reliable checkpoint in the
cluster's ``spark.checkpoint.dir``) after the feature tables, which every
later stage reuses, so a lost executor replays from there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.anomaly import ANOMALY_FEATURES, robust_apply, robust_fit
from ..operators.encode import target_encode_columns
from ..operators.evaluate import best_threshold, classification_report, threshold_sweep
from ..operators.folds import assign_folds
from ..operators.graph_oof import graph_features_apply, graph_features_oof
from ..operators.knn import knn_stats
from ..operators.boosting import Boosted, boosted_importance, boosted_labels, boosted_oof, fit_boosted
from ..operators.model import cv_f1, select_features
from ..operators.stats import class_balance
from ..session import cut_lineage, ensure_utc
from ..sources.io import Config, metrics_table, publish, write_metrics, write_predictions
from .features import build_features

ENC_COLS = ["reg_country", "gender", "traffic_type", "domain"]
GRAPH_COLS = ["fraud_card_exposure", "worst_card_fraud_rate", "avg_card_fraud_rate"]


@dataclass
class PipelineResult:
    train: DataFrame
    test: DataFrame
    oof: DataFrame
    cv: DataFrame
    sweep: DataFrame
    best: DataFrame
    report: DataFrame
    importance: DataFrame
    submission: DataFrame
    metrics: DataFrame


def prepare(train_users, train_tx, test_users, test_tx, seed: int = 42):
    """Feature tables for train (with folds, encodings, graph, KNN) and test."""
    # written once: some twelve branches read the transactions
    train_tx, test_tx = cut_lineage(train_tx), cut_lineage(test_tx)
    f_tr = cut_lineage(build_features(train_users, train_tx).withColumn("_row", F.monotonically_increasing_id()))
    f_te = cut_lineage(build_features(test_users, test_tx))
    # folds, encodings and scores are found on the few columns they need; the wide rows meet them once, by row
    tr = cut_lineage(assign_folds(f_tr.select("_row", "id_user", "is_fraud", *ENC_COLS), seed=seed))
    tr, te = target_encode_columns(tr, f_te, ENC_COLS)
    g_tr = graph_features_oof(train_users.join(tr.select("id_user", "fold"), "id_user"), train_tx)
    g_te = graph_features_apply(train_users, train_tx, test_users, test_tx)
    tr = tr.join(g_tr.drop("fold"), "id_user", "left")
    te = te.join(g_te, "id_user", "left")
    p = robust_fit(f_tr, ANOMALY_FEATURES)
    tr_s = cut_lineage(robust_apply(f_tr.select("id_user", *ANOMALY_FEATURES), p))
    te_s = robust_apply(f_te.select("id_user", *ANOMALY_FEATURES), p)
    # one search for both sides against the training rows
    both = tr_s.withColumn("_train", F.lit(True)).unionByName(te_s.withColumn("_train", F.lit(False)))
    near = cut_lineage(knn_stats(both, tr_s, ANOMALY_FEATURES, k=10).select("id_user", "knn_avg_dist", "_train"))
    k_tr, k_te = near.filter("_train").drop("_train"), near.filter("NOT _train").drop("_train")
    added = tr.join(k_tr, "id_user", "left").drop("id_user", "is_fraud", *ENC_COLS)
    tr = cut_lineage(f_tr.join(added, "_row").drop("_row"))
    te = cut_lineage(te.join(k_te, "id_user", "left"))
    return tr, te


def fit_models(tr: DataFrame, te: DataFrame, **boosting) -> tuple[Boosted, DataFrame]:
    """The boosted models of the listed features and the out-of-fold scores of every training row, written."""
    model, rows = fit_boosted(tr, select_features(tr, te), **boosting)
    return model, cut_lineage(boosted_oof(model, rows).select("id_user", "is_fraud", "fold", "p"))


def run_pipeline(spark: SparkSession, train_users, train_tx, test_users, test_tx,
                 cfg: Config | None = None, gbt_overrides: dict | None = None) -> PipelineResult:
    cfg = cfg or Config()
    ensure_utc(spark)
    tr, te = prepare(train_users, train_tx, test_users, test_tx, cfg.seed)
    model, oof = fit_models(tr, te, **{"n_estimators": cfg.gbt_iterations, "seed": cfg.seed, **(gbt_overrides or {})})
    cv = cv_f1(oof)
    sweep = threshold_sweep(oof)
    best = best_threshold(sweep)
    t = best.first()["best_threshold"]
    report = classification_report(oof, t)
    importance = boosted_importance(spark, model)
    submission = boosted_labels(model, te, t)
    metrics = metrics_table(spark, best, class_balance(train_users))
    if cfg.output_dir:
        write_predictions(submission, f"{cfg.output_dir}/submission")
        write_metrics(metrics, f"{cfg.output_dir}/metrics")
        if cfg.publish_uri:
            publish(submission, cfg.publish_uri)
    return PipelineResult(tr, te, oof, cv, sweep, best, report, importance, submission, metrics)
