"""Registry entries: model matrix, GBT scores, CV, sweep, report, importance,
predictions, pipeline metrics (M1-M9, L5), and scans (S1, S3, S4).

Fixed-score queries (sweep, best threshold, report) score train users by
``fail_status_coefficient`` so they are checkable by SQL; the boosting queries are
rows-only (boosting has no SQL) and run the reference's 400 rounds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.boosting import boosted_importance, boosted_labels, fit_boosted
from ..operators.evaluate import best_threshold, classification_report, f1_at, threshold_sweep
from ..operators.model import FEATURE_COLS, cv_f1, model_matrix, select_features
from ..sources.io import load_table, parse_ts, parse_ts_iso
from .features import build_features
from .oracle import feature_ctes
from .pipeline import ENC_COLS, GRAPH_COLS, fit_models, prepare, run_pipeline
from .queries_anomaly import KNN_CTES
from .queries_encode import _GRAPH_ORACLE, FOLDS_SQL, _oof_sql
from .registry import fixture, query


def _prepared(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return prepare(fx.train_users, fx.train_transactions, fx.test_users, fx.test_transactions)


def _fixed_scores(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    f = build_features(fx.train_users, fx.train_transactions)
    return f.select("id_user", "is_fraud", F.col("fail_status_coefficient").alias("p"))


_SCORED = "(SELECT id_user, is_fraud, fail_status_coefficient AS p FROM feat WHERE id_user % 5 <> 4)"
_SWEEP = f"""(SELECT g.i, CAST(0.05 AS DOUBLE) + CAST(0.01 AS DOUBLE) * g.i AS threshold,
    CAST(sum(CASE WHEN s.p >= CAST(0.05 AS DOUBLE) + CAST(0.01 AS DOUBLE) * g.i AND s.is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    CAST(sum(CASE WHEN s.p >= CAST(0.05 AS DOUBLE) + CAST(0.01 AS DOUBLE) * g.i AND s.is_fraud <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(sum(CASE WHEN NOT (s.p >= CAST(0.05 AS DOUBLE) + CAST(0.01 AS DOUBLE) * g.i) AND s.is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM (SELECT range AS i FROM range(65)) g CROSS JOIN {_SCORED} s GROUP BY g.i)"""


@query("m05_threshold_sweep", f"""
SELECT i, threshold, tp, fp, fn, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1
FROM {_SWEEP}""")
def q_sweep(spark, sf_dir):
    return threshold_sweep(_fixed_scores(spark, sf_dir))


@query("l05_best_threshold", f"""
SELECT round(threshold, 2) AS best_threshold, f1 AS best_f1 FROM (
  SELECT i, threshold, CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1
  FROM {_SWEEP}) ORDER BY f1 DESC, i LIMIT 1""")
def q_best(spark, sf_dir):
    return best_threshold(threshold_sweep(_fixed_scores(spark, sf_dir)))


@query("m06_classification_report", f"""
SELECT * FROM (WITH c AS (SELECT
    sum(CASE WHEN p >= 0.5 AND is_fraud = 1 THEN 1 ELSE 0 END) AS tp1,
    sum(CASE WHEN p >= 0.5 AND is_fraud = 0 THEN 1 ELSE 0 END) AS fp1,
    sum(CASE WHEN p < 0.5 AND is_fraud = 1 THEN 1 ELSE 0 END) AS fn1,
    sum(CASE WHEN p < 0.5 AND is_fraud = 0 THEN 1 ELSE 0 END) AS tn1 FROM {_SCORED}),
m AS (SELECT *,
    CASE WHEN tp1 + fp1 > 0 THEN tp1 / (tp1 + fp1) ELSE 0 END AS p1,
    CASE WHEN tp1 + fn1 > 0 THEN tp1 / (tp1 + fn1) ELSE 0 END AS r1,
    CASE WHEN tn1 + fn1 > 0 THEN tn1 / (tn1 + fn1) ELSE 0 END AS p0,
    CASE WHEN tn1 + fp1 > 0 THEN tn1 / (tn1 + fp1) ELSE 0 END AS r0,
    tp1 + fn1 AS s1, tn1 + fp1 AS s0 FROM c),
f AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0,
                CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1 FROM m)
SELECT 'legit' AS label, p0 AS precision, r0 AS recall, f0 AS f1, CAST(s0 AS DOUBLE) AS support FROM f
UNION ALL SELECT 'fraud', p1, r1, f1, s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, (tn1 + tp1) / (s0 + s1), s0 + s1 FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM f
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
                 (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM f) AS y""")
def q_report(spark, sf_dir):
    return classification_report(_fixed_scores(spark, sf_dir), 0.5)


def _matrix_sql() -> str:
    """Every feature of the training users, their out-of-fold encodings and card scores, and the neighbour distance."""
    source = {"knn_avg_dist": "knn.knn_avg_dist", "status_changes_per_tx": "f.status_changes / (f.tx_count + 1e-6)",
              **{c: f"g.{c}" for c in GRAPH_COLS}, **{f"{c}_enc": f"e{k}.{c}_enc" for k, c in enumerate(ENC_COLS)}}
    columns = ", ".join(f"coalesce(CAST({source.get(c, f'f.{c}')} AS DOUBLE), 0) AS {c}" for c in FEATURE_COLS)
    encodings = ", ".join(f"e{k} AS ({_oof_sql(c)})" for k, c in enumerate(ENC_COLS))
    joins = " ".join(f"JOIN e{k} ON e{k}.id_user = f.id_user" for k in range(len(ENC_COLS)))
    return f"""SELECT * FROM (WITH {feature_ctes("train_users", "train_tx", "m_").strip().rstrip(",")}, tr AS ({FOLDS_SQL}),
{encodings}, g AS (SELECT * FROM (WITH {_GRAPH_ORACLE})), {KNN_CTES.strip()}
SELECT f.id_user, f.is_fraud, tr.fold, {columns} FROM m_feat f JOIN tr ON tr.id_user = f.id_user {joins}
JOIN g ON g.id_user = f.id_user JOIN knn ON knn.id_user = f.id_user AND knn.split = 'train') AS y"""


@query("m01_model_matrix", _matrix_sql())
def q_matrix(spark, sf_dir):
    tr, te = _prepared(spark, sf_dir)
    cols = select_features(tr, te)
    return model_matrix(tr, cols).drop("features")


@query("m02_m04_oof_scores")
def q_oof(spark, sf_dir):
    return fit_models(*_prepared(spark, sf_dir), with_final=False)[1]


@query("m03_cv_f1")
def q_cv(spark, sf_dir):
    return cv_f1(fit_models(*_prepared(spark, sf_dir), with_final=False)[1])


# The reference prints F1 at the default cut beside the best one.
@query("m05_default_f1")
def q_default_f1(spark, sf_dir):
    return f1_at(fit_models(*_prepared(spark, sf_dir), with_final=False)[1], 0.5)


@query("m07_feature_importance")
def q_importance(spark, sf_dir):
    tr, te = _prepared(spark, sf_dir)
    model, _ = fit_boosted(tr, select_features(tr, te), with_folds=False)
    return boosted_importance(spark, model, top=25)


@query("m08_predictions")
def q_predictions(spark, sf_dir):
    tr, te = _prepared(spark, sf_dir)
    model, oof = fit_models(tr, te)
    return boosted_labels(model, te, best_threshold(threshold_sweep(oof)).first()["best_threshold"])


@query("m09_pipeline_metrics")
def q_pipeline(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return run_pipeline(spark, fx.train_users, fx.train_transactions, fx.test_users, fx.test_transactions).metrics


@query("s01_load_table", "SELECT * FROM customer")
def q_load(spark, sf_dir):
    return load_table(spark, "customer", path=f"{sf_dir}/customer.parquet")


@query("s03_parse_ts", """
SELECT event_id, epoch_us(TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP)) AS ts_us,
       epoch_us(TRY_CAST(props AS TIMESTAMP)) AS props_us FROM events""")
def q_parse(spark, sf_dir):
    ev = load_table(spark, "events", path=f"{sf_dir}/events.parquet")
    ev = ev.withColumn("ts", F.col("ts").cast("string"))
    p = parse_ts(ev, ["ts", "props"])
    return p.select("event_id", F.unix_micros("ts").alias("ts_us"), F.unix_micros("props").alias("props_us"))


@query("s04_parse_ts_iso", """
SELECT event_id, epoch(date_trunc('second', CAST(CAST(ts AS VARCHAR) AS TIMESTAMP))) AS ts_s FROM events""")
def q_parse_iso(spark, sf_dir):
    ev = load_table(spark, "events", path=f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("string"))
    return parse_ts_iso(ev, "ts", strict=True, floor_seconds=True).select(
        "event_id", F.unix_seconds("ts").cast("double").alias("ts_s"))
