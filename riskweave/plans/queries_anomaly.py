"""Registry entries: robust scaling, exact KNN, LOF, Isolation Forest, anomaly quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.anomaly import (ANOMALY_FEATURES, EDA_ANOMALY_FEATURES, anomaly_quality, isolation_forest, lof, robust_fit,
                                 robust_apply)
from ..operators.association import compare_scores
from ..operators.knn import TrainNeighbours, knn_stats
from ..operators.stats import describe_num
from ..session import cut_lineage
from .features import build_features
from .registry import fixture, query

AF = ANOMALY_FEATURES


def split_features(fx):
    # the training side is read by every query here: its transactions are written once, some ten branches read them
    tr = build_features(fx.train_users, cut_lineage(fx.train_transactions))
    te = build_features(fx.test_users, fx.test_transactions)
    return tr, te


def scaled(fx):
    tr, te = split_features(fx)
    tr = cut_lineage(tr)
    p = robust_fit(tr, AF)
    return robust_apply(tr, p), robust_apply(te, p)


def scaled_ctes(features) -> str:
    quartiles = ", ".join(
        f"quantile_cont(coalesce({c}, 0), 0.25) AS {c}_q1, quantile_cont(coalesce({c}, 0), 0.5) AS {c}_md, "
        f"quantile_cont(coalesce({c}, 0), 0.75) AS {c}_q3" for c in features)
    columns = ", ".join(f"(coalesce(f.{c}, 0) - q.{c}_md) / CASE WHEN q.{c}_q3 - q.{c}_q1 = 0 THEN 1 "
                        f"ELSE q.{c}_q3 - q.{c}_q1 END AS {c}" for c in features)
    return f"""
qs AS (SELECT {quartiles} FROM feat WHERE id_user % 5 <> 4),
sc AS (SELECT f.id_user, f.is_fraud, CASE WHEN f.id_user % 5 = 4 THEN 'test' ELSE 'train' END AS split, {columns}
       FROM feat f CROSS JOIN qs q),
scv AS (SELECT *, [{", ".join(features)}] AS v FROM sc)"""


def _dist(features) -> str:
    return "sqrt(" + " + ".join(f"power(a.{c} - b.{c}, 2)" for c in features) + ")"


def knn_ctes(features) -> str:
    return scaled_ctes(features) + f""",
kp AS (SELECT a.id_user, a.split, {_dist(features)} AS dist FROM scv a JOIN scv b ON b.split = 'train'),
kr AS (SELECT *, row_number() OVER (PARTITION BY id_user ORDER BY dist) AS rn FROM kp),
knn AS (SELECT id_user, split, sum(dist) / 10 AS knn_avg_dist, max(dist) AS knn_max_dist,
               max(CASE WHEN rn = 5 THEN dist END) AS knn_5th_dist FROM kr WHERE rn <= 10 GROUP BY 1, 2)"""


def lof_ctes(features, scaled: str | None = None) -> str:
    return (scaled or scaled_ctes(features)) + f""",
tv AS (SELECT * FROM scv WHERE split = 'train'),
lp AS (SELECT a.id_user, b.id_user AS nid, {_dist(features)} AS dist,
              row_number() OVER (PARTITION BY a.id_user ORDER BY round({_dist(features)}, 9), b.v, b.id_user) AS rn
       FROM tv a JOIN tv b ON a.id_user <> b.id_user),
ln AS (SELECT * FROM lp WHERE rn <= 20),
kd AS (SELECT id_user, max(dist) AS kd FROM ln GROUP BY 1),
lrd AS (SELECT ln.id_user, 1 / (avg(greatest(kd.kd, ln.dist)) + 1e-10) AS lrd
        FROM ln JOIN kd ON ln.nid = kd.id_user GROUP BY 1),
lofs AS (SELECT ln.id_user, avg(o.lrd) / max(p.lrd) AS lof_score
         FROM ln JOIN lrd o ON ln.nid = o.id_user JOIN lrd p ON ln.id_user = p.id_user GROUP BY 1),
lofl AS (SELECT l.id_user, l.lof_score,
                CASE WHEN -l.lof_score < (SELECT quantile_cont(-lof_score, 0.038) FROM lofs) THEN -1 ELSE 1 END
                  AS lof_label FROM lofs l)"""


SCALED_CTES, KNN_CTES, LOF_CTES = scaled_ctes(AF), knn_ctes(AF), lof_ctes(AF)


@query("g07_robust_scale", f"SELECT * FROM (WITH {SCALED_CTES} SELECT id_user, split, "
       + ", ".join(AF) + " FROM sc) AS y")
def q_robust(spark, sf_dir):
    tr, te = scaled(fixture(spark, sf_dir))
    cols = ["id_user", "split"] + AF
    return (tr.withColumn("split", F.lit("train")).select(*cols)
            .unionByName(te.withColumn("split", F.lit("test")).select(*cols)))


@query("g08_g09_knn_distance", f"SELECT * FROM (WITH {KNN_CTES} SELECT * FROM knn) AS y")
def q_knn(spark, sf_dir):
    tr, te = scaled(fixture(spark, sf_dir))
    cols = ["id_user", *AF]
    both = cut_lineage(tr.select(*cols, F.lit("train").alias("split")).unionByName(te.select(*cols, F.lit("test").alias("split"))))
    return knn_stats(both, tr, AF, k=10).select("id_user", "split", "knn_avg_dist", "knn_max_dist", "knn_5th_dist")


@query("g08_knn_by_class", f"""SELECT * FROM (WITH {KNN_CTES}
SELECT sc.is_fraud, count(*) AS count, avg(knn_avg_dist) AS mean, stddev_samp(knn_avg_dist) AS std, min(knn_avg_dist) AS min,
       quantile_cont(knn_avg_dist, 0.25) AS p25, quantile_cont(knn_avg_dist, 0.5) AS p50, quantile_cont(knn_avg_dist, 0.75) AS p75,
       max(knn_avg_dist) AS max
FROM knn JOIN sc ON knn.id_user = sc.id_user WHERE knn.split = 'train' GROUP BY 1) AS y""")
def q_knn_by_class(spark, sf_dir):
    tr, _ = scaled(fixture(spark, sf_dir))
    return describe_num(cut_lineage(knn_stats(tr, tr, AF, k=10)), "knn_avg_dist", by="is_fraud")


@query("j06_approximate_knn")
def q_knn_approximate(spark, sf_dir):
    """Both modes side by side; the approximate distances are never below the exact ones."""
    tr, _ = scaled(fixture(spark, sf_dir))
    near = knn_stats(tr, tr, AF, k=10, mode="approximate").select("id_user", *[
        F.col(c).alias(f"approximate_{c}") for c in ("knn_avg_dist", "knn_max_dist")])
    return (knn_stats(tr, tr, AF, k=10).select("id_user", "knn_avg_dist", "knn_max_dist").join(near, "id_user"))


# LOF reaches ~1e13 next to duplicate clusters (sklearn's 1e-10 density guard);
# the checked query reports ln(LOF), which is stable to 1e-15 relative.
@query("g11_lof", f"SELECT * FROM (WITH {LOF_CTES} SELECT id_user, ln(lof_score) AS ln_lof_score, lof_label FROM lofl) AS y")
def q_lof(spark, sf_dir):
    tr, _ = scaled(fixture(spark, sf_dir))
    return lof(tr, AF, k=20).select("id_user", F.ln("lof_score").alias("ln_lof_score"), "lof_label")


# The raw score, rounded relatively: its power of ten and what that leaves.
@query("g11_lof_raw", f"""SELECT * FROM (WITH {LOF_CTES}
SELECT id_user, CAST(floor(log10(lof_score)) AS BIGINT) AS lof_exponent, lof_score / power(10, floor(log10(lof_score))) AS lof_mantissa
FROM lofl) AS y""")
def q_lof_raw(spark, sf_dir):
    tr, _ = scaled(fixture(spark, sf_dir))
    power = F.floor(F.log10("lof_score"))
    return lof(tr, AF, k=20).select("id_user", power.cast("long").alias("lof_exponent"),
                                    (F.col("lof_score") / F.pow(F.lit(10.0), power)).alias("lof_mantissa"))


# The notebook's own set of 23 columns, every distance score of one neighbour table.
@query("d01_eda_anomaly_scores", f"""SELECT * FROM (WITH {lof_ctes(EDA_ANOMALY_FEATURES, knn_ctes(EDA_ANOMALY_FEATURES))}
SELECT knn.id_user, knn_avg_dist, knn_max_dist, knn_5th_dist, ln(lof_score) AS ln_lof_score, lof_label
FROM knn JOIN lofl ON knn.id_user = lofl.id_user WHERE knn.split = 'train') AS y""")
def q_eda_scores(spark, sf_dir):
    tr = cut_lineage(build_features(fixture(spark, sf_dir).train_users, fixture(spark, sf_dir).train_transactions))
    tr = cut_lineage(robust_apply(tr, robust_fit(tr, EDA_ANOMALY_FEATURES)))
    near = TrainNeighbours(tr, EDA_ANOMALY_FEATURES, depth=21)
    scores = near.stats(k=10, df=lof(tr, EDA_ANOMALY_FEATURES, k=20, neighbours=near))
    return scores.select("id_user", "knn_avg_dist", "knn_max_dist", "knn_5th_dist", F.ln("lof_score").alias("ln_lof_score"), "lof_label")


@query("g12_anomaly_quality", f"""SELECT * FROM (WITH {LOF_CTES}
SELECT CAST(sum(CASE WHEN lof_label = -1 THEN 1 ELSE 0 END) AS BIGINT) AS anomalies,
       CAST(sum(is_fraud) AS BIGINT) AS frauds,
       CAST(sum(CASE WHEN lof_label = -1 THEN is_fraud ELSE 0 END) AS BIGINT) AS tp,
       sum(CASE WHEN lof_label = -1 THEN is_fraud ELSE 0 END) / sum(CASE WHEN lof_label = -1 THEN 1 ELSE 0 END) AS precision,
       sum(CASE WHEN lof_label = -1 THEN is_fraud ELSE 0 END) / sum(is_fraud) AS recall,
       2 * (sum(CASE WHEN lof_label = -1 THEN is_fraud ELSE 0 END) / sum(CASE WHEN lof_label = -1 THEN 1 ELSE 0 END))
         * (sum(CASE WHEN lof_label = -1 THEN is_fraud ELSE 0 END) / sum(is_fraud))
         / ((sum(CASE WHEN lof_label = -1 THEN is_fraud ELSE 0 END) / sum(CASE WHEN lof_label = -1 THEN 1 ELSE 0 END))
            + (sum(CASE WHEN lof_label = -1 THEN is_fraud ELSE 0 END) / sum(is_fraud)) + 1e-6) AS f1
FROM lofl JOIN sc ON lofl.id_user = sc.id_user) AS y""")
def q_anomaly_quality(spark, sf_dir):
    tr, _ = scaled(fixture(spark, sf_dir))
    return anomaly_quality(lof(tr, AF, k=20), "lof_label")


@query("g12_forest_quality")
def q_forest_quality(spark, sf_dir):
    tr, _ = scaled(fixture(spark, sf_dir))
    return anomaly_quality(isolation_forest(tr, AF, n_trees=200), "iso_label")


@query("g10_isolation_forest")
def q_iforest(spark, sf_dir):
    tr, _ = scaled(fixture(spark, sf_dir))
    return isolation_forest(tr, AF, n_trees=200).select("id_user", "iso_score", "iso_label")


_T8_METHODS = {"KNN avg dist": ("knn_avg_dist", False), "KNN max dist": ("knn_max_dist", False)}


@query("t08_compare_scores", f"""SELECT * FROM (WITH {KNN_CTES},
j AS (SELECT knn.*, sc.is_fraud FROM knn JOIN sc ON knn.id_user = sc.id_user WHERE knn.split = 'train'),
l AS (SELECT 'KNN avg dist' AS method, knn_avg_dist AS value, is_fraud FROM j
      UNION ALL SELECT 'KNN max dist', knn_max_dist, is_fraud FROM j),
r AS (SELECT method, is_fraud, value, rank() OVER (PARTITION BY method ORDER BY value) AS rk,
             count(*) OVER (PARTITION BY method, value) AS ties FROM l),
a AS (SELECT method, sum(is_fraud) AS n1, count(*) - sum(is_fraud) AS n0,
             sum(CASE WHEN is_fraud = 1 THEN rk + (ties - 1) / 2.0 END) AS rs,
             CASE WHEN stddev_samp(value) > 0 THEN corr(value, is_fraud) END AS corr FROM r GROUP BY 1)
SELECT method, (rs - n1 * (n1 + 1) / 2.0) / (n1 * n0) AS auc, corr,
       (rs - n1 * (n1 + 1) / 2.0) / (n1 * n0) > 0.55 AS recommend FROM a) AS y""")
def q_compare(spark, sf_dir):
    tr, _ = scaled(fixture(spark, sf_dir))
    return compare_scores(cut_lineage(knn_stats(tr, tr, AF, k=10)), _T8_METHODS)


@query("t08_compare_scores_with_iforest")
def q_compare_all(spark, sf_dir):
    tr, _ = scaled(fixture(spark, sf_dir))
    k = cut_lineage(isolation_forest(cut_lineage(knn_stats(tr, tr, AF, k=10)), AF, n_trees=200))
    methods = {"Isolation Forest": ("iso_score", True), **_T8_METHODS}
    return compare_scores(k, methods)
