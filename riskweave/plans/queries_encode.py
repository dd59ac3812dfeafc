"""Registry entries: folds (W9), encodings (G1-G3, G13, T7), graph OOF."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import email_domain
from ..operators.encode import (frequency_encode_columns, target_encode_apply, target_encode_columns,
                                target_mean_encode)
from ..operators.folds import assign_folds
from ..operators.graph_oof import graph_features_apply, graph_features_oof
from .registry import fixture, query

ENC_COLS = ["reg_country", "gender", "traffic_type", "domain"]
# Fixed value: the eleven categorical columns of the notebook's association study.
CAT_COLS = ["gender", "reg_country", "traffic_type", "domain", "status", "transaction_type",
            "card_brand", "card_type", "currency", "card_country", "payment_country"]

FOLDS_SQL = """
SELECT *, CAST((row_number() OVER (PARTITION BY is_fraud
          ORDER BY md5(concat(CAST(id_user AS VARCHAR), ':42')), id_user) - 1) % 5 AS INTEGER) AS fold,
       coalesce(split(email, '@')[2], 'missing') AS domain
FROM train_users
"""


def train_with_folds(fx):
    return assign_folds(fx.train_users).withColumn("domain", email_domain("email"))


def _with_folds(sql: str) -> str:
    # the oracle prelude already opened a WITH list: add the fold CTE in front
    return f"SELECT * FROM (WITH tr AS ({FOLDS_SQL}) {sql}) AS x"


@query("w09_folds", _with_folds("SELECT id_user, is_fraud, fold FROM tr"))
def q_folds(spark, sf_dir):
    return assign_folds(fixture(spark, sf_dir).train_users).select("id_user", "is_fraud", "fold")


def _oof_sql(col):
    return f"""
SELECT r.id_user, CASE WHEN count(x.id_user) > 0
    THEN (sum(x.is_fraud) + 50 * max(g.g)) / (count(x.id_user) + 50) ELSE max(g.g) END AS {col}_enc
FROM tr r CROSS JOIN (SELECT avg(is_fraud) AS g FROM tr) g
LEFT JOIN tr x ON x.{col} = r.{col} AND x.fold <> r.fold
GROUP BY r.id_user"""


@query("g01_target_encode_oof", _with_folds(
    "SELECT a.id_user, " + ", ".join(f"e{i}.{c}_enc" for i, c in enumerate(ENC_COLS)) + " FROM tr a "
    + " ".join(f"JOIN ({_oof_sql(c)}) e{i} ON a.id_user = e{i}.id_user" for i, c in enumerate(ENC_COLS))))
def q_target_oof(spark, sf_dir):
    tr = train_with_folds(fixture(spark, sf_dir))
    out, _ = target_encode_columns(tr, tr.limit(0), ENC_COLS)
    return out.select("id_user", *[f"{c}_enc" for c in ENC_COLS])


def _apply_sql(col):
    return f"""
SELECT t.id_user, coalesce((s.pos + 50 * g.g) / (s.cnt + 50), g.g) AS {col}_enc
FROM te t CROSS JOIN (SELECT avg(is_fraud) AS g FROM tr) g
LEFT JOIN (SELECT {col}, count(*) AS cnt, sum(is_fraud) AS pos FROM tr WHERE {col} IS NOT NULL GROUP BY 1) s
  ON t.{col} = s.{col}"""


_TE = "te AS (SELECT *, coalesce(split(email, '@')[2], 'missing') AS domain FROM test_users)"


@query("g02_target_encode_apply", _with_folds(
    f"SELECT * FROM (WITH {_TE} SELECT a.id_user, "
    + ", ".join(f"e{i}.{c}_enc" for i, c in enumerate(ENC_COLS)) + " FROM te a "
    + " ".join(f"JOIN ({_apply_sql(c)}) e{i} ON a.id_user = e{i}.id_user" for i, c in enumerate(ENC_COLS))
    + ") AS y"))
def q_target_apply(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    tr = fx.train_users.withColumn("domain", email_domain("email"))
    te = fx.test_users.withColumn("domain", email_domain("email"))
    out = te
    for c in ENC_COLS:
        out = target_encode_apply(tr, out, c)
    return out.select("id_user", *[f"{c}_enc" for c in ENC_COLS])


@query("g03_encode_train_and_test", _with_folds(
    f"SELECT * FROM (WITH {_TE} "
    "SELECT a.id_user, " + ", ".join(f"e{i}.{c}_enc" for i, c in enumerate(ENC_COLS)) + " FROM tr a "
    + " ".join(f"JOIN ({_oof_sql(c)}) e{i} ON a.id_user = e{i}.id_user" for i, c in enumerate(ENC_COLS))
    + " UNION ALL SELECT a.id_user, " + ", ".join(f"e{i}.{c}_enc" for i, c in enumerate(ENC_COLS)) + " FROM te a "
    + " ".join(f"JOIN ({_apply_sql(c)}) e{i} ON a.id_user = e{i}.id_user" for i, c in enumerate(ENC_COLS))
    + ") AS y"))
def q_encode_both(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    tr = train_with_folds(fx)
    te = fx.test_users.withColumn("domain", email_domain("email"))
    tr, te = target_encode_columns(tr, te, ENC_COLS)
    cols = ["id_user"] + [f"{c}_enc" for c in ENC_COLS]
    return tr.select(*cols).unionByName(te.select(*cols))


@query("g13_frequency_encode", """
SELECT u.id_user, """ + ", ".join(
    f"coalesce(f{i}.fr, 0) AS {c}_freq" for i, c in enumerate(ENC_COLS)) + """
FROM (SELECT *, coalesce(split(email, '@')[2], 'missing') AS domain FROM users) u """ + " ".join(
    f"""LEFT JOIN (SELECT {c} AS v, count(*) / sum(count(*)) OVER () AS fr
        FROM (SELECT *, coalesce(split(email, '@')[2], 'missing') AS domain FROM users)
        WHERE {c} IS NOT NULL GROUP BY 1) f{i} ON u.{c} = f{i}.v""" for i, c in enumerate(ENC_COLS)))
def q_frequency(spark, sf_dir):
    u = fixture(spark, sf_dir).users.withColumn("domain", email_domain("email"))
    return frequency_encode_columns(u, ENC_COLS).select("id_user", *[f"{c}_freq" for c in ENC_COLS])


_MERGED = """m AS (SELECT t.*, u.email, u.gender, u.reg_country, u.traffic_type, u.timestamp_reg, u.is_fraud,
                coalesce(split(u.email, '@')[2], 'missing') AS domain
         FROM transactions t JOIN users u ON t.id_user = u.id_user)"""


@query("t07_target_mean_encode", "SELECT * FROM (WITH " + _MERGED + " SELECT m.id_tx, " + ", ".join(
    f"coalesce(r{i}.v, (SELECT avg(is_fraud) FROM m)) AS {c}_te" for i, c in enumerate(CAT_COLS))
    + " FROM m " + " ".join(
        f"LEFT JOIN (SELECT {c} AS k, avg(is_fraud) AS v FROM m WHERE {c} IS NOT NULL GROUP BY 1) r{i} "
        f"ON m.{c} = r{i}.k" for i, c in enumerate(CAT_COLS)) + ") AS y")
def q_target_mean(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    merged = label_transactions(fx.transactions, fx.users)
    return target_mean_encode(merged, CAT_COLS).select("id_tx", *[f"{c}_te" for c in CAT_COLS])


def label_transactions(tx, users):
    """Transactions inner-joined to their user's attributes."""
    u = users.select("id_user", "email", "gender", "reg_country", "traffic_type", "timestamp_reg", "is_fraud")
    return tx.join(u, "id_user").withColumn("domain", email_domain("email"))


_GRAPH_ORACLE = """
ftx AS (SELECT t.id_user, coalesce(t.card_mask_hash, '<null>') AS ck, t.card_mask_hash, f.is_fraud, f.fold
        FROM train_tx t JOIN tr f ON t.id_user = f.id_user),
uc AS (SELECT DISTINCT id_user, fold, ck FROM ftx),
ffc AS (SELECT DISTINCT ck, fold FROM ftx WHERE is_fraud = 1),
expo AS (SELECT uc.id_user, avg(CASE WHEN EXISTS (SELECT 1 FROM ffc WHERE ffc.ck = uc.ck AND ffc.fold <> uc.fold)
                                THEN 1.0 ELSE 0.0 END) AS fraud_card_exposure FROM uc GROUP BY 1),
cf AS (SELECT card_mask_hash, fold, count(*) AS n, sum(is_fraud) AS s FROM ftx
       WHERE card_mask_hash IS NOT NULL GROUP BY 1, 2),
rated AS (SELECT x.id_user, coalesce((SELECT sum(s) / sum(n) FROM cf WHERE cf.card_mask_hash = x.card_mask_hash
                                      AND cf.fold <> x.fold), 0) AS cfr FROM ftx x),
rr AS (SELECT id_user, max(cfr) AS worst_card_fraud_rate, avg(cfr) AS avg_card_fraud_rate FROM rated GROUP BY 1)
SELECT tr.id_user, tr.fold, coalesce(e.fraud_card_exposure, 0) AS fraud_card_exposure,
       coalesce(rr.worst_card_fraud_rate, 0) AS worst_card_fraud_rate,
       coalesce(rr.avg_card_fraud_rate, 0) AS avg_card_fraud_rate
FROM tr LEFT JOIN expo e ON tr.id_user = e.id_user LEFT JOIN rr ON tr.id_user = rr.id_user
"""


@query("g04_g05_graph_oof", _with_folds("SELECT * FROM (WITH " + _GRAPH_ORACLE + ") AS y"))
def q_graph_oof(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return graph_features_oof(assign_folds(fx.train_users), fx.train_transactions)


@query("g06_graph_apply", """
SELECT * FROM (WITH
ltx AS (SELECT t.*, u.is_fraud FROM train_tx t JOIN train_users u ON t.id_user = u.id_user),
fc AS (SELECT DISTINCT coalesce(card_mask_hash, '<null>') AS ck FROM ltx WHERE is_fraud = 1),
cr AS (SELECT card_mask_hash, avg(is_fraud) AS r FROM ltx WHERE card_mask_hash IS NOT NULL GROUP BY 1),
uc AS (SELECT DISTINCT id_user, coalesce(card_mask_hash, '<null>') AS ck FROM test_tx),
expo AS (SELECT uc.id_user, avg(CASE WHEN fc.ck IS NOT NULL THEN 1.0 ELSE 0.0 END) AS e
         FROM uc LEFT JOIN fc ON uc.ck = fc.ck GROUP BY 1),
rt AS (SELECT t.id_user, max(coalesce(cr.r, 0)) AS w, avg(coalesce(cr.r, 0)) AS a
       FROM test_tx t LEFT JOIN cr ON t.card_mask_hash = cr.card_mask_hash GROUP BY 1)
SELECT u.id_user, coalesce(expo.e, 0) AS fraud_card_exposure, coalesce(rt.w, 0) AS worst_card_fraud_rate,
       coalesce(rt.a, 0) AS avg_card_fraud_rate
FROM test_users u LEFT JOIN expo ON u.id_user = expo.id_user LEFT JOIN rt ON u.id_user = rt.id_user) AS y
""")
def q_graph_apply(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return graph_features_apply(fx.train_users, fx.train_transactions, fx.test_users, fx.test_transactions)
