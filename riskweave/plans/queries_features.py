"""Registry entries for per-user features (A*, W1-W8, P1-P9, P18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import email_domain, email_local
from ..operators.user_aggs import registration_time_features, time_to_first, type_shares
from .features import build_features
from .registry import fixture, query

# feature queries: name -> output columns (besides id_user); each is a slice of
# build_features (Catalyst prunes the branches a slice does not use).
FEATURE_SLICES = {
    "a01_tx_count": ["tx_count"],
    "a02_amount_stats": ["amount_mean", "amount_std", "amount_max", "amount_min", "amount_median",
                         "amount_sum", "amount_range"],
    "a03_amount_cv": ["amount_cv"],
    "a04_distinct_counts": ["unique_cards_per_user", "unique_card_holders", "unique_error_types",
                            "unique_card_brands", "unique_card_types", "unique_card_countries"],
    "a05_fail_rate": ["fail_status_coefficient"],
    "a06_fraud_error": ["fraud_error_rate", "fraud_error_count"],
    "a07_error_rates": ["error_antifraud_rate", "error_do_not_honor_rate", "error_fraud_rate",
                        "error_cvv_error_rate", "error_insufficient_funds_error_rate",
                        "error_3ds_error_rate", "error_card_problem_rate"],
    "a08_cvv_error_coef": ["cvv_error_coef"],
    "a09_cp_mismatch": ["country_CP_missmatch_coef"],
    "a10_creg_mismatch": ["country_CReg_missmatch"],
    "a11_card_init_rate": ["tx_type_card_init_rate"],
    "a12_resign_rate": ["resign_count", "transaction_type_resign_rate"],
    "a15_unique_amounts": ["unique_amounts", "unique_amounts_per_tx"],
    "a16_hour_std": ["hour_std"],
    "a17_holder_name": ["holder_name_length", "holder_name_words"],
    "a18_hourly_burst": ["max_hourly_burst"],
    "a19_card_sharing": ["max_users_sharing_card", "avg_users_sharing_card"],
    "a20_card_fail_rate": ["worst_card_fail_rate", "avg_card_fail_rate"],
    "a21_card_activity": ["most_active_card_tx", "avg_card_tx"],
    "a22_amount_entropy": ["amount_entropy"],
    "a23_mode_concentration": ["amount_mode_concentration"],
    "a24_small_amount_rate": ["small_amount_rate"],
    "a25_name_in_email": ["name_in_email"],
    "a26_unique_first_names": ["unique_first_names"],
    "a38_gap_stats": ["avg_time_between_tx", "min_time_between_tx", "std_time_between_tx"],
    "w02_min_gap": ["min_time_between_tx"],
    "w03_fail_streak": ["max_consecutive_fails"],
    "w04_first_tx_failed": ["first_tx_failed"],
    "w05_fails_before_success": ["fails_before_first_success"],
    "w06_status_changes": ["status_changes", "status_changes_per_tx"],
    "w07_cards_first_5": ["unique_cards_first_5"],
    "w08_cvv_last_10": ["is_cvv_error"],
    "p01_email_domain": ["domain"],
    "p06_interactions": ["errors_x_cards", "holders_x_cards", "consec_fails_x_cards", "burst_x_cards",
                         "burst_x_errors", "consec_fails_x_holders", "burst_x_fail_rate"],
    "p07_ratios": ["countries_per_tx", "errors_per_tx", "holders_per_card", "holders_per_tx",
                   "cards_per_tx", "unique_amounts_per_tx", "transaction_type_resign_rate",
                   "status_changes_per_tx"],
}

_EXTRA_SQL = {"status_changes_per_tx": "status_changes / (tx_count + 1e-6) AS status_changes_per_tx"}


def _slice_sql(cols):
    sel = ", ".join(_EXTRA_SQL.get(c, c) for c in cols)
    return f"SELECT id_user, {sel} FROM feat"


def _register_slice(name, cols):
    @query(name, _slice_sql(cols))
    def _q(spark, sf_dir, _cols=tuple(cols)):
        fx = fixture(spark, sf_dir)
        want = [c for c in _cols if c != "status_changes_per_tx"]
        if "status_changes_per_tx" in _cols:
            want += [c for c in ("status_changes", "tx_count") if c not in want]
        df = build_features(fx.users, fx.transactions, only=want)
        if "status_changes_per_tx" in _cols:
            df = df.withColumn("status_changes_per_tx", F.col("status_changes") / (F.col("tx_count") + 1e-6))
        return df.select("id_user", *_cols)


for _n, _c in FEATURE_SLICES.items():
    _register_slice(_n, _c)


ALL_FEATURE_COLS_SQL = "SELECT * EXCLUDE (email_name, main_card_holder, first_timestamp_tr, time_to_first_transaction_eda) FROM feat"


@query("build_features", ALL_FEATURE_COLS_SQL)
def q_build_features(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return build_features(fx.users, fx.transactions)


@query("a13_type_shares", """
SELECT u.id_user,
  coalesce(s."tx_type_card_init_rate", 0) AS "tx_type_card_init_rate",
  coalesce(s."tx_type_resign_rate", 0) AS "tx_type_resign_rate",
  coalesce(s."tx_type_card_recurring_rate", 0) AS "tx_type_card_recurring_rate",
  coalesce(s."tx_type_apple-pay_rate", 0) AS "tx_type_apple-pay_rate",
  coalesce(s."tx_type_google-pay_rate", 0) AS "tx_type_google-pay_rate"
FROM users u LEFT JOIN (
  SELECT id_user,
    avg(CASE WHEN transaction_type = 'card_init' THEN 1.0 ELSE 0.0 END) AS "tx_type_card_init_rate",
    avg(CASE WHEN transaction_type = 'resign' THEN 1.0 ELSE 0.0 END) AS "tx_type_resign_rate",
    avg(CASE WHEN transaction_type = 'card_recurring' THEN 1.0 ELSE 0.0 END) AS "tx_type_card_recurring_rate",
    avg(CASE WHEN transaction_type = 'apple-pay' THEN 1.0 ELSE 0.0 END) AS "tx_type_apple-pay_rate",
    avg(CASE WHEN transaction_type = 'google-pay' THEN 1.0 ELSE 0.0 END) AS "tx_type_google-pay_rate"
  FROM transactions WHERE transaction_type IS NOT NULL GROUP BY id_user) s ON u.id_user = s.id_user
""")
def q_type_shares(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    shares = type_shares(fx.transactions)
    cols = [c for c in shares.columns if c != "id_user"]
    return (fx.users.select("id_user").join(shares, "id_user", "left")
            .fillna(0.0, subset=cols))


@query("a14_time_to_first", """
SELECT id_user, time_to_first_transaction, time_to_first_transaction_eda FROM feat
""")
def q_time_to_first(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    first = fx.transactions.groupBy("id_user").agg(F.min("timestamp_tr").alias("first_timestamp_tr"))
    u = fx.users.join(first, "id_user", "left")
    return u.select("id_user", time_to_first(clip=True).alias("time_to_first_transaction"),
                    time_to_first(clip=False, floor_seconds=True).alias("time_to_first_transaction_eda"))


@query("p02_email_local", "SELECT id_user, email_name FROM feat")
def q_email_local(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return fx.users.select("id_user", email_local("email").alias("email_name"))


@query("p18_registration_time", """
SELECT id_user, hour(timestamp_reg) AS reg_hour, isodow(timestamp_reg) - 1 AS reg_dayofweek,
  CAST(hour(timestamp_reg) < 6 AS INTEGER) AS reg_is_night,
  CAST(isodow(timestamp_reg) >= 6 AS INTEGER) AS reg_is_weekend
FROM users
""")
def q_registration_time(spark, sf_dir):
    return registration_time_features(fixture(spark, sf_dir).users)
