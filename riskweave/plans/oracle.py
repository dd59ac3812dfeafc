"""Independent DuckDB SQL for every SQL-expressible query in the registry.

The fixture mapping (FIXTURES.md §3) is the shared prelude; each operator is
then written the plain way (whole-user windows, per-fold loops unrolled as
joins) so it checks the Spark plan shapes rather than mirroring them.
"""

from __future__ import annotations

import json
import os

FIXTURE_CTES = r"""
users AS (
  SELECT c.c_custkey AS id_user,
    CASE WHEN c.c_custkey % 17 = 3 THEN NULL ELSE
      concat(CASE c.c_custkey % 4 WHEN 0 THEN 'anna' WHEN 1 THEN 'Oleh' WHEN 2 THEN 'maria' ELSE 'x' END,
             CAST(c.c_custkey AS VARCHAR), '@',
             CASE WHEN c.c_custkey % 7 <= 2 THEN 'mail.example' WHEN c.c_custkey % 7 <= 4 THEN 'post.example'
                  WHEN c.c_custkey % 7 = 5 THEN 'corp.example' ELSE 'rare.example' END) END AS email,
    CASE WHEN c.c_custkey % 11 = 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    n.n_name AS reg_country, c.c_mktsegment AS traffic_type,
    TIMESTAMP '2023-12-20 00:00:00' + (c.c_custkey % 20) * INTERVAL 1 DAY AS timestamp_reg,
    CAST(CASE WHEN c.c_custkey % 13 = 0 OR c.c_custkey % 29 = 7 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
ev1 AS (SELECT event_id, ts, user_id, event_type, value,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
ev2 AS (SELECT *, (user_id % 13 = 0 OR user_id % 29 = 7) AS f,
          CASE WHEN k % 3 = 0 THEN CAST(floor(user_id / 3) AS BIGINT) ELSE 1000000 + user_id END AS cg,
          CASE WHEN user_id % 13 = 0 THEN k % 12 ELSE k % (1 + user_id % 6) END AS cb FROM ev1),
ev3 AS (SELECT *, (event_type = 'error' OR (f AND k < 35)) AS bad FROM ev2),
transactions AS (
  SELECT event_id AS id_tx, user_id AS id_user, CAST(ts AS TIMESTAMP) AS timestamp_tr, value AS amount,
    CASE WHEN bad THEN 'fail' ELSE 'success' END AS status,
    CASE WHEN NOT bad THEN NULL WHEN k < 15 THEN 'antifraud' WHEN k < 30 THEN 'fraud' WHEN k < 45 THEN '3ds error'
         WHEN k < 60 THEN 'card problem' WHEN k < 75 THEN 'cvv error' WHEN k < 90 THEN 'insufficient funds error'
         ELSE 'do not honor' END AS error_group,
    CASE event_type WHEN 'signup' THEN 'card_init' WHEN 'purchase' THEN 'card_recurring'
         WHEN 'click' THEN 'apple-pay' WHEN 'view' THEN 'google-pay' ELSE 'resign' END AS transaction_type,
    CASE WHEN k = 99 THEN NULL ELSE concat('card_', CAST(cg AS VARCHAR), '_', CAST(cb AS VARCHAR)) END AS card_mask_hash,
    CASE WHEN k % 50 = 49 THEN NULL WHEN cb % 4 = 0 THEN 'anna koval' WHEN cb % 4 = 1 THEN 'OLEH BONDAR'
         WHEN cb % 4 = 2 THEN ' maria  li ' ELSE 'Anna Shevchenko' END AS card_holder,
    CASE cb % 3 WHEN 0 THEN 'VISA' WHEN 1 THEN 'MASTERCARD' ELSE 'AMEX' END AS card_brand,
    CASE WHEN cb % 2 = 0 THEN 'DEBIT' ELSE 'CREDIT' END AS card_type,
    CASE WHEN k % 33 = 32 THEN NULL ELSE concat('NATION_', CAST((cg + cb) % 25 AS VARCHAR)) END AS card_country,
    CASE WHEN k % 41 = 40 THEN NULL WHEN k % 4 = 0 THEN concat('NATION_', CAST(k % 25 AS VARCHAR))
         ELSE concat('NATION_', CAST((cg + cb) % 25 AS VARCHAR)) END AS payment_country,
    CASE k % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'UAH' END AS currency
  FROM ev3),
train_users AS (SELECT * FROM users WHERE id_user % 5 <> 4),
test_users AS (SELECT * EXCLUDE (is_fraud) FROM users WHERE id_user % 5 = 4),
train_tx AS (SELECT * FROM transactions WHERE id_user % 5 <> 4),
test_tx AS (SELECT * FROM transactions WHERE id_user % 5 = 4)
"""

# Feature CTEs over parameters {U} (users) and {T} (transactions), prefixed {p}.
FEATURE_CTES = r"""
{p}ua AS (
  SELECT id_user, count(*) AS tx_count, avg(amount) AS amount_mean,
    coalesce(stddev_samp(amount), 0) AS amount_std, max(amount) AS amount_max, min(amount) AS amount_min,
    median(amount) AS amount_median, sum(amount) AS amount_sum,
    count(DISTINCT card_mask_hash) AS unique_cards_per_user, count(DISTINCT card_holder) AS unique_card_holders,
    count(DISTINCT error_group) AS unique_error_types, count(DISTINCT card_brand) AS unique_card_brands,
    count(DISTINCT card_type) AS unique_card_types, count(DISTINCT card_country) AS unique_card_countries,
    avg(CASE WHEN status = 'fail' THEN 1.0 ELSE 0.0 END) AS fail_status_coefficient,
    avg(CASE WHEN error_group = 'fraud' THEN 1.0 ELSE 0.0 END) AS fraud_error_rate,
    CAST(sum(CASE WHEN error_group = 'fraud' THEN 1 ELSE 0 END) AS BIGINT) AS fraud_error_count,
    avg(CASE WHEN error_group = 'cvv error' THEN 1.0 ELSE 0.0 END) AS cvv_error_coef,
    avg(CASE WHEN error_group = 'antifraud' THEN 1.0 ELSE 0.0 END) AS error_antifraud_rate,
    avg(CASE WHEN error_group = 'do not honor' THEN 1.0 ELSE 0.0 END) AS error_do_not_honor_rate,
    avg(CASE WHEN error_group = 'insufficient funds error' THEN 1.0 ELSE 0.0 END) AS error_insufficient_funds_error_rate,
    avg(CASE WHEN error_group = '3ds error' THEN 1.0 ELSE 0.0 END) AS error_3ds_error_rate,
    avg(CASE WHEN error_group = 'card problem' THEN 1.0 ELSE 0.0 END) AS error_card_problem_rate,
    avg(CASE WHEN card_country IS NULL OR payment_country IS NULL OR card_country <> payment_country
             THEN 1.0 ELSE 0.0 END) AS country_CP_missmatch_coef,
    avg(CASE WHEN transaction_type = 'card_init' THEN 1.0 ELSE 0.0 END) AS tx_type_card_init_rate,
    CAST(sum(CASE WHEN transaction_type = 'resign' THEN 1 ELSE 0 END) AS BIGINT) AS resign_count,
    min(timestamp_tr) AS first_timestamp_tr,
    coalesce(stddev_samp(hour(timestamp_tr)), 0) AS hour_std,
    avg(CASE WHEN amount <= 5 THEN 1.0 ELSE 0.0 END) AS small_amount_rate,
    count(DISTINCT lower(nullif(regexp_extract(card_holder, '\S+', 0), ''))) AS unique_first_names
  FROM {T} GROUP BY id_user),
{p}hc AS (SELECT id_user, card_holder, count(*) AS n FROM {T} WHERE card_holder IS NOT NULL GROUP BY 1, 2),
{p}mh AS (SELECT id_user, card_holder AS main_card_holder FROM (
    SELECT *, row_number() OVER (PARTITION BY id_user ORDER BY n DESC, card_holder) AS r FROM {p}hc) WHERE r = 1),
{p}hb AS (SELECT id_user, max(n) AS max_hourly_burst FROM (
    SELECT id_user, date_trunc('hour', timestamp_tr) AS h, count(*) AS n FROM {T}
    WHERE timestamp_tr IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
{p}pa AS (SELECT id_user, amount, count(*) AS n FROM {T} GROUP BY 1, 2),
{p}pa2 AS (SELECT *, sum(CASE WHEN amount IS NOT NULL THEN n END) OVER (PARTITION BY id_user) AS nn,
                  sum(n) OVER (PARTITION BY id_user) AS rows_all FROM {p}pa),
{p}am AS (SELECT id_user, count(amount) AS unique_amounts,
    coalesce(-sum(CASE WHEN amount IS NOT NULL THEN (n / nn) * ln(n / nn) END), 0) AS amount_entropy,
    max(CASE WHEN amount IS NOT NULL THEN n END) / max(rows_all) AS amount_mode_concentration
  FROM {p}pa2 GROUP BY 1),
{p}cr AS (SELECT t.id_user, avg(CASE WHEN t.card_country IS NULL OR u.reg_country IS NULL
                                      OR t.card_country <> u.reg_country THEN 1.0 ELSE 0.0 END) AS country_CReg_missmatch
  FROM {T} t JOIN {U} u ON t.id_user = u.id_user GROUP BY 1),
{p}o AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY id_user) AS n,
    (epoch_us(timestamp_tr) - epoch_us(lag(timestamp_tr) OVER w)) / 1e6 AS gap,
    lag(status) OVER w AS prev_status,
    CASE WHEN status = 'fail' THEN 1 ELSE 0 END AS is_fail
  FROM {T} WINDOW w AS (PARTITION BY id_user ORDER BY timestamp_tr NULLS LAST, id_tx)),
{p}o2 AS (SELECT *, rn - row_number() OVER (PARTITION BY id_user, is_fail ORDER BY timestamp_tr NULLS LAST, id_tx) AS isl
  FROM {p}o),
{p}streak AS (SELECT id_user, max(len) AS max_consecutive_fails FROM (
    SELECT id_user, isl, count(*) AS len FROM {p}o2 WHERE is_fail = 1 GROUP BY 1, 2) GROUP BY 1),
{p}sq AS (SELECT id_user,
    min(gap) AS min_time_between_tx, avg(gap) AS avg_time_between_tx, stddev_samp(gap) AS std_time_between_tx,
    CAST(sum(CASE WHEN rn > 1 AND status IS DISTINCT FROM prev_status THEN 1 ELSE 0 END) AS BIGINT) AS status_changes,
    coalesce(min(CASE WHEN status = 'success' THEN rn END) - 1, count(*)) AS fails_before_first_success,
    CAST(coalesce(arg_min(status, rn) FILTER (WHERE status IS NOT NULL) = 'fail', false) AS INTEGER) AS first_tx_failed,
    count(DISTINCT CASE WHEN rn <= 5 THEN card_mask_hash END) AS unique_cards_first_5,
    max(CASE WHEN rn > n - 10 AND error_group = 'cvv error' THEN 1 ELSE 0 END) AS is_cvv_error
  FROM {p}o GROUP BY 1),
{p}cs AS (SELECT card_mask_hash, count(DISTINCT id_user) AS users_per_card,
    avg(CASE WHEN status = 'fail' THEN 1.0 ELSE 0.0 END) AS card_fail_rate, count(*) AS card_total_tx
  FROM {T} WHERE card_mask_hash IS NOT NULL GROUP BY 1),
{p}cu AS (SELECT t.id_user,
    CAST(max(c.users_per_card) AS DOUBLE) AS max_users_sharing_card, avg(c.users_per_card) AS avg_users_sharing_card,
    max(c.card_fail_rate) AS worst_card_fail_rate, avg(c.card_fail_rate) AS avg_card_fail_rate,
    CAST(max(c.card_total_tx) AS DOUBLE) AS most_active_card_tx, avg(c.card_total_tx) AS avg_card_tx
  FROM {T} t JOIN {p}cs c ON t.card_mask_hash = c.card_mask_hash GROUP BY 1),
{p}f0 AS (
  SELECT u.*,
    coalesce(split(u.email, '@')[2], 'missing') AS domain,
    coalesce(lower(split(u.email, '@')[1]), '') AS email_name,
    coalesce(ua.tx_count, 0) AS tx_count, ua.amount_mean, ua.amount_std, ua.amount_max, ua.amount_min,
    ua.amount_median, ua.amount_sum, ua.amount_max - ua.amount_min AS amount_range,
    ua.amount_std / (ua.amount_mean + 1e-6) AS amount_cv,
    coalesce(ua.unique_cards_per_user, 0) AS unique_cards_per_user,
    coalesce(ua.unique_card_holders, 0) AS unique_card_holders,
    coalesce(ua.unique_error_types, 0) AS unique_error_types,
    coalesce(ua.unique_card_brands, 0) AS unique_card_brands,
    coalesce(ua.unique_card_types, 0) AS unique_card_types,
    coalesce(ua.unique_card_countries, 0) AS unique_card_countries,
    coalesce(ua.fail_status_coefficient, 0) AS fail_status_coefficient,
    coalesce(ua.fraud_error_rate, 0) AS fraud_error_rate,
    coalesce(ua.fraud_error_count, 0) AS fraud_error_count,
    coalesce(ua.cvv_error_coef, 0) AS cvv_error_coef,
    coalesce(ua.error_antifraud_rate, 0) AS error_antifraud_rate,
    coalesce(ua.error_do_not_honor_rate, 0) AS error_do_not_honor_rate,
    coalesce(ua.fraud_error_rate, 0) AS error_fraud_rate,
    coalesce(ua.cvv_error_coef, 0) AS error_cvv_error_rate,
    coalesce(ua.error_insufficient_funds_error_rate, 0) AS error_insufficient_funds_error_rate,
    coalesce(ua.error_3ds_error_rate, 0) AS error_3ds_error_rate,
    coalesce(ua.error_card_problem_rate, 0) AS error_card_problem_rate,
    coalesce(ua.country_CP_missmatch_coef, 0) AS country_CP_missmatch_coef,
    coalesce(cr.country_CReg_missmatch, 0) AS country_CReg_missmatch,
    coalesce(ua.tx_type_card_init_rate, 0) AS tx_type_card_init_rate,
    coalesce(ua.resign_count, 0) AS resign_count,
    ua.first_timestamp_tr,
    CASE WHEN ua.first_timestamp_tr IS NULL OR u.timestamp_reg IS NULL THEN NULL
         ELSE greatest((epoch_us(ua.first_timestamp_tr) - epoch_us(u.timestamp_reg)) / 1e6, 0) END
      AS time_to_first_transaction,
    (epoch_us(date_trunc('second', ua.first_timestamp_tr)) - epoch_us(date_trunc('second', u.timestamp_reg))) / 1e6
      AS time_to_first_transaction_eda,
    coalesce(am.unique_amounts, 0) AS unique_amounts,
    coalesce(ua.hour_std, 0) AS hour_std,
    coalesce(length(coalesce(mh.main_card_holder, '')), 0) AS holder_name_length,
    coalesce(len(regexp_extract_all(coalesce(mh.main_card_holder, ''), '\S+')), 0) AS holder_name_words,
    coalesce(mh.main_card_holder, '') AS main_card_holder,
    coalesce(hb.max_hourly_burst, 0) AS max_hourly_burst,
    coalesce(am.amount_entropy, 0) AS amount_entropy,
    coalesce(am.amount_mode_concentration, 0) AS amount_mode_concentration,
    coalesce(ua.small_amount_rate, 0) AS small_amount_rate,
    coalesce(ua.unique_first_names, 0) AS unique_first_names,
    coalesce(st.max_consecutive_fails, 0) AS max_consecutive_fails,
    coalesce(sq.first_tx_failed, 0) AS first_tx_failed,
    coalesce(sq.fails_before_first_success, 0) AS fails_before_first_success,
    coalesce(sq.status_changes, 0) AS status_changes,
    coalesce(sq.unique_cards_first_5, 0) AS unique_cards_first_5,
    coalesce(sq.is_cvv_error, 0) AS is_cvv_error,
    sq.min_time_between_tx, sq.avg_time_between_tx, sq.std_time_between_tx,
    cu.max_users_sharing_card, cu.avg_users_sharing_card, cu.worst_card_fail_rate, cu.avg_card_fail_rate,
    cu.most_active_card_tx, cu.avg_card_tx
  FROM {U} u
  LEFT JOIN {p}ua ua ON u.id_user = ua.id_user
  LEFT JOIN {p}mh mh ON u.id_user = mh.id_user
  LEFT JOIN {p}hb hb ON u.id_user = hb.id_user
  LEFT JOIN {p}am am ON u.id_user = am.id_user
  LEFT JOIN {p}cr cr ON u.id_user = cr.id_user
  LEFT JOIN {p}streak st ON u.id_user = st.id_user
  LEFT JOIN {p}sq sq ON u.id_user = sq.id_user
  LEFT JOIN {p}cu cu ON u.id_user = cu.id_user),
{p}feat AS (
  SELECT *,
    unique_error_types * unique_cards_per_user AS errors_x_cards,
    unique_card_holders * unique_cards_per_user AS holders_x_cards,
    max_consecutive_fails * unique_cards_per_user AS consec_fails_x_cards,
    max_hourly_burst * unique_cards_per_user AS burst_x_cards,
    max_hourly_burst * unique_error_types AS burst_x_errors,
    max_consecutive_fails * unique_card_holders AS consec_fails_x_holders,
    max_hourly_burst * fail_status_coefficient AS burst_x_fail_rate,
    unique_card_countries / (tx_count + 1e-6) AS countries_per_tx,
    unique_error_types / (tx_count + 1e-6) AS errors_per_tx,
    unique_card_holders / (unique_cards_per_user + 1e-6) AS holders_per_card,
    unique_card_holders / (tx_count + 1e-6) AS holders_per_tx,
    unique_cards_per_user / (tx_count + 1e-6) AS cards_per_tx,
    unique_amounts / (tx_count + 1e-6) AS unique_amounts_per_tx,
    resign_count / (tx_count + 1e-6) AS transaction_type_resign_rate,
    CAST(len(list_filter(regexp_extract_all(main_card_holder, '\S+'),
                         lambda t: length(t) > 2 AND contains(email_name, t))) > 0 AS INTEGER) AS name_in_email
  FROM {p}f0)
"""


def feature_ctes(users: str = "users", tx: str = "transactions", prefix: str = "") -> str:
    return FEATURE_CTES.format(U=users, T=tx, p=prefix)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"


PRELUDE = with_ctes(FIXTURE_CTES, feature_ctes())

_TYPES_FILE = os.path.join(os.path.dirname(__file__), "result_types.json")


def result_types() -> dict[str, list[list[str]]]:
    try:
        with open(_TYPES_FILE) as fh:
            return json.load(fh)
    except FileNotFoundError:
        return {}


def normalise(name: str, sql: str, types: dict | None = None) -> str:
    """Cast the oracle's result to the registry's normalised result types
    (BIGINT / DOUBLE rounded to 6 places / VARCHAR / BOOLEAN), by name."""
    types = result_types() if types is None else types
    cols = types.get(name)
    if not cols:
        return sql
    sel = []
    for col, kind in cols:
        q = '"' + col.replace('"', '""') + '"'
        if kind == "double":
            sel.append(f"round(CAST({q} AS DOUBLE), 6) AS {q}")
        elif kind == "bigint":
            sel.append(f"CAST({q} AS BIGINT) AS {q}")
        else:
            sel.append(q)
    return f"SELECT {', '.join(sel)} FROM (\n{sql}\n) AS q"
