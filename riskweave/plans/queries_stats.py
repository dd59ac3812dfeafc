"""Registry entries: descriptive and association statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import email_domain
from ..operators import association as A
from ..operators import stats as S
from ..operators.user_aggs import registration_time_features, time_to_first, type_shares
from .features import build_features
from .queries_encode import CAT_COLS, label_transactions
from .registry import fixture, query

USER_CATS = ["gender", "reg_country", "traffic_type", "domain"]
MIN_GROUP = 60          # P15 split point at fixture scale (the notebook used 1,800 users)

# The two feature lists scored by the notebooks (22, then 24).
REPORT_FEATURES_1 = [
    "unique_cards_per_user", "fraud_error_rate", "fraud_error_count", "tx_count", "country_CP_missmatch_coef",
    "unique_error_types", "unique_card_countries", "unique_card_holders", "fail_status_coefficient",
    "cvv_error_coef", "amount_mean", "amount_std", "amount_max", "amount_sum", "amount_cv", "amount_range",
    "transaction_type_resign_rate", "reg_hour", "reg_is_night", "name_in_email", "time_to_first_transaction",
    "country_CReg_missmatch",
]
REPORT_FEATURES_2 = [
    "holders_x_cards", "errors_x_cards", "holders_per_card", "cards_per_tx", "holders_per_tx", "errors_per_tx",
    "countries_per_tx", "error_antifraud_rate", "error_do_not_honor_rate", "error_fraud_rate",
    "error_cvv_error_rate", "error_insufficient_funds_error_rate", "error_3ds_error_rate",
    "error_card_problem_rate", "unique_card_brands", "unique_card_types", "tx_type_apple-pay_rate",
    "tx_type_card_init_rate", "tx_type_card_recurring_rate", "tx_type_google-pay_rate", "tx_type_resign_rate",
    "avg_time_between_tx", "min_time_between_tx", "std_time_between_tx",
]
REPORT_FEATURES = REPORT_FEATURES_1 + REPORT_FEATURES_2

U_DOM = "(SELECT *, coalesce(split(email, '@')[2], 'missing') AS domain FROM users)"
MERGED = """(SELECT t.*, u.email, u.gender, u.reg_country, u.traffic_type, u.timestamp_reg, u.is_fraud,
                coalesce(split(u.email, '@')[2], 'missing') AS domain
             FROM transactions t JOIN users u ON t.id_user = u.id_user)"""


def users_d(fx):
    return fx.users.withColumn("domain", email_domain("email"))


def merged(fx):
    return label_transactions(fx.transactions, fx.users)


@query("a27_rate_by_group", """
SELECT reg_country, avg(is_fraud) AS rate, count(*) AS n FROM users WHERE reg_country IS NOT NULL GROUP BY 1""")
def q_rate_by_group(spark, sf_dir):
    return S.rate_by_group(fixture(spark, sf_dir).users, "reg_country")


@query("p15_rate_by_group_size", f"""
SELECT reg_country, avg(is_fraud) AS rate, count(*) AS n FROM users WHERE reg_country IS NOT NULL
GROUP BY 1 HAVING count(*) >= {MIN_GROUP}""")
def q_rate_by_group_size(spark, sf_dir):
    return S.rate_by_group(fixture(spark, sf_dir).users, "reg_country", min_n=MIN_GROUP)


# Fixed value: the notebook's group size.
NOTEBOOK_GROUP = 1800


@query("p15_groups_of_1800", f"""
SELECT reg_country, avg(is_fraud) AS rate, count(*) AS n FROM users WHERE reg_country IS NOT NULL
GROUP BY 1 HAVING count(*) >= {NOTEBOOK_GROUP}""")
def q_large_groups(spark, sf_dir):
    return S.rate_by_group(fixture(spark, sf_dir).users, "reg_country", min_n=NOTEBOOK_GROUP)


@query("p15_groups_below_1800", f"""
SELECT reg_country, avg(is_fraud) AS rate, count(*) AS n FROM users WHERE reg_country IS NOT NULL
GROUP BY 1 HAVING count(*) < {NOTEBOOK_GROUP}""")
def q_small_groups(spark, sf_dir):
    return S.rate_by_group(fixture(spark, sf_dir).users, "reg_country", max_n=NOTEBOOK_GROUP)


@query("p11_a27_rates_by_text_columns", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", {c} AS value, avg(is_fraud) AS rate, count(*) AS n FROM {U_DOM} WHERE {c} IS NOT NULL GROUP BY 2"""
                                                           for c in USER_CATS))
def q_rates_by_columns(spark, sf_dir):
    u = users_d(fixture(spark, sf_dir))
    return S.rates_by_columns(u, S.categorical_cols(u, exclude=("timestamp_reg", "email")))


@query("a27_rate_by_error_group", f"""
SELECT error_group, avg(is_fraud) AS rate, count(*) AS n FROM {MERGED} WHERE error_group IS NOT NULL GROUP BY 1""")
def q_rate_by_error(spark, sf_dir):
    return S.rate_by_group(merged(fixture(spark, sf_dir)), "error_group")


@query("a34_transactions_per_user", """
SELECT count(n) AS count, avg(n) AS mean, stddev_samp(n) AS std, min(n) AS min, quantile_cont(n, 0.25) AS p25,
       quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.75) AS p75, max(n) AS max
FROM (SELECT id_user, count(*) AS n FROM transactions GROUP BY 1)""")
def q_tx_per_user(spark, sf_dir):
    return S.describe_num(fixture(spark, sf_dir).transactions.groupBy("id_user").agg(F.count(F.lit(1)).alias("n")), "n")


@query("a28_fraud_share_by_domain", f"""
SELECT domain, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, count(*) AS total_users,
       sum(is_fraud) / count(*) * 100.0 AS fraud_percentage
FROM {U_DOM} GROUP BY 1 HAVING sum(is_fraud) > 0""")
def q_fraud_share(spark, sf_dir):
    return S.fraud_share_by(users_d(fixture(spark, sf_dir)), "domain")


@query("a29_mean_group_size", """
SELECT avg(n) AS mean_group_size, count(*) AS groups FROM (
  SELECT reg_country, count(*) AS n FROM users WHERE reg_country IS NOT NULL GROUP BY 1)""")
def q_mean_group_size(spark, sf_dir):
    return S.mean_group_size(fixture(spark, sf_dir).users, "reg_country")


@query("a30_crosstab", f"""
SELECT transaction_type, is_fraud, count(*) AS n FROM {MERGED} WHERE transaction_type IS NOT NULL GROUP BY 1, 2""")
def q_crosstab(spark, sf_dir):
    return S.crosstab_long(merged(fixture(spark, sf_dir)), "transaction_type", "is_fraud")


@query("a31_crosstab_norm", f"""
SELECT transaction_type, is_fraud, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY is_fraud) AS share
FROM {MERGED} WHERE transaction_type IS NOT NULL GROUP BY 1, 2""")
def q_crosstab_norm(spark, sf_dir):
    return S.crosstab_norm(merged(fixture(spark, sf_dir)), "transaction_type", "is_fraud")


@query("a32_crosstab_margins", f"""
SELECT coalesce(status, 'All') AS status, coalesce(CAST(is_fraud AS VARCHAR), 'All') AS is_fraud, count(*) AS n
FROM {MERGED} WHERE status IS NOT NULL GROUP BY CUBE (status, is_fraud)""")
def q_crosstab_margins(spark, sf_dir):
    return S.crosstab_margins(merged(fixture(spark, sf_dir)), "status", "is_fraud")


@query("a33_top_values", f"""
SELECT * FROM (SELECT is_fraud, amount, count(*) AS count,
    row_number() OVER (PARTITION BY is_fraud ORDER BY count(*) DESC, amount) AS rank
  FROM {MERGED} WHERE amount IS NOT NULL GROUP BY 1, 2) WHERE rank <= 20""")
def q_top_values(spark, sf_dir):
    return S.top_values(merged(fixture(spark, sf_dir)), "is_fraud", "amount", 20)


@query("a34_describe_num", f"""
SELECT is_fraud, count(amount) AS count, avg(amount) AS mean, stddev_samp(amount) AS std, min(amount) AS min,
  quantile_cont(amount, 0.25) AS p25, quantile_cont(amount, 0.5) AS p50, quantile_cont(amount, 0.75) AS p75,
  max(amount) AS max
FROM {MERGED} GROUP BY 1""")
def q_describe_num(spark, sf_dir):
    return S.describe_num(merged(fixture(spark, sf_dir)), "amount", by="is_fraud")


@query("a35_describe_cat", f"""
SELECT sum(n) AS count, count(*) AS unique, arg_min(card_country, (-n, card_country)) AS top, max(n) AS freq
FROM (SELECT card_country, count(*) AS n FROM {MERGED} WHERE is_fraud = 1 AND card_country IS NOT NULL GROUP BY 1)""")
def q_describe_cat(spark, sf_dir):
    m = merged(fixture(spark, sf_dir))
    return S.describe_cat(m.filter(F.col("is_fraud") == 1), "card_country")


@query("a36_histogram", f"""
SELECT * FROM (WITH d AS (SELECT is_fraud, ln(1 + amount) AS v FROM {MERGED} WHERE amount IS NOT NULL),
r AS (SELECT is_fraud, min(v) AS lo, max(v) AS hi, count(*) AS n FROM d GROUP BY 1),
g AS (SELECT is_fraud, n, i AS bin, CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN hi = lo THEN hi + 0.5 ELSE hi END AS hi
      FROM r CROSS JOIN range(100) AS t(i)),
e AS (SELECT *, lo + bin * ((hi - lo) / 100) AS bin_lo, lo + (bin + 1) * ((hi - lo) / 100) AS bin_hi FROM g)
SELECT e.is_fraud, bin, bin_lo, bin_hi, count(d.v) AS count, count(d.v) / (e.n * ((e.hi - e.lo) / 100)) AS density
FROM e LEFT JOIN d ON d.is_fraud = e.is_fraud AND (d.v >= bin_lo OR bin = 0) AND (d.v < bin_hi OR bin = 99)
GROUP BY e.is_fraud, bin, bin_lo, bin_hi, e.n, e.hi, e.lo) AS y""")
def q_histogram(spark, sf_dir):
    return S.histogram(merged(fixture(spark, sf_dir)), "amount", 100, by="is_fraud")


@query("a37_box_stats", f"""
SELECT * FROM (WITH d AS (SELECT is_fraud, amount AS x FROM {MERGED} WHERE amount IS NOT NULL),
q AS (SELECT is_fraud, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM d GROUP BY 1)
SELECT q.is_fraud, q.n, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr,
  min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END) AS whisker_lo,
  max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_hi,
  CAST(sum(CASE WHEN x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS fliers
FROM d JOIN q ON d.is_fraud = q.is_fraud GROUP BY q.is_fraud, q.n, q.q1, q.median, q.q3) AS y""")
def q_box(spark, sf_dir):
    return S.box_stats(merged(fixture(spark, sf_dir)), "amount", by="is_fraud")


def _chi2_sql(src: str, col: str, y: str, na: str | None = None) -> str:
    """Plain chi-squared over the full r x c grid (Yates for 2x2)."""
    x = f"coalesce(CAST({col} AS VARCHAR), '{na}')" if na else f"CAST({col} AS VARCHAR)"
    yy = f"coalesce(CAST({y} AS VARCHAR), '{na}')" if na else f"CAST({y} AS VARCHAR)"
    return f"""(WITH o AS (SELECT {x} AS a, {yy} AS b, count(*) AS n FROM {src}
                      WHERE {x} IS NOT NULL AND {yy} IS NOT NULL GROUP BY 1, 2),
  ra AS (SELECT a, sum(n) AS r FROM o GROUP BY 1), cb AS (SELECT b, sum(n) AS c FROM o GROUP BY 1),
  tot AS (SELECT sum(n) AS nn, (SELECT count(*) FROM ra) AS nr, (SELECT count(*) FROM cb) AS nc FROM o),
  grid AS (SELECT ra.a, cb.b, ra.r * cb.c / tot.nn AS e, coalesce(o.n, 0) AS obs, tot.nr, tot.nc, tot.nn
           FROM ra CROSS JOIN cb CROSS JOIN tot LEFT JOIN o ON o.a = ra.a AND o.b = cb.b)
  SELECT '{col}' AS pair,
    CASE WHEN (max(nr) - 1) * (max(nc) - 1) = 0 THEN 0.0
         WHEN (max(nr) - 1) * (max(nc) - 1) = 1
           THEN sum(power(greatest(abs(obs - e) - 0.5, 0), 2) / e)
         ELSE sum(power(obs - e, 2) / e) END AS chi2,
    (max(nr) - 1) * (max(nc) - 1) AS dof, max(nn) AS nn, max(nr) AS nr, max(nc) AS nc FROM grid)"""


@query("t01_chi2", " UNION ALL ".join(
    f"SELECT pair AS \"column\", chi2, dof FROM {_chi2_sql(U_DOM, c, 'is_fraud')}" for c in USER_CATS))
def q_chi2(spark, sf_dir):
    return A.chi2_table(users_d(fixture(spark, sf_dir)), USER_CATS, "is_fraud", with_p=False).select(
        "column", "chi2", "dof")


def _cramer_sql() -> str:
    parts = []
    for i, a in enumerate(CAT_COLS):
        for j, b in enumerate(CAT_COLS):
            if j < i:
                continue
            sub = _chi2_sql(f"(SELECT coalesce(CAST({a} AS VARCHAR), 'NA') AS xa, "
                            f"coalesce(CAST({b} AS VARCHAR), 'NA') AS xb FROM {MERGED})", "xa", "xb")
            v = "CASE WHEN least(nr, nc) - 1 > 0 THEN sqrt(chi2 / (nn * (least(nr, nc) - 1))) ELSE 0 END"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {v} AS cramers_v FROM {sub}")
            if i != j:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {v} AS cramers_v FROM {sub}")
    return " UNION ALL ".join(parts)


@query("t02_cramers_v", _cramer_sql())
def q_cramers_v(spark, sf_dir):
    return A.cramers_v_matrix(merged(fixture(spark, sf_dir)), CAT_COLS)


@query("t03_theils_u", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CASE WHEN hy > 0 THEN (hy - hyx) / hy ELSE 0 END AS theils_u FROM (
  WITH o AS (SELECT coalesce(CAST({c} AS VARCHAR), 'NA') AS x, is_fraud AS y, count(*) AS n FROM {MERGED} GROUP BY 1, 2),
  px AS (SELECT x, sum(n) AS nx FROM o GROUP BY 1), py AS (SELECT y, sum(n) AS ny FROM o GROUP BY 1),
  t AS (SELECT sum(n) AS nn FROM o)
  SELECT (SELECT -sum(ny / nn * ln(ny / nn)) FROM py, t) AS hy,
         (SELECT sum(nx / nn * h) FROM (
             SELECT px.x, px.nx, -sum(o.n / px.nx * ln(o.n / px.nx)) AS h FROM o JOIN px ON o.x = px.x
             GROUP BY px.x, px.nx), t) AS hyx)""" for c in CAT_COLS))
def q_theils_u(spark, sf_dir):
    return A.theils_u(merged(fixture(spark, sf_dir)), CAT_COLS, "is_fraud")


def report_frame(fx):
    feats = build_features(fx.users, fx.transactions, keep_helpers=True)
    shares = type_shares(fx.transactions).drop("tx_type_card_init_rate")
    share_cols = [c for c in shares.columns if c != "id_user"]
    return (feats.withColumn("time_to_first_transaction", time_to_first(clip=False, floor_seconds=True))
            .join(registration_time_features(fx.users).drop("reg_dayofweek", "reg_is_weekend"), "id_user")
            .join(shares, "id_user", "left").fillna(0.0, subset=share_cols))


def _report_sql() -> str:
    cast = ", ".join(f'CAST("{f}" AS DOUBLE) AS "{f}"' for f in REPORT_FEATURES)
    on = ", ".join(f'"{f}"' for f in REPORT_FEATURES)
    shares = ", ".join(
        f"avg(CASE WHEN transaction_type = '{t}' THEN 1.0 ELSE 0.0 END) AS \"tx_type_{t}_rate\""
        for t in ["resign", "card_recurring", "apple-pay", "google-pay"])
    share_cols = ", ".join(f'coalesce(s."tx_type_{t}_rate", 0) AS "tx_type_{t}_rate"'
                           for t in ["resign", "card_recurring", "apple-pay", "google-pay"])
    return f"""
SELECT * FROM (WITH fz AS (
  SELECT f.* REPLACE (f.time_to_first_transaction_eda AS time_to_first_transaction),
         hour(f.timestamp_reg) AS reg_hour, CAST(hour(f.timestamp_reg) < 6 AS INTEGER) AS reg_is_night, {share_cols}
  FROM feat f LEFT JOIN (SELECT id_user AS sid, {shares} FROM transactions
                         WHERE transaction_type IS NOT NULL GROUP BY 1) s ON f.id_user = s.sid),
l AS (UNPIVOT (SELECT is_fraud, {cast} FROM fz) ON {on} INTO NAME feature VALUE value),
r AS (SELECT feature, value, is_fraud, rank() OVER (PARTITION BY feature ORDER BY value) AS rk,
             count(*) OVER (PARTITION BY feature, value) AS ties FROM l),
a AS (SELECT feature, count(*) AS n, sum(is_fraud) AS n1, count(*) - sum(is_fraud) AS n0,
             sum(CASE WHEN is_fraud = 1 THEN rk + (ties - 1) / 2.0 END) AS rs,
             CASE WHEN stddev_samp(value) > 0 THEN corr(value, is_fraud) END AS corr FROM r GROUP BY 1)
SELECT feature, greatest((rs - n1 * (n1 + 1) / 2.0) / (n1 * n0), 1 - (rs - n1 * (n1 + 1) / 2.0) / (n1 * n0)) AS auc,
       corr, n FROM a WHERE n >= 100) AS y"""


@query("t04_t05_feature_report", _report_sql())
def q_feature_report(spark, sf_dir):
    return A.feature_report(report_frame(fixture(spark, sf_dir)), REPORT_FEATURES)


@query("t06_phi", "SELECT corr(is_cvv_error, is_fraud) AS phi, count(*) AS n FROM feat")
def q_phi(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    return A.phi(build_features(fx.users, fx.transactions), "is_cvv_error", "is_fraud")


def _fraction(terms: int, step: str, first: str) -> str:
    """A continued fraction from its last term up: ``step`` is what stands above term i, given ``acc`` below."""
    return f"list_reduce(range({terms}, 0, -1), lambda acc, i: {step}, CAST({first} AS DOUBLE))"


def _chi2_log10(chi2: str, dof: str) -> str:
    """log10 of the upper tail: the fraction of Gamma(a, x), or 1 less the power series below a + 1."""
    a, x = f"(CAST({dof} AS DOUBLE) / 2)", f"(CAST({chi2} AS DOUBLE) / 2)"
    above = _fraction(2000, f"{x} + 2 * i - 1 - {a} - i * (i - {a}) / acc", f"{x} + 4001 - {a}")
    below = _fraction(500, f"1 + {x} / ({a} + i) * acc", "1")
    return (f"CASE WHEN {dof} <= 0 OR {x} <= 0 THEN 0 WHEN {x} < {a} + 1 THEN log10(1 - exp({a} * ln({x}) - {x} - lgamma({a} + 1)) * {below}) "
            f"ELSE ({a} * ln({x}) - {x} - lgamma({a}) - ln({above})) / ln(10) END")


def _beta_ln(a: str, b: str, x: str) -> str:
    odd = f"-({a} + (i - 1) / 2) * ({a} + {b} + (i - 1) / 2)"
    fraction = _fraction(400, f"1 + CASE WHEN i % 2 = 0 THEN (i / 2) * ({b} - i / 2) ELSE {odd} END * {x} / (({a} + i - 1) * ({a} + i)) / acc", "1")
    return f"(lgamma({a} + {b}) - lgamma({a}) - lgamma({b}) + {a} * ln({x}) + {b} * ln(1 - {x}) - ln({a}) - ln({fraction}))"


def _corr_log10(r: str, n: str) -> str:
    """log10 of the two-sided p of a correlation."""
    a, r2 = f"(CAST({n} - 2 AS DOUBLE) / 2)", f"(CAST({r} AS DOUBLE) * {r})"
    return (f"CASE WHEN {r} IS NULL OR {n} <= 2 THEN NULL WHEN {r2} = 0 THEN 0 WHEN 1 - {r2} < ({a} + 1) / ({a} + 2.5) THEN "
            f"{_beta_ln(a, 'CAST(0.5 AS DOUBLE)', f'(1 - {r2})')} / ln(10) ELSE log10(1 - exp({_beta_ln('CAST(0.5 AS DOUBLE)', a, r2)})) END")


_PVALUES = f"""
SELECT test, subject, statistic, power(10, log10_p) AS p_value, log10_p FROM (
  SELECT 'chi2' AS test, pair AS subject, chi2 AS statistic, {_chi2_log10('chi2', 'dof')} AS log10_p
  FROM ({" UNION ALL ".join(f"SELECT * FROM {_chi2_sql(U_DOM, c, 'is_fraud')}" for c in USER_CATS)})
  UNION ALL SELECT 'point_biserial', feature, corr, {_corr_log10('corr', 'n')} FROM ({_report_sql()})
  UNION ALL SELECT 'phi', 'is_cvv_error', phi, {_corr_log10('phi', 'n')}
  FROM (SELECT corr(is_cvv_error, is_fraud) AS phi, count(*) AS n FROM feat))"""


@query("t_pvalues", _PVALUES)
def q_pvalues(spark, sf_dir):
    """p-values of T1, T4 and T6 and their logarithms (scalar tails on the statistics tables)."""
    fx = fixture(spark, sf_dir)
    ps = ["p_value", "log10_p"]
    chi = A.chi2_table(users_d(fx), USER_CATS, "is_fraud").select(
        F.lit("chi2").alias("test"), F.col("column").alias("subject"), F.col("chi2").alias("statistic"), *ps)
    rep = A.feature_report(report_frame(fx), REPORT_FEATURES, with_p=True).select(
        F.lit("point_biserial").alias("test"), F.col("feature").alias("subject"), F.col("corr").alias("statistic"), *ps)
    ph = A.phi(build_features(fx.users, fx.transactions), "is_cvv_error", "is_fraud", with_p=True).select(
        F.lit("phi").alias("test"), F.lit("is_cvv_error").alias("subject"), F.col("phi").alias("statistic"), *ps)
    return chi.unionByName(rep).unionByName(ph)


@query("j04_users_with_event", """
SELECT u.id_user FROM users u WHERE u.is_fraud = 1
  AND u.id_user IN (SELECT id_user FROM transactions WHERE error_group = 'fraud')""")
def q_semi(spark, sf_dir):
    fx = fixture(spark, sf_dir)
    ev = fx.transactions.filter(F.col("error_group") == "fraud").select("id_user")
    return fx.users.filter(F.col("is_fraud") == 1).join(ev, "id_user", "left_semi").select("id_user")


@query("p14_distinct_values", f"SELECT DISTINCT domain FROM {U_DOM}")
def q_distinct(spark, sf_dir):
    return users_d(fixture(spark, sf_dir)).select("domain").distinct()


@query("p16_sample_first", """
SELECT id_user, is_fraud FROM users ORDER BY md5(CAST(id_user AS VARCHAR)), id_user LIMIT 50000""")
def q_sample(spark, sf_dir):
    return S.sample_first(fixture(spark, sf_dir).users, 50_000, "id_user").select("id_user", "is_fraud")


@query("s09_profile_schema", f"""
SELECT "column", non_null FROM (UNPIVOT (SELECT {", ".join(f'count({c}) AS {c}' for c in
    ["id_user", "email", "gender", "reg_country", "traffic_type", "timestamp_reg", "is_fraud"])} FROM users)
  ON COLUMNS(*) INTO NAME "column" VALUE non_null)""")
def q_profile(spark, sf_dir):
    return S.profile_schema(fixture(spark, sf_dir).users).select("column", "non_null")


@query("s10_shape", "SELECT count(*) AS rows, 14 AS columns FROM transactions")
def q_shape(spark, sf_dir):
    return S.shape(fixture(spark, sf_dir).transactions)


@query("s11_class_balance", """
SELECT count(*) AS users, CAST(sum(is_fraud) AS BIGINT) AS frauds, avg(is_fraud) * 100.0 AS fraud_percent FROM users""")
def q_class_balance(spark, sf_dir):
    return S.class_balance(fixture(spark, sf_dir).users)


@query("j02_label_transactions", f"SELECT id_tx, id_user, reg_country, is_fraud, domain FROM {MERGED}")
def q_label_tx(spark, sf_dir):
    return merged(fixture(spark, sf_dir)).select("id_tx", "id_user", "reg_country", "is_fraud", "domain")
