"""Edge contract (FIXTURES.md §4): one hand-made frame per rule."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import make_tx, make_users
from riskweave.operators.quantiles import exact_quantiles
from riskweave.operators.stats import describe_num
from riskweave.operators.anomaly import robust_fit
from riskweave.operators.association import _cells, chi2_from_cells
from riskweave.operators.encode import target_encode_apply
from riskweave.plans.features import build_features
from riskweave.functions.exprs import email_domain


def feats(spark, tx_rows, user_rows=None, **kw):
    users = make_users(spark, user_rows or [{}])
    tx = make_tx(spark, tx_rows)
    return {r["id_user"]: r.asDict() for r in build_features(users, tx, keep_helpers=True, **kw).collect()}


def test_null_vs_null_country_is_mismatch(spark):
    f = feats(spark, [{"card_country": None, "payment_country": None}])[1]
    assert f["country_CP_missmatch_coef"] == 1.0


def test_single_transaction(spark):
    f = feats(spark, [{}])[1]
    assert f["amount_std"] == 0.0 and f["hour_std"] == 0.0
    assert f["min_time_between_tx"] is None and f["status_changes"] == 0


def test_user_without_transactions(spark):
    f = feats(spark, [{"id_user": 1}], [{"id_user": 1}, {"id_user": 2}])[2]
    assert f["tx_count"] == 0 and f["fail_status_coefficient"] == 0 and f["unique_cards_per_user"] == 0
    assert f["amount_sum"] is None and f["max_users_sharing_card"] is None and f["avg_card_tx"] is None


def test_mode_tie_takes_smallest(spark):
    f = feats(spark, [{"card_holder": h} for h in ["a", "b", "a", "b"]])[1]
    assert f["main_card_holder"] == "a" and f["holder_name_length"] == 1


def test_all_holders_null(spark):
    f = feats(spark, [{"card_holder": None}, {"card_holder": None}])[1]
    assert (f["holder_name_length"], f["holder_name_words"], f["unique_card_holders"]) == (0, 0, 0)


def test_first_status_null_uses_first_non_null(spark):
    f = feats(spark, [{"status": None}, {"status": "fail"}, {"status": "success"}])[1]
    assert f["first_tx_failed"] == 1


def test_never_succeeds(spark):
    f = feats(spark, [{"status": "fail"}] * 3)[1]
    assert f["fails_before_first_success"] == 3 and f["max_consecutive_fails"] == 3


@pytest.mark.parametrize("seg_us", [1, 60_000_000, 3_600_000_000, 10**15])
def test_streak_split_any_segment_width(spark, seg_us):
    f = feats(spark, [{"status": s} for s in ["fail", "fail", "success", "fail"]], segment_us=seg_us)[1]
    assert f["max_consecutive_fails"] == 2 and f["status_changes"] == 2


def test_email_without_at(spark):
    df = make_users(spark, [{"email": "abc"}, {"id_user": 2, "email": "a@b@c"}, {"id_user": 3, "email": None}])
    got = {r.id_user: r.d for r in df.select("id_user", email_domain("email").alias("d")).collect()}
    assert got == {1: "missing", 2: "b", 3: "missing"}


def test_upper_case_holder_never_matches(spark):
    f = feats(spark, [{"card_holder": "ANNA K"}], [{"email": "anna@x"}])[1]
    assert f["name_in_email"] == 0
    g = feats(spark, [{"card_holder": "anna k"}], [{"email": "Anna@x"}])[1]
    assert g["name_in_email"] == 1


def test_amount_entropy_concentration_small_rate(spark):
    f = feats(spark, [{"amount": a} for a in [5.0, 5.0, 7.0, 9.0]])[1]
    assert f["amount_entropy"] == pytest.approx(1.039721, abs=1e-6)
    assert f["amount_mode_concentration"] == 0.5 and f["small_amount_rate"] == 0.5


def test_registration_after_first_transaction(spark):
    from riskweave.operators.user_aggs import time_to_first
    u = make_users(spark, [{"timestamp_reg": dt.datetime(2024, 1, 2)}])
    df = u.withColumn("first_timestamp_tr", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp"))
    r = df.select(time_to_first(clip=True).alias("c"), time_to_first(clip=False).alias("u")).first()
    assert r.c == 0.0 and r.u == -86400.0


def test_two_by_two_yates(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 40
    df = spark.createDataFrame(rows, "p string, q string")
    cells = _cells(df, [("pq", F.col("p"), F.col("q"))])
    y = chi2_from_cells(cells, yates=True).first()
    n = chi2_from_cells(cells, yates=False).first()
    assert y.chi2 == pytest.approx(0.446429, abs=1e-6) and n.chi2 == pytest.approx(0.793651, abs=1e-6)


def test_unseen_and_null_category_get_global_mean(spark):
    tr = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("b", 1)], "c string, is_fraud int")
    te = spark.createDataFrame([("z",), (None,)], "c string")
    got = [r.c_enc for r in target_encode_apply(tr, te, "c").collect()]
    assert got == [pytest.approx(0.75), pytest.approx(0.75)]


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (3.0,)], "x double")
    assert robust_fit(df, ["x"]) == {"x": (3.0, 1.0)}


def test_last_10_cvv(spark):
    rows = [{"error_group": "cvv error"}] + [{}] * 10     # the cvv error is the 11th latest
    assert feats(spark, rows)[1]["is_cvv_error"] == 0
    rows = [{}] + [{"error_group": "cvv error"}] + [{}] * 9
    assert feats(spark, rows)[1]["is_cvv_error"] == 1


def test_fails_before_first_success_counts_all_statuses(spark):
    f = feats(spark, [{"status": None}, {"status": "fail"}, {"status": "success"}, {"status": "fail"}])[1]
    assert f["fails_before_first_success"] == 2


def test_median_from_amount_counts_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    rows, want = [], {}
    for u, size in [(1, 1), (2, 2), (3, 7), (4, 200), (5, 3)]:
        vals = [float(v) for v in rng.integers(0, 12, size)]     # many repeated amounts
        if u == 5:
            vals = [None] * size                                   # only NULL amounts -> NULL median
        rows += [{"id_user": u, "amount": v} for v in vals] + [{"id_user": u, "amount": None}]
        nn = [v for v in vals if v is not None]
        want[u] = float(np.median(nn)) if nn else None
    users = [{"id_user": u} for u in want]
    got = {u: f["amount_median"] for u, f in feats(spark, rows, users).items()}
    assert got == want


@pytest.mark.parametrize("tied", [0.0, 0.5, 0.9, 1.0])
def test_exact_quantiles_with_ties(spark, tied):
    rng = np.random.default_rng(5)
    x = np.where(rng.random(3000) < tied, 0.0, np.round(rng.normal(size=3000), 2))
    g = np.arange(3000) % 3
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x, strict=True)] + [(7, None)], "g int, x double")
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))] for r in exact_quantiles(df, "x", probs, by=["g"], accuracy=200).collect()}
    assert sorted(got) == [0, 1, 2]
    for k, q in got.items():
        assert np.allclose(q, np.quantile(x[g == k], probs), rtol=0, atol=1e-12)


def test_quantiles_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1, None), (2, None), (2, 3.0)], "g int, x double")
    none = exact_quantiles(df.filter("g = 1"), "x", [0.5]).collect()
    assert [(r["n"], r["q0"]) for r in none] == [(0, None)]
    by = {r["g"]: (r["count"], r["p50"]) for r in describe_num(df, "x", by="g").collect()}
    assert by == {1: (0, None), 2: (1, 3.0)}
