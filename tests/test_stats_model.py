"""p-values, folds, sweep, report, sinks, isolation forest."""
import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from riskweave.functions.pvalues import betainc, chi2_sf, corr_pvalue
from riskweave.operators.anomaly import isolation_forest
from riskweave.operators.association import auc_from_long, _long
from riskweave.operators.evaluate import best_threshold, classification_report, threshold_sweep
from riskweave.operators.folds import assign_folds
from riskweave.sources.fixtures import load_fixture
from riskweave.sources.io import load_csv, metrics_table, publish, write_predictions


def test_pvalues_known_values():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(10, 5) == pytest.approx(0.0752352461, rel=1e-8)
    assert corr_pvalue(0.5, 10) == pytest.approx(0.141113281, rel=1e-8)
    assert betainc(2, 3, 0.4) == pytest.approx(0.5248, rel=1e-9)


def test_folds_are_stratified_and_match_plain_window(spark):
    fx = load_fixture(spark, SF01)
    f = assign_folds(fx.train_users)
    sizes = {(r.is_fraud, r.fold): r.n for r in f.groupBy("is_fraud", "fold").agg(F.count("*").alias("n")).collect()}
    for y in (0, 1):
        v = [sizes[(y, k)] for k in range(5)]
        assert max(v) - min(v) <= 1
    plain = spark.sql("select 1").sparkSession.createDataFrame(
        fx.train_users.select("id_user", "is_fraud").toPandas())
    plain.createOrReplaceTempView("tu")
    ref = spark.sql("""select id_user, cast((row_number() over (partition by is_fraud
        order by md5(concat(cast(id_user as string), ':42')), id_user) - 1) % 5 as int) as fold from tu""")
    assert sorted(map(tuple, ref.collect())) == sorted(map(tuple, f.select("id_user", "fold").collect()))


def test_sweep_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.uniform(0, 1, 500), 2)            # many exact grid hits
    y = (rng.uniform(0, 1, 500) < p).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, is_fraud int")
    sw = {r.i: r.f1 for r in threshold_sweep(df).collect()}
    for i in range(65):
        t = 0.05 + 0.01 * i
        pred = p >= t
        tp, fp, fn = (pred & (y == 1)).sum(), (pred & (y == 0)).sum(), (~pred & (y == 1)).sum()
        assert sw[i] == pytest.approx(2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0)
    best = best_threshold(threshold_sweep(df)).first()
    assert best.best_f1 == pytest.approx(max(sw.values()))
    rep = {r.label: r for r in classification_report(df, 0.5).collect()}
    assert rep["accuracy"].f1 == pytest.approx(((p >= 0.5) == (y == 1)).mean())


def test_auc_prefix_sums_match_pairwise(spark):
    rng = np.random.default_rng(5)
    v = np.round(rng.normal(size=400), 1)
    y = (rng.uniform(size=400) < 0.3).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(v, y)], "f double, is_fraud int")
    auc = auc_from_long(_long(df, ["f"], "is_fraud"), n_buckets=8).first().auc_raw
    pos, neg = v[y == 1], v[y == 0]
    ref = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert auc == pytest.approx(ref, rel=1e-12)


def test_sinks_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="rw-sink-")
    df = spark.createDataFrame([(1, 0), (2, 1)], "id_user long, is_fraud int")
    write_predictions(df, f"{out}/pred")
    back = load_csv(spark, f"{out}/pred", "id_user long, is_fraud int")
    assert sorted(map(tuple, back.collect())) == [(1, 0), (2, 1)]
    assert publish(df, "nosuchscheme://bucket/x") is False
    m = metrics_table(spark, spark.createDataFrame([(0.49, 0.65)], "best_threshold double, best_f1 double"),
                      spark.createDataFrame([(3.83,)], "fraud_percent double")).first()
    assert (m.best_threshold, m.best_f1, m.fraud_rate_percent) == (0.49, 0.65, 3.83)


def test_isolation_forest_is_deterministic_and_meets_contamination(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(1000, 3))
    X[:20] += 8                                            # clear outliers
    df = spark.createDataFrame([(i, *map(float, X[i])) for i in range(1000)], "id_user long, a double, b double, c double")
    a = isolation_forest(df, ["a", "b", "c"], n_trees=50).select("id_user", "iso_score", "iso_label")
    b = isolation_forest(df, ["a", "b", "c"], n_trees=50).select("id_user", "iso_score", "iso_label")
    ra, rb = sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))
    assert ra == rb
    flagged = {r[0] for r in ra if r[2] == -1}
    assert abs(len(flagged) - 38) <= 2
    assert len(flagged & set(range(20))) >= 18


def test_checkpoint_dir_required_off_local_mode():
    from types import SimpleNamespace
    from riskweave.session import ensure_checkpoint_dir
    sc = SimpleNamespace(master="spark://cluster:7077", getCheckpointDir=lambda: None,
                         setCheckpointDir=lambda d: pytest.fail("no local folder may be set on a cluster"))
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)
    shared = SimpleNamespace(master="yarn", getCheckpointDir=lambda: "hdfs:///ckpt/app-1", setCheckpointDir=None)
    assert ensure_checkpoint_dir(SimpleNamespace(sparkContext=shared, conf=fake.conf)) == "hdfs:///ckpt/app-1"
