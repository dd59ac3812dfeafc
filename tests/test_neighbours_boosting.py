"""Metric-partition neighbours, radix medians and histogram boosting against brute force."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.operators import boosting, neighbours
from riskweave.operators.knn import TrainNeighbours, collapse, knn_stats, numbered
from riskweave.operators.user_aggs import _amount_counts, amount_bin, amount_median

COLS = [f"x{i}" for i in range(5)]


def frame(spark, X):
    return spark.createDataFrame(pd.DataFrame({"id_user": np.arange(len(X)), **{c: X[:, k] for k, c in enumerate(COLS)}})).repartition(5)


def brute(Q, B, k):
    return np.sort(np.sqrt(((Q[:, None] - B[None]) ** 2).sum(-1)), 1)[:, :k]


def points(seed=3):
    """Clusters, heavy tails, far outliers and a third of all rows equal."""
    rng = np.random.default_rng(seed)
    X = np.r_[rng.normal(size=(500, 5)), rng.lognormal(sigma=2, size=(500, 5)), rng.normal(size=(200, 5)) * 0.01 + 7,
              rng.normal(size=(5, 5)) * 1e6]
    return np.r_[X, np.repeat(X[:1], len(X) // 2, 0)]


@pytest.mark.parametrize("chunk,cells", [(128, None), (2, 40)])
def test_neighbours_of_uneven_data(spark, monkeypatch, chunk, cells):
    monkeypatch.setattr(neighbours, "CHUNK", chunk)
    X = points()
    base = numbered(collapse(frame(spark, X), COLS))
    found = neighbours.neighbour_table(base, 5, 6, cells=cells)
    ids = {r["id"]: np.array(r["v"]) for r in base.collect()}
    got = {}
    for r in found.collect():
        got.setdefault(r["id"], []).append(r["dist"])
    B = np.array(list(ids.values()))
    ref = brute(B, B, 6)
    assert len(got) == len(ids)
    for k, i in enumerate(ids):
        assert sorted(got[i]) == pytest.approx(ref[k], rel=1e-12, abs=1e-9)


def test_few_base_vectors(spark):
    X = points()[:4]
    base = numbered(collapse(frame(spark, X), COLS))
    assert neighbours.neighbour_table(base, 5, 10).count() == 16
    assert neighbours.neighbour_table(numbered(collapse(frame(spark, X).limit(0), COLS)), 5, 10).count() == 0


def test_approximate_mode_finds_nine_in_ten(spark):
    X = np.random.default_rng(8).normal(size=(3000, 5))
    df = frame(spark, X)
    near = {r["id_user"]: r["knn_max_dist"] for r in knn_stats(df, df, COLS, k=10, mode="approximate").collect()}
    exact = brute(X, X, 10)
    assert all(near[i] >= exact[i, -1] - 1e-9 for i in range(len(X)))
    # an exact list has no neighbour beyond the exact k-th distance
    assert np.mean([near[i] <= exact[i, -1] + 1e-9 for i in range(len(X))]) > 0.5
    base = numbered(collapse(df, COLS))
    full = neighbours.neighbour_table(base, 5, 10)
    some = neighbours.neighbour_table(base, 5, 10, cells=55, probes=8)
    assert full.join(some, ["id", "nid"]).count() >= 0.9 * full.count()
    with pytest.raises(ValueError):
        knn_stats(df, df, COLS, mode="nearly")


def test_one_table_serves_several_depths(spark):
    X = points(4)[:300]
    df = frame(spark, X)
    near = TrainNeighbours(df, COLS, depth=9)
    got = {r["id_user"]: r["knn_avg_dist"] for r in near.stats(k=4, kth=2).collect()}
    ref = brute(X, X, 4).mean(1)
    assert [got[i] for i in range(300)] == pytest.approx(ref)
    with pytest.raises(ValueError):
        near.taken(9, exclude_self=True)


def test_median_of_a_hot_user(spark):
    rng = np.random.default_rng(1)
    hot = np.round(rng.lognormal(3, 1.5, 40_000), 2)
    rows = [(1, float(x)) for x in hot] + [(2, x) for x in (-5.0, -0.5, 0.0, 3.0)] + [(3, None), (4, 7.0), (4, None),
            (5, float("inf")), (5, 1.0), (5, 2.0), (6, 1e-300), (6, -1e300)]
    df = spark.createDataFrame(rows, "id_user long, amount double")
    got = {r["id_user"]: r["amount_median"] for r in amount_median(df).collect()}
    assert got == {1: pytest.approx(np.median(hot)), 2: -0.25, 4: 7.0, 5: 2.0, 6: pytest.approx(-5e299)}
    # windows are per (user, bin): none holds more than a sliver of the hot user's amounts
    binned = _amount_counts(df).withColumn("b", amount_bin())
    largest = binned.groupBy("id_user", "b").count().agg(F.max("count")).first()[0]
    assert largest < 0.02 * len(set(hot))
    order = [r["b"] for r in binned.filter("amount is not null").orderBy("amount").collect()]
    assert order == sorted(order)


# ------------------------------------------------------------------ boosting

def table(spark, n=900, seed=0):
    rng = np.random.default_rng(seed)
    X = np.round(rng.normal(size=(n, 5)), 2)
    y = (X[:, 0] * X[:, 1] + X[:, 2] + rng.normal(size=n) * 0.3 > 0.4).astype(int)
    df = frame(spark, X).join(spark.createDataFrame([(i, int(v), i % 5) for i, v in enumerate(y)], "id_user long, is_fraud int, fold int"), "id_user")
    return X, y, df


def auc(p, y):
    ranks = pd.Series(p).rank().to_numpy()
    return (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_boosting_out_of_fold(spark):
    X, y, df = table(spark)
    model, rows = boosting.fit_boosted(df, COLS, n_estimators=80, learning_rate=0.1, min_child_samples=10)
    got = {r["id_user"]: r["p"] for r in boosting.boosted_oof(model, rows).collect()}
    p = np.array([got[i] for i in range(len(y))])
    assert auc(p, y) > 0.93
    assert sorted(model.trees) == [0, 1, 2, 3, 4, 5] and all(len(t) == 80 for t in model.trees.values())
    # the scores equal those of the model fitted outside Spark on the rows of the other folds
    edges = boosting.bin_edges(df, COLS)
    bins = np.stack([np.searchsorted(e, X[:, k], "left") for k, e in enumerate(edges)], 1).astype(np.uint8)
    params = {**boosting.BOOSTING, "n_estimators": 80, "learning_rate": 0.1, "min_child_samples": 10}
    fold = np.arange(len(y)) % 5
    start, trees = boosting.grow_model(bins[fold != 2], y[fold != 2].astype(float), np.array([len(e) + 1 for e in edges]), params)
    ref = 1 / (1 + np.exp(-(start + boosting.walk(trees, bins[fold == 2]))))
    assert p[fold == 2] == pytest.approx(ref, abs=1e-12)
    top = boosting.boosted_importance(spark, model).collect()
    assert {r["feature"] for r in top[:3]} == {"x0", "x1", "x2"}
    labels = boosting.boosted_labels(model, df.drop("is_fraud", "fold"), 0.5)
    assert 0.85 < np.mean([r["is_fraud"] == y[r["id_user"]] for r in labels.collect()]) <= 1


def test_first_split_is_the_best_of_all(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (200, 4)).astype(np.uint8)
    y = ((x[:, 2] > 2) ^ (rng.random(200) < 0.2)).astype(float)
    params = {**boosting.BOOSTING, "n_estimators": 1, "max_depth": 1, "colsample_bytree": 1.0, "min_child_samples": 20}
    start, (nodes,) = boosting.grow_model(x, y, np.full(4, 6), params)
    w = np.where(y == 1, 2.0, 1.0)
    p = 1 / (1 + np.exp(-start))
    g, h = (p - y) * w, p * (1 - p) * w

    def score(m):
        a = max(abs(g[m].sum()) - 2.0, 0)
        return a * a / (h[m].sum() + 1.5)

    gains = {(c, b): score(x[:, c] <= b) + score(x[:, c] > b) - score(np.ones(200, bool)) for c in range(4) for b in range(5)
             if min((x[:, c] <= b).sum(), (x[:, c] > b).sum()) >= 20}
    assert tuple(nodes[0][:2]) == max(gains, key=gains.get)
    assert nodes[0][5] == pytest.approx(max(gains.values()))


def test_the_fit_is_bounded_and_scores_everything(spark):
    _, y, df = table(spark)
    model, rows = boosting.fit_boosted(df, COLS, n_estimators=5, min_child_samples=5, max_rows=200, with_folds=False)
    assert boosting.predict_boosted(model, rows, model.final).count() == len(y)
    with pytest.raises(ValueError):
        boosting.fit_boosted(df, COLS, depth=3)


def test_models_are_fitted_on_all_rows(spark):
    # more rows than the fits once drew; models 0..4 and 5 take the rows of the other folds and all rows
    n = 230_000
    df = spark.range(n).select(F.col("id").alias("id_user"), (F.col("id") % 3 == 0).cast("int").alias("is_fraud"),
                               (F.col("id") % 5).cast("int").alias("fold"), (F.col("id") % 7).alias("a"), (F.col("id") % 11).alias("b"))
    model, _ = boosting.fit_boosted(df, ["a", "b"], n_estimators=1)
    ids = np.arange(n)
    for m in range(6):
        y = ids[ids % 5 != m] % 3 == 0
        weighted = 2 * y.sum() / (2 * y.sum() + (~y).sum())
        assert model.starts[m] == pytest.approx(np.log(weighted / (1 - weighted)), abs=1e-12)
    assert sorted(model.trees) == [0, 1, 2, 3, 4, 5]


def test_a_fit_on_disk_equals_one_in_memory(monkeypatch):
    fits = []
    for limit in (boosting.MATRIX_BYTES, 0):
        monkeypatch.setattr(boosting, "MATRIX_BYTES", limit)
        x = boosting._matrix(5, 900)
        assert isinstance(x, np.memmap) == (limit == 0)
        x[:] = np.random.default_rng(1).integers(0, 9, (5, 900))
        y = (x[0] > 4).astype(float)
        fits.append(boosting.grow_model(x.T, y, np.full(5, 9), {**boosting.BOOSTING, "n_estimators": 3}))
    assert fits[0] == fits[1]


def test_histogram_sums_every_bin_in_row_order():
    rng = np.random.default_rng(8)
    bins = np.array([7, 1, 256, 40])
    x = np.stack([rng.integers(0, n, 500) for n in bins], 1).astype(np.uint8)
    g, h = rng.standard_normal(500), rng.random(500)
    grower = boosting._Grower(x, bins, boosting.BOOSTING)
    for rows in (np.arange(500), np.flatnonzero(rng.random(500) < 0.3), np.zeros(0, np.int64)):
        got, begin = grower.histogram(rows, g, h), 0
        assert got.shape == (3, bins.sum())
        for c, n in enumerate(bins):
            for b in range(n):
                here = [r for r in rows if x[r, c] == b]
                total = [0.0, 0.0]
                for r in here:
                    total = [total[0] + g[r], total[1] + h[r]]
                assert got[:, begin + b].tolist() == [*total, len(here)]
            begin += n
