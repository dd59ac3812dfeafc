"""Unsupervised anomaly scores (inventory G7, G10-G12).

G7 robust scaling fits exact quartiles in one aggregate (3 scalars per
column) and applies them as literals.  G11 LOF is built on the exact KNN join
(``knn.TrainNeighbours``) with joins and aggregates only.  G10 Isolation Forest
builds each tree from a 256-row sample in ``applyInPandas`` (one group per
tree), collects the forest (bounded: trees x at most 511 nodes) and scores all
rows with a vectorised ``mapInPandas``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .quantiles import exact_quantiles
from .knn import TrainNeighbours, vector_col

# Fixed values from the reference: the anomaly feature subset (14 columns).
ANOMALY_FEATURES = [
    "errors_x_cards", "holders_x_cards", "unique_card_holders", "unique_error_types", "unique_cards_per_user",
    "tx_count", "fail_status_coefficient", "countries_per_tx", "amount_sum", "amount_range",
    "min_time_between_tx", "max_consecutive_fails", "max_hourly_burst", "unique_amounts_per_tx",
]
# Fixed values from the reference: the exploratory notebook's anomaly feature set (23 columns).
EDA_ANOMALY_FEATURES = [
    "errors_x_cards", "holders_x_cards", "unique_card_holders", "unique_error_types", "unique_cards_per_user",
    "tx_count", "fail_status_coefficient", "countries_per_tx", "min_time_between_tx", "amount_sum",
    "unique_card_brands", "unique_card_types", "country_CP_missmatch_coef", "error_antifraud_rate",
    "errors_per_tx", "country_CReg_missmatch", "fraud_error_count", "holders_per_card",
    "fraud_error_rate", "tx_type_card_init_rate", "error_3ds_error_rate", "holders_per_tx", "amount_range",
]
CONTAMINATION = 0.038
LRD_EPS = 1e-10


def robust_fit(train: DataFrame, cols) -> dict[str, tuple[float, float]]:
    """Median and IQR per column (NULL -> 0 first); zero IQR -> scale 1.

    Exact quartiles of all columns in one distributed pass (columns unpivoted
    to (name, value), ``exact_quantiles`` by name): no column is gathered
    into one buffer.
    """
    arr = F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("x"))
                    for c in cols])
    long = train.select(F.explode(arr).alias("_c")).select("_c.name", "_c.x")
    q = {r["name"]: (r["q0"], r["q1"], r["q2"]) for r in
         exact_quantiles(long, "x", [0.25, 0.5, 0.75], by=["name"]).collect()}
    out = {}
    for c in cols:
        q1, med, q3 = q[c]
        iqr = q3 - q1
        out[c] = (med, iqr if iqr != 0 else 1.0)
    return out


def robust_apply(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({
        f"{c}{suffix}": (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(med)) / F.lit(scale)
        for c, (med, scale) in params.items()})


def lof(df: DataFrame, cols, k: int = 20, contamination: float = CONTAMINATION,
        neighbours: TrainNeighbours | None = None) -> DataFrame:
    """Local Outlier Factor of every row (self excluded, duplicates
    counted), ``lof_score`` (= -negative_outlier_factor) and ``lof_label``
    (-1 for the ``contamination`` share with the lowest negative factor).

    ``neighbours``: the table of ``df``'s vectors, at least ``k`` + 1 deep, if it is at hand."""
    near = neighbours or TrainNeighbours(df, cols, k + 1)
    nb = cut_lineage(near.taken(k, exclude_self=True))
    kd = nb.groupBy("id").agg(F.max("dist").alias("kd"))
    reach = (nb.join(kd.withColumnRenamed("id", "nid").withColumnRenamed("kd", "nkd"), "nid")
             .withColumn("reach", F.greatest("nkd", "dist")))
    lrd = cut_lineage(reach.groupBy("id").agg(
        (1.0 / (F.sum(F.col("take") * F.col("reach")) / F.lit(float(k)) + F.lit(LRD_EPS))).alias("lrd")))
    ratio = (nb.join(lrd.withColumnRenamed("id", "nid").withColumnRenamed("lrd", "nlrd"), "nid")
             .groupBy("id").agg((F.sum(F.col("take") * F.col("nlrd")) / F.lit(float(k))).alias("_mean_nlrd")))
    score = ratio.join(lrd, "id").select("id", (F.col("_mean_nlrd") / F.col("lrd")).alias("lof_score"))
    # every row gets its vector's score; the offset is an exact quantile over
    # those rows (= the multiplicity-weighted quantile over distinct vectors)
    rows = cut_lineage(near.attach(score, df))
    offset = exact_quantiles(rows.select((-F.col("lof_score")).alias("nof")), "nof",
                             [float(contamination)]).first()["q0"]
    return rows.withColumn("lof_label", F.when(F.col("lof_score").isNull(), F.lit(None).cast("int"))
                           .when(-F.col("lof_score") < F.lit(offset), -1).otherwise(1))


def anomaly_quality(df: DataFrame, label: str, y: str = "is_fraud") -> DataFrame:
    """Precision, recall and F1 of ``label == -1`` against ``y``, plus counts."""
    anom = F.col(label) == -1
    yy = F.col(y).cast("double")
    q = df.agg(F.count_if(anom).alias("anomalies"), F.sum(yy).alias("frauds"),
               F.sum(F.when(anom, yy).otherwise(0.0)).alias("tp"))
    p = F.try_divide(F.col("tp"), F.col("anomalies").cast("double"))
    r = F.try_divide(F.col("tp"), F.col("frauds"))
    return q.select(F.col("anomalies").cast("long"), F.col("frauds").cast("long"), F.col("tp").cast("long"),
                    p.alias("precision"), r.alias("recall"),
                    (2 * p * r / (p + r + F.lit(1e-6))).alias("f1"))


# ----------------------------------------------------------------- isolation forest

def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


_TREE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("depth", T.IntegerType()), T.StructField("size", T.IntegerType()),
])


def _grow(pdf: pd.DataFrame, d: int, max_depth: int, seed: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    X = np.vstack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, d))
    rng = np.random.default_rng(seed * 100003 + tree)
    rows = []
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        node, idx, depth = stack.pop()
        sub = X[idx]
        if depth >= max_depth or len(idx) <= 1:
            rows.append((tree, node, -1, 0.0, -1, -1, depth, len(idx)))
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if len(usable) == 0:
            rows.append((tree, node, -1, 0.0, -1, -1, depth, len(idx)))
            continue
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        left = idx[sub[:, f] < thr]
        right = idx[sub[:, f] >= thr]
        lid, rid = next_id, next_id + 1
        next_id += 2
        rows.append((tree, node, f, thr, lid, rid, depth, len(idx)))
        stack.append((lid, left, depth + 1))
        stack.append((rid, right, depth + 1))
    return pd.DataFrame(rows, columns=[f.name for f in _TREE_SCHEMA.fields])


def isolation_forest(df: DataFrame, cols, n_trees: int = 200, max_samples: int = 256,
                     contamination: float = CONTAMINATION, seed: int = 42, key: str = "id_user") -> DataFrame:
    """``iso_score`` (decision function, lower = more anomalous) and
    ``iso_label`` (-1 anomaly / 1 normal) for every row.

    Sampling: a Bernoulli pool of about 4 x trees x max_samples rows, then per
    tree the ``max_samples`` pool rows with the smallest seeded hash (a
    partial top-k per task).  The pool size is bounded, not the data.
    """
    d = len(cols)
    spark = df.sparkSession
    x = vector_col(cols)
    n = df.count()
    psi = min(max_samples, n)
    frac = min(1.0, 4.0 * n_trees * psi / max(n, 1))
    pool = df.select(F.col(key), x.alias("x")).sample(False, frac, seed) if frac < 1.0 else df.select(F.col(key), x.alias("x"))
    # each pool row joins a tree with probability q (hash test inside the row,
    # no pool x trees product); per tree the psi smallest hashes are kept.
    pool_n = max(1.0, frac * n)
    q = min(1.0, 3.0 * psi / pool_n)
    cut = int(q * 2147483647)

    def tree_hash(t):
        return F.pmod(F.xxhash64(F.lit(seed), t, F.col(key)), F.lit(2147483647))

    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: tree_hash(t) <= F.lit(cut))
    from pyspark.sql import Window
    picks = (pool.withColumn("tree", F.explode(trees))
             .withColumn("_h", tree_hash(F.col("tree")))
             .withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("_h", key)))
             .filter(F.col("_r") <= psi).select("tree", "x"))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    forest_df = picks.groupBy("tree").applyInPandas(
        lambda p: _grow(p, d, max_depth, seed), schema=_TREE_SCHEMA)
    forest = forest_df.toPandas()          # bounded: n_trees x (2 psi - 1) nodes
    bc = spark.sparkContext.broadcast(_pack(forest, n_trees))
    norm = _c(psi)

    def score(it):
        packed = bc.value
        for pdf in it:
            X = np.vstack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, d))
            depth = np.zeros(len(X))
            for feat, thr, left, right, dep, size in packed:
                node = np.zeros(len(X), dtype=np.int64)
                active = feat[node] >= 0
                while active.any():
                    f = feat[node[active]]
                    go_left = X[np.flatnonzero(active), f] < thr[node[active]]
                    node[active] = np.where(go_left, left[node[active]], right[node[active]])
                    active = feat[node] >= 0
                depth += dep[node] + np.array([_c(s) for s in size[node]])
            s = -np.power(2.0, -(depth / len(packed)) / norm)
            yield pd.DataFrame({key: pdf[key], "_raw": s})

    raw = cut_lineage(df.select(F.col(key), x.alias("x")).mapInPandas(score, schema=f"`{key}` {df.schema[key].dataType.simpleString()}, _raw double"))
    offset = exact_quantiles(raw, "_raw", [float(contamination)]).first()["q0"]
    scored = raw.select(key, (F.col("_raw") - F.lit(offset)).alias("iso_score"))
    scored = scored.withColumn("iso_label", F.when(F.col("iso_score") < 0, -1).otherwise(1))
    return df.join(scored, key, "left")


def _pack(forest: pd.DataFrame, n_trees: int):
    out = []
    for t in range(n_trees):
        f = forest[forest["tree"] == t].sort_values("node")
        if f.empty:
            continue
        out.append((f["feature"].to_numpy(np.int64), f["threshold"].to_numpy(np.float64),
                    f["left"].to_numpy(np.int64), f["right"].to_numpy(np.int64),
                    f["depth"].to_numpy(np.float64), f["size"].to_numpy(np.float64)))
    return out
