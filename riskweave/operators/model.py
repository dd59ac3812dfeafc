"""Model matrix, gradient-boosted classifier, fold CV and OOF scores (inventory M1-M4, M7, M8, P12).

MLlib's ``GBTClassifier`` replaces the reference's LightGBM (no leaf-count,
L1/L2 terms; column sampling is per node).  The mapping of parameters is in
``GBT_PARAMS``; scores will not equal the reference's.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import clean_number

# The reference's 59 model features, in order.
FEATURE_COLS = [
    "errors_x_cards", "holders_x_cards", "consec_fails_x_cards", "burst_x_cards", "burst_x_errors",
    "consec_fails_x_holders", "burst_x_fail_rate", "unique_card_holders", "unique_error_types",
    "unique_cards_per_user", "unique_card_brands", "unique_card_types", "tx_count", "fail_status_coefficient",
    "error_antifraud_rate", "fraud_error_count", "fraud_error_rate", "error_3ds_error_rate", "countries_per_tx",
    "errors_per_tx", "holders_per_card", "holders_per_tx", "country_CP_missmatch_coef", "country_CReg_missmatch",
    "amount_sum", "amount_range", "min_time_between_tx", "tx_type_card_init_rate", "max_consecutive_fails",
    "unique_amounts_per_tx", "max_hourly_burst", "first_tx_failed", "hour_std", "holder_name_length",
    "holder_name_words", "unique_amounts", "knn_avg_dist", "fraud_card_exposure", "worst_card_fraud_rate",
    "avg_card_fraud_rate", "max_users_sharing_card", "avg_users_sharing_card", "worst_card_fail_rate",
    "avg_card_fail_rate", "most_active_card_tx", "avg_card_tx", "fails_before_first_success", "status_changes",
    "status_changes_per_tx", "unique_cards_first_5", "amount_entropy", "amount_mode_concentration",
    "small_amount_rate", "name_in_email", "unique_first_names", "reg_country_enc", "gender_enc",
    "traffic_type_enc", "domain_enc",
]

# Reference hyper-parameters mapped onto GBTClassifier.
GBT_PARAMS = dict(maxIter=400, stepSize=0.02, maxDepth=8, minInstancesPerNode=50, subsamplingRate=0.6,
                  featureSubsetStrategy="0.8", seed=42)
POS_WEIGHT = 2.0


def select_features(train: DataFrame, test: DataFrame, cols=FEATURE_COLS) -> list[str]:
    """Keep listed columns present on both sides, in list order."""
    a, b = set(train.columns), set(test.columns)
    return [c for c in cols if c in a and c in b]


def model_matrix(df: DataFrame, cols, keep=("id_user", "is_fraud", "fold")) -> DataFrame:
    """M1: scrubbed numeric columns (NULL/NaN/inf -> 0) assembled into ``features``."""
    kept = [c for c in keep if c in df.columns]
    clean = df.select(*kept, *[clean_number(c).alias(c) for c in cols])
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(clean)


def _weighted(df: DataFrame, y: str) -> DataFrame:
    return df.withColumn("_w", F.when(F.col(y) == 1, F.lit(POS_WEIGHT)).otherwise(F.lit(1.0)))


def fit_gbt(train_m: DataFrame, y: str = "is_fraud", **overrides):
    """M2: fit on an assembled matrix; positives weigh ``POS_WEIGHT``."""
    params = {**GBT_PARAMS, **overrides}
    est = GBTClassifier(featuresCol="features", labelCol="_label", weightCol="_w", **params)
    d = _weighted(train_m, y).withColumn("_label", F.col(y).cast("double"))
    return est.fit(d)


def predict_proba(model, m: DataFrame, out: str = "p") -> DataFrame:
    return (model.transform(m).withColumn(out, vector_to_array("probability")[1])
            .drop("rawPrediction", "probability", "prediction"))


def oof_predict(train_m: DataFrame, y: str = "is_fraud", fold: str = "fold", k: int = 5,
                **overrides) -> DataFrame:
    """M4: out-of-fold probability for every training row (k fits)."""
    parts = []
    for f in range(k):
        model = fit_gbt(train_m.filter(F.col(fold) != f), y, **overrides)
        parts.append(predict_proba(model, train_m.filter(F.col(fold) == f)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cv_f1(oof: DataFrame, y: str = "is_fraud", fold: str = "fold", p: str = "p", cut: float = 0.5) -> DataFrame:
    """M3: per-fold F1 at ``cut`` plus mean and population std over folds."""
    pred = F.col(p) >= F.lit(cut)
    yy = F.col(y) == 1
    per = oof.groupBy(fold).agg(F.count_if(pred & yy).alias("tp"), F.count_if(pred & ~yy).alias("fp"),
                                F.count_if(~pred & yy).alias("fn"))
    denom = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    per = per.withColumn("f1", F.when(denom > 0, 2.0 * F.col("tp") / denom).otherwise(0.0))
    w = Window.partitionBy()            # k rows
    return per.select(fold, "f1", F.avg("f1").over(w).alias("f1_mean"), F.stddev_pop("f1").over(w).alias("f1_std"))


def feature_importance(model, cols, top: int | None = None) -> DataFrame:
    """M7: importances (MLlib's normalised gain) sorted descending."""
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(cols, [float(x) for x in imp])), "feature string, importance double")
    df = df.orderBy(F.desc("importance"), F.col("feature"))
    return df.limit(top) if top else df


def predict_labels(model, test_m: DataFrame, threshold: float, key: str = "id_user") -> DataFrame:
    """M8: final labels ``p >= threshold``."""
    return (predict_proba(model, test_m).select(key, (F.col("p") >= F.lit(threshold)).cast("int").alias("is_fraud")))
