"""Stratified k-fold assignment (inventory W9).

fold = (row_number() over (partition by y order by md5(id ':' seed), id) - 1) % k

Stratified (each label spread evenly over folds) and deterministic for a
seed.  NumPy's seeded shuffle cannot be reproduced, so the fold members differ
from the reference's; the layout rule is the same.  Ranks come from
``bucketed_row_number`` (4096 md5-prefix buckets), never from a window over a
whole label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import bucketed_row_number


def fold_key(key: str = "id_user", seed: int = 42):
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def assign_folds(df: DataFrame, y: str = "is_fraud", key: str = "id_user", k: int = 5,
                 seed: int = 42, out: str = "fold") -> DataFrame:
    h = fold_key(key, seed)
    ranked = bucketed_row_number(df.withColumn("_h", h), [y], [F.col("_h"), F.col(key)],
                                 F.substring("_h", 1, 3), out="_rank")
    return ranked.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_h", "_rank")
