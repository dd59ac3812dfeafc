"""Table scans, timestamp parsing, configuration and sinks (inventory S1-S8)."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import parse_ts_lenient

log = logging.getLogger(__name__)

TABLES = ("train_users", "train_transactions", "test_users", "test_transactions")


def load_table(spark: SparkSession, name: str, fmt: str = "parquet", path: str | None = None,
               **opts) -> DataFrame:
    """Whole-table scan; a catalog table when no path is given.  Column
    pruning and filters reach the scan through Catalyst."""
    if path is None:
        return spark.table(name)
    return spark.read.format(fmt).options(**opts).load(path)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def parse_ts(df: DataFrame, cols) -> DataFrame:
    """S3: lenient UTC timestamp parse (unparseable -> NULL) of string columns."""
    types = dict(df.dtypes)
    out = {}
    for c in cols:
        if types.get(c) == "string":
            out[c] = parse_ts_lenient(c)
        elif types.get(c) == "timestamp_ntz":
            out[c] = F.col(c).cast("timestamp")
    return df.withColumns(out) if out else df


def parse_ts_iso(df: DataFrame, col: str, strict: bool = True, floor_seconds: bool = True) -> DataFrame:
    """ISO-8601 parse, strict (raises on bad input) or coercing, optionally floored to the second."""
    c = F.col(col).cast("string")
    ts = F.to_timestamp(c) if strict else F.try_to_timestamp(c)
    if floor_seconds:
        ts = F.date_trunc("second", ts)
    return df.withColumn(col, ts)


@dataclass
class Config:
    """Pipeline settings; every field can come from the environment."""
    input_dir: str | None = None            # directory with one dataset per table
    input_format: str = "parquet"
    output_dir: str | None = None
    publish_uri: str | None = None
    tables: dict = field(default_factory=lambda: {t: t for t in TABLES})
    gbt_iterations: int = 400
    seed: int = 42

    @classmethod
    def from_env(cls, prefix: str = "RISKWEAVE_") -> "Config":
        env = os.environ
        return cls(input_dir=env.get(prefix + "INPUT_DIR"),
                   input_format=env.get(prefix + "INPUT_FORMAT", "parquet"),
                   output_dir=env.get(prefix + "OUTPUT_DIR"),
                   publish_uri=env.get(prefix + "PUBLISH_URI"),
                   gbt_iterations=int(env.get(prefix + "GBT_ITERATIONS", "400")),
                   seed=int(env.get(prefix + "SEED", "42")))


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(id_user, is_fraud) as CSV with a header, written in parallel."""
    df.select("id_user", "is_fraud").write.mode(mode).option("header", True).csv(path)


def publish(df: DataFrame, uri: str, required: bool = False, fmt: str = "csv") -> bool:
    """Copy a result to a Hadoop-FS URI (gs://, s3a://, file:); failure
    is a warning unless ``required``."""
    try:
        df.write.mode("overwrite").option("header", True).format(fmt).save(uri)
        return True
    except Exception as exc:  # noqa: BLE001
        if required:
            raise
        log.warning("publish to %s failed: %s", uri, exc)
        return False


def metrics_table(spark: SparkSession, best_f1: DataFrame, fraud_rate: DataFrame) -> DataFrame:
    """One row (best_f1, best_threshold, fraud_rate_percent) from the
    one-row best-threshold and class-balance frames (joined on a constant key)."""
    a = best_f1.withColumn("_k", F.lit(1))
    b = fraud_rate.select(F.col("fraud_percent").alias("fraud_rate_percent")).withColumn("_k", F.lit(1))
    return a.join(F.broadcast(b), "_k").drop("_k")


def write_metrics(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)      # one row
