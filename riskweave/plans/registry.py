"""Query registry: one Spark query per inventory operator, plus its oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Outputs are normalised by :func:`finish` (integers -> BIGINT, doubles rounded
to 6 places) so the Spark result and the DuckDB oracle compare by value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_utc
from ..sources.fixtures import load_fixture
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType, T.DecimalType)


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _INTS):
            cols.append(c.cast("bigint").alias(f.name))
        elif isinstance(f.dataType, _FLOATS):
            cols.append(F.round(c.cast("double"), 6).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def kind_of(dt: T.DataType) -> str:
    if isinstance(dt, _INTS):
        return "bigint"
    if isinstance(dt, _FLOATS):
        return "double"
    return dt.simpleString()


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the oracle's final statement (the shared
    prelude of fixture and feature CTEs is prepended)."""
    def deco(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return finish(fn(spark, sf_dir))
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def oracle_sql() -> dict[str, str]:
    types = O.result_types()
    return {k: O.normalise(k, O.PRELUDE + v, types) for k, v in ORACLE.items()}


def fixture(spark: SparkSession, sf_dir: str):
    return load_fixture(spark, sf_dir)


# importing the query modules fills the registry
from . import queries_features, queries_encode, queries_stats, queries_anomaly, queries_model  # noqa: E402,F401
