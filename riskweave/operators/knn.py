"""k-nearest-neighbour joins (inventory J6, G8, G9) on the metric partition of ``neighbours``.

Equal vectors collapse to one row with a multiplicity; the search runs over
distinct vectors, and a query takes copies of the nearest ones until it has k.
One neighbour table, as deep as the deepest user needs, serves every statistic
built on it (mean, max and k-th distance; the local outlier factor).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .neighbours import MAX_CELLS, neighbour_table, take_copies

#: Cells that an approximate search visits for each query.
PROBES = 8


def vector_col(cols) -> F.Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def collapse(df: DataFrame, cols) -> DataFrame:
    """Distinct vectors with multiplicity ``m``."""
    return df.select(vector_col(cols).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("m"))


def numbered(collapsed: DataFrame) -> DataFrame:
    """(id, v, m), written: ids ascend with the vectors."""
    return cut_lineage(collapsed.repartitionByRange("v").sortWithinPartitions("v")
                       .withColumn("id", F.monotonically_increasing_id()))


def query_ids(queries: DataFrame, base: DataFrame) -> DataFrame:
    """(id, v) of the distinct query vectors, written: the base's id where the base has the vector, else a negative one."""
    own = queries.select("v").distinct().join(base.select("v", "id"), "v", "left")
    return cut_lineage(own.withColumn("id", F.coalesce("id", -1 - F.monotonically_increasing_id())))


def knn_distances(queries: DataFrame, base: DataFrame, d: int, k: int, exclude_self: bool = False,
                  n_buckets: int | None = None, base_is_written: bool = False) -> DataFrame:
    """Per distinct query vector ``v``: the k nearest base copies as rows
    (v, nv, dist, take, first_copy) where ``take`` copies of base vector ``nv`` are used.

    ``queries``: (v); ``base``: (v, m), or (id, v, m) as ``numbered`` writes it (``base_is_written``).  A query
    equal to a base vector sees that vector's copies at distance 0 (minus one copy with ``exclude_self``).
    ``n_buckets``: cells of the partition, by size if None.
    """
    base = base if base_is_written else numbered(base)
    q = query_ids(queries, base)
    found = take_copies(neighbour_table(base, d, k + exclude_self, queries=q, cells=n_buckets), k, exclude_self)
    return (found.join(q, "id").join(base.select(F.col("id").alias("nid"), F.col("v").alias("nv")), "nid")
            .select("v", "nv", "dist", "take", "first_copy"))


def distance_stats(taken: DataFrame, k: int, kth: int = 5, prefix: str = "knn") -> DataFrame:
    """G8/G9 by query id: mean, max and ``kth`` distance of the k copies taken."""
    return taken.groupBy("id").agg(
        (F.sum(F.col("dist") * F.col("take")) / F.lit(float(k))).alias(f"{prefix}_avg_dist"),
        F.max("dist").alias(f"{prefix}_max_dist"),
        F.max(F.when((F.col("first_copy") <= kth) & (F.col("first_copy") + F.col("take") > kth),
                     F.col("dist"))).alias(f"{prefix}_{kth}th_dist"))


def knn_stats(queries: DataFrame, base: DataFrame, cols, k: int = 10, exclude_self: bool = False,
              kth: int = 5, prefix: str = "knn", mode: str = "exact", probes: int = PROBES) -> DataFrame:
    """Per query row, mean, max and ``kth`` distance to its k nearest
    base rows (train rows include themselves at distance 0).

    ``mode`` "approximate" visits the ``probes`` cells nearest to a query, of about as many cells as the square
    root of the distinct base vectors; no distance is then below the exact one."""
    if mode not in ("exact", "approximate"):
        raise ValueError(f"mode {mode!r}")
    d = len(cols)
    numbers = numbered(collapse(base, cols))
    qv = queries.withColumn("v", vector_col(cols))
    ids = query_ids(qv, numbers)
    near = None if mode == "exact" else probes
    cells = None if mode == "exact" else min(MAX_CELLS, math.isqrt(numbers.count()) + 1)
    found = neighbour_table(numbers, d, k + exclude_self, queries=ids, cells=cells, probes=near)
    stats = distance_stats(take_copies(found, k, exclude_self), k, kth, prefix)
    return qv.join(ids.join(stats, "id").drop("id"), "v", "left").drop("v")


class TrainNeighbours:
    """The neighbour table of a training table among itself, made once for every score built on it.

    ``depth`` distinct neighbours of each distinct vector, its own included; ``attach`` joins per-vector values to rows."""

    def __init__(self, df: DataFrame, cols, depth: int):
        self.df, self.cols, self.depth = df, cols, depth
        self.base = numbered(collapse(df, cols))
        self.found = neighbour_table(self.base, len(cols), depth)

    def taken(self, k: int, exclude_self: bool) -> DataFrame:
        if k + exclude_self > self.depth:
            raise ValueError(f"{k} neighbours asked of a table that is {self.depth} deep")
        return take_copies(self.found, k, exclude_self)

    def attach(self, values: DataFrame, df: DataFrame | None = None) -> DataFrame:
        """Rows of ``df`` (the training rows) with the columns of ``values`` (id, ...)."""
        rows = (self.df if df is None else df).withColumn("v", vector_col(self.cols))
        return rows.join(self.base.select("v", "id").join(values, "id").drop("id"), "v", "left").drop("v")

    def stats(self, k: int = 10, kth: int = 5, prefix: str = "knn", df: DataFrame | None = None) -> DataFrame:
        return self.attach(distance_stats(self.taken(k, False), k, kth, prefix), df)
