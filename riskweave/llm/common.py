"""Helpers shared by the llm operators: work tables in the shared folder, and
numpy kernels over the byte buffers of Arrow string columns.

Contract kept by every operator of this subpackage
--------------------------------------------------
* only the named id and text columns are read, so extra columns (whatever
  their names) never clash with the columns an operator makes;
* a null text counts as the empty text, null ids are ordinary keys;
* an empty table gives an empty result of the same schema.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: Bytes of text that the numpy kernels take at a time (a longer document is taken whole).
BLOCK_BYTES = 2 << 20

U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


class Work:
    """Run-scoped tables under the session's ``spark.checkpoint.dir``.

    ``cut`` writes a table and reads it back (lineage ends there, on storage
    that every executor shares).  ``result`` does the same for the table that
    is returned; on exit the tables of ``cut`` are deleted, the result stays
    for the caller.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        ship_package(spark)
        root = ensure_checkpoint_dir(spark).rstrip("/")
        self.base = f"{root}/riskweave-llm/{name}-{uuid.uuid4().hex[:12]}"

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *exc) -> None:
        self.drop(f"{self.base}/tmp")

    def path(self, name: str) -> str:
        return f"{self.base}/tmp/{name}"

    def drop(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def _write(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("error").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        return self._write(df, self.path(name))

    def result(self, df: DataFrame) -> DataFrame:
        return self._write(df, f"{self.base}/result")


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


# ---------------------------------------------------------------- Arrow text

def _string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (n + 1, from 0) of a string or binary column; null: empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = col.type in (pa.large_string(), pa.large_binary())
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def text_blocks(col: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over consecutive rows, about ``limit`` bytes each."""
    data, offs = _string_buffers(col)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


# ---------------------------------------------------------------- hashing

def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The splitmix64 finaliser, by value."""
    x = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BYTES = [mix64(np.arange(256, dtype=U64), 11 + k) for k in range(2)]
_LOWER = [b.copy() for b in _BYTES]
for _plain, _low in zip(_BYTES, _LOWER, strict=True):
    _low[65:91] = _plain[97:123]
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64, at least n of them."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 16), base, U64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=U64)
    return _powers[base]


class SpanHash:
    """Hashes of arbitrary byte spans of one block in O(1) each: a prefix sum
    of byte codes times powers of an odd base modulo 2^64, shifted back by the
    base's inverse and mixed.  ``other``: an independent second hash."""

    def __init__(self, data: np.ndarray, lower: bool = False, other: bool = False):
        n, base = len(data), _BASES[other]
        self.sums = np.zeros(n + 1, U64)
        np.cumsum((_LOWER if lower else _BYTES)[other][data] * _power(base, n + 1)[:n], dtype=U64, out=self.sums[1:])
        self.inverse = _power(pow(base, -1, 1 << 64), n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start]
                     + (end - start).astype(U64) * _M2, seed)


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row (0-based in the block) of each word ``[^\\x20\\x09-\\x0D]+``; words end with their row."""
    n = len(data)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.zeros(n, bool)
    before[1:] = word[:-1]
    after = np.zeros(n, bool)
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:n]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(starts, offs)))


# ---------------------------------------------------------------- graph

def connected_components(work: Work, edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); root is the least node of the component.

    Alternating large-star / small-star (Kiveris et al., 2014): the edge table
    never grows, every round is map-side combined minima and equi-joins, and
    the rounds needed grow with the logarithm of the longest path.  A node
    with very many edges meets them through the partial minimum and through a
    join that adaptive execution splits; no group is collected.
    """
    now = work.cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .filter("u <> v").distinct(), f"{name}-0")
    k = 0
    while True:
        k += 1
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = work.cut(large, f"{name}-l{k}")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        small = (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        small = work.cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), f"{name}-s{k}")
        if _sum(small) == _sum(now):
            break
        now = small
    roots = small.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())


def _sum(edges: DataFrame) -> tuple:
    """A row count and two hash sums: equal for equal edge sets."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 32)), F.bit_xor(h)).first())


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)
