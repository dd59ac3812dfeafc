"""Exact nearest neighbours over a metric partition (inventory J6).

Index: distinct base vectors go to the cell of their nearest pivot (a bounded
sample of the base, least hashes; it decides the speed, not the result).  Rows
of a cell are sorted by their distance to the pivot and cut into blocks, so a block
is a shell of its cell: all its vectors lie between ``lo`` and ``hi`` from the pivot.

Search, in two rounds over blocks of queries that share a cell:

0. the distances to the sampled vectors bound each query's radius: its
   ``depth``-th neighbour cannot be farther;
1. the shells of the query's own cell that its radius reaches give a first list
   of neighbours and a tighter radius;
2. other cells are dropped for a query when the triangle inequality puts all
   their vectors outside the radius: ``d(q, p) - hi`` or ``lo - d(q, p)``
   exceeds it, or half the difference between the distances to the cell's pivot and to
   the own one (the plane between two pivots).  The shells that are left are
   visited nearest first, and the radius shrinks on the way.

Queries meet shells in a streaming pass over (query block, chunk): one shell
is in memory at a time, a query block with many shells left (outliers) is dealt
over chunks, and the chunks' lists are merged.  Tiles are compared by a matrix
product whose error is bounded; what could be a neighbour is measured again
coordinate by coordinate, so distances and order are those of the plain formula.

Neighbours are ordered by distance rounded to 9 places, then by vector; ids ascend with
the vectors.  With ``probes`` the search is approximate: round 1 takes the
``probes`` nearest cells, round 2 is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package

#: Base vectors for each cell, the most cells (pivots are broadcast: 4096 x dimensions doubles), rows of a block.
CELL_ROWS = 1024
MAX_CELLS = 4096
BLOCK_ROWS = 1024
#: Sampled vectors that bound the first radius, at least.
SAMPLE = 256
#: Shells that a query block meets in one streaming group of the second round.
CHUNK = 128
ROUNDING = 1e9


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances, coordinate by coordinate."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        gap = a[:, i, None] - b[None, :, i]
        out += gap * gap
    return np.sqrt(out)


def _vectors(col: pa.Array, d: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.float64).reshape(len(col), d)


# ---------------------------------------------------------------- index

class Pivots:
    """A bounded sample of the base: ``points`` (the first ``cells`` of them are pivots)."""

    def __init__(self, base: DataFrame, d: int, depth: int, rows: int, cells: int | None):
        self.cells = max(1, min(MAX_CELLS, cells or -(-rows // CELL_ROWS), rows))
        sample = max(self.cells, min(rows, max(SAMPLE, 4 * depth)))
        got = base.select("v").orderBy(F.xxhash64("v"), "v").limit(sample).collect()
        self.points = np.array([r["v"] for r in got], np.float64).reshape(len(got), d)
        self.depth = depth

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, distance to its pivot, and first radius of each vector."""
        cell, near, radius = np.zeros(len(x), np.int32), np.zeros(len(x)), np.full(len(x), np.inf)
        for lo in range(0, len(x), 256):
            at = slice(lo, lo + 256)
            dist = _distances(x[at], self.points)
            cell[at] = dist[:, :self.cells].argmin(axis=1)
            near[at] = dist[np.arange(len(dist)), cell[at]]
            if dist.shape[1] >= self.depth:
                radius[at] = _widened(np.partition(dist, self.depth - 1, axis=1)[:, self.depth - 1])
        return cell, near, radius


def _widened(r: np.ndarray) -> np.ndarray:
    """A radius that holds everything whose rounded distance is not above that of ``r``."""
    return r * (1 + 1e-12) + 2 / ROUNDING


_BLOCK = "block long, cell int, lo double, hi double, ids array<long>, copies array<long>, vectors binary, radius array<double>"


def _blocks(rows: DataFrame, pivots: Pivots, d: int) -> DataFrame:
    """Blocks (shells of cells) of ``rows`` (id, v, m), written."""
    sent = rows.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, near, radius = sent.value.place(_vectors(batch.column("v"), d))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(near), batch.column("id"), batch.column("m"),
                                              batch.column("v"), pa.array(radius)], ["cell", "near", "id", "m", "v", "radius"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = TaskContext.get().partitionId() << 32
        for batch in batches:
            cells, near = np.asarray(batch.column("cell")), np.asarray(batch.column("near"))
            starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else []
            for lo, hi in zip(starts, [*starts[1:], len(cells)], strict=True):
                for at in range(lo, hi, BLOCK_ROWS):
                    end = min(at + BLOCK_ROWS, hi)
                    some = batch.slice(at, end - at)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([k], pa.int64()), pa.array([cells[at]], pa.int32()), pa.array([near[at]]), pa.array([near[end - 1]]),
                        pa.array([some.column("id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([some.column("m").to_pylist()], pa.list_(pa.int64())),
                        pa.array([_vectors(some.column("v"), d).tobytes()], pa.binary()),
                        pa.array([some.column("radius").to_pylist()], pa.list_(pa.float64()))],
                        ["block", "cell", "lo", "hi", "ids", "copies", "vectors", "radius"])
                    k += 1

    placed = rows.select("id", "v", "m").mapInArrow(assign, "cell int, near double, id long, m long, v array<double>, radius double")
    return cut_lineage(placed.repartitionByRange("cell", "near").sortWithinPartitions("cell", "near").mapInArrow(pack, _BLOCK))


# ---------------------------------------------------------------- search

class Search:
    """The running lists of one block of queries: at most ``depth`` neighbours each."""

    def __init__(self, row: dict, d: int, depth: int):
        self.depth, self.ids = depth, np.array(row["ids"], np.int64)
        self.x = np.frombuffer(row["vectors"], np.float64).reshape(-1, d)
        self.norms = (self.x ** 2).sum(axis=1)
        self.radius = np.array(row["radius"], np.float64)
        self.line, self.near, self.dist, self.copies = (np.array(row[c], t) for c, t in (
            ("line", np.int64), ("near", np.int64), ("dist", np.float64), ("near_copies", np.int64)))

    def meet(self, ids: np.ndarray, copies: np.ndarray, y: np.ndarray) -> None:
        """Compare all queries with a shell."""
        norms = (y ** 2).sum(axis=1)
        size = self.norms[:, None] + norms[None, :]
        square = size - 2 * (self.x @ y.T)
        slack = size * (4 * (self.x.shape[1] + 4) * np.finfo(np.float64).eps)
        bound = self.radius.copy()
        if len(y) > self.depth:
            top = np.partition(square + slack, self.depth - 1, axis=1)[:, self.depth - 1]
            bound = np.minimum(bound, _widened(np.sqrt(np.maximum(top, 0))))
        line, col = np.nonzero(square - slack <= (bound * bound)[:, None])
        total = np.zeros(len(line))
        for i in range(self.x.shape[1]):
            gap = self.x[line, i] - y[col, i]
            total += gap * gap
        self._merge(line, ids[col], np.sqrt(total), copies[col])

    def _merge(self, line: np.ndarray, near: np.ndarray, dist: np.ndarray, copies: np.ndarray) -> None:
        line, near = np.r_[self.line, line], np.r_[self.near, near]
        dist, copies = np.r_[self.dist, dist], np.r_[self.copies, copies]
        order = np.lexsort((near, np.rint(dist * ROUNDING), line))
        line = line[order]
        rank = np.arange(len(line)) - np.searchsorted(line, line)
        order = order[rank < self.depth]
        last = line[rank == self.depth - 1]
        self.line, self.near, self.dist, self.copies = line[rank < self.depth], near[order], dist[order], copies[order]
        # the farthest that is listed bounds the radius: order follows rounded distances, so take the largest
        full = np.zeros(len(self.x))
        np.maximum.at(full, self.line, self.dist)
        self.radius[last] = np.minimum(self.radius[last], _widened(full[last]))


_STATE = ("block long, cell int, ids array<long>, vectors binary, radius array<double>, "
          "line array<int>, near array<long>, dist array<double>, near_copies array<long>")
_FOUND = "id long, nid long, dist double, m long"


def _visit(state: DataFrame, pairs: DataFrame, base: DataFrame, d: int, depth: int, last: bool) -> DataFrame:
    """Queries of ``state`` meet the shells of ``pairs`` (qblock, chunk, order, block), in that order.

    ``state`` has a row for every (block, chunk).  Gives the next state, or with ``last`` the lists as rows."""
    shells = (pairs.join(base.select("block", F.col("ids").alias("b_ids"), "copies", F.col("vectors").alias("b_vectors")), "block")
              .drop("block").withColumnRenamed("qblock", "block"))
    heads = state.withColumn("order", F.lit(-1.0))
    rows = heads.unionByName(shells, allowMissingColumns=True)
    dealt = rows.repartition("block", "chunk").sortWithinPartitions("block", "chunk", "order")
    columns = [c.split()[0] for c in _STATE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, None
        for batch in batches:
            for k, order in enumerate(batch.column("order").to_pylist()):
                if order < 0:
                    if now is not None:
                        yield out(now, group)
                    group = {c: batch.column(c)[k].as_py() for c in columns}
                    now = Search(group, d, depth)
                else:
                    ids, copies, raw = (batch.column(c)[k] for c in ("b_ids", "copies", "b_vectors"))
                    now.meet(np.asarray(ids.values), np.asarray(copies.values), np.frombuffer(raw.as_py(), np.float64).reshape(-1, d))
        if now is not None:
            yield out(now, group)

    def out(now: Search, group: dict) -> pa.RecordBatch:
        if last:
            return pa.RecordBatch.from_arrays([pa.array(now.ids[now.line]), pa.array(now.near), pa.array(now.dist),
                                               pa.array(now.copies)], ["id", "nid", "dist", "m"])
        return pa.RecordBatch.from_arrays([
            pa.array([group["block"]], pa.int64()), pa.array([group["cell"]], pa.int32()), pa.array([now.ids]),
            pa.array([group["vectors"]], pa.binary()), pa.array([now.radius]), pa.array([now.line.astype(np.int32)]),
            pa.array([now.near]), pa.array([now.dist]), pa.array([now.copies])], columns)

    return dealt.mapInArrow(run, _FOUND if last else _STATE)


def _reach(state: DataFrame, cells: dict[int, tuple[float, float]], pivots: Pivots, d: int, own: bool, probes: int | None = None) -> DataFrame:
    """(qblock, cell, order, lo, hi): the cells that a block's queries can't rule out, the range of pivot distances
    they reach there, and the least distance.  ``own``: the block's cell (or its ``probes`` nearest), else the others."""
    sent = state.sparkSession.sparkContext.broadcast((pivots.points[:pivots.cells], cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, known = sent.value
        which = np.array(sorted(known), np.int64)
        lo, hi = (np.array([known[c][k] for c in which]) for k in range(2))
        for batch in batches:
            for block, home, raw, radius in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                x, r = np.frombuffer(raw, np.float64).reshape(-1, d), np.array(radius)
                need = np.zeros(len(which), bool)
                low, high, order = np.full(len(which), np.inf), np.full(len(which), -np.inf), np.full(len(which), np.inf)
                for at in range(0, len(x), 256):
                    dist, some = _distances(x[at:at + 256], points[which]), r[at:at + 256, None]
                    here = _distances(x[at:at + 256], points[[home]])
                    away = np.maximum(np.maximum(dist - hi, lo - dist), (dist - here) / 2) - 1e-9 * (1 + dist + hi)
                    if own and probes:
                        nearest = np.argsort(dist, axis=1)[:, :probes]
                        live = np.zeros(dist.shape, bool)
                        np.put_along_axis(live, nearest, True, axis=1)
                    else:
                        live = (away <= some) & ((which == home) == own)[None, :]
                    need |= live.any(axis=0)
                    span = some * (1 + 1e-9) + 1e-9 * (1 + dist)
                    low = np.minimum(low, np.where(live, dist - span, np.inf).min(axis=0))
                    high = np.maximum(high, np.where(live, dist + span, -np.inf).max(axis=0))
                    order = np.minimum(order, np.where(live, away, np.inf).min(axis=0))
                got = np.flatnonzero(need)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * len(got), pa.int64()), pa.array(which[got].astype(np.int32)), pa.array(np.maximum(order[got], 0.0)),
                    pa.array(low[got]), pa.array(high[got])], ["qblock", "cell", "order", "q_lo", "q_hi"])

    return state.select("block", "cell", "vectors", "radius").mapInArrow(run, "qblock long, cell int, order double, q_lo double, q_hi double")


def _pairs(reach: DataFrame, base: DataFrame) -> DataFrame:
    """(qblock, block, order): shells of the reached cells whose pivot distances meet the queries' range."""
    shells = base.select("cell", "block", "lo", "hi")
    return (reach.join(shells, "cell").filter((F.col("lo") <= F.col("q_hi")) & (F.col("hi") >= F.col("q_lo")))
            .select("qblock", "block", "order"))


def neighbour_table(base: DataFrame, d: int, depth: int, queries: DataFrame | None = None, cells: int | None = None,
                    probes: int | None = None) -> DataFrame:
    """(id, nid, dist, m): per query its ``depth`` nearest distinct base vectors (fewer, if the base has fewer), written.

    ``base``: (id, v, m), written; distinct vectors whose ids ascend with the vectors, ``m`` copies each.  ``queries``: (id, v),
    distinct; None: the base itself, each vector its own first neighbour.  ``cells``: how many, by size if None.
    """
    spark = base.sparkSession
    ship_package(spark)
    rows = base.count()
    if not rows:
        return spark.createDataFrame([], _FOUND)
    pivots = Pivots(base, d, depth, rows, cells)
    blocks = _blocks(base, pivots, d)
    asked = blocks if queries is None else _blocks(queries.withColumn("m", F.lit(1).cast("long")), pivots, d)
    # bounded: a row for each cell
    known = {r["cell"]: (r["lo"], r["hi"]) for r in
             blocks.groupBy("cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}
    none = {"line": "array<int>", "near": "array<long>", "dist": "array<double>", "near_copies": "array<long>"}
    state = asked.select("block", "cell", "ids", "vectors", "radius", *[F.array().cast(t).alias(c) for c, t in none.items()])
    first = _pairs(_reach(state, known, pivots, d, own=True, probes=probes), blocks).withColumn("chunk", F.lit(0))
    if probes:
        return cut_lineage(_visit(state.withColumn("chunk", F.lit(0)), first, blocks, d, depth, last=True))
    state = cut_lineage(_visit(state.withColumn("chunk", F.lit(0)), first, blocks, d, depth, last=False))
    left = cut_lineage(_pairs(_reach(state, known, pivots, d, own=False), blocks))
    chunks = left.groupBy("qblock").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    second = left.join(chunks, "qblock").withColumn("chunk", F.pmod(F.xxhash64("block"), F.col("chunks")).cast("int")).drop("chunks")
    heads = (state.join(chunks.withColumnRenamed("qblock", "block"), "block", "left")
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))).drop("chunks"))
    found = _visit(heads, second, blocks, d, depth, last=True)
    # the first round's list comes with every chunk of a block: equal rows once
    order = Window.partitionBy("id").orderBy(F.rint(F.col("dist") * ROUNDING), "nid")
    ranked = found.withColumn("_rn", F.dense_rank().over(order)).filter(F.col("_rn") <= depth)
    return cut_lineage(ranked.drop("_rn").dropDuplicates(["id", "nid"]))


def take_copies(found: DataFrame, k: int, exclude_self: bool = False) -> DataFrame:
    """(id, nid, dist, take, first_copy): the nearest ``k`` base rows, copies counted, of a neighbour table that is
    at least ``k`` deep (one more with ``exclude_self``, which leaves out one copy of the query's own vector)."""
    if exclude_self:
        found = found.withColumn("m", F.col("m") - F.when(F.col("id") == F.col("nid"), 1).otherwise(0)).filter("m > 0")
    order = Window.partitionBy("id").orderBy(F.rint(F.col("dist") * ROUNDING), "nid")
    before = F.coalesce(F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (found.withColumn("_before", before).filter(F.col("_before") < k)
            .select("id", "nid", "dist", F.least(F.col("m"), F.lit(k) - F.col("_before")).alias("take"),
                    (F.col("_before") + 1).alias("first_copy")))
