"""Hard-negative mining: exact integer scores by a residue-number-system GEMM.

Vectors are integers (``floor(scale * x)``).  Blocks of rows meet blocks of
anchors; in a tile, both matrices are taken modulo several small primes with
residues around 0, multiplied in float32 (no sum reaches 2^24, so every product
matrix is exact), and the signed scores are reconstructed from the residues of
the products by Chinese remaindering in balanced mixed radix.  The primes are
as large as the length of the vectors allows, and as many as the largest
squared norm asks for (|score| <= that norm, Cauchy-Schwarz).

1. Positives: tiles of blocks that share a label; each keeps an anchor's best
   rows, and the best of those are the anchor's positives.
2. Negatives: every anchor block meets every row block; per positive, a tile
   keeps the best rows of other labels whose score lies in the positive's window
   (``low``/100 to 100 % of its score), and the best of those are returned.

The anchors are the stated query set, the search is exhaustive.  Blocks are
written once, sorted by label and id, so a label of any size is many blocks,
and a block meets few others of its label.  A tile holds ``ROW_BLOCK`` by
``ANCHOR_BLOCK`` scores; a task streams tiles.  Per tile at most ``k`` rows of
an anchor (and positive) leave it.  The anchor side is sent ``SALT`` times, so that no
block of anchors is a hot join key.

Edge cases: rows with a null label, a null vector, or a null or non-finite
component take no part; shorter vectors are read as ending in zeros; a null id
is no anchor and comes last in ties; repeated rows are rows of their own (a copy
of an anchor is one of its other rows); no anchors or an empty table give no
rows.  Components beyond 2^28 after scaling, or squared norms beyond 2^56, raise
an error, as a hundred times a score must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Work

ROW_BLOCK = 4096
ANCHOR_BLOCK = 512
SALT = 64
MAX_COMPONENT = 1 << 28
MAX_NORM = 1 << 56
_NONE = np.iinfo(np.int64).min


# ---------------------------------------------------------------- the residue number system

def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def moduli(dims: int, most: int) -> list[int]:
    """Odd primes, largest first, for products of ``dims`` terms summed exactly in float32, whose product
    holds every signed value up to ``most``."""
    # residues reach (p - 1) / 2 on either side: dims * ((p - 1) / 2)^2 must stay below 2^24
    p = 2 * int((((1 << 24) - 1) / max(dims, 1)) ** 0.5) + 1
    out, product = [], 1
    while product <= 2 * most + 1:
        while not (p % 2 and _prime(p)):
            p -= 1
            if p < 3:
                raise ValueError(f"vectors of {dims} components are too long for exact float32 residues")
        out.append(p)
        product *= p
        p -= 1
    return out


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, in -(p - 1) / 2 .. (p - 1) / 2."""
    r = np.mod(x, p)
    return r - p * (r > p // 2)


def exact_scores(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """a @ b.T of integer matrices as int64, from float32 products of their residues."""
    digits: list[np.ndarray] = []
    score = np.zeros((len(a), len(b)), np.int64)
    weight = 1
    for k, p in enumerate(primes):
        product = (_balanced(a, p).astype(np.float32) @ _balanced(b, p).astype(np.float32).T).astype(np.int64)
        # Garner: what the digits so far leave of the product, over the primes before
        at, place = np.zeros_like(product), 1
        for digit, q in zip(digits, primes, strict=False):
            at += digit * place
            place = place * q % p
        digits.append(_balanced((product - at) % p * pow(weight, -1, p) if k else product, p))
        # the last sum fits a long, so sums on the way may wrap
        score += digits[-1] * np.int64((weight + (1 << 63)) % (1 << 64) - (1 << 63))
        weight *= p
    return score


# ---------------------------------------------------------------- selection in a tile

def best_rows(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of the k best entries of each line, ties by column; entries that are _NONE don't count."""
    if score.shape[1] > k:
        bar = np.partition(score, score.shape[1] - k, axis=1)[:, [score.shape[1] - k]]
    else:
        bar = np.full((len(score), 1), _NONE)
    line, col = np.nonzero((score >= bar) & (score > _NONE))
    order = np.lexsort((col, -score[line, col], line))
    line, col = line[order], col[order]
    rank = np.arange(len(line)) - np.searchsorted(line, line)
    return line[rank < k], col[rank < k]


def best_in_windows(score: np.ndarray, allowed: np.ndarray, tops: np.ndarray, low: int, k: int) -> tuple[np.ndarray, ...]:
    """(line, window, column): per line and window top ``tops[line, window]`` (_NONE: no window), the k best allowed
    entries from low/100 of the top to the top, ties by column."""
    real = tops > _NONE
    highest = np.where(real, tops, _NONE).max(axis=1, initial=_NONE)
    lowest = np.where(real, tops, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
    floor = -(-np.maximum(lowest, 0) * low // 100)                # windows of negative tops are empty
    line, col = np.nonzero(allowed & (score <= highest[:, None]) & (score >= np.where(highest >= 0, floor, np.iinfo(np.int64).max)[:, None]))
    value = score[line, col]
    order = np.lexsort((col, -value, line))
    line, col, value = line[order], col[order], value[order]
    levels = np.unique(value)
    wide = len(levels) + 1
    falling = line * wide + (len(levels) - 1 - np.searchsorted(levels, value))
    at_line, window = np.nonzero(real & (tops >= 0))
    top = tops[at_line, window]
    # the first entry of the line that is not above the top, and the k - 1 after it
    begin = np.searchsorted(falling, at_line * wide + (len(levels) - np.searchsorted(levels, top, "right")))
    pick = begin[:, None] + np.arange(k)[None, :]
    inside = pick < len(line)
    pick = np.where(inside, pick, 0)
    if len(line):
        inside &= (line[pick] == at_line[:, None]) & (value[pick] * 100 >= top[:, None] * low)
    else:
        inside[:] = False
    which = np.nonzero(inside)
    return at_line[which[0]], window[which[0]], col[pick[which]]


# ---------------------------------------------------------------- blocks

_ITEM = "block long, ids array<long>, labels array<long>, vectors binary"


def _matrix(col: pa.Array, scale: float) -> np.ndarray:
    """The list column as a float64 matrix floor(scale * x); shorter lists end in zeros."""
    sizes = np.asarray(col.value_lengths(), np.int64)
    flat = np.floor(np.asarray(col.flatten(), np.float64) * scale)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


def make_blocks(work: Work, rows: DataFrame, scale: float, size: int) -> DataFrame:
    """Blocks of ``rows`` (id, label, vector), by id inside, nulls last; ``dims`` and ``norm``, the largest squared norm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size).sort_by("id")
                ints = _matrix(part.column("vector"), scale)
                norm = (ints ** 2).sum(axis=1).max(initial=0.0)
                fits = norm <= MAX_NORM and np.abs(ints).max(initial=0.0) <= MAX_COMPONENT
                stored = (ints if fits else np.zeros_like(ints)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([k], pa.int64()), pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([part.column("label").to_pylist()], pa.list_(pa.int64())),
                    pa.array([stored.tobytes()], pa.binary()), pa.array([ints.shape[1]], pa.int32()),
                    pa.array([norm if fits else np.inf], pa.float64())],
                    ["block", "ids", "labels", "vectors", "dims", "norm"])
                k += 1

    return work.cut(rows.mapInArrow(run, _ITEM + ", dims int, norm double"), "blocks")


def _unpack(raw: bytes, rows: int, dims: int) -> np.ndarray:
    got = np.frombuffer(raw, np.int32).reshape(rows, -1)
    return got if got.shape[1] == dims else np.pad(got, ((0, 0), (0, dims - got.shape[1])))


def _anchors(blocks: DataFrame, every: int, dims: int) -> DataFrame:
    """(anchor, at_block, at_place, label, vector): a row for each anchor of the blocks; ``anchor`` its id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, labels, raw in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                at = [k for k, i in enumerate(ids) if i is not None and i % every == 0]
                if at:
                    own = _unpack(raw, len(ids), dims)[at]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[k] for k in at], pa.int64()), pa.array([block] * len(at), pa.int64()),
                        pa.array(at, pa.int32()), pa.array([labels[k] for k in at], pa.int64()),
                        pa.array([v.tobytes() for v in own], pa.binary())],
                        ["anchor", "at_block", "at_place", "label", "vector"])

    return blocks.select("block", "ids", "labels", "vectors").mapInArrow(
        run, "anchor long, at_block long, at_place int, label long, vector binary")


_ANCHOR = "struct<anchor:bigint,at_block:bigint,at_place:int,label:bigint,vector:binary,tops:array<bigint>>"


def _pack(work: Work, anchors: DataFrame, name: str) -> tuple[DataFrame, int]:
    """(part, anchors: up to ANCHOR_BLOCK of them, sorted by label), and how many; parts are numbered from 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows = pa.StructArray.from_arrays(batch.columns, names=batch.schema.names)
            for lo in range(0, len(rows), ANCHOR_BLOCK):
                some = rows.slice(lo, ANCHOR_BLOCK)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.ListArray.from_arrays(
                    pa.array([0, len(some)], pa.int32()), some)], ["place", "anchors"])
                k += 1

    order = ("label", "anchor", "at_block", "at_place")
    placed = anchors.select("anchor", "at_block", "at_place", "label", "vector", "tops").repartitionByRange(*order).sortWithinPartitions(*order)
    packed = work.cut(placed.mapInArrow(run, f"place long, anchors array<{_ANCHOR}>"), name)
    # numbers without gaps: blocks of a partition are consecutive, partitions few
    sizes = packed.select(F.shiftright("place", 32).alias("p")).groupBy("p").count().orderBy("p").collect()
    first, total = [], 0
    for row in sizes:
        first += [F.lit(row["p"]).cast("long"), F.lit(total).cast("long")]
        total += row["count"]
    if not total:
        return packed.withColumnRenamed("place", "part"), 0
    before = F.create_map(*first)[F.shiftright("place", 32)]
    return packed.select((before + F.col("place").bitwiseAND((1 << 32) - 1)).alias("part"), "anchors"), total


def _tiles(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """``rows`` (block, ..., part: the anchor block to meet) joined with the anchor blocks, salted by row block."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    return (rows.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(SALT)).cast("int"))
            .join(anchors.select("*", salt), ["part", "salt"]))


def _score_tiles(tiles: DataFrame, dims: int, primes: list[int], k: int, low: int | None) -> DataFrame:
    """Per tile and anchor the best rows of its label (``low`` None) or, per window, of other labels:
    (anchor, at_block, at_place, window, score, id, top)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in range(batch.num_rows):
                block, ids = batch.column("block")[t].as_py(), batch.column("ids")[t].values
                labels = np.asarray(batch.column("labels")[t].values)
                own = pa.RecordBatch.from_struct_array(batch.column("anchors")[t].values)
                vectors = _unpack(batch.column("vectors")[t].as_py(), len(labels), dims)
                queries = np.frombuffer(b"".join(own.column("vector").to_pylist()), np.int32).reshape(own.num_rows, dims)
                score = exact_scores(queries, vectors, primes)
                same = np.asarray(own.column("label"))[:, None] == labels[None, :]
                if low is None:
                    here = np.flatnonzero(np.asarray(own.column("at_block")) == block)
                    same[here, np.asarray(own.column("at_place"))[here]] = False
                    line, col = best_rows(np.where(same, score, _NONE), k)
                    window, top = np.zeros(len(line), np.int64), np.zeros(len(line), np.int64)
                else:
                    sizes = np.asarray(own.column("tops").value_lengths())
                    tops = np.full((own.num_rows, int(sizes.max(initial=0))), _NONE)
                    tops[np.arange(tops.shape[1])[None, :] < sizes[:, None]] = np.asarray(own.column("tops").flatten())
                    line, window, col = best_in_windows(score, ~same, tops, low, k)
                    top = tops[line, window]
                if len(line):
                    took = pa.array(line)
                    yield pa.RecordBatch.from_arrays([
                        own.column("anchor").take(took), own.column("at_block").take(took), own.column("at_place").take(took),
                        pa.array(window, pa.int32()), pa.array(score[line, col], pa.int64()), ids.take(pa.array(col)),
                        pa.array(top, pa.int64())], ["anchor", "at_block", "at_place", "window", "score", "id", "top"])

    return tiles.select("block", "ids", "labels", "vectors", "anchors").mapInArrow(
        run, "anchor long, at_block long, at_place int, window int, score long, id long, top long")


def _first(df: DataFrame, keys: list[str], k: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def mine(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, scale: float = 256.0,
         every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, row_block: int = ROW_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``; their positives the first ``positives`` other rows of
    their label by score, then id; for each, the first ``negatives`` rows of other labels that score from ``low`` to
    100 % of the positive's score.  ``label``: the label column or an expression for it.
    """
    spark = df.sparkSession
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    label = F.col("label") if label is None else label
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(sound, F.lit(False)))
    order = (F.col("label"), F.col("id").asc_nulls_last())
    with Work(spark, "negatives") as work:
        blocks = make_blocks(work, rows.repartitionByRange(*order).sortWithinPartitions(*order), scale, row_block)
        bound = blocks.agg(F.max("dims").alias("dims"), F.max("norm").alias("norm"), F.count("*").alias("n")).first()
        if bound["n"] and bound["norm"] > MAX_NORM:
            raise ValueError("scaled vectors too long: components must stay within 2^28 and squared norms within 2^56")
        dims = max(bound["dims"] or 0, 1)
        primes = moduli(dims, int(bound["norm"] or 0))
        anchors = work.cut(_anchors(blocks, every, dims), "anchors")
        no_tops = F.array().cast("array<long>")
        packed, _ = _pack(work, anchors.withColumn("tops", no_tops), "anchors-1")
        # positives: blocks that share a label
        pairs = (blocks.select("block", F.explode(F.array_distinct("labels")).alias("label"))
                 .join(packed.select("part", F.explode(F.array_distinct(F.transform("anchors", lambda a: a["label"]))).alias("label")), "label")
                 .select("block", "part").distinct())
        scored = _score_tiles(_tiles(blocks.join(pairs, "block"), packed), dims, primes, positives, None)
        key = ["anchor", "at_block", "at_place"]
        best = work.cut(_first(scored, key, positives, "positive_rank").select(
            *key, "positive_rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
        # negatives: every block
        tops = best.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("positive_rank", "positive_score"))).alias("t"))
        tops = tops.select(*key, F.transform("t", lambda x: x["positive_score"]).alias("tops"))
        packed, parts = _pack(work, anchors.join(tops, key), "anchors-2")
        meet = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(parts - 1, 0)).cast("long"))).alias("part")
        scored = _score_tiles(_tiles(blocks.select("*", meet), packed), dims, primes, negatives, low)
        found = _first(scored, [*key, "window"], negatives, "rank").withColumn("positive_rank", F.col("window") + 1)
        return work.result(found.join(best, [*key, "positive_rank"]).select(
            F.col("anchor").alias("anchor_id"), "positive_id", "positive_rank", "rank", F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")))
