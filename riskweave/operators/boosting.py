"""Histogram gradient boosting on one binned matrix (inventory M2-M4, M7, M8).

1. Bin edges of every feature come from one distributed sketch; every row is
   binned once (a byte per feature) and the binned matrix is written.  Folds
   and the final model share it.
2. Models are fitted side by side, one task each: model f on the rows outside
   fold f, and one more on all.  A task reads its rows in batches into one matrix
   of a byte per row and feature (on its disk, beyond ``MATRIX_BYTES``) and returns
   the trees as rows of a node table.
3. Rows are scored where they lie by the nodes of their model, which are
   bounded by rounds x leaves.

The objective is the logistic loss with weighted positives, leaves grow best
first, with L1 and L2 terms, a least number of rows a leaf and a share of the columns drawn for each
tree.  Rows are drawn only every ``subsample_freq`` rounds; 0, the reference's
setting, draws none, whatever ``subsample`` says.
"""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clean_number
from ..session import cut_lineage, ship_package

# Fixed values from the reference: its boosting parameters.
BOOSTING = dict(n_estimators=400, learning_rate=0.02, max_depth=8, num_leaves=200, min_child_samples=50, subsample=0.6,
                subsample_freq=0, colsample_bytree=0.8, reg_alpha=2.0, reg_lambda=1.5, scale_pos_weight=2.0, seed=42)
#: Binned rows of a fit beyond which they lie in a file of the task's temporary folder, read a column at a time.
MATRIX_BYTES = 256 << 20
BINS = 255
MIN_HESSIAN = 1e-3

_NODE = pa.schema([("model", pa.int32()), ("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()),
                   ("left", pa.int32()), ("right", pa.int32()), ("value", pa.float64()), ("gain", pa.float64())])
_NODE_DDL = ", ".join(f"`{f.name}` {'double' if f.type == pa.float64() else 'int'}" for f in _NODE)


# ---------------------------------------------------------------- binning

def bin_edges(df: DataFrame, cols, bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of each column's bins: distinct approximate quantiles, from one aggregate."""
    probs = [k / bins for k in range(1, bins)]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), clean_number(c).alias("x")) for k, c in enumerate(cols)])).alias("c"))
    got = {r["k"]: r["e"] for r in long.groupBy("c.k").agg(F.percentile_approx("c.x", probs, 10_000).alias("e")).collect()}
    return [np.unique(np.array(got.get(k, []), np.float64)) for k in range(len(cols))]


def binned(df: DataFrame, cols, edges: list[np.ndarray], keep) -> DataFrame:
    """(keep..., bins): a byte per column, the number of edges below the value."""
    kept = [c for c in keep if c in df.columns]
    rows = df.select(*kept, F.array(*[clean_number(c) for c in cols]).alias("x"))
    sent = df.sparkSession.sparkContext.broadcast(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), np.float64).reshape(batch.num_rows, len(cols))
            out = np.empty(x.shape, np.uint8)
            for k, edge in enumerate(sent.value):
                out[:, k] = np.searchsorted(edge, x[:, k], "left")
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([r.tobytes() for r in out], pa.binary())],
                                             [*kept, "bins"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("x").schema.fields)
    return rows.mapInArrow(run, f"{schema}, bins binary")


# ---------------------------------------------------------------- fitting

def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


class _Grower:
    """Grows the trees of one model over its binned rows; the bins of all columns lie side by side."""

    def __init__(self, x: np.ndarray, bins: np.ndarray, params: dict):
        self.p = params
        self.begin = np.cumsum(bins) - bins
        self.size = int(bins.sum())
        self.column = np.repeat(np.arange(len(bins)), bins)
        self.bins = bins.tolist()
        self.by_column = np.ascontiguousarray(x.T)

    def histogram(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Sums of g, h and rows by bin, a column at a time: its bins and the rows' g and h stay in the processor's cache."""
        out = np.empty((3, self.size))
        every = len(rows) == self.by_column.shape[1]
        g, h = g[rows], h[rows]
        for column, begin, n in zip(self.by_column, self.begin.tolist(), self.bins, strict=True):
            at = (column if every else column[rows]).astype(np.intp)
            part = out[:, begin:begin + n]
            part[0], part[1], part[2] = np.bincount(at, g, n), np.bincount(at, h, n), np.bincount(at, minlength=n)
        return out

    def score(self, g, h):
        return _shrunk(g, self.p["reg_alpha"]) ** 2 / (h + self.p["reg_lambda"])

    def best(self, hist: np.ndarray, total: np.ndarray, drawn: np.ndarray) -> tuple[float, int, int]:
        """(gain, column, bin) of the best split of a leaf; gain 0: none.  ``drawn``: the bins of the tree's columns."""
        least = self.p["min_child_samples"]
        if total[2] < 2 * least:
            return 0.0, -1, -1
        left = np.cumsum(hist, axis=1)
        left -= (left[:, self.begin] - hist[:, self.begin])[:, self.column]
        some = np.flatnonzero(drawn & (left[2] >= least) & (left[2] <= total[2] - least) & (left[1] >= MIN_HESSIAN)
                              & (left[1] <= total[1] - MIN_HESSIAN))
        if not len(some):
            return 0.0, -1, -1
        g, h = left[0, some], left[1, some]
        gain = self.score(g, h) + self.score(total[0] - g, total[1] - h) - self.score(total[0], total[1])
        k = int(gain.argmax())
        return float(gain[k]), int(self.column[some[k]]), int(some[k] - self.begin[self.column[some[k]]])

    def tree(self, g: np.ndarray, h: np.ndarray, rows: np.ndarray, drawn: np.ndarray) -> tuple[list[list], list[tuple[int, np.ndarray]]]:
        """Nodes [feature, bin, left, right, value, gain], and the rows of each leaf."""
        nodes: list[list] = []
        leaves: dict[int, tuple] = {}
        heap: list[tuple[float, int]] = []
        drawn = drawn[self.column]

        def add(members: np.ndarray, hist: np.ndarray | None, depth: int) -> int:
            total = np.array([g[members].sum(), h[members].sum(), len(members)])
            value = -_shrunk(total[0], self.p["reg_alpha"]) / (total[1] + self.p["reg_lambda"]) * self.p["learning_rate"]
            nodes.append([-1, -1, -1, -1, float(value), 0.0])
            gain, column, cut = self.best(hist, total, drawn) if depth < self.p["max_depth"] else (0.0, -1, -1)
            leaves[len(nodes) - 1] = (members, hist, depth, column, cut)
            if gain > 0:
                heapq.heappush(heap, (-gain, len(nodes) - 1))
            return len(nodes) - 1

        add(rows, self.histogram(rows, g, h), 0)
        while heap and len(leaves) < self.p["num_leaves"]:
            gain, node = heapq.heappop(heap)
            members, hist, depth, column, cut = leaves.pop(node)
            goes = self.by_column[column][members] <= cut
            sides = members[goes], members[~goes]
            small = int(len(sides[1]) < len(sides[0]))
            hists = (None, None)
            if depth + 1 < self.p["max_depth"]:         # nodes of the last level are not split
                part = self.histogram(sides[small], g, h)
                hists = (hist - part, part) if small else (part, hist - part)
            nodes[node][:4] = column, cut, add(sides[0], hists[0], depth + 1), add(sides[1], hists[1], depth + 1)
            nodes[node][5] = -gain
        return nodes, [(k, v[0]) for k, v in leaves.items()]


def grow_model(x: np.ndarray, y: np.ndarray, bins: np.ndarray, params: dict) -> tuple[float, list[list[list]]]:
    """The first score (log odds of the weighted mean) and the trees' nodes; ``bins``: how many each column has."""
    rng = np.random.default_rng(params["seed"])
    weight = np.where(y == 1, params["scale_pos_weight"], 1.0)
    mean = np.clip((weight * y).sum() / max(weight.sum(), 1e-12), 1e-6, 1 - 1e-6)
    start = float(np.log(mean / (1 - mean)))
    score, grower, trees = np.full(len(y), start), _Grower(x, bins, params), []
    rows, d = np.arange(len(y)), x.shape[1]
    for t in range(params["n_estimators"] if len(y) else 0):
        p = 1 / (1 + np.exp(-score))
        if params["subsample_freq"] and t % params["subsample_freq"] == 0:
            rows = np.sort(rng.choice(len(y), max(1, int(len(y) * params["subsample"])), replace=False))
        drawn = np.zeros(d, bool)
        drawn[rng.choice(d, max(1, round(d * params["colsample_bytree"])), replace=False)] = True
        nodes, leaves = grower.tree((p - y) * weight, p * (1 - p) * weight, rows, drawn)
        if len(rows) == len(y):
            for k, members in leaves:
                score[members] += nodes[k][4]
        else:
            score += walk([nodes], x)
        trees.append(nodes)
    return start, trees


def walk(trees: list, x: np.ndarray) -> np.ndarray:
    """Sum of the trees' values for binned rows."""
    out = np.zeros(len(x))
    for nodes in trees:
        feature, cut, left, right, value = (np.array([n[k] for n in nodes]) for k in range(5)) if isinstance(nodes, list) else nodes
        at = np.zeros(len(x), np.int64)
        live = np.flatnonzero(feature[at] >= 0)
        while len(live):
            here = at[live]
            at[live] = np.where(x[live, feature[here]] <= cut[here], left[here], right[here])
            live = live[feature[at[live]] >= 0]
        out += value[at]
    return out


# ---------------------------------------------------------------- operators

def _matrix(d: int, n: int) -> np.ndarray:
    """Room for the bins of n rows, a column's side by side; a file that goes with the array beyond ``MATRIX_BYTES``."""
    if d * n <= MATRIX_BYTES:
        return np.empty((d, n), np.uint8)
    with tempfile.TemporaryFile() as file:
        return np.memmap(file, np.uint8, "w+", shape=(d, n))


@dataclass
class Boosted:
    """Fitted models over one set of bins: ``nodes`` by model number, first scores, edges."""
    cols: list[str]
    edges: list[np.ndarray]
    starts: dict[int, float]
    trees: dict[int, list]
    node_rows: pa.Table
    final: int


def fit_boosted(matrix: DataFrame, cols, y: str = "is_fraud", fold: str = "fold", k: int = 5, key: str = "id_user",
                with_folds: bool = True, with_final: bool = True, max_rows: int | None = None, **overrides) -> tuple[Boosted, DataFrame]:
    """The models (number f without fold f, number k on all rows) and the binned matrix (key, y, fold, bins), written.

    ``overrides`` change ``BOOSTING``.  The fits take all rows; a caller who gives ``max_rows`` has them drawn by a hash of the key."""
    unknown = set(overrides) - set(BOOSTING)
    if unknown:
        raise ValueError(f"no such boosting parameters: {sorted(unknown)}")
    spark = matrix.sparkSession
    ship_package(spark)
    params = {**BOOSTING, **overrides}
    edges = bin_edges(matrix, cols)
    rows = cut_lineage(binned(matrix, cols, edges, (key, y, fold)))
    fitted = rows
    if max_rows is not None:
        share = min(1.0, max_rows / max(rows.count(), 1))
        fitted = rows.filter(F.pmod(F.xxhash64(F.lit(params["seed"]), key), F.lit(1 << 30)) < int((1 << 30) * share))
    numbers = [*range(k)] * with_folds + [k] * with_final
    own = F.coalesce(F.col(fold), F.lit(-1))
    sizes = dict(zip(numbers, fitted.agg(*[F.count(F.when(own != m, 1)) for m in numbers]).first(), strict=True))
    dealt = (fitted.withColumn("model", F.explode(F.array(*[F.lit(m) for m in numbers]))).filter(F.col("model") != own)
             .select("model", F.col(key).alias("key"), F.col(y).cast("double").alias("y"), "bins"))
    d, bins = len(cols), np.array([len(e) + 1 for e in edges])
    # a task for each model
    dealt = (dealt.repartitionById(len(numbers), F.col("model") - numbers[0])
             .sortWithinPartitions(F.asc_nulls_last("key")).drop("key"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, at = -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if not at:
                model = batch.column("model")[0].as_py()
                x, label = _matrix(d, sizes[model]), np.empty(sizes[model])
            end = at + batch.num_rows
            x[:, at:end] = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, d).T
            label[at:end] = batch.column("y").to_numpy(zero_copy_only=False)
            at = end
        if not at:
            return
        start, trees = grow_model(x.T, label, bins, params)
        out = [(model, -1, 0, -1, -1, -1, -1, start, 0.0)]
        out += [(model, t, n, *node) for t, nodes in enumerate(trees) for n, node in enumerate(nodes)]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), _NODE, strict=True)],
                                         schema=_NODE)

    # bounded: models x rounds x twice the leaves
    nodes = dealt.mapInArrow(fit, _NODE_DDL).toArrow().sort_by([("model", "ascending"), ("tree", "ascending"),
                                                                                     ("node", "ascending")])
    starts, trees = {}, {}
    column = {f: nodes.column(f).to_numpy() for f in nodes.schema.names}
    cuts = np.flatnonzero((np.diff(column["model"]) != 0) | (np.diff(column["tree"]) != 0)) + 1
    for part in np.split(np.arange(nodes.num_rows), cuts):
        if not len(part):
            continue
        model, tree = int(column["model"][part[0]]), int(column["tree"][part[0]])
        if tree < 0:
            starts[model], trees[model] = float(column["value"][part[0]]), []
        else:
            trees[model].append(tuple(column[c][part] for c in ("feature", "bin", "left", "right", "value")))
    return Boosted(list(cols), edges, starts, trees, nodes, k), rows


def predict_boosted(model: Boosted, rows: DataFrame, number: str | int, out: str = "p") -> DataFrame:
    """``rows`` (..., bins) with the probability of the model named by a column or a number, without the bins."""
    which = F.col(number) if isinstance(number, str) else F.lit(number)
    sent = rows.sparkSession.sparkContext.broadcast((model.starts, model.trees))
    rows = rows.select(*[c for c in rows.columns if c != "bins"], which.cast("int").alias("_model"), "bins")
    kept = rows.drop("_model", "bins")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, trees = sent.value
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            mine, p = np.asarray(batch.column("_model")), np.zeros(batch.num_rows)
            for m in np.unique(mine):
                at = np.flatnonzero(mine == m)
                p[at] = 1 / (1 + np.exp(-(starts[m] + walk(trees[m], x[at]))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(p)], [*batch.schema.names[:-2], out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return rows.mapInArrow(run, f"{schema}, `{out}` double")


def boosted_oof(model: Boosted, rows: DataFrame, fold: str = "fold") -> DataFrame:
    """M4: every training row scored by the model that has not seen its fold."""
    return predict_boosted(model, rows, fold)


def boosted_labels(model: Boosted, test: DataFrame, threshold: float, key: str = "id_user") -> DataFrame:
    """M8: final labels ``p >= threshold`` of a table with the model's columns."""
    scored = predict_boosted(model, binned(test, model.cols, model.edges, (key,)), model.final)
    return scored.select(key, (F.col("p") >= F.lit(threshold)).cast("int").alias("is_fraud"))


def boosted_importance(spark, model: Boosted, top: int | None = None) -> DataFrame:
    """M7: how often the final model splits on each feature, and the gain of these splits, sorted."""
    splits, gain = np.zeros(len(model.cols), np.int64), np.zeros(len(model.cols))
    nodes = {c: model.node_rows.column(c).to_numpy() for c in ("model", "feature", "gain")}
    own = (nodes["model"] == model.final) & (nodes["feature"] >= 0)
    np.add.at(splits, nodes["feature"][own], 1)
    np.add.at(gain, nodes["feature"][own], nodes["gain"][own])
    rows = [(c, float(s), float(v)) for c, s, v in zip(model.cols, splits, gain, strict=True)]
    out = spark.createDataFrame(rows, "feature string, importance double, gain double").orderBy(F.desc("importance"), "feature")
    return out.limit(top) if top else out
