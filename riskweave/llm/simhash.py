"""SimHash near-dedup by tiled exact comparison.

Fingerprints: 64 bits, a bit is 1 if set in over half of the XXH64 (seed 42)
of the text's word shingles.  Two fingerprints whose distance is at most r
also differ by at most r in the summed differences of the population counts of
their four 16-bit parts.  So distinct fingerprints are laid out in tiles by the
counts of the first two parts; only tile pairs within the radius meet, and
inside a pair only runs within what the radius leaves for the other two parts.
What remains is compared exactly, numpy exclusive-or and bit counts on whole
arrays.  Tiles hold at most about ``TILE`` fingerprints; each tile pair sends
back a spanning forest of its links (never more rows than fingerprints), and
connected components join the forests.

Edge cases: a null, empty or blank text has fingerprint zero and links like
any other; fewer words than the shingle length make one shingle of them all;
null ids never name a component, except that a component of null ids alone
has a null id; equal rows are all returned; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, connected_components, text_blocks, text_or_empty

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: Fingerprints of a tile; more in a cell are dealt to several tiles by hash.
TILE = 1 << 15
#: Pairs compared by one numpy call.
_CALL = 1 << 20
#: Bytes of one text split into words at a time.
_PIECE = 1 << 20
_BLANK = re.compile(rb"[ \t-\r]")


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        cut = _BLANK.search(text, at + _PIECE)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of one UTF-8 text; A-Z count as a-z."""
    ones, total, kept = np.zeros(64, np.int64), 0, []
    for piece in _pieces(text.lower()):
        kept += piece.split()
        n = len(kept) - words + 1
        if n < 1:
            continue
        joined = b" ".join(kept)
        length = np.fromiter(map(len, kept), np.int64, len(kept)) + 1
        end = np.cumsum(length)
        starts, ends = (end - length)[:n].tolist(), (end - 1)[words - 1:].tolist()
        hashes = np.array(list(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, starts, ends)),
                                   repeat(seed))), "<u8")
        for lo in range(0, n, 1 << 14):
            bits = np.unpackbits(hashes[lo:lo + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int64)
        total += n
        kept = kept[n:]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(kept), seed) if kept else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, *carry); fp is the fingerprint's 64 bits as a signed long."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *carry, text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                raw = data.tobytes()
                out[lo:hi] = [fingerprint(raw[a:b], words) for a, b in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out.view(np.int64))],
                                             [*batch.schema.names[:-1], "fp"])

    kept = rows.drop("text").schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return rows.mapInArrow(run, f"{schema}, fp long")


# ---------------------------------------------------------------- tiles

def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (flat: every entry is a root) after joining a[i] with b[i]."""
    while True:
        x, y = label[a], label[b]
        far = x != y
        if not far.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[far], np.minimum(x, y)[far])
        label, a, b = _roots(label), a[far], b[far]


def _parts(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit counts of the last two 16-bit parts."""
    low = np.uint64(0xFFFF)
    return (np.bitwise_count(fp >> np.uint64(16) & low).astype(np.int64), np.bitwise_count(fp & low).astype(np.int64))


def tile_links(left: np.ndarray, right: np.ndarray, radius: int, left_over: int) -> np.ndarray:
    """Spanning forest, rows (fp, root), of the links of two tiles (the same array twice: of one).

    ``left_over``: the radius less what the first two parts' counts differ by.
    """
    same = left is right
    nodes = left if same else np.concatenate([left, right])
    shift = 0 if same else len(left)
    label = np.arange(len(nodes))
    keys = [p * 32 + q for p, q in (_parts(left), _parts(right))]
    orders = [np.argsort(k, kind="stable") for k in keys]
    a_key, b_key = keys[0][orders[0]], keys[1][orders[1]]
    a_all, b_all = left[orders[0]], right[orders[1]]
    cells, first = np.unique(a_key, return_index=True)
    last = np.append(first[1:], len(a_key))
    for cell, lo, hi in zip(cells.tolist(), first.tolist(), last.tolist(), strict=True):
        p, q = divmod(cell, 32)
        for d in range(-left_over, left_over + 1):
            room = left_over - abs(d)
            if p + d < 0:
                continue
            b_lo, b_hi = np.searchsorted(b_key, [(p + d) * 32 + max(0, q - room), (p + d) * 32 + q + room + 1])
            if same:
                b_lo = max(b_lo, lo)              # each pair of cells once
            if b_lo >= b_hi:
                continue
            wide = max(1, _CALL // int(b_hi - b_lo))
            for at in range(lo, hi, wide):
                i, j = np.nonzero(np.bitwise_count(a_all[at:min(hi, at + wide), None] ^ b_all[None, b_lo:b_hi]) <= radius)
                if len(i):
                    label = _unite(label, orders[0][at + i], orders[1][b_lo + j] + shift)
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[linked], nodes[label[linked]]], 1)


def links(work: Work, fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fps`` (fp) at distance ``radius`` or less, reduced to forests."""
    spark = work.spark
    cell = (F.bit_count(F.shiftrightunsigned("fp", 48)) * 32
            + F.bit_count(F.shiftrightunsigned("fp", 32).bitwiseAND(F.lit(0xFFFF))))
    laid = fps.select("fp", cell.cast("int").alias("cell"))
    # one row per pair of bit counts: at most 17 x 17, whatever the corpus
    count = {r["cell"]: -(-r["n"] // tile) for r in laid.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    near = []
    for c in count:
        for d in count:
            gap = abs(c // 32 - d // 32) + abs(c % 32 - d % 32)
            if gap <= radius:
                near.append((c, count[c], d, count[d], radius - gap))
    near = spark.createDataFrame(near, "cell int, own int, other int, others int, room int")
    slot = F.pmod(F.xxhash64("fp"), F.col("own")).cast("int")
    sent = (laid.join(F.broadcast(near), "cell")                       # at most 289 x 13 rows
            .select("fp", "room", "cell", "other", slot.alias("slot"),
                    F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("their")))
    # of a pair of tiles the smaller (cell, slot) is the left side; a tile meets itself once
    here, there = F.struct("cell", "slot"), F.struct(F.col("other"), F.col("their"))
    mine = here <= there
    sent = sent.select("fp", "room", (~mine).alias("right"),
                       F.when(mine, F.col("cell")).otherwise(F.col("other")).alias("c1"),
                       F.when(mine, F.col("slot")).otherwise(F.col("their")).alias("s1"),
                       F.when(mine, F.col("other")).otherwise(F.col("cell")).alias("c2"),
                       F.when(mine, F.col("their")).otherwise(F.col("slot")).alias("s2"))

    def run(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        side = table.column("right").to_numpy(zero_copy_only=False).astype(bool)
        left, right = fp[~side], fp[side]
        if table.column("c1")[0] == table.column("c2")[0] and table.column("s1")[0] == table.column("s2")[0]:
            right = left
        found = tile_links(left, right, radius, table.column("room")[0].as_py()).view(np.int64)
        return pa.table({"u": found[:, 0], "v": found[:, 1]})

    return sent.groupBy("c1", "s1", "c2", "s2").applyInArrow(run, "u long, v long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    radius: int = RADIUS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, fp, component_id (least id reachable over links of at most ``radius`` bits)."""
    with Work(df.sparkSession, "simhash") as work:
        prints = work.cut(fingerprints(df, id_col, text_col, words, carry), "prints")
        fps = work.cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
        found = work.cut(links(work, fps.select("fp"), radius), "links")
        roots = connected_components(work, found)
        placed = work.cut(fps.join(roots, fps["fp"] == roots["node"], "left")
                          .select("fp", "least", F.coalesce("root", "fp").alias("root")), "placed")
        named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        named = placed.join(named, "root").select("fp", "component_id")
        return work.result(prints.join(named, "fp").select("doc_id", *carry, "fp", "component_id"))


def hex_fingerprint(name: str = "fp"):
    return F.lower(F.lpad(F.hex(name), 16, "0"))
