"""Line dedup: two Bloom filters pick suspected repeats, an exact count confirms them.

A line's key is the line without blanks (``[\\x20\\x09-\\x0D]``) at both ends,
A-Z lower-cased.  Keys of at least ``min_chars`` code points that are found in
at least ``min_docs`` documents lose all their lines, except in the document
of the largest id that holds them.

1. Every task of the first pass adds the hash of each key, once a document,
   to two filters: a bit of ``once`` is set by the first hash that meets it,
   a bit of ``twice`` by any later one.  The tasks' filters are merged segment
   by segment, where no more than one segment is in memory: a bit that two
   tasks have set is set twice.  A key of two documents has all its bits in
   ``twice``; a key of one has them by chance alone.
2. The second pass asks ``twice`` about each key.  Suspected ones leave their
   128-bit digest, id and line numbers; nothing else is shuffled.
3. Documents are counted per digest, and the largest id is taken.  Only
   documents with suspected lines meet the lines to drop in a join; others pass
   through where they were written.

``twice`` is broadcast.  Its size follows the bytes of all texts (a key takes
more than ``min_chars`` of them), up to ``MAX_FILTER_BYTES``.  Past that bound
more keys are suspected by chance and shuffle as digests: the result stays
exact at any size, at the price of some 40 bytes a line.

Edge cases: a null or empty text is one empty line; a null id is a document
id below all others; rows of one id are one document for the count, each is
cleaned by itself; an empty table gives no rows; a very long text is taken
whole.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, SpanHash, Work, mix64, text_blocks, text_or_empty

MIN_CHARS = 40
MIN_DOCS = 5
BITS_PER_KEY = 8
HASHES = 3
#: Bits of a segment: the unit in which filters are merged.
SEGMENT_BITS = 1 << 20
#: Bound of the filter that is broadcast, and of each of the two that a task builds.
MAX_FILTER_BYTES = 32 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


class Lines:
    """The lines of a block of texts: ``row`` and ``place`` of each, ``start`` and ``end`` of its key, ``chars`` of the key."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        rows = len(offs) - 1
        breaks = np.flatnonzero(data == 10)
        # a line begins with each text and after each break; a break belongs to the text it lies in
        self.per_row = np.searchsorted(breaks, offs[1:]) - np.searchsorted(breaks, offs[:-1]) + 1
        self.row = np.repeat(np.arange(rows), self.per_row)
        heads = np.cumsum(self.per_row) - self.per_row
        self.place = np.arange(len(self.row)) - heads[self.row]
        first, last = np.empty(len(self.row), np.int64), np.empty(len(self.row), np.int64)
        inner = self.place > 0
        first[~inner], first[inner] = offs[:-1], breaks + 1
        broken = np.ones(len(self.row), bool)
        broken[heads + self.per_row - 1] = False
        last[~broken], last[broken] = offs[1:], breaks
        solid = np.flatnonzero(~_BLANK[data])
        lo, hi = np.searchsorted(solid, first), np.searchsorted(solid, last)
        some = hi > lo
        self.start, self.end = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        self.start[some], self.end[some] = solid[lo[some]], solid[hi[some] - 1] + 1
        heads_of_chars = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=heads_of_chars[1:])
        self.chars = heads_of_chars[self.end] - heads_of_chars[self.start]


def _bits(keys: np.ndarray, size: int) -> np.ndarray:
    """The ``HASHES`` bits of each hash in a filter of ``size`` bits (a power of two): rows of positions."""
    step = mix64(keys, 7) | U64(1)
    return ((keys[:, None] + np.arange(HASHES, dtype=U64)[None, :] * step[:, None]) & U64(size - 1)).astype(np.int64)


def _keys(data: np.ndarray, lines: Lines, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the lines whose key is long enough, and their hashes."""
    long = np.flatnonzero(lines.chars >= min_chars)
    return long, SpanHash(data, lower=True)(lines.start[long], lines.end[long])


def filter_bits(total_bytes: int, min_chars: int = MIN_CHARS, most: int = MAX_FILTER_BYTES) -> int:
    """Bits of each filter: ``BITS_PER_KEY`` for every key that the texts can hold, a power of two up to the bound."""
    wanted = BITS_PER_KEY * (total_bytes // (min_chars + 1) + 1)
    return min(max(SEGMENT_BITS, 1 << (wanted - 1).bit_length()), most * 8)


def build_filter(work: Work, rows: DataFrame, size: int, min_chars: int) -> DataFrame:
    """(segment, bits): the ``twice`` filter of the keys of ``rows`` (text), zstd-packed, without empty segments."""
    step = SEGMENT_BITS // 8

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8)
        for batch in batches:
            for _, _, data, offs in text_blocks(batch.column("text")):
                lines = Lines(data, offs)
                long, keys = _keys(data, lines, min_chars)
                # a key counts once a document
                order = np.lexsort((keys, lines.row[long]))
                keys, owner = keys[order], lines.row[long][order]
                fresh = np.ones(len(keys), bool)
                fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
                # a bit that one key hits more than once is one hit
                hits = np.sort(_bits(keys[fresh], size), axis=1)
                again = np.zeros(hits.shape, bool)
                again[:, 1:] = hits[:, 1:] == hits[:, :-1]
                places, counts = np.unique(hits[~again], return_counts=True)
                bit = np.left_shift(1, places & 7).astype(np.uint8)
                known = (once[places >> 3] & bit) > 0
                more = known | (counts > 1)
                np.bitwise_or.at(twice, places[more] >> 3, bit[more])
                np.bitwise_or.at(once, places >> 3, bit)
        used = np.flatnonzero(once.reshape(-1, step).any(axis=1))
        for s in used:
            yield pa.RecordBatch.from_arrays([
                pa.array([s], pa.int32()),
                pa.array([pa.compress(once[s * step:(s + 1) * step].tobytes(), "zstd", asbytes=True)], pa.binary()),
                pa.array([pa.compress(twice[s * step:(s + 1) * step].tobytes(), "zstd", asbytes=True)], pa.binary())],
                ["segment", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice = None, None, None

        def done() -> pa.RecordBatch:
            packed = pa.compress(twice.tobytes(), "zstd", asbytes=True)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed], pa.binary())], ["segment", "bits"])

        for batch in batches:
            for s, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                a, b = (np.frombuffer(pa.decompress(x.as_py(), step, "zstd"), np.uint8) for x in (a, b))
                if s != now:
                    if now is not None and twice.any():
                        yield done()
                    now, once, twice = s, a.copy(), b.copy()
                else:
                    twice |= b
                    twice |= once & a
                    once |= a
        if now is not None and twice.any():
            yield done()

    parts = rows.select("text").mapInArrow(part, "segment int, once binary, twice binary")
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, bits binary")
    return work.cut(merged, "twice")


def find_suspects(work: Work, rows: DataFrame, twice: DataFrame, size: int, min_chars: int) -> DataFrame:
    """(row, doc_id, text, n_lines, suspects: (digest, places)): lines by key that ``twice`` holds; ``row`` names a row."""
    step = SEGMENT_BITS // 8
    # bounded: at most MAX_FILTER_BYTES
    packed = work.spark.sparkContext.broadcast({r["segment"]: bytes(r["bits"]) for r in twice.toLocalIterator()})
    kept: list = []

    def the_filter() -> np.ndarray:
        if not kept:
            out = np.zeros(size // 8, np.uint8)
            for s, bits in packed.value.items():
                out[s * step:(s + 1) * step] = np.frombuffer(pa.decompress(bits, step, "zstd"), np.uint8)
            kept.append(out)
        return kept[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, row = the_filter(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                lines = Lines(data, offs)
                long, keys = _keys(data, lines, min_chars)
                at = _bits(keys, size)
                held = ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
                found: list[dict[bytes, list[int]]] = [{} for _ in range(hi - lo)]
                for k in long[held]:
                    key = data[lines.start[k]:lines.end[k]].tobytes().lower()
                    (found[lines.row[k]].setdefault(hashlib.blake2b(key, digest_size=16).digest(), [])
                     .append(int(lines.place[k])))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + hi - lo), pa.int64()), batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("text").slice(lo, hi - lo), pa.array(lines.per_row, pa.int64()),
                    pa.array([[{"digest": d, "places": p} for d, p in f.items()] for f in found], _SUSPECTS)],
                    ["row", "doc_id", "text", "n_lines", "suspects"])
                row += hi - lo

    return work.cut(rows.mapInArrow(run, "row long, doc_id long, text string, n_lines long, "
                                         "suspects array<struct<digest:binary,places:array<int>>>"), "scanned")


_SUSPECTS = pa.list_(pa.struct([("digest", pa.binary()), ("places", pa.list_(pa.int32()))]))


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = [], []
        for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True):
            lines = text.split("\n")
            drop = {p for group in places or [] for p in group}
            texts.append("\n".join(line for k, line in enumerate(lines) if k not in drop) if drop else text)
            gone.append(len(drop))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_lines"), pa.array(gone, pa.int64()),
                                          pa.array(texts, pa.string())], ["doc_id", "n_lines", "n_dropped", "text"])


def dedup_lines(work: Work, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): every row with its lines that stay; reads work tables, so use it inside ``work``."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = filter_bits(total, min_chars, filter_bytes)
    scanned = find_suspects(work, rows, build_filter(work, rows, size, min_chars), size, min_chars)
    suspects = scanned.select("row", "doc_id", F.explode("suspects").alias("s")).select("row", "doc_id", "s.digest", "s.places")
    # documents of a key: one row per (key, id) first, so a key that is everywhere arrives as partial counts
    confirmed = (suspects.groupBy("digest", "doc_id").agg(F.lit(1).alias("one")).groupBy("digest")
                 .agg(F.count("*").alias("docs"), F.max("doc_id").alias("keep_id")).filter(F.col("docs") >= min_docs))
    confirmed = work.cut(confirmed.select("digest", "keep_id"), "confirmed")
    drops = (suspects.join(confirmed, "digest").filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
             .groupBy("row").agg(F.collect_list("places").alias("places")))            # lines of one document
    clean = scanned.filter(F.size("suspects") == 0).select("doc_id", "n_lines", F.lit(0).cast("long").alias("n_dropped"), "text")
    rest = (scanned.filter(F.size("suspects") > 0).select("row", "doc_id", "n_lines", "text").join(drops, "row", "left")
            .select("doc_id", "n_lines", "text", "places")
            .mapInArrow(_drop, "doc_id long, n_lines long, n_dropped long, text string"))
    return clean.unionAll(rest)
