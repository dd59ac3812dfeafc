"""Substring dedup in the manner of blockwise suffix sorting with a difference cover.

Marks every byte covered by a ``LENGTH``-byte string that also starts earlier
in the corpus (smaller document, or same document and earlier start), judged
on the input.  Suffixes count to a depth of ``LENGTH`` bytes and never run
over the end of their document, so only equality to that depth matters.

1. Documents are laid out in order in blocks of a few MB, whose ids ascend
   with the documents.
2. Cover sample: in each document the places whose number modulo 57 is in a
   perfect difference set.  Of two equal 100-byte strings some pair of sample
   places lies at the same depth, at most 56, so the 44 bytes from there are
   equal too.  Sample strings are ranked bucket by bucket; those whose rank is
   theirs alone are dropped, what is left are ties.
3. Only a suffix with a tied sample place in reach can tie.  These suffixes
   are sorted one set of buckets at a time (several passes; a pass shuffles at
   most about ``PASS_SHARE`` of the text's bytes, so disk and memory are bounded), by 96 bits
   of fingerprint of their 100 bytes, then by place: all but the first of a
   tie are repeats.  The order of different strings is by fingerprint.
4. Repeats cover their 100 bytes; runs are merged per document.

A string that is everywhere reaches a bucket once per block, as blocks drop
their own repeats first.  Two different strings of 100 bytes would have to
agree in two independent hashes (64 and 32 bits) to be confused.

Edge cases: a null text is empty; null ids sort last, rows of one id are
ordered by a hash of the text and rows equal in both lie one after the other; texts shorter than
``LENGTH`` stay whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, Work, mix64
from .layout import Layout, release

LENGTH = 100
# fixed values: a perfect difference set (every residue is a difference of two members)
MODULUS, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
#: Bytes that every cover sample must agree on: what is left of LENGTH after the deepest place.
SAMPLE = LENGTH - MODULUS + 1
#: Bytes of one bucket's shuffled elements, about.
BUCKET_BYTES = 24 << 20
#: Bytes a pass shuffles, as a share of the text's bytes.
PASS_SHARE = 1.2

_IN_COVER = np.zeros(MODULUS, bool)
_IN_COVER[list(COVER)] = True
_ELEMENT = "bucket int, part long, block long, hashes binary, checks binary, offsets binary"
_MARKS = "block long, offsets binary"


def _layout(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document offsets, and for each byte its place in the document and the bytes from there to the end."""
    offs = np.concatenate([[0], np.cumsum(lens)])
    start = np.repeat(offs[:-1], lens)
    at = np.arange(offs[-1])
    return offs, at - start, np.repeat(offs[1:], lens) - at


def sample_places(lens: np.ndarray) -> np.ndarray:
    _, place, room = _layout(lens)
    return np.flatnonzero((room >= SAMPLE) & _IN_COVER[place % MODULUS])


def candidate_places(lens: np.ndarray, tied: np.ndarray) -> np.ndarray:
    """Places of suffixes that have one of the ``tied`` sample places in reach."""
    _, place, room = _layout(lens)
    n = len(place)
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, np.maximum(tied - (MODULUS - 1), tied - place[tied]), 1)
    np.add.at(edge, tied + 1, -1)
    return np.flatnonzero((np.cumsum(edge)[:n] > 0) & (room >= LENGTH))


def covered(lens: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Bytes covered by the strings that start at ``repeats``."""
    n = int(lens.sum())
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, repeats, 1)
    np.add.at(edge, repeats + LENGTH, -1)
    return np.cumsum(edge)[:n] > 0


def _steps(places: np.ndarray) -> bytes:
    """Ascending places as their differences (small numbers, which compress)."""
    return np.diff(places, prepend=0).astype("<u4").tobytes()


def _elements(block: int, hashes: np.ndarray, checks: np.ndarray | None, places: np.ndarray, buckets: int, passes: int,
              turn: int, all_ties: bool) -> Iterator[tuple]:
    """Rows of ``_ELEMENT``: the block's first of each string by bucket; under bucket -1 the places that are
    ties inside the block already (``all_ties``: with the first one)."""
    dealt = mix64(hashes, 3) >> np.uint64(20)
    mine = np.flatnonzero(dealt % np.uint64(passes) == turn) if passes > 1 else np.arange(len(hashes))
    order = mine[np.argsort(hashes[mine], kind="stable")]
    if checks is not None and len(order) > 1:
        h, c = hashes[order], checks[order]
        if ((h[1:] == h[:-1]) & (c[1:] != c[:-1])).any():
            order = mine[np.lexsort((checks[mine], hashes[mine]))]
    same = np.zeros(len(order), bool)
    same[1:] = hashes[order][1:] == hashes[order][:-1]
    if checks is not None:
        same[1:] &= checks[order][1:] == checks[order][:-1]
    known = same.copy()
    if all_ties:
        known[:-1] |= same[1:]
    if known.any():
        yield -1, block, block, b"", b"", _steps(np.sort(places[order[known]]))
    first = np.sort(order[~same])
    bucket = (dealt[first] // np.uint64(passes) % np.uint64(buckets)).astype(np.int32)
    by = np.argsort(bucket, kind="stable")
    first, bucket = first[by], bucket[by]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for run in np.split(np.arange(len(first)), cuts) if len(first) else ():
        at = first[run]
        h = hashes[at] if checks is not None else hashes[at].astype("<u4")
        yield (int(bucket[run[0]]), 0, block, h.tobytes(), b"" if checks is None else checks[at].tobytes(),
               places[at].astype("<u4").tobytes())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      ["bucket", "part", "block", "hashes", "checks", "offsets"])


def _ties(group: pa.Table, width: str, all_ties: bool) -> pa.Table:
    """Places of a bucket that share a string: all of them, or all but the first in (block, place) order."""
    group = group.sort_by("block")
    if group.column("bucket")[0].as_py() == -1:
        return group.select(["block", "offsets"])
    blocks = group.column("block").to_numpy()
    raw = {c: [np.frombuffer(x.as_buffer(), t) for x in group.column(c)] for c, t in
           (("hashes", width), ("offsets", "<u4"), ("checks", "<u4"))}
    whose = np.repeat(np.arange(len(blocks)), [len(x) for x in raw["offsets"]])
    hashes, offsets, checks = (np.concatenate(raw[c]) for c in ("hashes", "offsets", "checks"))
    order = np.argsort(hashes, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = hashes[order][1:] == hashes[order][:-1]
    if len(checks):
        c = checks[order]
        if (same[1:] & (c[1:] != c[:-1])).any():
            order = np.lexsort((checks, hashes))
            same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (checks[order][1:] == checks[order][:-1])
    if all_ties:
        same[:-1] |= same[1:]
    found = np.sort(order[same])
    owner = whose[found]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    runs = np.split(found, cuts) if len(found) else []
    return pa.table({"block": pa.array([int(blocks[whose[r[0]]]) for r in runs], pa.int64()),
                     "offsets": pa.array([_steps(offsets[r].astype(np.int64)) for r in runs], pa.binary())})


def _marks(batch: pa.RecordBatch, row: int) -> np.ndarray:
    """The places collected for a block."""
    got = batch.column("marks")[row].as_py() or []
    return np.concatenate([np.cumsum(np.frombuffer(x, "<u4"), dtype=np.int64) for x in got]) if got else np.zeros(0, np.int64)


def _tied_samples(blocks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column("text")[row].as_buffer(), np.uint8)
                at = sample_places(np.array(batch.column("lens")[row].as_py(), np.int64))
                rows = list(_elements(batch.column("block")[row].as_py(), SpanHash(data)(at, at + SAMPLE), None, at,
                                      buckets, 1, 0, True))
                if rows:
                    yield _batch(rows)

    return (blocks.select("block", "lens", "text").mapInArrow(run, _ELEMENT).groupBy("bucket", "part")
            .applyInArrow(lambda g: _ties(g, "<u4", True), _MARKS))


def _repeats(marked: DataFrame, buckets: int, passes: int, turn: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tied = _marks(batch, row)
                if not len(tied):
                    continue
                data = np.frombuffer(batch.column("text")[row].as_buffer(), np.uint8)
                at = candidate_places(np.array(batch.column("lens")[row].as_py(), np.int64), tied)
                rows = list(_elements(batch.column("block")[row].as_py(), SpanHash(data)(at, at + LENGTH),
                                      (SpanHash(data, other=True)(at, at + LENGTH) >> np.uint64(32)).astype(np.uint32), at, buckets, passes, turn, False))
                if rows:
                    yield _batch(rows)

    return (marked.select("block", "lens", "text", "marks").mapInArrow(run, _ELEMENT).groupBy("bucket", "part")
            .applyInArrow(lambda g: _ties(g, "<u8", False), _MARKS))


def _judge(marked: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, runs, and the digest of what stays."""
    names = ["doc_id", "mark", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column("text")[row].as_buffer(), np.uint8)
                lens = np.array(batch.column("lens")[row].as_py(), np.int64)
                gone = covered(lens, _marks(batch, row))
                out = []
                ends = np.cumsum(lens)
                for lo, hi in zip(ends - lens, ends, strict=True):
                    cut = gone[lo:hi]
                    runs = int(cut[:1].sum()) + int((cut[1:] & ~cut[:-1]).sum())
                    out.append((hi - lo, int(cut.sum()), runs, hashlib.sha256(data[lo:hi][~cut].tobytes()).hexdigest()))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(batch.column("doc_ids")[row].as_py(), pa.int64()),
                    pa.array(batch.column("marks_of")[row].as_py(), pa.int64()),
                    *[pa.array([int(x) for x in c], pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names)

    return marked.mapInArrow(run, "doc_id long, mark long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, mark (hash of the text), n_bytes, n_removed, n_spans, kept_sha256."""
    with Work(df.sparkSession, "suffix") as work:
        laid = Layout(work, df, id_col, text_col)
        blocks, total = laid.blocks, laid.total
        try:
            buckets = max(16, -(-int(total * len(COVER) / MODULUS * 8) // BUCKET_BYTES))
            tied = work.cut(_tied_samples(blocks, buckets), "tied")
            release(work)
            samples = tied.agg(F.sum(F.octet_length("offsets") / 4)).first()[0] or 0
            expected = samples * MODULUS / len(COVER) * 16
            passes = max(1, -(-int(expected) // max(1, int(total * PASS_SHARE))))
            buckets = max(16, -(-int(expected / passes) // BUCKET_BYTES))

            def marked(places: DataFrame, how: str) -> DataFrame:
                # a block's places: at most one entry per bucket, of the block's own bytes
                places = places.groupBy("block").agg(F.collect_list("offsets").alias("marks"))
                return blocks.join(places.hint("merge"), "block", how)

            repeats = None
            for turn in range(passes if samples else 0):
                got = work.cut(_repeats(marked(tied, "inner"), buckets, passes, turn), f"repeats-{turn}")
                release(work)
                repeats = got if repeats is None else repeats.unionAll(got)
            if repeats is None:
                repeats = df.sparkSession.createDataFrame([], _MARKS)
            return work.result(_judge(marked(repeats, "left")))
        finally:
            laid.close()
