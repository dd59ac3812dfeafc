"""Token-id output: frequency-ranked ids in byte-aligned variable-length
coding with separate control bytes.

Data set layout (``write_token_files``), both parts Parquet, so that Spark's
committer makes the write safe against lost executors on any shared storage:

* ``ranks``: (rank, id): ids by falling corpus frequency, then by id;
* ``blocks``: (shard, block, n_ids, payload); shards are ranges of the id
  column, blocks are consecutive inside a shard.  A payload is little-endian:
  ``RWT1``, uint32 n_docs, uint64 n_ids, n_docs x int64 document id,
  n_docs x uint8 "id is null", n_docs x uint64 length, ceil(n_ids / 4) control
  bytes, data bytes.  Two bits of a control byte (lowest first) hold the byte
  count, less one, of one rank; the data bytes hold the ranks.

Edge cases: a null or empty text is the end id alone; null ids come first and
stay null; rows of one id are ordered by a hash of their text (equal rows are
interchangeable); an empty table gives no blocks.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SpanHash, Work, text_blocks, text_or_empty, word_spans

#: Ids of a block (a longer document makes a block of its own).
BLOCK_IDS = 1 << 18
#: Distinct chunks a Python worker remembers, and parts of chunks (words, marks) that it keeps as strings.
CACHE_CHUNKS = 2_000_000
CACHE_PARTS = 50_000

MAGIC = b"RWT1"


# The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on, in order.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LATIN_END = "\u0250"


class ChunkEncoder:
    """Encodes texts with a byte-level BPE of the tokenizers library: chunk (a
    word with the white space before it) to its ids, kept for the worker's life
    while there is room, by the chunk's hash in sorted arrays (some 20 bytes a chunk).

    No alternative of the byte-level pre-tokenizer runs on from a non-space into a space, so chunks are tokenized
    independently; texts with white space beyond ASCII go to the library whole.  The chunks of a block of texts are
    found, told apart and looked up by numpy; only new ones become strings.  A new chunk of a space and
    Latin letters is one pre-token, so the library's model takes it as it is; marks
    after a letter are a pre-token of their own.  Other new chunks are encoded as one text; the bytes that each id
    stands for tell where a chunk's ids end."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        self.encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        # a byte-level token has a character for each byte
        vocabulary = tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.width[list(vocabulary.values())] = [len(t) for t in vocabulary]
        made = json.loads(Path(tokenizer_path).read_text())
        split = made.get("pre_tokenizer") or {}
        self.model = tokenizer.model
        #: Whether words are pre-tokens as described: the usual byte-level rule and nothing before it.
        self.plain = (split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
                      and not made.get("normalizer") and not any(t["content"].strip().isalpha() for t in made.get("added_tokens", [])))
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)                       # words come once
        dtype = "<u2" if len(self.width) <= 1 << 16 else "<u4"
        #: Hashes of the known chunks, sorted; where the ids of each begin in ``flat``, and how many they are.
        self.keys, self.at, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat = np.zeros(0, dtype)
        #: Words and marks that came as a part of a chunk.
        self.parts: dict[str, array] = {}

    def __len__(self) -> int:
        return len(self.keys)

    def _one(self, chunk: str) -> array:
        return array("I", self.encode([chunk], add_special_tokens=False)[0].ids)

    def _word(self, chunk: str) -> array:
        shown = "\u0120" + chunk[1:] if chunk.isascii() else chunk.encode().decode("latin-1").translate(_BYTE_LEVEL)
        return array("I", [t.id for t in self.model.tokenize(shown)])

    def _part(self, part: str) -> array:
        got = self.parts.get(part)
        if got is None:
            got = self._word(part) if part[0] == " " else self._one(part)
            if len(self.parts) < CACHE_PARTS:
                self.parts[part] = got
        return got

    def _together(self, chunks: list[str]) -> list[array]:
        """Ids of chunks that begin with white space and end without it."""
        ids = np.array(self.encode(["".join(chunks)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum([len(c.encode()) for c in chunks])
        reached = np.cumsum(self.width[ids])
        cut = np.searchsorted(reached, ends)
        if not np.array_equal(reached[np.minimum(cut, len(ids) - 1)], ends):
            return [self._one(c) for c in chunks]
        every, cut = array("I", ids.tobytes()), (cut + 1).tolist()
        return [every[lo:hi] for lo, hi in zip([0, *cut[:-1]], cut, strict=True)]

    def _learn(self, chunks: list[str]) -> list[array]:
        """Ids of each of ``chunks``, none of which is known."""
        out: list = [None] * len(chunks)
        joined = []
        for k, c in enumerate(chunks):
            if c[0] == " " and self.plain:
                base = c if c[-1].isalpha() else c.rstrip(_MARKS)
                word = base[1:]
                if word.isalpha() and (word.isascii() or max(word) < _LATIN_END):
                    out[k] = self._word(c) if len(base) == len(c) else self._part(base) + self._part(c[len(base):])
                    continue
            if c[0].isspace() and not c[-1].isspace():
                joined.append(k)
            else:
                out[k] = self._one(c)
        if joined:
            for k, ids in zip(joined, self._together([chunks[k] for k in joined]), strict=True):
                out[k] = ids
        return out

    def _look_up(self, raw: bytes, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of each distinct chunk (its hash, ascending, and place) begin and how many they are."""
        place = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        inside = np.flatnonzero(place < len(self.keys))
        known[inside] = self.keys[place[inside]] == hashes[inside]
        at, sizes = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int32)
        at[known], sizes[known] = self.at[place[known]], self.sizes[place[known]]
        new = np.flatnonzero(~known)
        if not len(new):
            return self.flat, at, sizes
        got = self._learn([raw[a:b].decode() for a, b in zip(begin[new].tolist(), end[new].tolist(), strict=True)])
        sizes[new] = [len(x) for x in got]
        fresh = np.frombuffer(b"".join(got), np.uint32).astype(self.flat.dtype)
        at[new] = len(self.flat) + np.cumsum(sizes[new], dtype=np.int64) - sizes[new]
        flat = np.concatenate([self.flat, fresh])
        if len(self.keys) + len(new) <= CACHE_CHUNKS:
            self.keys, self.at, self.sizes = (np.insert(x, place[new], y[new]) for x, y in
                                              ((self.keys, hashes), (self.at, at), (self.sizes, sizes)))
            self.flat = flat
        return flat, at, sizes

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a block, whose bytes and offsets are given."""
        begin, end, row = chunk_spans(data, offs)
        hashes, index, which = np.unique(SpanHash(data)(begin, end), return_index=True, return_inverse=True)
        raw = data.tobytes()
        flat, at, sizes = self._look_up(raw, hashes, begin[index], end[index])
        each = sizes[which]
        ends = np.cumsum(each, dtype=np.int64)
        every = flat[np.repeat(at[which] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[np.searchsorted(row, np.arange(len(offs)))]
        out = [every[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for k in odd_rows(data, offs):
            out[k] = np.frombuffer(self._one(raw[offs[k]:offs[k + 1]].decode()), np.uint32)
        return out


def chunk_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each chunk of a block: a word with the (ASCII) white space before it, or what white space ends a row."""
    start, end, row = word_spans(data, offs)
    begin = np.concatenate([[0], end[:-1]]) if len(end) else end
    head = np.ones(len(row), bool)
    head[1:] = row[1:] != row[:-1]
    begin[head] = offs[row[head]]
    rest = offs[:-1].copy()
    rest[row] = end                                               # the last word's end stays
    tail = np.flatnonzero(rest < offs[1:])
    order = np.argsort(np.concatenate([begin, rest[tail]]), kind="stable")
    return (np.concatenate([begin, rest[tail]])[order], np.concatenate([end, offs[1:][tail]])[order],
            np.concatenate([row, tail])[order])


def odd_rows(data: np.ndarray, offs: np.ndarray) -> list[int]:
    """Rows with white space beyond ASCII."""
    at = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    one, two = (np.concatenate([data, np.zeros(2, np.uint8)])[at + k] for k in (1, 2))
    lead = data[at]
    odd = (((lead == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((lead == 0xE1) & (one == 0x9A) & (two == 0x80))
           | ((lead == 0xE2) & (one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF)))
           | ((lead == 0xE2) & (one == 0x81) & (two == 0x9F)) | ((lead == 0xE3) & (one == 0x80) & (two == 0x80)))
    return np.unique(np.searchsorted(offs, at[odd], "right") - 1).tolist()


_encoders: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def encode_documents(df: DataFrame, tokenizer_path: str, end_id: int, vocab: int, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, tie, ids, count_ids, counts): plain ids of each document with the end id (``tie``: a hash of the text);
    and a row for each task, without ``ids``, that says how often which id came."""
    width = "<u2" if vocab <= 1 << 16 else "<u4"
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("ids", pa.binary()), ("count_ids", pa.list_(pa.int32())),
                        ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(tokenizer_path), np.array([end_id], width).tobytes()
        total = np.zeros(vocab, np.int64)
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                ids = [x.astype(width).tobytes() + end for x in encode(data, offs)]
                got = np.bincount(np.frombuffer(b"".join(ids), width))
                total = np.pad(total, (0, max(0, len(got) - len(total))))
                total[:len(got)] += got
                none = pa.nulls(hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("tie").slice(lo, hi - lo),
                                                  pa.array(ids, pa.binary()), none.cast(schema.field(3).type),
                                                  none.cast(schema.field(4).type)], schema=schema)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((None, None, None, at, total[at]), schema, strict=True)],
                                             schema=schema)

    return rows.mapInArrow(run, "doc_id long, tie long, ids binary, count_ids array<int>, counts array<long>")


def id_counts(plain: DataFrame) -> DataFrame:
    """(id, n) over all ids, from the tasks' counts."""
    both = plain.filter("ids IS NULL").select(F.explode(F.arrays_zip("count_ids", "counts")).alias("c"))
    return both.groupBy(F.col("c.count_ids").alias("id")).agg(F.sum("c.counts").alias("n"))


# ---------------------------------------------------------------- coding

def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    r = ranks.astype("<u4")
    extra = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    padded = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    padded[:len(r)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control.tobytes(), r.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]].tobytes()


# byte counts of the four ranks of each control byte
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def unpack_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ranks again: a table lookup gives the byte counts, sums of these the places."""
    lengths = _LENGTHS[control].ravel()[:n]
    at = np.cumsum(lengths) - lengths
    data = np.concatenate([data, np.zeros(4, np.uint8)])
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        wide = np.flatnonzero(lengths > k)
        out[wide] |= data[at[wide] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def pack_block(doc_ids: list, lens: list[int], ranks: np.ndarray) -> bytes:
    null = np.array([d is None for d in doc_ids], np.uint8)
    control, data = pack_ranks(ranks)
    return b"".join([MAGIC, np.uint32(len(doc_ids)).tobytes(), np.uint64(len(ranks)).tobytes(),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(),
                     np.array(lens, "<u8").tobytes(), control, data])


def unpack_block(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, lengths and ranks of a payload."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token block")
    docs, n = int(np.frombuffer(raw, "<u4", 1, 4)[0]), int(np.frombuffer(raw, "<u8", 1, 8)[0])
    ids = np.frombuffer(raw, "<i8", docs, 16)
    null = np.frombuffer(raw, np.uint8, docs, 16 + 8 * docs)
    lens = np.frombuffer(raw, "<u8", docs, 16 + 9 * docs).astype(np.int64)
    at, quads = 16 + 17 * docs, -(-n // 4)
    ranks = unpack_ranks(np.frombuffer(raw, np.uint8, quads, at), np.frombuffer(raw, np.uint8, offset=at + quads), n)
    return [None if z else int(i) for i, z in zip(ids, null, strict=True)], lens, ranks


# ---------------------------------------------------------------- operator

def write_token_files(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, vocab: int = 50_257,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize every whole text once, rank ids by corpus frequency, write the data set under ``path``.

    ``vocab``: the tokenizer's number of ids, which bounds the rank table (the only thing that passes
    the driver).
    """
    spark = df.sparkSession
    with Work(spark, "tokens") as work:
        plain = encode_documents(df, tokenizer_path, end_id, vocab, id_col, text_col)
        plain.write.option("compression", "zstd").parquet(work.path("plain"))
        plain = spark.read.schema(plain.schema).parquet(work.path("plain"))
        counted = id_counts(plain).collect()                   # at most one row per id of the vocabulary
        order = [r["id"] for r in sorted(counted, key=lambda r: (-r["n"], r["id"]))]
        spark.createDataFrame(list(enumerate(order)), "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
        rank = np.zeros(max([vocab, *(i + 1 for i in order)]), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        width = "<u2" if vocab <= 1 << 16 else "<u4"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, block, size = TaskContext.get().partitionId(), 0, 0
            held: list[tuple] = []

            def flush() -> pa.RecordBatch:
                lens = [len(x) for _, x in held]
                ids = np.concatenate([x for _, x in held])
                return pa.RecordBatch.from_arrays([
                    pa.array([shard], pa.int64()), pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()),
                    pa.array([pack_block([d for d, _ in held], lens, rank[ids])], pa.binary())],
                    ["shard", "block", "n_ids", "payload"])

            for batch in batches:
                for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                    ids = np.frombuffer(raw.as_py(), width)       # a copy, as the batch goes
                    if held and size + len(ids) > BLOCK_IDS:
                        yield flush()
                        block, held[:], size = block + 1, [], 0
                    held.append((doc, ids))
                    size += len(ids)
            if held:
                yield flush()

        order_by = (F.col("doc_id").asc_nulls_first(), F.col("tie"))
        (plain.filter("ids IS NOT NULL").repartitionByRange(*order_by).sortWithinPartitions(*order_by).select("doc_id", "ids")
         .mapInArrow(run, "shard long, block long, n_ids long, payload binary")
         .write.option("compression", "zstd").parquet(f"{path}/blocks"))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of each document of a data set, from its files.

    ``start`` is a prefix sum in two levels, over shards (one row each) and over the blocks of a shard.
    """
    # at most one row per id of the vocabulary
    order = np.array([r["id"] for r in spark.read.schema("rank long, id long").parquet(f"{path}/ranks")
                      .orderBy("rank").collect()], np.uint32)
    blocks = spark.read.schema("shard long, block long, n_ids long, payload binary").parquet(f"{path}/blocks")
    schema = "shard long, block long, doc_id long, inside long, n_tokens long, ids_crc32 long"
    fields = ["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs, lens, ranks = unpack_block(batch.column("payload")[row].as_py())
                ids = order[ranks].astype("<u4")
                ends = np.cumsum(lens)
                parts = [ids[e - n:e] for e, n in zip(ends, lens, strict=True)]
                made = [pa.array([batch.column(c)[row].as_py()] * len(docs), pa.int64()) for c in ("shard", "block")]
                made += [pa.array(x, pa.int64()) for x in (docs, ends - lens, lens)]
                made.append(pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64()))
                if with_ids:
                    made.append(pa.array([x.astype(np.int64) for x in parts], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(made, fields + ["ids"] * with_ids)

    docs = blocks.select("shard", "block", "payload").mapInArrow(run, schema + ", ids array<long>" * with_ids)
    shards = (blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before")))
    inner = Window.partitionBy("shard").orderBy("block")
    starts = (blocks.select("shard", "block", (F.sum("n_ids").over(inner) - F.col("n_ids")).alias("earlier"))
              .join(shards, "shard").select("shard", "block", (F.col("before") + F.col("earlier")).alias("base")))
    return (docs.join(starts, ["shard", "block"])
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32",
                    *(["ids"] if with_ids else [])))
