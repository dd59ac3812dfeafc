"""Quality classifier by importance resampling (hashed n-gram ratio models, Gumbel top-k).

Two bags of hashed n-grams describe a text: byte n-grams that begin words
(4 to 8 bytes), and words with word pairs.  For each, a target model is counted on documents
labelled good (quality 1, toxic 0) and a raw model on all documents; an
n-gram's log ratio is ``log((target + 1) / (raw scaled to target + 1))``, so an
n-gram that is too rare to tell counts nothing.  Per document:

* prefix score: sum of what log ratios fall below -1, over the square
  root of the number of n-grams (clear evidence against the target, which a
  long text can't dilute);
* word score: mean log ratio.

Both are log ratios of the two models, summed and scaled by the text's length.
They are put on one scale by the good documents that were held out of the
counts: margin = (score - their ``TOLERATED`` quantile) / (their median - that
quantile).  The log importance weight is ``SHARPNESS`` times the smaller
margin, whatever its size.  The sample is the Gumbel top-k of log weight plus seeded
noise, without replacement; k is given, or the number of documents whose margin
is not negative.  Documents outside the sample are rejected.

Bounds: at most ``MAX_LABELS`` labelled documents fit the target (least
hashes of the id); raw counts and scores cover all documents and whole texts.
Broadcast: the two tables of log ratios and the label sample, all of fixed size.

Edge cases: an empty text (or null) has scores 0; without labelled good documents every
weight is 0 and everything stays; labels of null id are ignored, repeated
labels count as their worst; rows tied with the k-th all stay; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, Work, mix64, text_blocks, text_or_empty, word_spans

PREFIXES = (4, 5, 6, 7, 8)
PREFIX_BUCKETS = 1 << 20
WORD_BUCKETS = 1 << 16
MAX_LABELS = 200_000
TOLERATED = 0.001
SHARPNESS = 50.0
SEED = 23


def features(data: np.ndarray, offs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of the word beginnings and of the words and word pairs; A-Z count as a-z."""
    span = SpanHash(data, lower=True)
    start, end, row = word_spans(data, offs)
    heads, head_rows = [], []
    for n in PREFIXES:
        long = np.flatnonzero(end - start >= n)
        heads.append(span(start[long], start[long] + n, 10 + n))
        head_rows.append(row[long])
    head = np.concatenate(heads) & np.uint64(PREFIX_BUCKETS - 1)
    one = span(start, end, 2)
    same = row[:-1] == row[1:]
    two = mix64(one[:-1] * np.uint64(3) + one[1:], 3)[same]
    words = np.concatenate([one, two]) & np.uint64(WORD_BUCKETS - 1)
    return [(head.astype(np.int64), np.concatenate(head_rows)), (words.astype(np.int64), np.concatenate([row, row[:-1][same]]))]


class LabelSample:
    """A bounded sample of good labelled ids: kind 1 (three in four) fits the target, kind 2 is held out."""

    def __init__(self, labels: DataFrame, bound: int, id_col: str, quality_col: str, toxic_col: str):
        rows = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{quality_col}`").alias("q"),
                              F.col(f"`{toxic_col}`").alias("x")).filter("id is not null")
                .groupBy("id").agg(F.min("q").alias("q"), F.max("x").alias("x"))
                .filter("q = 1 and coalesce(x, 0) = 0")
                .select("id", F.xxhash64(F.lit(SEED), "id").alias("h")).orderBy("h", "id").limit(bound).toArrow()).sort_by("id")
        self.ids = rows["id"].to_numpy()
        self.kind = np.where(rows["h"].to_numpy() & 3, 1, 2).astype(np.int8)

    def of(self, ids: pa.Array) -> np.ndarray:
        """The kind of each id, 0 for ids outside the sample."""
        null = ids.is_null().to_numpy(zero_copy_only=False)
        value = ids.fill_null(0).to_numpy()
        if not len(self.ids):
            return np.zeros(len(value), np.int8)
        at = np.minimum(np.searchsorted(self.ids, value), len(self.ids) - 1)
        return np.where((self.ids[at] == value) & ~null, self.kind[at], 0).astype(np.int8)


def count_models(rows: DataFrame, sample: LabelSample) -> np.ndarray:
    """Raw and target counts, shape (2, PREFIX_BUCKETS + WORD_BUCKETS), over all ``rows`` (doc_id, text)."""
    total = PREFIX_BUCKETS + WORD_BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, total), np.int64)
        for batch in batches:
            fits = sample.of(batch.column("doc_id")) == 1
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                for shift, size, (bucket, row) in zip((0, PREFIX_BUCKETS), (PREFIX_BUCKETS, WORD_BUCKETS),
                                                      features(data, offs), strict=True):
                    counts[0, shift:shift + size] += np.bincount(bucket, minlength=size)
                    counts[1, shift:shift + size] += np.bincount(bucket[fits[lo:hi][row]], minlength=size)
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[0, at]), pa.array(counts[1, at])],
                                         ["bucket", "raw", "target"])

    # map-side sums, then at most one row per bucket, whose number is fixed
    got = (rows.mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket")
           .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    out = np.zeros((2, total), np.int64)
    out[:, got["bucket"].to_numpy()] = got["raw"].to_numpy(), got["target"].to_numpy()
    return out


def log_ratios(counts: np.ndarray) -> np.ndarray:
    out = []
    for part in (counts[:, :PREFIX_BUCKETS], counts[:, PREFIX_BUCKETS:]):
        raw, target = part.astype(float)
        if not target.sum():
            out.append(np.zeros(part.shape[1]))
            continue
        out.append(np.log((target + 1) / (raw * (target.sum() / raw.sum()) + 1)))
    return np.concatenate(out).astype(np.float32)


def score(rows: DataFrame, ratios: np.ndarray, sample: LabelSample) -> DataFrame:
    """(all columns but text, kind, prefixes, words): the two scores of each document."""
    kept = rows.drop("text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes, words = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                (p, p_row), (w, w_row) = features(data, offs)
                against = np.minimum(ratios[p] + 1, 0)
                n = np.maximum(np.bincount(p_row, minlength=hi - lo), 1)
                prefixes[lo:hi] = np.bincount(p_row, weights=against, minlength=hi - lo) / np.sqrt(n)
                n = np.maximum(np.bincount(w_row, minlength=hi - lo), 1)
                words[lo:hi] = np.bincount(w_row, weights=ratios[PREFIX_BUCKETS + w], minlength=hi - lo) / n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sample.of(batch.column("doc_id"))), pa.array(prefixes), pa.array(words)],
                [*batch.schema.names[:-1], "kind", "prefixes", "words"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return rows.mapInArrow(run, f"{schema}, kind byte, prefixes double, words double")


def kth_largest(df: DataFrame, name: str, k: int) -> int | None:
    """The k-th largest value of a long column by counting digits, 12 bits a round: at most 4,096 rows
    reach the driver in each of six rounds."""
    if k < 1:
        return None
    # from signed to unsigned order
    value = F.col(name).bitwiseXOR(F.lit(-1 << 63))
    found, used = 0, 0
    while used < 64:
        width = min(12, 64 - used)
        rows = df
        if used:
            rows = df.filter(F.shiftrightunsigned(value, 64 - used) == F.lit(found))
        digit = F.shiftrightunsigned(value, 64 - used - width).bitwiseAND(F.lit((1 << width) - 1))
        counts = {r["d"]: r["n"] for r in rows.groupBy(digit.alias("d")).agg(F.count("*").alias("n")).collect()}
        for d in sorted(counts, reverse=True):
            if counts[d] >= k:
                break
            k -= counts[d]
        else:
            return None                                       # fewer rows than k
        found, used = found << width | d, used + width
    return (found ^ 1 << 63) - (1 << 64 if found ^ 1 << 63 >= 1 << 63 else 0)


def gumbel(*cols, seed: int = SEED):
    """Seeded standard Gumbel noise, a function of the columns."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def resample(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             quality_col: str = "quality", toxic_col: str = "toxic", k: int | None = None,
             max_labels: int = MAX_LABELS, tolerated: float = TOLERATED, carry: tuple[str, ...] = (),
             seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, *carry, prefixes, words, log_weight, key, kept; ``seed`` of the noise."""
    with Work(df.sparkSession, "resample") as work:
        rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *carry, text_or_empty(text_col).alias("text"))
        sample = LabelSample(labels, max_labels, id_col, quality_col, toxic_col)
        ratios = log_ratios(count_models(rows, sample))
        scored = work.cut(score(rows, ratios, sample), "scored")
        # held-out good documents: at most max_labels rows
        low, mid = {}, {}
        marks = scored.filter("kind = 2").agg(*[F.percentile(c, F.array(F.lit(tolerated), F.lit(0.5))).alias(c)
                                                for c in ("prefixes", "words")]).first()
        margins = []
        for c in ("prefixes", "words"):
            if marks[c] is None:
                continue
            low[c], mid[c] = marks[c]
            margins.append((F.col(c) - low[c]) / max(mid[c] - low[c], 1e-9))
        margin = F.least(*margins) if len(margins) > 1 else margins[0] if margins else F.lit(0.0)
        weighed = scored.withColumn("log_weight", margin * SHARPNESS)
        weighed = weighed.withColumn("key", F.col("log_weight") + gumbel("doc_id", seed=seed))
        # order-preserving bits: the key in units of 2^-20
        weighed = work.cut(weighed.withColumn("rank_key", F.floor(F.col("key") * (1 << 20)).cast("long")), "weighed")
        if k is None:
            k = weighed.filter("log_weight >= 0").count()
        least = kth_largest(weighed, "rank_key", k)
        if least is None:
            kept = F.lit(k > 0)                               # as many wanted as there are, or none
        else:
            kept = F.col("rank_key") >= least
        return work.result(weighed.select("doc_id", *carry, "prefixes", "words", "log_weight", "key", kept.alias("kept")))
