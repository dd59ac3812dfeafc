"""Benchmark decontamination by latent semantic retrieval.

The term space is the vocabulary of the benchmark (hashed words; passages can
only be alike in words that they share).  Terms weigh by inverse frequency over
all documents, every other word weighs as the median term.  A randomised SVD
of the TF-IDF passages of all documents, stacked with the benchmark's items at
``ITEM_SHARE`` times their energy, gives the latent space: each task adds up
its part of ``A^T (A R)`` for a random R, the driver orthogonalises the sum
(terms x ``RANK``), a second round repeats it from that basis.  Every passage of every document, windows of 32 and 64 words every 16 words, is projected and compared
with every item by cosine (and must hold part of the item's latent length, so
that few common words are no candidate).  An item longer than the longest window is compared
by passages of that length, any of which makes it a candidate.  Candidates are verified on their words by longest
common subsequence of the whole item and as many words of the document, with slack, around the place.  An item counts as leaked where ``LCS_SURE`` of its words
are found in order, or ``LCS_MAYBE`` of them together with its answer (its
last sentence, ``ANSWER`` of the words in order), which catches paraphrases.

Items are taken in blocks of at most ``BLOCK_ITEMS``; each block is a query set
against all rows, and what is broadcast for it (terms x rank) is bounded by it.

Edge cases: null or empty texts hold no passage; an item without words is
never found; equal items are found each; rows equal in id and text are
reported once; an empty table or benchmark gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, Work, text_blocks, text_or_empty, word_spans

RANK = 96
#: Energy of the items in the decomposed matrix, in times the documents'.
ITEM_SHARE = 16.0
SEGMENT = 16
WINDOWS = (2, 4)
#: A candidate's least cosine, and least part of the item's latent length that the window holds.
COSINE = 0.13
HELD = 0.5
LCS_SURE = 0.7
LCS_MAYBE = 0.6
ANSWER = 0.8
#: Words an answer needs to tell anything.
ANSWER_WORDS = 4
BLOCK_ITEMS = 2048
#: Terms whose words are counted in a matrix, groups of words that it holds at a time.
FREQUENT = 256
GROUPS = 2048
#: Marks of the terms of a block's rows, and pairs of row and item looked up there at a time.
MARKS = 1 << 22
PAIRS = 4096
#: Hash slots of the term space.
SLOTS = 1 << 20
SEED = 31
#: Words of a passage of a long item, and vectors compared at a time.
PASSAGE = max(WINDOWS) * SEGMENT
BLOCK_VECTORS = 2048
#: Part of a long item's words by which its place in a document may be longer, on either side.
SLACK = 4

_SENTENCE = re.compile(r"[.!?]\s+")


def hashed_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word, A-Z as a-z, without a stop or comma at its end."""
    start, end, row = word_spans(data, offs)
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    marked = ((last == 46) | (last == 44)) & (end - start > 1)
    return SpanHash(data, lower=True)(start, end - marked, 4), row


def _words_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return hashed_words(data, np.array([0, len(data)], np.int64))[0]


class Items:
    """A block of benchmark items: their words, answers, and the term space they span."""

    def __init__(self, rows: list):
        self.ids = [r["item_id"] for r in rows]
        self.words = [_words_of(r["text"]) for r in rows]
        self.answers = [_words_of(([s for s in _SENTENCE.split(r["text"].strip()) if s] or [""])[-1]) for r in rows]
        slots = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.words]) & np.uint64(SLOTS - 1)).astype(np.int64)
        self.n_terms = len(slots)
        self.table = np.full(SLOTS, self.n_terms, np.int32)
        self.table[slots] = np.arange(self.n_terms, dtype=np.int32)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.all_terms = self.terms(np.concatenate([np.zeros(0, np.uint64), *self.words]))

    def terms(self, hashes: np.ndarray) -> np.ndarray:
        """Term of each word; ``n_terms`` for words outside the space."""
        return self.table[(hashes & np.uint64(SLOTS - 1)).astype(np.int64)]


class Segments:
    """The words of a block of documents cut into runs of ``SEGMENT`` words, each within its document."""

    def __init__(self, hashes: np.ndarray, row: np.ndarray):
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(first, len(row)))
        number = np.arange(len(row)) - np.repeat(first, sizes)
        self.start = np.flatnonzero(number % SEGMENT == 0)
        self.row = row[self.start]
        per_row = -(-sizes // SEGMENT)
        self.row_end = np.repeat(np.cumsum(per_row), per_row)            # segment after the row's last
        self.word_end = np.append(self.start[1:], len(row))
        self.number = np.repeat(np.arange(len(self.start)), self.word_end - self.start)   # segment of each word
        self.hashes = hashes

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.start, axis=0) if len(self.start) else values[:0]

    def window_sums(self, values: np.ndarray) -> dict[int, np.ndarray]:
        """Sums of two and of four segments from each on, up to its row's end."""
        two, at = values.copy(), np.arange(len(values))
        ok = np.flatnonzero(at + 1 < self.row_end)
        two[ok] += values[ok + 1]
        four = two.copy()
        ok = np.flatnonzero(at + 2 < self.row_end)
        four[ok] += two[ok + 2]
        return {2: two, 4: four}


class TermVectors:
    """A vector of each term.  The words of the terms that weigh least, the most frequent ones, are counted by group and
    multiplied; those of the others are looked up one by one.  Words outside the space add nothing."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray):
        self.vectors = vectors
        self.often = np.argsort(weights[:len(vectors)], kind="stable")[:FREQUENT]
        self.matrix = vectors[self.often]
        self.column = np.full(len(vectors) + 1, len(self.often))
        self.column[self.often] = np.arange(len(self.often))

    def _counts(self, group: np.ndarray, column: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first group, end group, words of each frequent term in each of them); ``group`` ascends."""
        width = len(self.often) + 1
        cuts = np.searchsorted(group, np.arange(0, n + GROUPS, GROUPS))
        for a, lo, hi in zip(range(0, n, GROUPS), cuts[:-1], cuts[1:], strict=True):
            m = min(GROUPS, n - a)
            counts = np.bincount((group[lo:hi] - a) * width + column[lo:hi], minlength=m * width)
            yield a, a + m, counts.reshape(m, width)[:, :-1].astype(np.float32)

    def sums(self, group: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Per group of words, of n, the sum of its terms' vectors."""
        column = self.column[term]
        out = np.empty((n, self.vectors.shape[1]), np.float32)
        for a, b, counts in self._counts(group, column, n):
            np.matmul(counts, self.matrix, out=out[a:b])
        rare = self._rare(column, term)
        sizes = np.bincount(group[rare], minlength=n)
        cuts, rare = np.cumsum(sizes) - sizes, term[rare]
        # groups with most terms first: the k-th terms of those that have one are a leading part
        order = np.argsort(-sizes, kind="stable")
        cuts, sizes = cuts[order], sizes[order]
        for k in range(int(sizes[0]) if n else 0):
            m = int(np.searchsorted(-sizes, -k, "left"))
            out[order[:m]] += self.vectors[rare[cuts[:m] + k]]
        return out

    def add_groups(self, group: np.ndarray, term: np.ndarray, values: np.ndarray, total: np.ndarray) -> None:
        """Add to each term's row of ``total`` the ``values`` of the groups of its words."""
        column = self.column[term]
        for a, b, counts in self._counts(group, column, len(values)):
            total[self.often] += counts.T.astype(float) @ values[a:b].astype(float)
        rare = self._rare(column, term)
        group, term = group[rare], term[rare]
        # a dimension at a time: its values of the groups and its sums stay in the processor's cache
        for j, x in enumerate(np.ascontiguousarray(values.T, dtype=float)):
            total[:, j] += np.bincount(term, x[group], len(total))

    def _rare(self, column: np.ndarray, term: np.ndarray) -> np.ndarray:
        return np.flatnonzero((column == len(self.often)) & (term < len(self.vectors)))


class Presence:
    """Which terms each row of a block holds, and perhaps some more (rows and terms share ``MARKS`` marks)."""

    def __init__(self, items: Items, row: np.ndarray, term: np.ndarray):
        self.items = items
        known = term < items.n_terms
        self.marks = np.zeros(MARKS, bool)
        self.marks[self._mark(row[known], term[known])] = True

    def _mark(self, row: np.ndarray, term: np.ndarray) -> np.ndarray:
        return (row * self.items.n_terms + term) & (MARKS - 1)

    def held(self, row: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether each row may hold ``LCS_MAYBE`` of its item's words; false only where it does not."""
        out = np.zeros(len(row), bool)
        for lo in range(0, len(row), PAIRS):
            r, j = row[lo:lo + PAIRS], item[lo:lo + PAIRS]
            sizes = self.items.sizes[j]
            ends = np.cumsum(sizes)
            place = np.arange(ends[-1]) + np.repeat(self.items.first[j] - (ends - sizes), sizes)
            marked = self.marks[self._mark(np.repeat(r, sizes), self.items.all_terms[place])]
            counts = np.diff(np.concatenate([[0], np.cumsum(marked)])[np.concatenate([[0], ends])])
            out[lo:lo + PAIRS] = counts >= LCS_MAYBE * sizes
        return out


def _sum_rows(df: DataFrame, run, width: int, n: int) -> np.ndarray:
    """Sum over tasks of an (n, width) float matrix, sent as its non-zero rows."""
    got = (df.mapInArrow(run, "term int, part array<double>")
           .select("term", F.posexplode("part").alias("k", "x")).groupBy("term", "k").agg(F.sum("x").alias("x")).toArrow())
    out = np.zeros((n, width))
    out[got["term"].to_numpy(), got["k"].to_numpy()] = got["x"].to_numpy()
    return out


def _rows(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total.any(axis=1))
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(list(total[at]), pa.list_(pa.float64()))],
                                      ["term", "part"])


def term_weights(rows: DataFrame, items: Items) -> tuple[np.ndarray, float]:
    """Inverse frequency of the terms over all documents, at n_terms what any other word weighs; and the energy of the
    documents, the squared weights of all their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((items.n_terms + 2, 1))
        for batch in batches:
            for _, _, data, offs in text_blocks(batch.column("text")):
                hashes, _ = hashed_words(data, offs)
                total[:-1, 0] += np.bincount(items.terms(hashes), minlength=items.n_terms + 1)
                total[-1, 0] += len(hashes)
        yield _rows(total)

    got = _sum_rows(rows, run, 1, items.n_terms + 2)[:, 0]
    passages = got[-1] / SEGMENT + 1
    weights = np.maximum(np.log((passages + 1) / (got[:items.n_terms] + 1)), 0.05)
    return (np.append(weights, np.median(weights) if len(weights) else 1.0).astype(np.float32),
            float((got[:items.n_terms] * weights ** 2).sum()))


def sketch(rows: DataFrame, items: Items, weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``A^T (A basis)`` over the 64-word passages of ``rows``."""
    vectors, n = TermVectors((basis * weights[:-1, None]).astype(np.float32), weights), items.n_terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, basis.shape[1]))
        for batch in batches:
            for _, _, data, offs in text_blocks(batch.column("text")):
                hashes, row = hashed_words(data, offs)
                if not len(hashes):
                    continue
                # passages of 64 words, each within its row
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                number = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
                passage = np.cumsum(number % PASSAGE == 0) - 1
                term = items.terms(hashes)
                low = vectors.sums(passage, term, int(passage[-1]) + 1)
                vectors.add_groups(passage, term, low, total)
        yield _rows(total * weights[:-1, None])

    return _sum_rows(rows, run, basis.shape[1], n)


def latent_space(rows: DataFrame, items: Items, weights: np.ndarray, energy: float, rank: int = RANK) -> np.ndarray:
    """Right singular basis (terms x rank) of the documents' and the items' TF-IDF passages."""
    n = items.n_terms
    width = min(rank, n)
    own = np.zeros((len(items.words), n), np.float32)
    for k, w in enumerate(items.words):
        np.add.at(own[k], items.terms(w), weights[items.terms(w)])
    share = ITEM_SHARE * energy / max(float((own ** 2).sum()), 1e-9)
    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((n, width)))[0]
    for _ in range(2):
        basis = np.linalg.qr(sketch(rows, items, weights, basis) + share * (own.T @ (own @ basis)))[0]
    return basis


def longest_common(words: list[int], other: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over ``words``."""
    places: dict[int, int] = {}
    for k, w in enumerate(words):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << len(words)) - 1
    state = full
    for w in other:
        hit = state & places.get(w, 0)
        if hit:
            state = (state + hit | state - hit) & full
    return len(words) - state.bit_count()


def passages(n: int) -> list[tuple[int, int]]:
    """[start, end) of the passages of an item of n words: the whole of it, or each of ``PASSAGE`` words, the last at its end."""
    if n <= PASSAGE:
        return [(0, n)]
    return [(a, a + PASSAGE) for a in range(0, n - PASSAGE, PASSAGE)] + [(n - PASSAGE, n)]


def _leaks(rows: DataFrame, items: Items, weights: np.ndarray, basis: np.ndarray) -> DataFrame:
    scaled = np.vstack([basis * weights[:-1, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)
    cut = [(j, a, b) for j, w in enumerate(items.words) for a, b in passages(len(w))]
    own = np.stack([scaled[items.terms(items.words[j][a:b])].sum(0) if b > a else np.zeros(basis.shape[1], np.float32)
                    for j, a, b in cut])
    vectors, item_of = TermVectors(scaled[:-1], weights), np.array([j for j, _, _ in cut])
    length = np.maximum(np.linalg.norm(own, axis=1), 1e-9).astype(np.float32)
    own = (own / length[:, None]).T.astype(np.float32)
    words, answers = [w.tolist() for w in items.words], [w.tolist() for w in items.answers]
    squares = (weights ** 2).astype(np.float32)

    def holds(region: list[int], item: int) -> bool:
        """Whether enough of the item's words occur at all: no stretch of the region has more in order."""
        return sum(map(set(region).__contains__, words[item])) >= LCS_MAYBE * len(words[item])

    def verify(region: list[int], item: int) -> tuple[float, bool] | None:
        known = words[item]
        if not holds(region, item):
            return None
        ratio = longest_common(known, region) / len(known)
        if ratio < LCS_MAYBE:
            return None
        answer = answers[item]
        hit = len(answer) >= ANSWER_WORDS and longest_common(answer, region) >= ANSWER * len(answer)
        return (ratio, hit) if ratio >= LCS_SURE or hit else None

    def spread(item: int, a: int, b: int, start: int, end: int, first: int, last: int) -> tuple[int, int]:
        """Words of a row, [first, last), that hold the whole of a long item whose passage [a, b) is about at [start, end);
        places are rounded outwards, so that the item's passages mean the same words."""
        slack = max(SEGMENT, len(words[item]) // SLACK)
        lo, hi = start - a - slack - first, end + len(words[item]) - b + slack - first
        return max(first, first + lo // slack * slack), min(last, first - (-hi // slack * slack))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for lo, _, data, offs in text_blocks(batch.column("text")):
                hashes, row = hashed_words(data, offs)
                if not len(hashes):
                    continue
                seg = Segments(hashes, row)
                term = items.terms(hashes)
                low = seg.window_sums(vectors.sums(seg.number, term, len(seg.start)))
                size = np.concatenate([[0.0], np.cumsum(seg.sums(squares[term]), dtype=float)])
                at = np.arange(len(seg.start))
                row_start = np.searchsorted(row, np.arange(len(offs)))
                present = Presence(items, row, term)
                found: dict[tuple[int, int], list[tuple[float, int, int, int]]] = {}
                for k in WINDOWS:
                    end = np.minimum(at + k, seg.row_end)
                    for a in range(0, len(at), 1 << 13):
                        s, e = at[a:a + (1 << 13)], end[a:a + (1 << 13)]
                        energy = np.sqrt(np.maximum(size[e] - size[s], 1e-9)).astype(np.float32)[:, None]
                        for v in range(0, len(cut), BLOCK_VECTORS):
                            cosine = low[k][a:a + (1 << 13)] @ own[:, v:v + BLOCK_VECTORS]
                            held = cosine >= HELD * length[v:v + BLOCK_VECTORS]
                            cosine /= energy
                            held &= cosine >= COSINE
                            spot, vector = np.divmod(np.flatnonzero(held), held.shape[1])
                            # rows without enough of an item's words at all have no stretch with them in order
                            pair, of = np.unique(seg.row[s[spot]] * len(items.words) + item_of[v + vector], return_inverse=True)
                            some = present.held(*np.divmod(pair, len(items.words)))[of]
                            spot, vector = spot[some], vector[some]
                            for r, item, *place in zip(*(x.tolist() for x in (
                                    seg.row[s[spot]], item_of[v + vector], cosine[spot, vector], s[spot], e[spot], v + vector)), strict=True):
                                found.setdefault((r, item), []).append(tuple(place))
                for (r, item), spots in found.items():
                    tried: set[tuple[int, int]] = set()
                    for cosine, s, e, v in sorted(spots, reverse=True):
                        first = s - 1 if s and seg.row[s - 1] == r else s
                        last = e if e < len(at) and seg.row[e] == r else e - 1
                        region = int(seg.start[first]), int(seg.word_end[last])
                        if len(words[item]) > PASSAGE:
                            region = spread(*cut[v], int(seg.start[s]), int(seg.word_end[e - 1]), int(row_start[r]), int(row_start[r + 1]))
                        if region in tried:
                            continue
                        tried.add(region)
                        got = verify(hashes[region[0]:region[1]].tolist(), item)
                        if got:
                            out.append((batch.column("doc_id")[lo + r].as_py(), batch.column("mark")[lo + r].as_py(),
                                        items.ids[item], cosine, *got))
                            break
            if out:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 ["doc_id", "mark", "item_id", "cosine", "lcs_ratio", "answer_found"])

    return rows.mapInArrow(run, "doc_id long, mark long, item_id long, cosine double, lcs_ratio double, answer_found boolean")


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", rank: int = RANK,
               block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document (id and text) and leaked item: doc_id, mark (hash of the text), item_id, cosine,
    lcs_ratio, answer_found."""
    with Work(df.sparkSession, "leaks") as work:
        rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
        rows = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text")
        queries = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"),
                                   text_or_empty(item_text_col).alias("text")).filter(F.trim("text") != "")
        blocks = -(-queries.count() // block_items)
        out = None
        for k in range(blocks):
            items = Items(queries.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect())
            if not items.n_terms:
                continue
            weights, energy = term_weights(rows, items)
            basis = latent_space(rows, items, weights, energy, rank)
            got = work.cut(_leaks(rows, items, weights, basis), f"leaks-{k}")
            out = got if out is None else out.unionAll(got)
        if out is None:
            out = df.sparkSession.createDataFrame(
                [], "doc_id long, mark long, item_id long, cosine double, lcs_ratio double, answer_found boolean")
        return work.result(out.groupBy("doc_id", "mark", "item_id").agg(
            F.max("cosine").alias("cosine"), F.max("lcs_ratio").alias("lcs_ratio"), F.max("answer_found").alias("answer_found")))
