"""Information-theoretic sanitisation of personal data.

Base entities are found by pattern: e-mail addresses, IP addresses, card
numbers (Luhn), phone numbers.  Corpus co-occurrence then tells which terms
give an entity away: for a term t seen in the ``WINDOW`` words on either side
of an entity e, with N documents, n(t) holding t, n(e) holding e and n(t, e)
holding t beside e,

    disclosure(t, e) = log2(n(t, e) N / (n(t) n(e))) / log2(N / n(e)),

the part of e's information that t reveals (1: t never occurs without e).
Terms of at least ``SUPPORT`` different contexts with an entity are removed at
``REMOVE`` or more and generalised at ``GENERALISE`` or more, wherever they
occur.  Copies of a passage are one context, so a copied document alone makes
no term reveal anything.

Three passes read the texts, however many candidates there are: one finds the
entities and their terms, one counts the documents of candidate terms, one
finds the occurrences of revealing ones.  The last two ask a Bloom filter of
the terms (broadcast, ``FILTER_BITS`` at most); what passes is joined with the
terms themselves, so a full filter costs shuffle and changes nothing.

Edge cases: a null text is empty; terms are compared in lower case (A-Z),
without ASCII punctuation; a term span that overlaps a base span is left to
the base span; rows equal in id and text get the same spans; an empty table
gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, SpanHash, Work, mix64, text_blocks, text_or_empty, word_spans

#: Kinds in the order of their listing; the last two are added by the method.
KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
BASE = KINDS[:4]

WINDOW = 8
SUPPORT = 3
REMOVE = 0.95
GENERALISE = 0.8
#: Bits of a term filter for each term, and at most.
BITS_PER_TERM = 10
FILTER_BITS = 1 << 26
HASHES = 4

# fixed values: the patterns of the base entities.  Possessive quantifiers and the look-behind change no match
# (what follows a run is never in the run's class); they keep long runs linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base entities in code points, in order; kind indexes ``KINDS``."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


# ---------------------------------------------------------------- terms

_MARKS = b"!\"#$%&'()*+,./:;<=>?@[\\]^_`{|}~"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _MARKS, bytes(range(97, 123)) + b" " * len(_MARKS))
_TERM = re.compile(rb"[^\x20\x09-\x0D]+")


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, bytes, bool]]:
    """Distinct (entity, context, term) of a text: the ``WINDOW`` words on either side of each base span, whole however long
    they are; and whether it is the first of its entity and term here."""
    if not spans:
        return []
    folded = text.encode().translate(_FOLD)
    words = [m.span() for m in _TERM.finditer(folded)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    # places in bytes of the spans' ends
    places, at, points = {}, 0, 0
    for k in sorted({k for start, _, end in spans for k in (start, end)}):
        at += len(text[points:k].encode())
        points, places[k] = k, at
    out: dict[tuple[int, int, bytes], bool] = {}
    known: set[tuple[int, bytes]] = set()
    for start, kind, end in spans:
        a, b = places[start], places[end]
        # a word that the span cuts counts with what is outside
        k, j = bisect.bisect_left(starts, a), bisect.bisect_right(ends, b)
        before = [folded[s:min(e, a)] for s, e in words[max(0, k - WINDOW):k]]
        after = [folded[max(s, b):e] for s, e in words[j:j + WINDOW]]
        entity = xxhash.xxh64_intdigest(f"{KINDS[kind]}:{text[start:end].lower()}") >> 1
        context = xxhash.xxh64_intdigest(b" ".join([*before, b"|", *after])) >> 1
        for t in (*before, *after):
            if (entity, context, t) not in out:
                out[entity, context, t] = (entity, t) not in known
                known.add((entity, t))
    return [(*key, first) for key, first in out.items()]


def _scan(rows: DataFrame) -> DataFrame:
    """(doc_id, mark, spans, beside) per document: base spans, and (entity, context, term, first) around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
        near = pa.struct([("entity", pa.int64()), ("context", pa.int64()), ("term", pa.binary()), ("first", pa.bool_())])
        for batch in batches:
            found, beside = [], []
            for text in batch.column("text"):
                text = text.as_py()
                spans = base_spans(text)
                found.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                beside.append([{"entity": e, "context": c, "term": t, "first": f} for e, c, t, f in contexts(text, spans)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(found, pa.list_(span)),
                 pa.array(beside, pa.list_(near))], ["doc_id", "mark", "spans", "beside"])

    return rows.mapInArrow(run, "doc_id long, mark long, spans array<struct<start:long,kind:int,end:long>>, "
                                "beside array<struct<entity:long,context:long,term:binary,first:boolean>>")


def _bits(keys: np.ndarray, size: int) -> np.ndarray:
    """The ``HASHES`` bits of each hash in a filter of ``size`` bits (a power of two): rows of positions."""
    step = mix64(keys, 5) | U64(1)
    return ((keys[:, None] + np.arange(HASHES, dtype=U64)[None, :] * step[:, None]) & U64(size - 1)).astype(np.int64)


def term_filter(terms_df: DataFrame, most: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter of the column ``term`` as 64-bit words, whose number ``most`` bounds."""
    wanted = BITS_PER_TERM * terms_df.count()
    size = max(64, min(most, 1 << max(wanted - 1, 0).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in text_blocks(batch.column("term")):
                at = np.unique(_bits(SpanHash(data)(offs[:-1], offs[1:]), size))
                yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.left_shift(U64(1), (at & 63).astype(U64)).view(np.int64))],
                                                 ["word", "bits"])

    got = (terms_df.select("term").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
           .toArrow())                                            # at most size / 64 rows
    out = np.zeros(size // 64, U64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy().view(U64)
    return out


def _passing(col: pa.Array, words: np.ndarray) -> Iterator[tuple]:
    """Per block of texts: first row, folded bytes, offsets, and start, end, row and hash of each word that passes the filter."""
    for lo, _, data, offs in text_blocks(col):
        folded = data.tobytes().translate(_FOLD)
        block = np.frombuffer(folded, np.uint8)
        start, end, row = word_spans(block, offs)
        keys = SpanHash(block)(start, end)
        at = _bits(keys, len(words) * 64)
        held = ((words[at >> 6] >> (at & 63).astype(U64)) & U64(1)).all(axis=1) if len(keys) else np.zeros(0, bool)
        yield lo, folded, block, offs, start[held], end[held], row[held], keys[held]


def _document_counts(rows: DataFrame, words: np.ndarray) -> DataFrame:
    """(term, n): documents holding each term that passes the filter; counted in each block first."""
    sent = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, folded, _, _, start, end, row, keys in _passing(batch.column("text"), sent.value):
                order = np.lexsort((row, keys))
                first = np.ones(len(order), bool)
                first[1:] = (keys[order][1:] != keys[order][:-1]) | (row[order][1:] != row[order][:-1])
                _, at, n = np.unique(keys[order][first], return_index=True, return_counts=True)
                which = order[first][at]
                found = [folded[a:b] for a, b in zip(start[which].tolist(), end[which].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(n, pa.int64())], ["term", "n"])

    return rows.select("text").mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _occurrences(rows: DataFrame, words: np.ndarray) -> DataFrame:
    """(doc_id, mark, term, start, end) of each occurrence of a term that passes the filter, in code points."""
    sent = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, folded, block, offs, start, end, row, _ in _passing(batch.column("text"), sent.value):
                points = np.zeros(len(block) + 1, np.int64)
                np.cumsum((block & 0xC0) != 0x80, out=points[1:])
                before, took = points[offs[row]], pa.array(lo + row)
                found = [folded[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(took), batch.column("mark").take(took), pa.array(found, pa.binary()),
                    pa.array(points[start] - before), pa.array(points[end] - before)], ["doc_id", "mark", "term", "start", "end"])

    return rows.mapInArrow(run, "doc_id long, mark long, term binary, start long, end long")


def revealing_terms(work: Work, rows: DataFrame, scanned: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(term, kind, disclosure): terms to generalise (kind 4) or remove (kind 5)."""
    total = scanned.count()
    beside = scanned.select(F.explode("beside").alias("b")).select("b.entity", "b.context", "b.term", "b.first")
    # support counts contexts, wherever they are; n_te counts documents: each has one first row of an entity and term
    once = beside.groupBy("term", "entity", "context").agg(F.count_if("first").alias("n"))
    pairs = work.cut(once.groupBy("term", "entity").agg(F.count("*").alias("support"), F.sum("n").alias("n_te"))
                     .filter(F.col("support") >= SUPPORT), "pairs")
    entities = (scanned.select(F.array_distinct(F.transform("beside", lambda b: b["entity"])).alias("e"))
                .select(F.explode("e").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e")))
    counted = _document_counts(rows, term_filter(pairs.select("term").distinct(), filter_bits))
    part = F.log2(F.col("n_te") * F.lit(float(total)) / (F.col("n") * F.col("n_e"))) / F.log2(F.lit(float(total)) / F.col("n_e"))
    scored = (pairs.join(entities, "entity").filter(F.col("n_e") < total).join(counted, "term")
              .withColumn("disclosure", part).groupBy("term").agg(F.max("disclosure").alias("disclosure")))
    return work.cut(scored.filter(F.col("disclosure") >= GENERALISE)
                    .withColumn("kind", F.when(F.col("disclosure") >= REMOVE, 5).otherwise(4).cast("int")), "revealing")


def find_private(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per input row: doc_id, mark (hash of the text), spans array<struct<start, kind, end>> in order."""
    with Work(df.sparkSession, "privacy") as work:
        rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
        rows = rows.withColumn("mark", F.xxhash64("text"))
        scanned = work.cut(_scan(rows), "scanned")
        revealing = revealing_terms(work, rows, scanned, filter_bits)
        if revealing.isEmpty():
            return work.result(scanned.select("doc_id", "mark", "spans"))
        added = (_occurrences(rows, term_filter(revealing, filter_bits)).join(revealing.select("term", "kind"), "term")
                 .select("doc_id", "mark", "start", "kind", "end").distinct())
        added = added.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
        both = scanned.alias("s").join(added.alias("a"), F.col("s.doc_id").eqNullSafe(F.col("a.doc_id"))
                                       & (F.col("s.mark") == F.col("a.mark")), "left")
        clear = F.filter(F.coalesce("a.added", F.array()), lambda x: ~F.exists(
            F.col("s.spans"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
        return work.result(both.select("s.doc_id", "s.mark", F.array_sort(F.concat("s.spans", clear)).alias("spans")))


def sanitise(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with its text rewritten: base entities and generalised terms become their kind in angle
    brackets, removed terms go."""
    spans = found.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), F.col("spans").alias("__spans")).distinct()
    joined = df.join(spans, F.col(f"`{id_col}`").eqNullSafe(F.col("__id"))
                     & (F.xxhash64(text_or_empty(text_col)) == F.col("__mark")), "left")

    @F.pandas_udf("string")
    def rewrite(texts, spans):
        out = []
        for text, found in zip(texts, spans, strict=True):
            if text is None or found is None or not len(found):
                out.append(text)
                continue
            parts, at = [], 0
            for s in found:
                if s["start"] < at:
                    continue
                parts += [text[at:s["start"]], "" if s["kind"] == 5 else f"<{KINDS[s['kind']]}>"]
                at = s["end"]
            out.append("".join(parts) + text[at:])
        import pandas as pd
        return pd.Series(out, dtype=object)

    return joined.select(*[rewrite(F.col(f"`{text_col}`"), "__spans").alias(c) if c == text_col else F.col(f"`{c}`")
                           for c in df.columns])


def digest_spans(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind> of the base kinds, base_sha256, spans (``kind:start:end`` comma-joined)."""
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
