"""Filter audit, hard negatives and line dedup against brute force, and their edge cases, on small tables."""
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import filter_audit, hard_negatives, line_dedup
from riskweave.llm.common import Work

BLANK = "[ \t\n\x0b\f\r]"
LONG = "alpha beta gamma delta " * 4000


# ------------------------------------------------------------------ 11 filter audit

def brute_audit(rows, labels):
    """rows: (doc_id, text, source); every order applied document by document."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    ids = {}
    for d, text, _ in rows:
        if d is not None:
            ids.setdefault(text or "", []).append(d)
    docs = []
    for d, text, source in rows:
        text = text or ""
        words = [w for w in re.split(BLANK + "+", text) if w]
        same = ids.get(text, [])
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
                 "D": any(c in "#$%&*|" for c in text), "E": bool(same) and (d is None or min(same) < d)}
        docs.append((source or "", {f for f, x in fails.items() if x}, d in good, d in toxic))
    out, by_filter = {}, {}
    for part in {p for p, *_ in docs}:
        own = [x for x in docs if x[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = own
            for step, f in enumerate(order, 1):
                gone = [x for x in alive if f in x[1]]
                alive = [x for x in alive if f not in x[1]]
                out[part, order, step] = [len(alive), len(gone), sum(f in x[1] for x in own) - len(gone),
                                          sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone)]
                by_filter[part, f] = by_filter.get((part, f), 0) + len(gone)
    return {k: (*v, by_filter[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def run_audit(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, mask string, n int").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    with Work(spark, "audit-test") as work:
        names, counts = filter_audit.failure_counts(work, docs, marks)
        got = filter_audit.audit(names, counts, spark).collect()
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                        r["toxic_lost"], r["shapley"]) for r in got}


def test_path_counts():
    forward, backward = filter_audit.path_counts(5)
    for state in range(32):
        k = state.bit_count()
        assert (forward[state], backward[state]) == (math.factorial(k), math.factorial(5 - k))
    assert sum(w for _, f, w in filter_audit._edges(5) if f == 0) == 120


def test_audit_equals_every_order_by_hand(spark):
    rng = random.Random(5)
    pool = [" ".join(rng.choice(["ab", "Cd", "e", "f#", "gh", f"w{rng.random()}"]) for _ in range(rng.choice([3, 150, 199, 200, 260])))
            for _ in range(30)]
    rows = [(i, rng.choice(pool), rng.choice(["a", "b"])) for i in range(90)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 100, 2)]
    assert run_audit(spark, rows, labels) == brute_audit(rows, labels)


def test_audit_edges(spark):
    rows = [(1, "Same", "a"), (1, "Same", "a"), (2, "Same", None), (None, "Same", ""), (None, "only null", "a"), (None, None, "b"),
            (3, "", "b"), (4, None, "b"), (5, LONG, "b"), (6, " \x0b\t\n", "b"), (7, "  AB é", "b")]
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, 1), (5, 1, None)]
    assert run_audit(spark, rows, labels) == brute_audit(rows, labels)
    assert run_audit(spark, [], labels) == {}
    assert set(run_audit(spark, rows, [])) == set(brute_audit(rows, []))


# ------------------------------------------------------------------ 12 hard negatives

def brute_mine(rows, every=100):
    """rows: (id, vector, label); nulls take no part, each row is its own."""
    items = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
             if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    def first(found):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:5]

    out = []
    for k, (i, v, lab) in enumerate(items):
        if i is None or i % every:
            continue
        pos = first((dot(v, w), j) for m, (j, w, other) in enumerate(items) if m != k and other == lab)
        neg = [(dot(v, w), j) for j, w, other in items if other != lab]
        for rank, (p, j) in enumerate(pos, 1):
            for at, (n, g) in enumerate(first(x for x in neg if 80 * p <= 100 * x[0] <= 100 * p), 1):
                out.append((i, j, rank, at, g, p, n))
    return sorted(out, key=str)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<double>, label int, block string, part int").repartition(3)
    return sorted(map(tuple, hard_negatives.mine(df, **kw).collect()), key=str)


@pytest.mark.parametrize("dims,size", [(64, 1 << 10), (3, 1 << 27), (1000, 5), (1, 1)])
def test_residue_scores_are_exact(dims, size):
    rng = np.random.default_rng(dims)
    a, b = (rng.integers(-size, size + 1, (n, dims)).astype(np.int32) for n in (17, 23))
    most = int(max((x.astype(object) ** 2).sum(axis=1).max() for x in (a, b)))
    primes = hard_negatives.moduli(dims, most)
    assert len(set(primes)) == len(primes) and dims * ((primes[0] - 1) // 2) ** 2 < 1 << 24
    assert (hard_negatives.exact_scores(a, b, primes) == (a.astype(object) @ b.astype(object).T)).all()


def test_mining_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) + (i % 3 == 0) for _ in range(12)], rng.randrange(4)) for i in range(700)]
    rows += [(1000 + i, [float(rng.randrange(2)) for _ in range(12)], rng.randrange(2)) for i in range(200)]       # ties
    assert mined(spark, rows, row_block=64) == brute_mine(rows)


def test_mining_edges(spark):
    v = [0.5, -0.25]
    rows = [(0, v, 1), (0, v, 1), (0, v, 2), (100, None, 1), (200, [None, 1.0], 1), (300, v, None), (400, [float("nan"), 1.0], 1),
            (500, [float("inf"), 1.0], 2), (None, v, 1), (None, v, 2), (1, [], 1), (2, [0.5], 2), (3, v, 2), (4, v, 1), (600, [], 7),
            (700, [-1.0, 0.0, 0.0], 8), (701, [1.0, 0.0], 8), (-100, v, 9)]
    assert mined(spark, rows) == brute_mine(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(1, v, 1), (2, v, 2)]) == []
    with pytest.raises(ValueError, match="2.28"):
        mined(spark, [(0, [1e30], 1), (1, [1.0], 1)])


def test_mining_from_an_equal_vector_group(spark):
    rows = [(i, [0.125, 0.25, 0.5], i % 2) for i in range(1200)]
    got = mined(spark, rows, row_block=128)
    assert got == brute_mine(rows)
    assert {(r[1], r[4]) for r in got if r[0] == 100 and r[2] == 1} == {(0, n) for n in (1, 3, 5, 7, 9)}


# ------------------------------------------------------------------ 13 line dedup

def brute_lines(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))

    docs = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            docs.setdefault(key(line), set()).add(d)
    keep = {k: max((d for d in ds if d is not None), default=None) for k, ds in docs.items() if len(k) >= 40 and len(ds) >= 5}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in keep or keep[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def cleaned(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, row int, digest binary").repartition(4)
    with Work(spark, "lines-test") as work:
        got = line_dedup.dedup_lines(work, df, **kw)
        return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in got.collect()), key=str)


def line_rows(rng, n):
    pool = [f"{'Repeated ' * 4}line number {k} é漢" for k in range(40)] + ["x" * 39, "y" * 40, "漢" * 40, "", " "]
    weight = [1 / (k + 1) for k in range(len(pool))]
    rows = []
    for i in range(n):
        lines = [rng.choice(["", " ", "\t", "\r", "\x0b"]) + (x.upper() if rng.random() < 0.3 else x) + rng.choice(["", " ", "\r"])
                 for x in rng.choices(pool, weight, k=rng.randrange(6))]
        lines += [f"own line {i} {k} {'z' * 40}" for k in range(rng.randrange(3))]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("filter_bytes", [line_dedup.MAX_FILTER_BYTES, line_dedup.SEGMENT_BITS // 8])
def test_lines_equal_brute_force(spark, filter_bytes):
    rows = line_rows(random.Random(4), 600)
    assert cleaned(spark, rows, filter_bytes=filter_bytes) == brute_lines(rows)


def test_lines_edges(spark):
    a, b = "A shared line of more than forty characters, no. 1", "another shared line of more than forty chars"
    rows = [(None, a), (None, a), (1, a), (1, f"{a}\n{a.upper()}"), (2, f" {a}\r\n"), (3, f"{a}\n\n{b}"), (4, f"{b}\n{a}\n{a}"), (5, None), (6, ""),
            (7, "\n\n"), (8, LONG), (9, LONG), (10, "\n".join([b] * 500)), (11, b), (None, b), (12, f"{LONG}\n{b}")]
    assert cleaned(spark, rows) == brute_lines(rows)
    assert cleaned(spark, []) == []


def test_a_key_of_two_documents_is_always_suspected(spark):
    rows = [(i, f"the very same line that {i % 300} documents may hold, or only two") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    with Work(spark, "lines-test") as work:
        size = line_dedup.SEGMENT_BITS
        twice = line_dedup.build_filter(work, df, size, 40)
        found = line_dedup.find_suspects(work, df, twice, size, 40)
        assert found.filter(F.size("suspects") == 1).count() == 600
    single = df.filter("doc_id < 300")
    with Work(spark, "lines-test") as work:
        twice = line_dedup.build_filter(work, single, size, 40)
        assert line_dedup.find_suspects(work, single, twice, size, 40).filter(F.size("suspects") == 0).count() == 300
