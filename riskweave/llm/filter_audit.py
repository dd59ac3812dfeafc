"""Filter interaction audit by forward-backward path counting on the subset lattice.

A state of the lattice is the set of filters applied so far, an edge applies
one more.  What an edge removes (documents that fail its filter and none of
the state's) does not depend on the order in which the state was reached, so
the whole audit follows from one count of documents per failure mask:

* ``forward[S]`` orders reach a state, ``backward[S]`` lead from it to the
  full set; ``forward[S] * backward[S + f]`` orders cross the edge (S, f);
* the sum of that weight times the edge's removals is n! times the Shapley
  value of the filter;
* step k of an order is one edge, so every order is read off the same edges.

Documents meet the filters in one pass; their texts never move.  What shuffles
is a digest, an id and a mask per document, equal rows counted first, joined on
(digest, id) and id.  The lattice tables that are broadcast have sizes set by
the number of filters alone (5: 810, 80 and 600 rows; at most 6 are taken).

Edge cases: a null text is empty; a null part is the empty string; a null id
comes after all others and has no labels; repeated rows count each; of
repeated labels any good or toxic one counts, null marks are neither; an empty
table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, text_or_empty

MAX_FILTERS = 6
_BLANKS = " \t\n\x0b\f\r"


# ---------------------------------------------------------------- the filters of the registered audit

def _words(text: Column) -> Column:
    """The maximal runs ``[^\\x20\\x09-\\x0D]+``."""
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))


def failures(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of the per-text filters, by letter."""
    return {"A": F.size(words) < 200,
            "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
            "D": text.rlike("[#$%&*|]")}


#: The filter that looks beyond its own text: identical to the text of a smaller id.
DUPLICATE = "E"


# ---------------------------------------------------------------- the lattice

def path_counts(n: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state (a bit mask) from the empty set, and that lead from it to the full set."""
    states = 1 << n
    forward, backward = [0] * states, [0] * states
    forward[0] = backward[-1] = 1
    for state in range(1, states):
        forward[state] = sum(forward[state ^ (1 << f)] for f in range(n) if state >> f & 1)
    for state in range(states - 2, -1, -1):
        backward[state] = sum(backward[state | (1 << f)] for f in range(n) if not state >> f & 1)
    return forward, backward


def _edges(n: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders across) of every edge."""
    forward, backward = path_counts(n)
    return [(s, f, forward[s] * backward[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def _incidence(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, state, filter, 1 if the edge removes the mask) for the masks that are alive in the edge's state."""
    return [(m, s, f, m >> f & 1) for s, f, _ in _edges(n) for m in range(1 << n) if not m & s]


def _orders(names: list[str]) -> list[tuple[str, int, int, int]]:
    """(order, step, state, filter): the edges that each order crosses."""
    out = []
    for order in permutations(range(len(names))):
        state = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(names[g] for g in order), step, state, f))
            state |= 1 << f
    return out


# ---------------------------------------------------------------- the audit

def failure_counts(work: Work, df: DataFrame, labels: DataFrame, filters=failures, id_col: str = "doc_id",
                   text_col: str = "text", part_col: str = "source") -> tuple[list[str], DataFrame]:
    """The filters' letters and (part, mask, n, good, toxic): documents by part and set of failed filters."""
    tests = filters(F.col("text"), F.col("words"))
    names = sorted([*tests, DUPLICATE])
    if len(names) > MAX_FILTERS:
        raise ValueError(f"{len(names)} filters have {len(names)}! orders; at most {MAX_FILTERS} are taken")
    bit = {name: 1 << k for k, name in enumerate(names)}
    mask = sum((F.when(test, bit[name]).otherwise(0) for name, test in tests.items()), F.lit(0))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"),
                     F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    rows = rows.withColumn("words", _words(F.col("text")))
    seen = work.cut(rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
                    .groupBy("digest", "id", "part", "mask").agg(F.count("*").alias("n")), "masks")
    # of equal texts, the rows of the least id pass the duplicate filter; joined by digest and id, so no text is hot
    first = (seen.groupBy("digest").agg(F.min("id").alias("id")).select("digest", "id", F.lit(0).alias("repeat")))
    same = F.col("s.digest").eqNullSafe(F.col("f.digest")) & F.col("s.id").eqNullSafe(F.col("f.id"))
    marks = (labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") == 1).alias("q"), (F.col("toxic") == 1).alias("t"))
             .filter("id IS NOT NULL").groupBy("id").agg(
                 F.max(F.coalesce("q", F.lit(False)).cast("int")).alias("good"),
                 F.max(F.coalesce("t", F.lit(False)).cast("int")).alias("toxic")).filter("good + toxic > 0"))
    judged = seen.alias("s").join(first.alias("f"), same, "left").select(
        "s.id", "s.part", "s.n", (F.col("s.mask") + F.coalesce("f.repeat", F.lit(bit[DUPLICATE]))).alias("mask"))
    counts = (judged.join(marks, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")))
    return names, work.cut(counts, "counts")


def audit(names: list[str], counts: DataFrame, spark: SparkSession) -> DataFrame:
    """Every order's steps of every part, from :func:`failure_counts`: part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley (times the number of orders)."""
    n = len(names)
    full = (1 << n) - 1
    crossed = spark.createDataFrame(_incidence(n), "mask int, state int, filter int, hit int")
    weights = spark.createDataFrame(_edges(n), "state int, filter int, orders long")
    steps = spark.createDataFrame(_orders(names), "filter_order string, step int, state int, filter int")
    # every edge of every part, so that those that no document meets are zeros
    none = counts.select("part").distinct().select("part", F.explode(F.array(*[
        F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter")) for s, f, _ in _edges(n)])).alias("e"))
    zero = F.lit(0).cast("long")
    met = (counts.join(F.broadcast(crossed), "mask")
           .select("part", "state", "filter", F.col("n").alias("alive"), (F.col("n") * F.col("hit")).alias("removed"),
                   (F.col("good") * F.col("hit")).alias("good_lost"), (F.col("toxic") * F.col("hit")).alias("toxic_lost")))
    sums = ["alive", "removed", "good_lost", "toxic_lost"]
    edges = (met.unionAll(none.select("part", "e.state", "e.filter", zero, zero, zero, zero))
             .groupBy("part", "state", "filter").agg(*[F.sum(c).alias(c) for c in sums]))
    per_filter = (edges.join(F.broadcast(weights), ["state", "filter"]).groupBy("part", "filter").agg(
        F.sum(F.col("orders") * F.col("removed")).alias("shapley"),
        F.sum(F.when(F.col("state") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("state") == F.lit(full) - F.expr("shiftleft(1, filter)"), F.col("removed"))).alias("unique_fails")))
    return (edges.join(per_filter, ["part", "filter"]).join(F.broadcast(steps), ["state", "filter"])
            .select("part", "filter_order", "step", (F.col("alive") - F.col("removed")).alias("kept"), "removed",
                    (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley"))
