"""Mixing sources to target weights by subset-sum budget fitting.

1. Sizes: words per document; each source's words in total.
2. Targets: sources in code-point order (null last) weigh ``weights``,
   repeating; they share ``share`` times all words; a target stops at
   ``most`` times its source's words, and the excess is shared again by
   weight until none is above.
3. Fitting, per source, on the counts of documents by exact size: whole
   epochs first, then for the rest of the budget an equal part of the
   documents of every size, then the largest sizes until at most ``DP_BUDGET``
   words remain, then bounded-knapsack dynamic programming (one bit per
   reachable sum) for an exact fill.
4. Selection: of the documents of one size, the wanted number in the order
   of a seeded hash of the id.  Which hash bucket the last one falls in
   follows from counts; only that bucket is put in order.

Edge cases: a null or blank text has size 0 and is never taken; a source
without words has target 0; documents equal in source, id and size count
together and are returned once each; an empty table gives no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Work, text_or_empty

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 17
#: Words that dynamic programming fills at most (and bits of its tables).
DP_BUDGET = 1 << 16
#: Hash buckets that the documents of one (source, size) are counted by.
HASH_BUCKETS = 1 << 12


def word_count(text_col: str = "text"):
    return F.regexp_count(text_or_empty(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def fill(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size to take, each at most ``counts``, so that their sum is the
    largest reachable one up to ``budget`` (a few thousand words at most)."""
    reach, steps = 1, []
    mask = (1 << (budget + 1)) - 1
    for at, (s, n) in enumerate(zip(sizes, counts, strict=True)):
        left, power = min(n, budget // s), 1
        while left and not reach >> budget & 1:
            part = min(power, left)
            steps.append((at, part, reach))
            reach |= reach << part * s & mask
            left, power = left - part, power * 2
    best, taken = reach.bit_length() - 1, [0] * len(sizes)
    for at, part, before in reversed(steps):
        if not before >> best & 1:
            taken[at] += part
            best -= part * sizes[at]
    return taken


def plan_source(sizes: list[int], counts: list[int], target: float, most: int = MOST) -> tuple[int, list[int]]:
    """(whole epochs, further documents of each size) whose words come nearest to ``target`` from below."""
    total = sum(s * n for s, n in zip(sizes, counts, strict=True))
    if not total:
        return 0, [0] * len(sizes)
    full = min(most, int(target // total))
    budget = min(total, int(target) - full * total) if full < most else 0
    more = [n * budget // total for n in counts]
    left = budget - sum(s * k for s, k in zip(sizes, more, strict=True))
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if left <= DP_BUDGET:
            break
        k = min(counts[at] - more[at], -(-(left - DP_BUDGET) // sizes[at]))
        k = min(k, left // sizes[at])
        more[at] += k
        left -= k * sizes[at]
    near = [i for i, s in enumerate(sizes) if s <= left and counts[i] > more[i]]
    if near:
        # all that is left fits: no table of sums needed
        rest = [counts[i] - more[i] for i in near]
        if sum(sizes[i] * k for i, k in zip(near, rest, strict=True)) > left:
            rest = fill([sizes[i] for i in near], rest, left)
        for i, k in zip(near, rest, strict=True):
            more[i] += k
    return full, more


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with weight and target.  One row per source is ranked; only
    scalars come to the driver."""
    ranked = sources.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.withColumn("weight", weight)
    cap = F.col("source_size") * float(most)
    level = None
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level >= cap
        total, held, free = ranked.agg(F.sum("source_size"), F.sum(F.when(above, cap)),
                                       F.sum(F.when(~above, F.col("weight")))).first()
        now = ((total or 0) * share - (held or 0.0)) / free if free else level
        if now is None or now == level or not free:
            break
        level = now
    return ranked.drop("rank").withColumn("target", F.least(F.col("weight") * (level or 0.0), cap))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED,
        carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, source, *carry, size, source_size, target, copies (times the mix
    takes it, up to ``most``), taken (copies times size).  ``carry``: further columns that tell rows apart."""
    with Work(df.sparkSession, "mix") as work:
        key = ["source", "doc_id", "size", *carry]
        rows = df.select(F.col(f"`{source_col}`").alias("source"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         word_count(text_col).alias("size"), *carry)
        rows = rows.groupBy(*key).agg(F.count("*").alias("n"))
        # '=' before a source name keeps null and '' apart in equi-joins
        rows = rows.withColumn("part", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
        rows = work.cut(rows.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", *carry)), "rows")
        sizes = work.cut(rows.groupBy("part", "source", "size").agg(F.sum("n").alias("n")), "sizes")
        sources = sizes.groupBy("part", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
        sources = work.cut(source_targets(sources, weights, share, most), "sources")

        def plan(pdf: pd.DataFrame) -> pd.DataFrame:
            # distinct sizes of one source: at most the square root of twice its words
            pdf = pdf[pdf["size"] > 0].sort_values("size")
            if not len(pdf):
                return pd.DataFrame({"part": [], "size": [], "full": [], "more": []})
            full, more = plan_source(pdf["size"].tolist(), pdf["n"].tolist(), float(pdf["target"].iloc[0]), most)
            return pd.DataFrame({"part": pdf["part"], "size": pdf["size"], "full": full, "more": more})

        plans = work.cut(sizes.join(sources.select("part", "target"), "part").select("part", "size", "n", "target")
                         .groupBy("part").applyInPandas(plan, "part string, size long, full int, more long"), "plans")

        # the bucket in which each (source, size) reaches its number
        bucket = F.pmod(F.shiftrightunsigned("order", 20), F.lit(HASH_BUCKETS)).cast("int")
        chosen = rows.withColumn("bucket", bucket).join(plans.filter("more > 0").drop("full"), ["part", "size"])
        counts = chosen.groupBy("part", "size", "more", "bucket").agg(F.sum("n").alias("in_bucket"))
        upto = F.sum("in_bucket").over(Window.partitionBy("part", "size").orderBy("bucket"))
        counts = (counts.withColumn("before", upto - F.col("in_bucket")).filter("before < more")
                  .withColumn("room", F.col("more") - F.col("before"))
                  .select("part", "size", "bucket", "room", (F.col("room") < F.col("in_bucket")).alias("edge")))
        counts = work.cut(counts, "counts")
        chosen = work.cut(rows.withColumn("bucket", bucket).join(counts, ["part", "size", "bucket"]), "chosen")
        run = F.sum("n").over(Window.partitionBy("part", "size", "bucket").orderBy("order", "doc_id", *carry))
        edge = chosen.filter("edge").withColumn("extra", F.greatest(F.lit(0), F.least(F.col("n"), F.col("room") - run + F.col("n"))))
        extra = (chosen.filter("not edge").select("part", "doc_id", "size", *carry, F.col("n").alias("extra"))
                 .unionAll(edge.select("part", "doc_id", "size", *carry, "extra")))
        extra = work.cut(extra.filter("extra > 0"), "extra")

        same = (F.col("r.part") == F.col("e.part")) & (F.col("r.size") == F.col("e.size"))
        for c in ("doc_id", *carry):
            same &= F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}"))
        taken = rows.alias("r").join(extra.alias("e"), same, "left").select("r.*", F.coalesce("e.extra", F.lit(0)).alias("extra"))
        out = (taken.join(plans.select("part", "size", "full"), ["part", "size"], "left")
               .join(sources.select("part", "source_size", "target"), "part")
               .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
               .withColumn("copies", F.coalesce("full", F.lit(0)) + (F.col("copy") <= F.col("extra")).cast("int"))
               .select("doc_id", "source", *carry, "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken")))
        return work.result(out)
