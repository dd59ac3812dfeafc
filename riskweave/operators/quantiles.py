"""Exact quantiles without gathering a column into one buffer.

``percentile()`` keeps every distinct value of a group in one aggregation
buffer.  ``exact_quantiles`` instead (1) asks ``percentile_approx`` for a
value bracket around each target rank, (2) counts the rows below the bracket
and (3) ranks only the distinct values inside it by their running counts, then
interpolates linearly between the order statistics at floor/ceil of
p * (n - 1), exactly like numpy/pandas and ``percentile``.  A bracket that
misses is widened and retried, up to the whole range.

The bracket holds about 4/accuracy of the group's rows besides the ties of its
values; equal values are counted before the shuffle, so that a value which
most rows share is one row of the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, col: str, probs, by: list[str] | None = None,
                    accuracy: int = 10000) -> DataFrame:
    """One row per group with ``q0, q1, ...`` (one column per prob) and ``n``.

    ``by`` is meant for a low-cardinality key (a label, a handful of feature
    names): the result (groups x probs rows) is collected.  Per-entity
    quantiles belong in a grouped plan such as ``user_aggs.amount_profile``.
    Nulls and NaN are left out.  A group without a value gives no row; without
    ``by`` a column without a value gives one row, n = 0 and null quantiles.
    """
    by = list(by or [])
    if not by:
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    x = df.select(*by, F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    probs = [float(p) for p in probs]
    result = None
    counts: dict = {}
    margin = 2.0 / accuracy
    todo = list(range(len(probs)))
    while todo:
        lo_p = [max(0.0, probs[i] - margin) for i in todo]
        hi_p = [min(1.0, probs[i] + margin) for i in todo]
        # one sketch answers both ends of every bracket: lo_p then hi_p
        br = x.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                                F.percentile_approx("_x", lo_p + hi_p, accuracy).alias("_b"))
        targets = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(probs[i]).alias("p"))
                            for j, i in enumerate(todo)])
        br = (br.select(*by, "n", "_b", F.explode(targets).alias("_t"))
              .select(*by, "n", F.col("_t.j").alias("j"), F.col("_t.p").alias("p"),
                      F.element_at("_b", F.col("_t.j") + 1).alias("lo"),
                      F.element_at("_b", F.col("_t.j") + 1 + len(todo)).alias("hi"))
              .withColumn("pos", F.col("p") * (F.col("n") - 1))
              .withColumn("r0", F.floor("pos").cast("long"))
              .withColumn("r1", F.ceil("pos").cast("long")))
        j = x.join(br, by)
        inside = (F.col("_x") >= F.col("lo")) & (F.col("_x") <= F.col("hi"))
        below = j.groupBy(*by, "j").agg(F.count_if(F.col("_x") < F.col("lo")).alias("below"))
        values = j.filter(inside).groupBy(*by, "j", "p", "pos", "r0", "r1", "_x").agg(F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy(*by, "j").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = (values.withColumn("_run", F.sum("_n").over(w)).join(below, [*by, "j"])
                  .withColumn("end", F.col("below") + F.col("_run"))
                  .withColumn("start", F.col("end") - F.col("_n")))

        def order_stat(rank: str) -> Column:
            return F.max(F.when((F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("end")), F.col("_x")))

        picked = ranked.groupBy(*by, "j", "p", "pos", "r0", "r1").agg(order_stat("r0").alias("v0"),
                                                                      order_stat("r1").alias("v1"))
        got = picked.withColumn("q", F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("pos") - F.col("r0")))
        rows = got.join(br.select(*by, "j", "n"), [*by, "j"]).select(
            *by, "j", "q", "n", F.col("v0").isNotNull() & F.col("v1").isNotNull()).collect()
        # the collected table is groups x targets (tiny); it is empty only where no group has a value
        if not rows:
            result, todo = {i: {} for i in range(len(probs))}, []
            break
        ok = {}
        for r in rows:
            counts[tuple(r[b] for b in by)] = r["n"]
            key = tuple(r[b] for b in by)
            ok.setdefault(todo[r["j"]], {})[key] = (r["q"], r[-1])
        done = [i for i in todo if ok.get(i) and all(v[1] for v in ok[i].values())]
        result = result or {}
        for i in done:
            result[i] = {k: v[0] for k, v in ok[i].items()}
        todo = [i for i in todo if i not in done]
        margin *= 4                                           # in the end the bracket is the whole range
    spark = df.sparkSession
    groups = sorted({k for d in result.values() for k in d}) or [(0,)] * (by == ["_all"])
    data = [(*g, counts.get(g, 0), *[result[i].get(g) for i in range(len(probs))]) for g in groups]
    schema = ", ".join([f"`{b}` {t}" for b, t in _types(x, by)] + ["n long"] + [f"q{i} double" for i in range(len(probs))])
    out = spark.createDataFrame(data, schema)
    return out.drop("_all") if by == ["_all"] else out


def _types(df: DataFrame, cols):
    t = dict(df.dtypes)
    return [(c, t[c]) for c in cols]
