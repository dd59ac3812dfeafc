"""Association statistics (inventory T1-T6, T8, W10).

Contingency tables are long-form counts ``(pair, a, b, n)``; many column
pairs are counted in one job by emitting, per distinct tuple of values, one
(a, b) entry per requested pair, weighted by the tuple's rows.  chi-squared uses only observed
cells: sum (O-E)^2/E = sum O^2/E - N, and the 2x2 Yates form
max(0, |O-E| - 0.5)^2 * N * (1/R1 + 1/R2) * (1/C1 + 1/C2) (|O-E| is equal in
all four cells), so no cross product of margins is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pvalues import chi2_log10_udf, chi2_sf_udf, corr_log10_udf, corr_pvalue_udf
from ..session import cut_lineage
from .prefix import bucketed_prefix_sums


def _cells(df: DataFrame, pairs: list[tuple[str, Column, Column]]) -> DataFrame:
    """Counts per (pair, a, b) of named pairs of columns."""
    return _cells_of(df, [c for _, *both in pairs for c in both], [(name, 2 * k, 2 * k + 1) for k, (name, _, _) in enumerate(pairs)])


def _cells_of(df: DataFrame, columns: list[Column], pairs: list[tuple[str, int, int]]) -> DataFrame:
    """Counts per (pair, a, b) of the named pairs of ``columns``; rows where a or b is NULL are dropped.

    Rows are counted by their whole tuple of values first; each tuple then adds its count to every pair, so what
    is multiplied by the number of pairs is the tuples that occur, not the rows."""
    names = [f"c{k}" for k in range(len(columns))]
    tuples = (df.select(*[c.cast("string").alias(n) for c, n in zip(columns, names)]).groupBy(*names)
              .agg(F.count(F.lit(1)).alias("n")))
    arr = F.array(*[F.struct(F.lit(k).alias("pair"), F.col(names[i]).alias("a"), F.col(names[j]).alias("b")) for k, (_, i, j) in enumerate(pairs)])
    cells = (tuples.select("n", F.explode(arr).alias("_c")).select("_c.*", "n")
             .filter(F.col("a").isNotNull() & F.col("b").isNotNull())
             .groupBy("pair", "a", "b").agg(F.sum("n").alias("n")))
    return cells.withColumn("pair", F.element_at(F.array(*[F.lit(name) for name, _, _ in pairs]), F.col("pair") + 1))


def chi2_from_cells(cells: DataFrame, yates: bool = True) -> DataFrame:
    """Per pair: chi2, dof, total_n, nr, nc (scipy chi2_contingency conventions).

    Margins come from windows over the (small) cells table, so the cells are
    computed once and never joined back to themselves.
    """
    wa, wb, wp = Window.partitionBy("pair", "a"), Window.partitionBy("pair", "b"), Window.partitionBy("pair")
    j = (cells.withColumn("row_n", F.sum("n").over(wa)).withColumn("cnt_a", F.count(F.lit(1)).over(wa))
         .withColumn("col_n", F.sum("n").over(wb)).withColumn("cnt_b", F.count(F.lit(1)).over(wb))
         .withColumn("total_n", F.sum("n").over(wp))
         .withColumn("E", F.col("row_n") * F.col("col_n") / F.col("total_n")))
    per = j.groupBy("pair").agg(
        F.first("total_n").alias("total_n"),
        F.count_distinct("a").alias("nr"), F.count_distinct("b").alias("nc"),
        F.sum(1.0 / (F.col("row_n") * F.col("cnt_a"))).alias("inv_r"),
        F.sum(1.0 / (F.col("col_n") * F.col("cnt_b"))).alias("inv_c"),
        (F.sum(F.col("n") * F.col("n") / F.col("E")) - F.first("total_n")).alias("_plain"),
        F.max(F.abs(F.col("n") - F.col("E"))).alias("_d"))
    dof = (F.col("nr") - 1) * (F.col("nc") - 1)
    yates_chi2 = (F.pow(F.greatest(F.col("_d") - 0.5, F.lit(0.0)), 2) * F.col("total_n")
                  * F.col("inv_r") * F.col("inv_c"))
    chi2 = (F.when(dof == 0, F.lit(0.0))
            .when((dof == 1) & F.lit(yates), yates_chi2)
            .otherwise(F.greatest(F.col("_plain"), F.lit(0.0))))
    return per.select("pair", chi2.alias("chi2"), dof.cast("long").alias("dof"), "total_n", "nr", "nc")


def chi2_table(df: DataFrame, cols, y: str, yates: bool = True, with_p: bool = True) -> DataFrame:
    """Chi-squared test of independence of each column with ``y``."""
    cells = _cells_of(df, [F.col(c) for c in [*cols, y]], [(c, k, len(cols)) for k, c in enumerate(cols)])
    out = chi2_from_cells(cells, yates).withColumnRenamed("pair", "column")
    if with_p:
        dof = F.col("dof").cast("double")
        out = out.withColumn("p_value", chi2_sf_udf("chi2", dof)).withColumn("log10_p", chi2_log10_udf("chi2", dof))
    return out


def cramers_v_matrix(df: DataFrame, cols, na: str = "NA", yates: bool = True) -> DataFrame:
    """Cramér's V for every ordered column pair (NULL -> 'NA'), long form."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(na)) for c in cols]
    pairs = [(f"{i}|{j}", i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    st = chi2_from_cells(_cells_of(df, filled, pairs), yates)
    k = F.least(F.col("nr"), F.col("nc")) - 1
    v = F.when(k > 0, F.sqrt(F.col("chi2") / (F.col("total_n") * k))).otherwise(F.lit(0.0))
    names = F.array(*[F.lit(c) for c in cols])
    ij = F.split("pair", r"\|")
    a, b = F.element_at(names, ij[0].cast("int") + 1), F.element_at(names, ij[1].cast("int") + 1)
    # both orientations from one pass (a union would evaluate the statistics twice)
    both = F.when(ij[0] == ij[1], F.array(F.struct(a.alias("col_a"), b.alias("col_b")))).otherwise(
        F.array(F.struct(a.alias("col_a"), b.alias("col_b")), F.struct(b.alias("col_a"), a.alias("col_b"))))
    return (st.select(F.explode(both).alias("_ab"), v.alias("cramers_v"))
            .select("_ab.col_a", "_ab.col_b", "cramers_v"))


def theils_u(df: DataFrame, cols, y: str, na: str = "NA") -> DataFrame:
    """Uncertainty coefficient U(y | x) in nats for each column x."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(na)) for c in cols]
    cells = _cells_of(df, [*filled, F.col(y)], [(c, k, len(cols)) for k, c in enumerate(cols)])
    wa, wb, wp = Window.partitionBy("pair", "a"), Window.partitionBy("pair", "b"), Window.partitionBy("pair")
    j = (cells.withColumn("row_n", F.sum("n").over(wa)).withColumn("col_n", F.sum("n").over(wb))
         .withColumn("cnt_b", F.count(F.lit(1)).over(wb)).withColumn("total_n", F.sum("n").over(wp)))
    p_y = F.col("col_n") / F.col("total_n")
    per = j.groupBy("pair").agg(
        (-F.sum(p_y * F.ln(p_y) / F.col("cnt_b"))).alias("h_y"),
        (-F.sum(F.col("n") / F.col("total_n") * F.ln(F.col("n") / F.col("row_n")))).alias("h_y_x"))
    u = F.when(F.col("h_y") > 0, (F.col("h_y") - F.col("h_y_x")) / F.col("h_y")).otherwise(F.lit(0.0))
    return per.select(F.col("pair").alias("column"), u.alias("theils_u"))


def safe_corr(x, y) -> Column:
    """Pearson r; NULL when either side is constant (ANSI-safe, no divide error)."""
    x, y = (F.col(x) if isinstance(x, str) else x), (F.col(y) if isinstance(y, str) else y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def _long(df: DataFrame, feats, y: str) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("value"))
                    for f in feats])
    return (df.select(F.col(y).cast("int").alias("_y"), F.explode(arr).alias("_f"))
            .select("_f.feature", "_f.value", "_y")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def score_counts(long: DataFrame) -> DataFrame:
    """Distinct (feature, value) with positive and negative counts."""
    return long.groupBy("feature", "value").agg(
        F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") != 1).alias("neg"))


def auc_from_scores(scores: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Tie-aware ROC AUC per feature (Mann-Whitney with average ranks)
    from distinct-score counts and prefix sums of negatives."""
    pref = bucketed_prefix_sums(scores, ["feature"], "value", ["neg"], n_buckets)
    return pref.groupBy("feature").agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("cum_neg") + F.col("neg") / 2.0)),
                     (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc_raw"))


def auc_from_long(long: DataFrame, n_buckets: int | None = None) -> DataFrame:
    return auc_from_scores(score_counts(long), n_buckets)


def corr_from_scores(scores: DataFrame) -> DataFrame:
    """Pearson r of value and the 0/1 label from distinct-score counts, by
    centred sums (means first, joined back as a bounded per-feature table)."""
    w = F.col("pos") + F.col("neg")
    means = scores.groupBy("feature").agg(
        F.sum(w).alias("n"), (F.sum(F.col("value") * w) / F.sum(w)).alias("mx"),
        (F.sum("pos") / F.sum(w)).alias("my"))
    c = scores.join(F.broadcast(means), "feature")
    dx = F.col("value") - F.col("mx")
    sums = c.groupBy("feature", "n").agg(
        F.sum(dx * (1 - F.col("my")) * F.col("pos") - dx * F.col("my") * F.col("neg")).alias("sxy"),
        F.sum(dx * dx * w).alias("sxx"),
        F.sum(F.pow(1 - F.col("my"), 2) * F.col("pos") + F.pow(F.col("my"), 2) * F.col("neg")).alias("syy"))
    r = F.when((F.col("sxx") > 0) & (F.col("syy") > 0), F.col("sxy") / F.sqrt(F.col("sxx") * F.col("syy")))
    return sums.select("feature", "n", r.alias("corr"))


def feature_report(df: DataFrame, feats, y: str = "is_fraud", min_rows: int = 100,
                   with_p: bool = False) -> DataFrame:
    """T4+T5+P13: per feature with >= ``min_rows`` non-null values: AUC folded
    to >= 0.5, point-biserial r (Pearson with the 0/1 label), n.

    The distinct-score table is checkpointed once; every statistic reads it.
    """
    scores = cut_lineage(score_counts(_long(df, feats, y)))
    base = corr_from_scores(scores).filter(F.col("n") >= min_rows)
    auc = auc_from_scores(scores)
    out = base.join(auc, "feature").select(
        "feature", F.greatest(F.col("auc_raw"), 1 - F.col("auc_raw")).alias("auc"), "corr", "n")
    if with_p:
        n = F.col("n").cast("double")
        out = out.withColumn("p_value", corr_pvalue_udf("corr", n)).withColumn("log10_p", corr_log10_udf("corr", n))
    return out


def phi(df: DataFrame, a: str, b: str, with_p: bool = False) -> DataFrame:
    """Pearson correlation of two binary columns."""
    out = df.agg(safe_corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("phi"),
                 F.count(F.lit(1)).alias("n"))
    if with_p:
        n = F.col("n").cast("double")
        out = out.withColumn("p_value", corr_pvalue_udf("phi", n)).withColumn("log10_p", corr_log10_udf("phi", n))
    return out


def compare_scores(df: DataFrame, methods: dict[str, tuple[str, bool]], y: str = "is_fraud",
                   threshold: float = 0.55) -> DataFrame:
    """AUC of each (optionally sign-inverted) score, r of the raw score with
    the label, and whether the AUC clears ``threshold``."""
    signed = df.select(F.col(y), *[(-F.col(c) if inv else F.col(c)).alias(name)
                                   for name, (c, inv) in methods.items()])
    auc = auc_from_long(_long(signed, list(methods), y))
    raw = df.select(F.col(y), *[F.col(c).alias(name) for name, (c, _inv) in methods.items()])
    r = _long(raw, list(methods), y).groupBy("feature").agg(
        safe_corr("value", F.col("_y").cast("double")).alias("corr"))
    return (auc.join(r, "feature").select(F.col("feature").alias("method"), F.col("auc_raw").alias("auc"), "corr")
            .withColumn("recommend", (F.col("auc") > threshold)))
