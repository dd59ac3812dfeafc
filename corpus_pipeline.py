"""Corpus pipeline: raw documents to token files, one operator per stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame.  ``run`` applies them in order; every stage's result
is written as Parquet in the shared folder and read again as the next one's
docs.  All but the last return the columns of documents, whatever further
columns these have; rows are kept or dropped whole.

Decisions are taken per (doc_id, text): rows equal in both share a decision,
except that near-dedup keeps one row of a group.  Null ids and texts are
ordinary values; an empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import decontamination, mixing, resampling, simhash, token_files
from riskweave.llm.common import Work, documents, text_or_empty

TOKENIZER = "byte_bpe_50k.json"
_MARK = "__rw_mark"


def _marked(docs: DataFrame) -> DataFrame:
    """With a hash of the text, which tells rows of one id apart."""
    return docs.withColumn(_MARK, F.xxhash64(text_or_empty("text")))


def _matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` joined null-safely with ``keys`` (doc_id, mark, ...); a semi or anti join keeps docs' columns."""
    left = _marked(docs).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col(f"d.{_MARK}") == F.col("k.mark"))
    return left.join(keys.alias("k"), same, how)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the importance resample go."""
    judged = resampling.resample(_marked(docs), documents(spark, sf_dir, "labels"), carry=(_MARK,))
    gone = judged.filter(~F.col("kept")).select("doc_id", F.col(_MARK).alias("mark")).distinct()
    return _matching(docs, gone, "left_anti").drop(_MARK)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row of the least id stays (null last, then by a hash of the text)."""
    found = simhash.near_duplicates(_marked(docs), carry=(_MARK,))
    # a group is its component; components of null ids alone are told apart by fingerprint
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("null "), F.col("fp").cast("string")))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col(_MARK).alias("mark"))).alias("best")
    keep = found.withColumn("group", group).groupBy("group").agg(best).select("best.doc_id", "best.mark")
    # rows that are equal in id and text more than once: one of them stays
    often = (found.groupBy("doc_id", F.col(_MARK).alias("mark")).agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.mark") == F.col("b.mark"))
    once = _matching(docs, keep.alias("a").join(often.alias("b"), same, "left_anti"), "left_semi")
    several = _matching(docs, keep.alias("a").join(often.alias("b"), same, "left_semi"), "left_semi")
    return once.unionAll(several.dropDuplicates(["doc_id", _MARK])).drop(_MARK)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item leaked go."""
    found = decontamination.find_leaks(docs, documents(spark, sf_dir, "benchmark"))
    return _matching(docs, found.select("doc_id", "mark").distinct(), "left_anti").drop(_MARK)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(_marked(docs), carry=(_MARK,))
    # a row for every copy that the rows of one key are taken, over their number
    rows = mixed.groupBy("source", "doc_id", F.col(_MARK).alias("mark")).agg(
        F.count("*").alias("rows"), F.sum("copies").alias("taken"))
    with Work(spark, "mix-stage") as work:
        plan = work.result(rows.filter("taken > 0"))
    left = _marked(docs).alias("d")
    same = (F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & F.col("d.source").eqNullSafe(F.col("k.source"))
            & (F.col(f"d.{_MARK}") == F.col("k.mark")))
    single = left.join(plan.filter("rows = 1").alias("k"), same).withColumn("__rw_times", F.col("k.taken"))
    # rows that are equal in id, source and text: one of them stands for all
    keys = plan.filter("rows > 1").alias("k")
    one = left.join(keys, same, "left_semi").dropDuplicates(["doc_id", "source", _MARK]).alias("d")
    several = one.join(keys, same).withColumn("__rw_times", F.col("k.taken"))
    both = single.select("d.*", "__rw_times").unionAll(several.select("d.*", "__rw_times"))
    return (both.withColumn("__rw_copy", F.explode(F.sequence(F.lit(1), F.col("__rw_times").cast("int"))))
            .drop("__rw_copy", "__rw_times", _MARK))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 per document."""
    with Work(spark, "token-stage") as work:
        path = work.path("files")
        token_files.write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
        return work.result(token_files.read_token_files(spark, path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", mix_sources),
    ("token output", token_output),
]

#: The classifier, the latent search and the tokenizer have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    with Work(spark, "pipeline") as work:
        for k, (_, stage) in enumerate(STAGES):
            out = stage(spark, docs, sf_dir)
            docs = work.cut(out, f"stage-{k}") if k < len(STAGES) - 1 else work.result(out)
    return docs
