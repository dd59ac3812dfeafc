"""Texts laid out in blocks of a few MB: all of them in document order, or the distinct ones.

In document order block ids ascend with the documents, so (block, place)
orders the places of the corpus.  The blocks are a Parquet table bucketed by block id: jobs that send
marks back to their blocks join them where the text lies, without a shuffle of
the text.
"""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, text_blocks, text_or_empty

BUCKET_TEXT = 16 << 20


def _lay_out(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([
                    pa.array([(part << 32) + k], pa.int64()),
                    pa.array([batch.column("doc_id").slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                    pa.array([batch.column("mark").slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(offs)], pa.list_(pa.int64())),
                    pa.array([data.tobytes()], pa.binary())], ["block", "doc_ids", "marks_of", "lens", "text"])
                k += 1

    return rows.mapInArrow(run, "block long, doc_ids array<long>, marks_of array<long>, lens array<long>, text binary")


class Layout:
    """``blocks`` (block, doc_ids, marks_of, lens, text; ``marks_of``: a hash of each text), ``total``: bytes of all texts.

    In document order every row is laid out, by id (null last), then by a hash of the text.  With
    ``distinct`` each text is laid out once, with its least id, in no order; ``ids`` (digest, doc_id, n, mark) has the
    rows of each text and ``firsts`` (digest, first, mark) its least id.
    """

    def __init__(self, work: Work, df: DataFrame, id_col: str, text_col: str, distinct: bool = False):
        self.work, self.table = work, f"rw_blocks_{uuid.uuid4().hex[:12]}"
        rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
        rows = rows.withColumn("mark", F.xxhash64("text"))
        if distinct:
            digest = F.unhex(F.md5("text"))
            self.ids = work.cut(rows.withColumn("digest", digest).groupBy("digest", "doc_id").agg(
                F.count("*").alias("n"), F.min("mark").alias("mark"), F.min(F.octet_length("text")).alias("bytes")), "ids")
            self.total = self.ids.agg(F.sum("bytes")).first()[0] or 0
            self.firsts = self.ids.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min("mark").alias("mark"))
            # each task sends a text once, however many copies it read
            placed = rows.groupBy(digest.alias("digest")).agg(
                F.min("doc_id").alias("doc_id"), F.any_value("mark").alias("mark"), F.any_value("text").alias("text")).drop("digest")
        else:
            self.total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
            order = (F.col("doc_id").asc_nulls_last(), F.col("mark"))
            placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        files = max(8, -(-self.total // BUCKET_TEXT))
        (_lay_out(placed).write.format("parquet").option("compression", "zstd").bucketBy(files, "block").sortBy("block")
         .option("path", work.path("blocks")).saveAsTable(self.table))
        del rows, placed
        release(work)
        self.blocks = work.spark.table(self.table)

    def drop(self) -> None:
        """Delete the blocks, once nothing reads them any more."""
        self.work.drop(self.work.path("blocks"))

    def close(self) -> None:
        self.work.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def release(work: Work) -> None:
    """Let the driver drop the shuffle files of plans that are done."""
    # plans go with the first collection, the shuffles they held with the second; the cleaner works beside the driver
    for _ in range(2):
        gc.collect()
        work.spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
