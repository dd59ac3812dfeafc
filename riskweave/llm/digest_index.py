"""Exact dedup against a persistent digest index.

The index is a Parquet table (digest, keep_id, batch), bucketed and sorted by the
SHA-256 of the normalised text.  A batch meets it in a sort-merge anti-join
that reads each index bucket where it lies; digests not yet known are appended
to the same buckets with the batch's name.  A batch that is run again after
a failure adds nothing and keeps the rows that are in the index under its name, so it gives
what the first run would have given.  The name is the caller's, or follows from
the batch's rows (the same rows are the same batch).

Buckets hold ``BUCKET_ROWS`` digests at most: an index that outgrows them is
written anew with more buckets, beside the old one, which goes when the new one is whole.

Texts are equal when identical after each run ``[\\x20\\x09-\\x0D]+`` is
replaced by one space; a null text is empty.  Of equal texts the smallest id
stays, null ids last; of rows that are equal in id and text one stays.  Empty
tables give empty results.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, text_or_empty

#: Buckets of a new index: tasks of the anti-join.
BUCKETS = 64
#: Digests of a bucket beyond which the index gets more buckets (some 200 MB of files).
BUCKET_ROWS = 4_000_000


class DigestIndex:
    """The index stored under ``path`` (any shared storage), opened or made; ``buckets``: of a new one."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.bucket_rows = spark, path.rstrip("/"), bucket_rows
        self._open(max(self._whole(), default=buckets))

    def _folder(self, name: str = ""):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _whole(self) -> list[int]:
        """Bucket counts under which a whole index lies here."""
        folder, files = self._folder()
        names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
        counts = [int(n[1:]) for n in names if n[:1] == "b" and n[1:].isdigit()]
        return [n for n in counts if files.exists(self._folder(f"b{n}/_SUCCESS")[0])]

    def _open(self, buckets: int) -> None:
        self.buckets, self.path = buckets, f"{self.root}/b{buckets}"
        self.table = f"rw_digests_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
                       f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unknown(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` whose digest the index lacks."""
        return groups.join(self.read().hint("merge"), "digest", "left_anti")

    def _add(self, rows: DataFrame) -> None:
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))          # a bucket's rows meet in one task: one file each
        (rows.repartition(bucket).write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.path).saveAsTable(self.table))
        self.spark.catalog.refreshTable(self.table)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add the unknown (digest, keep_id) of ``groups``, distinct there, under the name of their batch."""
        self._add(self.unknown(groups).select("digest", "keep_id", F.lit(batch).alias("batch")))

    def fit(self, more: int) -> None:
        """Give the index buckets enough for ``more`` digests beside its own."""
        wanted = self.buckets
        while self.read().count() + more > wanted * self.bucket_rows:
            wanted *= 4
        if wanted == self.buckets:
            return
        old, rows = self.buckets, self.spark.read.schema("digest binary, keep_id long, batch string").parquet(self.path) \
            if self.buckets in self._whole() else None
        self.close()
        # what a failed attempt left
        half, files = self._folder(f"b{wanted}")
        files.delete(half, True)
        self._open(wanted)
        if rows is not None:
            self._add(rows)
            gone, files = self._folder(f"b{old}")
            files.delete(gone, True)

    def close(self) -> None:
        """Forget the session's table entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digest(text_col: str = "text"):
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(text_col), r"[\x20\x09-\x0D]+", " "), 256))


def batch_name(rows: DataFrame) -> str:
    """A name that follows from the rows (digest, doc_id, n), in any order."""
    h = [F.bit_xor(F.xxhash64(F.lit(k), "digest", "doc_id", "n")).alias(f"h{k}") for k in range(2)]
    got = rows.agg(F.count("*").alias("n"), *h).first()
    return "-".join(str(x or 0) for x in got)


def dedup_batch(df: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
                batch: str | None = None) -> DataFrame:
    """Deduplicate a batch within itself and against ``index``, then append it.

    Returns one row per input row: doc_id, keep_id, group_size (rows of the batch with the text), kept,
    digest.  ``keep_id`` comes from the index, so for a text known before it is the id that stayed then.
    ``batch``: the batch's name, the same when it is run again.
    """
    spark = df.sparkSession
    with Work(spark, "digests") as work:
        rows = work.cut(df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), digest(text_col).alias("digest"))
                        .groupBy("digest", "doc_id").agg(F.count("*").alias("n")), "rows")
        batch = batch or batch_name(rows)
        groups = work.cut(rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size")),
                          "groups")
        index.fit(groups.count())
        index.append(groups, batch)
        # a text known from another batch keeps no row of this one
        found = work.cut(groups.drop("keep_id").join(index.read().hint("merge"), "digest")
                         .select("digest", "group_size", "keep_id", (F.col("batch") == batch).alias("is_own")), "found")
        copy = F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")
        out = (rows.join(found, "digest").select("*", copy)
               .select("doc_id", "keep_id", "group_size",
                       (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1) & F.col("is_own")).alias("kept"),
                       "digest"))
        return work.result(out)
