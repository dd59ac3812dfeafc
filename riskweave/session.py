"""Session helpers: time zone contract, checkpoint directory, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# The reference works in UTC throughout (hour-of-day, clock-hour buckets).
SESSION_TZ = "UTC"
#: Largest table that Spark itself may choose to broadcast.  The choice goes by written (compressed) bytes; in memory the
#: relation is some 25 times that, and it passes through the driver, so the default of 10 MB is up to 250 MB a join.
BROADCAST_BYTES = 1 << 20
#: Shuffled bytes that a task is given where Spark puts partitions together.  The default of 64 MB is gigabytes of sorted rows in a
#: task that joins several wide tables; this bounds its memory however large the tables are.
TASK_BYTES = 8 << 20


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone (hour() and date_trunc() depend on it), bound memory and send the package to the workers."""
    ship_package(spark)
    bound_memory(spark)
    if spark.conf.get("spark.sql.session.timeZone", None) != SESSION_TZ:
        spark.conf.set("spark.sql.session.timeZone", SESSION_TZ)


def bound_memory(spark: SparkSession) -> None:
    """No broadcast above ``BROADCAST_BYTES`` but by an explicit hint, planned or chosen while running, and no task that is
    put together of more than ``TASK_BYTES``; smaller settings of the session stay."""
    conf = spark._jsparkSession.sessionState().conf()
    if conf.autoBroadcastJoinThreshold() > BROADCAST_BYTES:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(BROADCAST_BYTES))
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")           # then the one above holds
    task = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(task) > TASK_BYTES:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{TASK_BYTES}b")


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Functions that run in workers are pickled by reference, so workers must be
    able to import them; ``addPyFile`` sends a zip through Spark's own file
    distribution, whatever the working folder or ``PYTHONPATH``.
    """
    sc = spark.sparkContext
    if getattr(sc, "_riskweave_shipped", False):
        return
    package = Path(__file__).resolve().parent
    if package.suffix == ".zip" or not package.is_dir():        # already run from a shipped zip
        return
    target = os.path.join(tempfile.mkdtemp(prefix="riskweave-zip-"), "riskweave-package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*")):
            if file.is_file() and "__pycache__" not in file.parts:
                out.write(file, file.relative_to(package.parent))
    sc.addPyFile(target)
    sc._riskweave_shipped = True


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "riskweave", driver_memory: str | None = "8g") -> SparkSession:
    """A local session with the settings the tests and bench use.

    On a cluster, build the session with the cluster's own settings and only
    call :func:`ensure_utc`.
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", SESSION_TZ)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        b = b.master(master)
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; create a scratch one only
    when the session has none and runs in local mode (tests).  On a cluster
    a missing setting is an error: executors cannot share a local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder every executor "
                               "can reach (HDFS, object store) before running riskweave jobs")
        configured = tempfile.mkdtemp(prefix="riskweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once as Parquet under the shared checkpoint
    directory and continue from the written table.

    Used at reuse points so later stages (and a lost executor) start from the
    written files, not from the raw scan.  One computation (a reliable
    ``checkpoint()`` of an unpersisted plan computes it twice); never a local
    checkpoint.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/riskweave-tables/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
