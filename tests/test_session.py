"""Bounds of the session: broadcasts and what a task is put together of."""

from pyspark.sql import functions as F

from riskweave import session

KEYS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def _with(spark, values, run):
    before = {k: spark.conf.get(k, None) for k in KEYS}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        session.ensure_utc(spark)
        return run()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_table_of_megabytes_is_not_broadcast(spark, tmp_path):
    # 3 MB written, below Spark's own threshold of 10 MB
    big = spark.range(400_000).select("id", F.xxhash64("id").alias("h"))
    big.write.parquet(str(tmp_path / "a"))

    def plan():
        a = spark.read.parquet(str(tmp_path / "a"))
        return a.join(a.withColumnRenamed("h", "g"), "id")._jdf.queryExecution().executedPlan().toString()

    got = _with(spark, {KEYS[0]: "10m", KEYS[1]: "10m"}, plan)
    assert "BroadcastHashJoin" not in got and "SortMergeJoin" in got


def test_larger_settings_are_bounded_and_smaller_ones_stay(spark):
    def now():
        return [spark.conf.get(k, None) for k in (KEYS[0], KEYS[2])]

    assert _with(spark, {KEYS[0]: "20m", KEYS[2]: "64m"}, now) == [str(session.BROADCAST_BYTES), f"{session.TASK_BYTES}b"]
    low = _with(spark, {KEYS[0]: "-1", KEYS[2]: "2m"}, now)
    assert low[0] == "-1" and low[1] in ("2m", str(2 << 20), f"{2 << 20}b")
