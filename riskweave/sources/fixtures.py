"""Users / transactions views derived from the driver's generic tables.

The reference reads four tables (train/test users and transactions).  The
test data here is a TPC-H-like star schema plus an ``events`` table; the
mapping below (documented in FIXTURES.md) turns ``customer``+``nation`` into
users and ``events`` into card transactions.  Everything is a DataFrame
expression, so the views scale with the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc

# Fixed values of the fixture mapping (FIXTURES.md §3), kept together.
EMAIL_NAMES = ["anna", "Oleh", "maria", "x"]                    # by id % 4
HOLDER_NAMES = ["anna koval", "OLEH BONDAR", " maria  li ", "Anna Shevchenko"]  # by cb % 4
CARD_BRANDS = ["VISA", "MASTERCARD", "AMEX"]                    # by cb % 3
CURRENCIES = ["USD", "EUR", "UAH"]                              # by k % 3
ERROR_BY_K = [(15, "antifraud"), (30, "fraud"), (45, "3ds error"), (60, "card problem"),
              (75, "cvv error"), (90, "insufficient funds error")]  # else "do not honor"
TX_TYPE_BY_EVENT = [("signup", "card_init"), ("purchase", "card_recurring"),
                    ("click", "apple-pay"), ("view", "google-pay")]  # else "resign"
REG_BASE = "2023-12-20 00:00:00"
TEST_MOD, TEST_REM = 5, 4          # test users: id_user % 5 = 4


def _pick(idx: Column, values: list[str]) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(idx == i, F.lit(v)) if out is None else out.when(idx == i, F.lit(v))
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users (train and test), with ``is_fraud``."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    i = F.col("c_custkey")
    dom = (F.when(i % 7 <= 2, "mail.example").when(i % 7 <= 4, "post.example")
           .when(i % 7 == 5, "corp.example").otherwise("rare.example"))
    email = F.when(i % 17 == 3, F.lit(None).cast("string")).otherwise(
        F.concat(_pick(i % 4, EMAIL_NAMES), i.cast("string"), F.lit("@"), dom))
    gender = F.when(i % 11 == 0, F.lit(None).cast("string")).when(i % 2 == 0, "F").otherwise("M")
    reg = F.timestamp_seconds(F.unix_timestamp(F.lit(REG_BASE)) + (i % 20) * 86400)
    fraud = F.when((i % 13 == 0) | (i % 29 == 7), 1).otherwise(0).cast("int")
    # nation has 25 rows: a broadcast side of fixed size.
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .select(i.alias("id_user"), email.alias("email"), gender.alias("gender"),
                    F.col("n_name").alias("reg_country"), F.col("c_mktsegment").alias("traffic_type"),
                    reg.alias("timestamp_reg"), fraud.alias("is_fraud")))


def transactions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All card transactions, one per event; ``id_tx`` is the tie-break."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    u = F.col("user_id")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    f = (u % 13 == 0) | (u % 29 == 7)
    cg = F.when(k % 3 == 0, F.floor(u / 3).cast("bigint")).otherwise(F.lit(1000000) + u)
    cb = F.when(u % 13 == 0, k % 12).otherwise(k % (F.lit(1) + u % 6))
    nul = F.lit(None).cast("string")
    return (ev.select("event_id", "ts", "user_id", "value", "event_type",
                      k.alias("k"), f.alias("f"), cg.alias("cg"), cb.alias("cb"))
            .withColumn("bad", (F.col("event_type") == "error") | (F.col("f") & (F.col("k") < 35)))
            .select(
                F.col("event_id").alias("id_tx"), F.col("user_id").alias("id_user"),
                F.col("ts").cast("timestamp").alias("timestamp_tr"), F.col("value").alias("amount"),
                F.when(F.col("bad"), "fail").otherwise("success").alias("status"),
                F.when(F.col("bad"), _error_group()).otherwise(nul).alias("error_group"),
                _tx_type().alias("transaction_type"),
                F.when(F.col("k") == 99, nul).otherwise(
                    F.concat(F.lit("card_"), F.col("cg").cast("string"), F.lit("_"),
                             F.col("cb").cast("string"))).alias("card_mask_hash"),
                F.when(F.col("k") % 50 == 49, nul).otherwise(
                    _pick(F.col("cb") % 4, HOLDER_NAMES)).alias("card_holder"),
                _pick(F.col("cb") % 3, CARD_BRANDS).alias("card_brand"),
                F.when(F.col("cb") % 2 == 0, "DEBIT").otherwise("CREDIT").alias("card_type"),
                F.when(F.col("k") % 33 == 32, nul).otherwise(_cc()).alias("card_country"),
                F.when(F.col("k") % 41 == 40, nul)
                 .when(F.col("k") % 4 == 0, F.concat(F.lit("NATION_"), (F.col("k") % 25).cast("string")))
                 .otherwise(_cc()).alias("payment_country"),
                _pick(F.col("k") % 3, CURRENCIES).alias("currency")))


def _cc() -> Column:
    return F.concat(F.lit("NATION_"), ((F.col("cg") + F.col("cb")) % 25).cast("string"))


def _error_group() -> Column:
    out = None
    for bound, name in ERROR_BY_K:
        out = F.when(F.col("k") < bound, name) if out is None else out.when(F.col("k") < bound, name)
    return out.otherwise("do not honor")


def _tx_type() -> Column:
    out = None
    for ev_name, t in TX_TYPE_BY_EVENT:
        c = F.col("event_type") == ev_name
        out = F.when(c, t) if out is None else out.when(c, t)
    return out.otherwise("resign")


def is_test_user(id_col: Column) -> Column:
    return id_col % TEST_MOD == TEST_REM


@dataclass
class Fixture:
    """The four reference inputs, derived lazily from the driver tables."""
    users: DataFrame            # all users, with is_fraud
    transactions: DataFrame     # all transactions

    @property
    def train_users(self) -> DataFrame:
        return self.users.filter(~is_test_user(F.col("id_user")))

    @property
    def test_users(self) -> DataFrame:
        return self.users.filter(is_test_user(F.col("id_user"))).drop("is_fraud")

    @property
    def train_transactions(self) -> DataFrame:
        return self.transactions.filter(~is_test_user(F.col("id_user")))

    @property
    def test_transactions(self) -> DataFrame:
        return self.transactions.filter(is_test_user(F.col("id_user")))


def load_fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    ensure_utc(spark)
    return Fixture(users_view(spark, sf_dir), transactions_view(spark, sf_dir))
