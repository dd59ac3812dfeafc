import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[*]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rw-test-ckpt-"))
    yield spark


TX_SCHEMA = ("id_tx long, id_user long, timestamp_tr timestamp, amount double, status string, error_group string, "
             "transaction_type string, card_mask_hash string, card_holder string, card_brand string, "
             "card_type string, card_country string, payment_country string, currency string")
USER_SCHEMA = ("id_user long, email string, gender string, reg_country string, traffic_type string, "
               "timestamp_reg timestamp, is_fraud int")


def make_tx(spark, rows):
    """rows: dicts with any subset of the transaction columns."""
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    cols = [c.split()[0] for c in TX_SCHEMA.split(", ")]
    out = []
    for i, r in enumerate(rows):
        d = {"id_tx": i, "id_user": 1, "timestamp_tr": base + dt.timedelta(minutes=10 * i), "amount": 10.0,
             "status": "success", "error_group": None, "transaction_type": "card_init",
             "card_mask_hash": "c1", "card_holder": "anna koval", "card_brand": "VISA", "card_type": "DEBIT",
             "card_country": "UA", "payment_country": "UA", "currency": "USD"}
        d.update(r)
        out.append(tuple(d[c] for c in cols))
    return spark.createDataFrame(out, TX_SCHEMA)


def make_users(spark, rows):
    import datetime as dt
    cols = [c.split()[0] for c in USER_SCHEMA.split(", ")]
    out = []
    for r in rows:
        d = {"id_user": 1, "email": "anna@mail.example", "gender": "F", "reg_country": "UA",
             "traffic_type": "organic", "timestamp_reg": dt.datetime(2023, 12, 1), "is_fraud": 0}
        d.update(r)
        out.append(tuple(d[c] for c in cols))
    return spark.createDataFrame(out, USER_SCHEMA)
