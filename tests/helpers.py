"""Small frames in the shared record form."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

BASE = datetime(2026, 5, 27, 10, 0, 0)


def at(minute=0, second=0, millis=0, base=BASE):
    return base + timedelta(minutes=minute, seconds=second, milliseconds=millis)


def orders(spark, rows):
    """Rows are (key, order_id, amount_cents, currency, timestamp); offsets follow the
    given order."""
    data = [(k, "orders-placed", 0, i, t, o, k, a, c, t) for i, (k, o, a, c, t) in enumerate(rows)]
    return spark.createDataFrame(
        data,
        "key string, topic string, partition int, offset bigint, timestamp timestamp_ntz,"
        "order_id string, customer_id string, amount_cents bigint, currency string,"
        "placed_at timestamp_ntz",
    )


def profiles(spark, rows):
    """Rows are (key, tier or None for a deletion, timestamp)."""
    data = [(k, "customer-profiles", 0, i, t, tier, tier is None) for i, (k, tier, t) in enumerate(rows)]
    return spark.createDataFrame(
        data,
        "key string, topic string, partition int, offset bigint, timestamp timestamp_ntz,"
        "tier string, deleted boolean",
    )


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return [tuple(r) for r in picked.collect()]


def plain_list(df, column):
    return [r[0] for r in df.select(F.col(column)).collect()]
