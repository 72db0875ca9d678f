"""Synthetic orders: a bounded batch and a rate-driven stream."""

from pyspark.sql import functions as F

from ..model import ORDERS_TOPIC, SEED_CURRENCIES, SEED_PROFILES, UNIT_AMOUNT_CENTS


def as_generated_orders(numbered, number="id", time=None, random_ids=True):
    """Turn a frame with a running number into orders.

    Row i is for customer i mod 4 in currency i mod 3, always of the unit amount.
    With `random_ids=False` the id is a fixed function of the number, so that
    runs can be compared.
    """
    i = F.col(number)
    customers = F.array(*[F.lit(p[0]) for p in SEED_PROFILES])
    currencies = F.array(*[F.lit(c) for c in SEED_CURRENCIES])
    at = F.col(time) if time else F.current_timestamp()
    order_id = F.uuid() if random_ids else F.md5(i.cast("string"))
    customer = F.element_at(customers, (F.pmod(i, F.lit(len(SEED_PROFILES))) + 1).cast("int"))
    currency = F.element_at(currencies, (F.pmod(i, F.lit(len(SEED_CURRENCIES))) + 1).cast("int"))
    return numbered.select(
        customer.alias("key"),
        F.lit(ORDERS_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        i.cast("bigint").alias("offset"),
        at.alias("timestamp"),
        order_id.alias("order_id"),
        customer.alias("customer_id"),
        F.lit(UNIT_AMOUNT_CENTS).cast("bigint").alias("amount_cents"),
        currency.alias("currency"),
        at.alias("placed_at"),
    )


def generate_orders(spark, n=10, random_ids=True):
    return as_generated_orders(spark.range(n), random_ids=random_ids)


def generate_orders_stream(spark, rows_per_second=1):
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return as_generated_orders(rate, number="value", time="timestamp")
