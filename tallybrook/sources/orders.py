"""Order readers, the envelope scan and reader-schema resolution."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.wire import decode_key
from ..model import ORDER_FIELDS, ORDER_PAYLOAD, ORDERS


def read_orders(spark, path):
    """Bounded read of an orders table (envelope and payload columns)."""
    return spark.read.schema(ORDERS).parquet(path)


def stream_orders(spark, path, files_per_trigger=None, schema=ORDERS):
    """Unbounded read of a folder of order files, from the earliest file on.

    `files_per_trigger` bounds the size of a micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def scan_orders(orders):
    """One line per record: where it was read from and what it says."""
    return orders.select(
        decode_key("key").alias("key"),
        "order_id",
        "amount_cents",
        "currency",
        "placed_at",
        "partition",
        "offset",
    )


def skip_tombstones(df, *columns):
    """Drop records whose key or value is null."""
    return reduce(lambda d, c: d.filter(F.col(c).isNotNull()), columns, df)


def conform(df, reader=ORDER_PAYLOAD):
    """Resolve a writer's columns against the reader schema: (accepted, rejected).

    A column the writer does not have takes the reader's default. Without a
    default the writer is unreadable: all its records are rejected. Null values in
    columns the writer does have stay as they are, and columns the reader does not
    know are ignored.
    """
    written = set(df.columns)
    payload = {f.name for f in ORDER_FIELDS} | {f.name for f in reader.fields}
    envelope = [c for c in ORDERS.fieldNames() if c in written and c not in payload]
    missing = [
        f.name for f in reader.fields if f.name not in written and "default" not in f.metadata
    ]
    if missing:
        reason = "missing required field: " + ", ".join(missing)
        accepted = df.filter(F.lit(False)).select(
            *envelope, *[F.lit(None).cast(f.dataType).alias(f.name) for f in reader.fields]
        )
        return accepted, df.withColumn("reason", F.lit(reason))
    accepted = df.select(
        *envelope,
        *[
            F.col(f.name) if f.name in written else F.lit(f.metadata["default"]).alias(f.name)
            for f in reader.fields
        ],
    )
    return accepted, df.filter(F.lit(False)).withColumn("reason", F.lit(None).cast("string"))


def conform_all(writers, reader=ORDER_PAYLOAD):
    """`conform` over several writer versions, united by column name."""
    pairs = [conform(df, reader) for df in writers]
    unite = lambda a, b: a.unionByName(b, allowMissingColumns=True)
    return reduce(unite, [p[0] for p in pairs]), reduce(unite, [p[1] for p in pairs])
