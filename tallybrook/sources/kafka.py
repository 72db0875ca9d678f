"""Topics as source and sink.

These functions need Spark's Kafka and Avro packages on the class path.
"""

from pyspark.sql import functions as F

from ..functions.wire import MAGIC, PREFIX_BYTES, decode_key


def stream_topic(spark, servers, topic, offsets_per_trigger=None):
    """Raw records of a topic: from the earliest offset, committed records only.

    `offsets_per_trigger` bounds the size of a micro-batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("kafka.isolation.level", "read_committed")
    )
    if offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return reader.load()


def decode_records(raw, avro_schema):
    """Envelope columns and the decoded `record` of prefixed Avro values."""
    from pyspark.sql.avro.functions import from_avro

    body = F.substring(F.col("value"), F.lit(PREFIX_BYTES + 1), F.length("value"))
    return raw.filter(F.col("value").isNotNull()).select(
        decode_key("key").alias("key"),
        "topic",
        "partition",
        "offset",
        "timestamp",
        from_avro(body, avro_schema).alias("record"),
    )


def encode_records(records, key_schema, value_schema, key_id, value_id):
    """Key and value structs as prefixed Avro bytes, ready for the topic sink."""
    from pyspark.sql.avro.functions import to_avro

    def encoded(column, schema, schema_id):
        prefix = F.unhex(F.lit(f"{MAGIC:02X}{schema_id:08X}"))
        return F.concat(prefix, to_avro(F.col(column), schema)).alias(column)

    return records.select(
        encoded("key", key_schema, key_id), encoded("value", value_schema, value_id)
    )


def write_topic(encoded, servers, topic):
    """Topic sink. Spark delivers to topics at least once: a repeated batch appears
    twice. For exactly-once results use the table sinks."""
    return (
        encoded.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .outputMode("update")
    )
