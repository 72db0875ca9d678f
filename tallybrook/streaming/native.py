"""Queries on Spark's own streaming state: watermarked windows and de-duplication.

Watermarks are looser than the strict rule: they are global, move at the end of a
batch and filter the next but one, so a record the strict rule drops can still be
counted. They need no order of arrival and no state of our own.
"""

from pyspark.sql import functions as F

from ..model import WINDOW, WINDOW_KEY
from ..operators.windows import aggregate_windows
from .batch_folders import read_batches, write_batch
from .run import for_each_batch


def windowed(enriched, delay="0 seconds", size=WINDOW, time="timestamp"):
    """Windowed totals of a stream of enriched orders."""
    return aggregate_windows(enriched.withWatermark(time, delay), size, time)


def write_updates(totals, path):
    """Changelog sink: each batch writes the windows it changed, once."""

    def handle(batch, batch_id):
        write_batch(batch, path, batch_id)

    return for_each_batch(totals, handle, "update")


def latest_windows(spark, path):
    """The changelog as a table: the newest totals of every window."""
    values = F.struct("order_count", "total_amount_cents")
    return (
        read_batches(spark, path)
        .groupBy(*WINDOW_KEY)
        .agg(F.max_by(values, "batch_id").alias("_newest"))
        .select(*WINDOW_KEY, "_newest.*")
    )


def write_rows(rows, path, partition_by=()):
    """Append sink of the rows of a stateful operator. The folder's own log names the files of
    finished batches, so that a repeated batch changes nothing and readers see whole ones."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_final(totals, path):
    """Each window once, when the watermark has passed its end."""
    return (
        totals.withColumn("window_date", F.to_date("window_start"))
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("window_date")
        .option("path", path)
    )


def first_occurrences(orders, delay="1 day", id_column="order_id", time="timestamp"):
    """Orders whose id has not been seen within the delay."""
    return orders.withWatermark(time, delay).dropDuplicatesWithinWatermark([id_column])


def pass_through(orders, name):
    """Smoke test: the raw stream in an in-memory table."""
    return (
        orders.select("order_id", "customer_id", "amount_cents", "currency", "placed_at")
        .writeStream.format("memory")
        .queryName(name)
    )
