"""Streams that keep nothing from one micro-batch to the next."""

from pyspark.sql import functions as F

from ..operators.enrich import current_tiers, enrich_current, with_reason
from .batch_folders import read_batches, write_batch
from .run import for_each_batch


def dead_letters(orders, path, read_history):
    """Write countable and rejected orders of each micro-batch, joined once.

    `read_history` is called on every micro-batch, so that the profiles are those of that moment.
    """

    def handle(batch, batch_id):
        judged = with_reason(enrich_current(batch, current_tiers(read_history())))
        marked = judged.withColumn("rejected", F.col("reason").isNotNull())
        write_batch(marked, path, batch_id, ["rejected"])

    return for_each_batch(orders, handle)


def read_dead_letters(spark, path):
    return read_batches(spark, path).filter(F.col("rejected").cast("boolean")).drop("rejected")
