"""Orders joined with the profile version that held for them."""

from pyspark.sql import functions as F

from ..plans.asof import lookup_asof
from ..plans.hot_keys import HOT_ROWS
from ..plans.running import BLOCK_ROWS, Fold, offset_block, running
from .enrich import current_tiers, enrich_current, enrichment


def _versions(history):
    """Versions as structs that are never null: a deletion holds a null tier, and
    so hides the version before it."""
    tier = F.when(~F.coalesce(F.col("deleted"), F.lit(False)), F.col("tier"))
    return history.withColumn("_profile", F.struct(tier.alias("tier")))


def enrich_asof(orders, history, hot_rows=HOT_ROWS, block_rows=BLOCK_ROWS):
    """Each order with the profile version valid at its record timestamp.

    A version with the same timestamp as the order counts as valid.
    """
    matched = lookup_asof(
        orders,
        _versions(history).select("key", "timestamp", "offset", "_profile"),
        key="key",
        time="timestamp",
        payload="_profile",
        hot_rows=hot_rows,
        block_rows=block_rows,
    )
    return enrichment(matched.withColumn("tier", F.col("_profile.tier")))


def with_clock(records, queue=("offset",), block_rows=BLOCK_ROWS):
    """Add `clock`: the highest timestamp seen in the partition up to the record.

    `queue` gives the order of records within their partition.
    """
    return running(
        records,
        group=["partition"],
        order=list(queue),
        folds={"clock": Fold("max", F.col("timestamp"))},
        block=offset_block(queue[0], block_rows),
    )


def enrich_replay(
    orders,
    history,
    table_first=False,
    queue=("offset",),
    hot_rows=HOT_ROWS,
    block_rows=BLOCK_ROWS,
):
    """Each order with the profile that had been processed before it.

    A task reads one partition of both inputs and always takes the record with the
    lowest timestamp at the head of its queue. That is the order of the running
    maximum timestamp of each queue. Ties go to the profile. An order older than
    every profile finds none, whatever the profile table holds later.

    With `table_first` all profiles are processed before any order, which is the
    join with the newest profiles.
    """
    if table_first:
        return enrich_current(orders, current_tiers(history), hot_rows)
    versions = with_clock(_versions(history), block_rows=block_rows)
    matched = lookup_asof(
        with_clock(orders, queue, block_rows),
        versions.select("key", "clock", "offset", "_profile"),
        key="key",
        time="clock",
        payload="_profile",
        hot_rows=hot_rows,
        block_rows=block_rows,
    )
    return enrichment(matched.withColumn("tier", F.col("_profile.tier")))
