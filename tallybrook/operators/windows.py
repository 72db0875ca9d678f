"""Tumbling-window totals, their changelog, lateness and retention."""

from pyspark.sql import functions as F

from ..functions.clock import window_bounds, with_window
from ..model import DIMS, RETENTION_MS, WINDOW, WINDOW_KEY
from ..plans.hot_keys import DETECT, HOT_ROWS, find_hot_keys, mark_hot
from ..plans.running import BLOCK_ROWS, Fold, offset_block, running


def rekey(enriched, size=WINDOW, time="timestamp"):
    """Group columns of the aggregate. The customer is the message key."""
    return with_window(enriched.withColumnRenamed("key", "customer_id"), time, size)


def aggregate_windows(enriched, size=WINDOW, time="timestamp"):
    """Final count and sum per customer, tier, currency and window.

    Works on streams too: grouping by the window itself keeps its watermark.
    """
    return (
        enriched.withColumnRenamed("key", "customer_id")
        .groupBy(*DIMS, F.window(time, size).alias("_w"))
        .agg(
            F.sum("order_count").alias("order_count"),
            F.sum("total_amount_cents").alias("total_amount_cents"),
        )
        .select(*DIMS, *window_bounds("_w"), "order_count", "total_amount_cents")
    )


def orders_per_window(orders, current, size=WINDOW, time="timestamp"):
    """`aggregate_windows` of the orders joined with their current profile.

    The tier depends on the key alone, so orders are summed per key, currency and
    window first and the join sees one row per sum: a customer with very many
    orders is reduced in the map tasks and never meets the join as single rows.
    """
    sums = (
        orders.filter(F.col("key").isNotNull())
        .groupBy("key", "currency", F.window(time, size).alias("_w"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("amount_cents").alias("total_amount_cents"),
        )
    )
    profiles = current.filter(F.col("tier").isNotNull()).select("key", "tier")
    return sums.join(profiles, "key").select(
        F.col("key").alias("customer_id"),
        "tier",
        "currency",
        *window_bounds("_w"),
        "order_count",
        "total_amount_cents",
    )


def window_changelog(
    enriched,
    size=WINDOW,
    time="timestamp",
    hot=DETECT,
    hot_rows=HOT_ROWS,
    block_rows=BLOCK_ROWS,
    seed=None,
):
    """One row per order: the totals of its window right after it, in offset order.

    A group lies within one customer, so a cheap count per customer finds the
    groups that may be too large for a task; those are cut into offset blocks.
    `hot` takes the hot keys of the orders before the join, where that is cheaper.
    `seed` holds totals from before these orders.
    """
    rows = rekey(enriched, size, time)
    folds = {
        "running_count": Fold("sum", F.col("order_count")),
        "running_cents": Fold("sum", F.col("total_amount_cents")),
    }
    if seed is not None:
        out = running(
            rows, WINDOW_KEY, ["offset"], folds, offset_block("offset", block_rows), seed=seed
        )
    else:
        if hot is DETECT:
            hot = find_hot_keys(enriched, ["key"], hot_rows)
        if hot is None:
            out = running(rows, WINDOW_KEY, ["offset"], folds)
        else:
            out = running(
                mark_hot(rows, ["customer_id"], hot.toDF("customer_id")),
                WINDOW_KEY,
                ["offset"],
                folds,
                offset_block("offset", block_rows),
                split=F.col("_hot"),
            )
    return out.select(
        *WINDOW_KEY,
        F.col("running_count").alias("order_count"),
        F.col("running_cents").alias("total_amount_cents"),
        "order_id",
        "partition",
        "offset",
        "timestamp",
    )


def judge_lateness(
    records,
    size=WINDOW,
    grace="0 seconds",
    scope=("partition",),
    arrival=("offset",),
    time="timestamp",
    block_rows=BLOCK_ROWS,
    seed=None,
):
    """Add `stream_time` and `late` under the strict rule.

    Stream time is the highest timestamp seen so far in the scope, this record
    included. A record is late when its window, plus grace, has ended by then. It
    is judged on its own, at once: unlike a watermark nothing waits for the end of
    a batch, and a scope does not wait for the others.

    Scopes are few and large, so they are always cut into blocks of arrival
    numbers (`arrival[0]`), each scanned by itself.

    Orders without a profile must be dropped before: they do not reach the
    aggregate and do not advance its clock.
    """
    timed = running(
        records,
        group=list(scope),
        order=list(arrival),
        folds={"stream_time": Fold("max", F.col(time))},
        block=offset_block(arrival[0], block_rows),
        seed=seed,
    )
    end = with_window(timed, time, size)
    closed = F.col("window_end") + F.expr(f"interval {grace}") <= F.col("stream_time")
    return end.withColumn("late", closed)


def drop_late(records, **rule):
    """Records that are in time under the strict rule."""
    judged = judge_lateness(records, **rule).filter(~F.col("late"))
    return judged.select(*records.columns)


def late_records(records, **rule):
    """Records the strict rule drops."""
    judged = judge_lateness(records, **rule).filter("late")
    return judged.select(*records.columns, "window_end", "stream_time")


def retained(windows, records, retention_ms=RETENTION_MS, time="timestamp"):
    """Windows still kept when the newest record of `records` has been seen."""
    newest = records.agg(F.max(time)).scalar()
    keep_for = F.expr(f"interval {int(retention_ms)} milliseconds")
    return windows.filter(F.col("window_end") + keep_for > newest)


def as_records(windows):
    """Key and value structs of the output topic."""
    key = F.struct(F.col("customer_id").alias("customerId"), "tier", "currency")
    value = F.struct(
        F.col("customer_id").alias("customerId"),
        "tier",
        "currency",
        F.col("window_start").alias("windowStartMs"),
        F.col("window_end").alias("windowEndMs"),
        F.col("order_count").alias("orderCount"),
        F.col("total_amount_cents").alias("totalAmountCents"),
    )
    rest = [c for c in ("partition", "offset", "timestamp") if c in windows.columns]
    return windows.select(key.alias("key"), value.alias("value"), *rest)


def write_windows(windows, path, mode="overwrite"):
    """Batch sink, one folder per day of window start.

    The rebalance hint lets adaptive execution size the files: small days are
    merged, large ones split over several tasks.
    """
    (
        windows.withColumn("window_date", F.to_date("window_start"))
        .hint("rebalance", "window_date")
        .write.mode(mode)
        .partitionBy("window_date")
        .parquet(path)
    )
