"""Checks over orders and window records.

Both validators return every record with the list of rules it breaks. They report
all breaches and never stop at the first.
"""

from pyspark.sql import functions as F

from ..functions.clock import millis_between
from ..model import UNIT_AMOUNT_CENTS, WINDOW_KEY, WINDOW_MS
from ..plans.hot_keys import HOT_ROWS, find_hot_keys, mark_hot
from ..plans.running import BLOCK_ROWS, Fold, offset_block, running
from .duplicates import is_repeat, join_repeated, repeated_ids

# Rule names.
MISSING_ID = "missing order id"
KEY_MISMATCH = "key mismatch"
DUPLICATE_ID = "duplicate order id"
SUM = "sum"
DIMENSIONS = "dims"
WIDTH = "window width"
MONOTONIC = "non-monotonic"


def violations(*rules):
    """Array of the names whose condition is true. Rules are (name, broken)."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def validate_orders(records, hot_rows=HOT_ROWS, seen=None, folder=None):
    """Orders with `violations`. A null value is no record and is left out.

    `records` has a struct column `value` (order_id, customer_id, ...) and the
    envelope columns key and offset. `seen` (`_id`, `first_seen`) names ids from
    before these records; `folder` takes the table of repeated ids.
    """
    present = records.filter(F.col("value").isNotNull()).withColumn(
        "_id", F.nullif(F.col("value.order_id"), F.lit(""))
    )
    repeated = repeated_ids(present, "_id", "offset", seen, folder)
    # records without an id take no part in the join, however many there are
    named = join_repeated(
        present.filter(F.col("_id").isNotNull()), repeated, "_id", "left", hot_rows
    )
    unnamed = present.filter(F.col("_id").isNull())
    rows = named.unionByName(unnamed, allowMissingColumns=True)
    return rows.select(
        *records.columns,
        violations(
            (MISSING_ID, F.col("_id").isNull()),
            (KEY_MISMATCH, ~F.col("value.customer_id").eqNullSafe(F.col("key"))),
            (DUPLICATE_ID, is_repeat(records)),
        ).alias("violations"),
    )


def window_rules(previous_count, previous_total, unit_amount, width_ms):
    """The rules of a window record as (name, broken) pairs. A missing count, total or
    bound breaks the rule that needs it; the first record of a window has none before it."""
    dims = ("customer_id", "tier", "currency")
    same_dims = F.struct(*[F.col(f"value.{d}") for d in dims]).eqNullSafe(
        F.struct(*[F.col(f"key.{d}") for d in dims])
    )
    count, total = F.col("value.order_count"), F.col("value.total_amount_cents")
    return (
        (SUM, F.coalesce(total != count * F.lit(unit_amount), F.lit(True))),
        (DIMENSIONS, ~same_dims),
        (WIDTH, F.coalesce(millis_between("value.window_start", "value.window_end") != width_ms, F.lit(True))),
        (
            MONOTONIC,
            (count < previous_count)
            | (total < previous_total)
            | (count.isNull() & previous_count.isNotNull())
            | (total.isNull() & previous_total.isNotNull()),
        ),
    )


def validate_windows(
    records,
    unit_amount=UNIT_AMOUNT_CENTS,
    width_ms=WINDOW_MS,
    hot_rows=HOT_ROWS,
    block_rows=BLOCK_ROWS,
    seed=None,
):
    """Window records with `violations`, in offset order per (key, window start).

    `records` has struct columns `key` and `value`. The previous record of the
    same key and window start is the one to compare with, whether or not it broke
    a rule itself. Records with a null key or value are left out.
    """
    present = records.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
    rows = present.select(
        "*",
        F.col("key.customer_id").alias("_customer"),
        F.col("key.tier").alias("_tier"),
        F.col("key.currency").alias("_currency"),
        F.col("value.window_start").alias("_start"),
    )
    group = ["_customer", "_tier", "_currency", "_start"]
    folds = {
        "_previous": Fold(
            "last", F.struct(F.col("value.order_count"), F.col("value.total_amount_cents"))
        )
    }
    block = offset_block("offset", block_rows)
    if seed is not None:
        timed = running(rows, group, ["offset"], folds, block, seed=seed, inclusive=False)
    else:
        hot = find_hot_keys(rows, ["_customer"], hot_rows)
        if hot is None:
            timed = running(rows, group, ["offset"], folds, inclusive=False)
        else:
            rows = mark_hot(rows, ["_customer"], hot)
            timed = running(
                rows, group, ["offset"], folds, block, split=F.col("_hot"), inclusive=False
            )
    rules = window_rules(
        F.col("_previous.order_count"),
        F.col("_previous.total_amount_cents"),
        unit_amount,
        width_ms,
    )
    return timed.select(*records.columns, violations(*rules).alias("violations"))


def tally(validated):
    """How many records were checked and how many broke at least one rule."""
    return validated.agg(
        F.count(F.lit(1)).alias("validated"),
        F.count_if(F.size("violations") > 0).alias("failed"),
    )


def window_value_conflicts(windows):
    """Windows that occur with different totals (for outputs that are final only)."""
    return (
        windows.groupBy(*WINDOW_KEY)
        .agg(
            F.min("total_amount_cents").alias("lowest_cents"),
            F.max("total_amount_cents").alias("highest_cents"),
            F.count(F.lit(1)).alias("occurrences"),
        )
        .filter(F.col("lowest_cents") != F.col("highest_cents"))
    )


def differing(is_written, is_expected):
    """What is wrong between the written and the expected totals of a window, or null."""
    return (
        F.when(~F.coalesce(is_written, F.lit(False)), F.lit("missing"))
        .when(~F.coalesce(is_expected, F.lit(False)), F.lit("unexpected"))
        .when(
            (F.col("written_count") != F.col("expected_count"))
            | (F.col("written_cents") != F.col("expected_cents")),
            F.lit("different"),
        )
    )


def reconcile_windows(windows, expected):
    """Windows where the written totals differ from the recomputed ones.

    Both sides have one row per window. `verdict` is missing, unexpected or
    different.
    """
    counts = ["order_count", "total_amount_cents"]
    written = windows.select(*WINDOW_KEY, *counts).toDF(
        *WINDOW_KEY, "written_count", "written_cents"
    )
    recomputed = expected.select(*WINDOW_KEY, *counts).toDF(
        *WINDOW_KEY, "expected_count", "expected_cents"
    )
    measures = ["written_count", "written_cents", "expected_count", "expected_cents"]
    both = (
        written.unionByName(recomputed, allowMissingColumns=True)
        .groupBy(*WINDOW_KEY)
        .agg(*[F.max(m).alias(m) for m in measures])
    )
    verdict = differing(F.col("written_count").isNotNull(), F.col("expected_count").isNotNull())
    return both.withColumn("verdict", verdict).filter(F.col("verdict").isNotNull())
