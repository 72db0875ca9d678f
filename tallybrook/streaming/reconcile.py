"""Checking a stream of written totals against a stream of recomputed ones."""

from pyspark.sql import functions as F

from ..model import WINDOW_KEY
from ..operators.validate import differing


def _side(totals, name, lag):
    """One side of the join under its own names, its windows timed by their end."""
    columns = [F.col(c).alias(f"{name}_{c}") for c in WINDOW_KEY]
    counts = [F.col("order_count").alias(f"{name}_count"), F.col("total_amount_cents").alias(f"{name}_cents")]
    ends = F.col("window_end").cast("timestamp").alias(f"{name}_ends")
    return totals.select(*columns, *counts, F.lit(True).alias(f"{name}_there"), ends).withWatermark(f"{name}_ends", lag)


def reconcile_windows(written, expected, lag="7 days"):
    """`validate.reconcile_windows` of two streams, each with one row per window.

    A full outer join in Spark's own state. A pair is judged as soon as both rows are there,
    whichever comes first. A window that only one side has is missing or unexpected when both
    streams have passed its end by `lag`; then it leaves the state, so that state covers a `lag` of
    windows, not the history. A total that comes later than that is dropped. The last windows
    come out when later totals of both streams, or heartbeats (rows without a customer, which
    give nothing out), move the time on. Null tiers and currencies are values like others.
    """
    ours, theirs = _side(written, "written", lag), _side(expected, "expected", lag)
    same = F.col("written_ends") == F.col("expected_ends")
    for c in WINDOW_KEY:
        same = same & F.col(f"written_{c}").eqNullSafe(F.col(f"expected_{c}"))
    both = ours.join(theirs, same, "full_outer")
    kind = dict(written.dtypes)
    judged = both.select(
        *[F.coalesce(f"written_{c}", f"expected_{c}").cast(kind[c]).alias(c) for c in WINDOW_KEY],
        "written_count", "written_cents", "expected_count", "expected_cents",
        differing(F.col("written_there"), F.col("expected_there")).alias("verdict"),
    )
    return judged.filter(F.col("customer_id").isNotNull() & F.col("verdict").isNotNull())
