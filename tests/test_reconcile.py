"""Streams of written and expected totals, whatever comes first."""

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import validate
from tallybrook.streaming.reconcile import reconcile_windows
from tests.helpers import at, rows
from tests.test_stateful import written
from tests.test_streaming import Feed

COLUMNS = (
    "customer_id string, tier string, currency string, window_start timestamp_ntz,"
    "window_end timestamp_ntz, order_count bigint, total_amount_cents bigint"
)


def totals(spark, data):
    """Rows are (customer, tier, window, count, cents), in the order of their arrival."""
    made = [(c, t, "EUR", at(5 * w), at(5 * w + 5), n, cents, i) for i, (c, t, w, n, cents) in enumerate(data)]
    return spark.createDataFrame(made, COLUMNS + ", nth int")


def beat(spark):
    return totals(spark, [(None, None, 10**6, None, None)]).drop("nth")


def found(spark, tmp_path, ours, theirs, cuts, lag, restarts=1):
    sides = []
    for name, frame in (("written", ours), ("expected", theirs)):
        feed = Feed(spark, tmp_path / name)
        for low, high in zip([0, *cuts], [*cuts, 10**9]):
            feed.add(frame.filter((F.col("nth") >= low) & (F.col("nth") < high)).drop("nth"))
        feed.add(beat(spark))
        sides.append(feed)
    return written(spark, lambda: reconcile_windows(*[s.stream() for s in sides], lag=lag), tmp_path / "out", restarts)


@pytest.mark.parametrize("cuts", [[], [2, 5, 9, 14]])
def test_streams_give_the_answer_of_the_tables(spark, tmp_path, cuts):
    """Missing, unexpected and different totals, out of order, equal windows of other customers, null tiers."""
    theirs = [(c, t, w, w + 1, 100 * w) for w in range(6) for c, t in (("a", "PRO"), ("b", None), ("c", "FREE"))]
    ours = [(c, t, w, n + (c == "a" and w == 2), cents) for c, t, w, n, cents in theirs if (c, w) != ("b", 4)]
    ours += [("d", "PRO", 1, 1, 5), ("a", "FREE", 5, 1, 5)]
    ours = [ours[i * 7 % len(ours)] for i in range(len(ours))]
    ours, theirs = totals(spark, ours), totals(spark, theirs)
    out = found(spark, tmp_path, ours, theirs, cuts, "2 hours", restarts=2)
    batch = validate.reconcile_windows(ours, theirs)
    assert sorted(rows(out.select(*batch.columns)), key=str) == sorted(rows(batch), key=str)
    assert sorted(rows(out, "customer_id", "verdict")) == [
        ("a", "different"), ("a", "unexpected"), ("b", "missing"), ("d", "unexpected"),
    ]


def test_a_total_later_than_the_lag_is_missing_once(spark, tmp_path):
    theirs = totals(spark, [("a", "PRO", w, 1, 1) for w in (0, 1, 50, 100, 150)])
    ours = totals(spark, [("a", "PRO", w, 1, 1) for w in (0, 50, 100, 150, 1)])
    out = found(spark, tmp_path, ours, theirs, [1, 2, 3, 4], "10 minutes")
    assert rows(out, "window_start", "verdict") == [(at(5), "missing")]
