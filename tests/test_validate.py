"""Validators, conflicts and reconciliation."""

import pytest
from pyspark.sql import functions as F

from tallybrook.functions.clock import from_epoch_millis, is_window_label, to_epoch_millis, window_label
from tallybrook.operators import duplicates, validate
from tests.helpers import at, rows

ORDER_RECORDS = "key string, value struct<order_id:string,customer_id:string>, offset bigint"


def test_order_rules(spark):
    frame = spark.createDataFrame(
        [
            ("a", ("o1", "a"), 0),
            ("a", ("", "a"), 1),
            ("a", (None, "a"), 2),
            ("a", ("o2", "b"), 3),
            ("a", ("o1", "a"), 4),
            (None, ("o3", None), 5),
            (None, ("o4", "a"), 6),
            ("a", None, 7),
        ],
        ORDER_RECORDS,
    )
    found = dict(rows(validate.validate_orders(frame), "offset", "violations"))
    assert found == {
        0: [],
        1: ["missing order id"],
        2: ["missing order id"],
        3: ["key mismatch"],
        4: ["duplicate order id"],
        5: [],
        6: ["key mismatch"],
    }
    assert rows(validate.tally(validate.validate_orders(frame))) == [(7, 5)]


def test_duplicates_point_to_the_first(spark):
    frame = spark.createDataFrame(
        [("x", 3), ("y", 4), ("x", 5), ("x", 9), (None, 10), (None, 11)],
        "order_id string, offset bigint",
    )
    assert sorted(rows(duplicates.duplicate_orders(frame))) == [("x", 5, 3), ("x", 9, 3)]


def test_duplicates_across_partitions(spark):
    frame = spark.createDataFrame(
        [("x", 0, 5), ("x", 1, 5), ("y", 1, 100), ("y", 0, 50), ("z", 0, 1)],
        "order_id string, partition int, offset bigint",
    )
    found = sorted(rows(duplicates.duplicate_orders(frame), "order_id", "partition", "offset"))
    assert found == [("x", 1, 5), ("y", 1, 100)]


def test_ids_seen_before_make_every_record_a_repeat(spark):
    frame = spark.createDataFrame(
        [("k", ("o1", "k"), 0, 50), ("k", ("o2", "k"), 0, 51)],
        "key string, value struct<order_id:string,customer_id:string>, partition int, offset bigint",
    )
    seen = spark.createDataFrame([("o1", 100)], "_id string, first_seen bigint")
    checked = dict(rows(validate.validate_orders(frame, seen=seen), "offset", "violations"))
    assert checked == {50: ["duplicate order id"], 51: []}


DIMS = "struct<customer_id:string,tier:string,currency:string>"
VALUE = (
    "struct<customer_id:string,tier:string,currency:string,window_start:timestamp_ntz,"
    "window_end:timestamp_ntz,order_count:bigint,total_amount_cents:bigint>"
)
KEY = ("alice", "FREE", "HUF")

# (count, total, tier in the value, window end, expected violations)
CASES = [
    (1, 4242, "FREE", at(5), []),
    (2, 8484, "FREE", at(5), []),
    (2, 8484, "FREE", at(5), []),
    (1, 4242, "FREE", at(5), ["non-monotonic"]),
    (2, 8484, "FREE", at(5), []),
    (3, 12000, "FREE", at(5), ["sum"]),
    (3, 12726, "PRO", at(5), ["dims"]),
    (3, 12726, "FREE", at(10), ["window width"]),
    (3, 12000, "PRO", at(5), ["sum", "dims", "non-monotonic"]),
]


def window_records(spark):
    data = [
        (KEY, ("alice", tier, "HUF", at(), end, count, total), i)
        for i, (count, total, tier, end, _) in enumerate(CASES)
    ]
    data += [(KEY, None, len(CASES)), (None, data[0][1], len(CASES) + 1)]
    return spark.createDataFrame(data, f"key {DIMS}, value {VALUE}, offset bigint")


@pytest.mark.parametrize("limits", [{}, {"hot_rows": 2, "block_rows": 2}])
def test_window_rules(spark, limits):
    checked = validate.validate_windows(window_records(spark), **limits)
    found = dict(rows(checked, "offset", "violations"))
    assert found == {i: case[-1] for i, case in enumerate(CASES)}
    assert rows(validate.tally(checked)) == [(9, 5)]


def windows_frame(spark, data):
    return spark.createDataFrame(
        [(*KEY, at(m), at(m + 5), n, cents) for m, n, cents in data],
        "customer_id string, tier string, currency string, window_start timestamp_ntz,"
        "window_end timestamp_ntz, order_count bigint, total_amount_cents bigint",
    )


def test_conflicting_values(spark):
    frame = windows_frame(spark, [(0, 1, 10), (0, 1, 10), (5, 1, 10), (5, 2, 20)])
    out = validate.window_value_conflicts(frame)
    assert rows(out, "window_start", "lowest_cents", "highest_cents", "occurrences") == [
        (at(5), 10, 20, 2)
    ]


def test_reconciliation(spark):
    written = windows_frame(spark, [(0, 1, 10), (5, 2, 20), (15, 1, 1)])
    expected = windows_frame(spark, [(0, 1, 10), (5, 2, 21), (10, 1, 10)])
    out = validate.reconcile_windows(written, expected)
    assert sorted(rows(out, "window_start", "verdict")) == [
        (at(5), "different"),
        (at(10), "missing"),
        (at(15), "unexpected"),
    ]


def test_window_labels(spark):
    frame = windows_frame(spark, [(0, 1, 10)]).withColumn("label", window_label())
    assert rows(frame, "label", is_window_label("label")) == [("alice@2026-05-27T10:00:00Z", True)]
    wrong = spark.createDataFrame([("alice",), ("@2026-05-27T10:00:00Z",), ("a@yesterday",)], "label string")
    assert rows(wrong, is_window_label("label")) == [(False,)] * 3


def test_epoch_millis_round_trip(spark):
    frame = spark.createDataFrame([(1_779_876_000_123,)], "ms bigint")
    back = frame.withColumn("ts", from_epoch_millis(F.col("ms"))).withColumn("b", to_epoch_millis("ts"))
    assert rows(back, "b") == [(1_779_876_000_123,)]


def test_a_very_frequent_id_is_broadcast(spark):
    frame = spark.createDataFrame(
        [("hot", i) for i in range(50)] + [("two", 60), ("two", 61), ("one", 70)],
        "order_id string, offset bigint",
    )
    plain = duplicates.duplicate_orders(frame)
    split = duplicates.duplicate_orders(frame, hot_rows=10)
    assert split.count() == 50
    assert sorted(rows(plain)) == sorted(rows(split.select(*plain.columns)))
    records = frame.selectExpr(
        "'k' as key", "named_struct('order_id', order_id, 'customer_id', 'k') as value", "offset"
    )
    checked = validate.validate_orders(records, hot_rows=10)
    assert rows(validate.tally(checked)) == [(53, 50)]
