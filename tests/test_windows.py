"""Window totals, changelog, retention and record form."""

from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook.model import RETENTION_MS, WINDOW_KEY
from tallybrook.operators import enrich, windows
from tallybrook.sources.generators import generate_orders
from tallybrook.sources.profiles import seed_profiles
from tests.helpers import BASE, at, orders, profiles, rows

ALICE = [("alice", "FREE", at())]


def enriched(spark, order_rows, profile_rows=ALICE):
    current = enrich.latest_by_key(profiles(spark, profile_rows))
    return enrich.drop_unmatched(enrich.enrich_current(orders(spark, order_rows), current))


TWICE = [("alice", "o1", 4242, "HUF", at()), ("alice", "o1", 4242, "HUF", at(second=30))]


def test_same_order_twice_counts_twice(spark):
    out = windows.aggregate_windows(enriched(spark, TWICE))
    assert rows(out) == [("alice", "FREE", "HUF", at(), at(5), 2, 8484)]


def test_changelog_shows_every_step(spark):
    out = windows.window_changelog(enriched(spark, TWICE)).orderBy("offset")
    assert rows(out, "customer_id", "tier", "currency", "order_count", "total_amount_cents") == [
        ("alice", "FREE", "HUF", 1, 4242),
        ("alice", "FREE", "HUF", 2, 8484),
    ]


def test_window_follows_record_time_not_placed_at(spark):
    frame = orders(spark, TWICE).withColumn("placed_at", F.lit(at(30)))
    current = enrich.latest_by_key(profiles(spark, ALICE))
    assert rows(windows.orders_per_window(frame, current), "window_start") == [(at(),)]


def test_customer_is_the_message_key(spark):
    frame = orders(spark, TWICE).withColumn("customer_id", F.lit("mallory"))
    current = enrich.latest_by_key(profiles(spark, ALICE))
    assert rows(windows.orders_per_window(frame, current), "customer_id") == [("alice",)]


def test_generated_batch_gives_one_order_per_group(spark):
    made = generate_orders(spark, 10).withColumn("timestamp", F.lit(at()).cast("timestamp_ntz"))
    assert made.select("order_id").distinct().count() == 10
    current = enrich.latest_by_key(seed_profiles(spark))
    out = rows(windows.orders_per_window(made, current), "order_count", "total_amount_cents")
    assert out == [(1, 4242)] * 10


def test_boundary_opens_a_new_window(spark):
    out = windows.aggregate_windows(
        enriched(
            spark,
            [
                ("alice", "a", 1, "EUR", at(4, 59, 999)),
                ("alice", "b", 1, "EUR", at(5)),
            ],
        )
    )
    assert sorted(rows(out, "window_start", "order_count")) == [(at(), 1), (at(5), 1)]


def test_unmatched_and_keyless_orders_are_not_counted(spark):
    frame = orders(
        spark, [("alice", "a", 1, "EUR", at()), ("bob", "b", 1, "EUR", at()), (None, "c", 1, "EUR", at())]
    )
    current = enrich.latest_by_key(profiles(spark, ALICE))
    assert windows.orders_per_window(frame, current).count() == 1
    assert rows(enrich.unmatched_orders(frame, current).orderBy("order_id"), "order_id") == [("b",), ("c",)]
    kept, rejected = enrich.split_dead_letter(enrich.enrich_current(frame, current))
    assert rows(kept, "order_id") == [("a",)]
    assert sorted(rows(rejected, "order_id", "reason")) == [("b", "no profile"), ("c", "missing key")]


def test_retention_keeps_windows_until_it_has_passed(spark):
    keep = timedelta(milliseconds=RETENTION_MS)
    frame = orders(
        spark,
        [
            ("alice", "gone", 1, "EUR", at()),
            ("alice", "kept", 1, "EUR", at(5)),
            ("alice", "newest", 1, "EUR", at(5) + keep),
        ],
    )
    current = enrich.latest_by_key(profiles(spark, ALICE))
    kept = windows.retained(windows.orders_per_window(frame, current), frame)
    assert sorted(rows(kept, "window_start"))[0] == (at(5),)
    assert kept.count() == 2


def test_records_carry_key_and_value(spark):
    record = windows.as_records(windows.aggregate_windows(enriched(spark, TWICE))).first()
    assert record.key.asDict() == {"customerId": "alice", "tier": "FREE", "currency": "HUF"}
    assert record.value.windowStartMs == at()
    assert (record.value.orderCount, record.value.totalAmountCents) == (2, 8484)


def test_batch_sink_round_trip(spark, tmp_path):
    out = windows.aggregate_windows(enriched(spark, TWICE))
    windows.write_windows(out, str(tmp_path / "w"))
    back = spark.read.parquet(str(tmp_path / "w")).select(*out.columns)
    assert rows(back) == rows(out)


order_rows = st.lists(
    st.tuples(
        st.sampled_from(["alice", "bob", "carol"]),
        st.sampled_from(["EUR", "USD"]),
        st.integers(0, 10_000),
        st.integers(0, 1800),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(order_rows)
def test_changelog_properties(spark, drawn):
    """Counts add up to the kept orders, the last step is the final value, and cutting
    groups into blocks changes nothing."""
    made = [
        (k, f"o{i}", a, c, BASE + timedelta(seconds=s)) for i, (k, c, a, s) in enumerate(drawn)
    ]
    source = enriched(spark, made, [("alice", "FREE", at()), ("bob", "PRO", at())])
    final = windows.aggregate_windows(source)
    kept = sum(1 for k, *_ in drawn if k != "carol")
    assert (final.agg(F.sum("order_count")).first()[0] or 0) == kept
    plain = windows.window_changelog(source)
    cut = windows.window_changelog(source, hot_rows=2, block_rows=3)
    assert sorted(rows(plain)) == sorted(rows(cut))
    last = plain.groupBy(*WINDOW_KEY).agg(
        F.max_by(F.struct("order_count", "total_amount_cents"), "offset").alias("l")
    )
    assert sorted(rows(last.select(*WINDOW_KEY, "l.*"))) == sorted(rows(final))


@pytest.mark.parametrize("size", ["5 minutes", "1 day"])
def test_summing_before_the_join_changes_nothing(spark, sf_dir, size):
    from tallybrook.sources import testdata as td

    frame = td.orders(spark, sf_dir)
    current = enrich.latest_by_key(td.profile_history(spark, sf_dir))
    joined = enrich.drop_unmatched(enrich.enrich_current(frame, current))
    after = windows.aggregate_windows(joined, size)
    assert windows.orders_per_window(frame, current, size).exceptAll(after).isEmpty()
    assert after.exceptAll(windows.orders_per_window(frame, current, size)).isEmpty()
