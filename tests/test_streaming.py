"""Streams: lateness, restart, replayed batches, fresh profiles."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import enrich, windows
from tallybrook.sources.generators import generate_orders_stream
from tallybrook.sources.orders import stream_orders
from tallybrook.streaming import batches, native, stateful
from tallybrook.streaming.batch_folders import read_batches, write_batch
from tallybrook.streaming.run import for_each_batch, run_to_end, start
from tests.helpers import at, orders, profiles, rows

# Minutes after 10:00 of one key's orders; one inner list per micro-batch.
LATE = [[1], [7, 2], [3, 8], [12, 4], [4, 13], [6, 14]]


class Feed:
    """A folder of order files, one file per micro-batch, oldest first."""

    def __init__(self, spark, path, zoned=False):
        self.spark, self.path, self.zoned = spark, str(path), zoned
        self.files = 0
        os.makedirs(self.path)

    def add(self, frame):
        if self.zoned:
            frame = frame.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        pdf = frame.coalesce(1)
        self.schema = pdf.schema
        target = os.path.join(self.path, f"part={self.files:04d}")
        pdf.write.parquet(target)
        for name in os.listdir(target):
            if name.endswith(".parquet"):
                # the file source takes files in the order of their times
                os.utime(os.path.join(target, name), (1_000_000 + self.files,) * 2)
        self.files += 1

    def stream(self):
        return stream_orders(self.spark, self.path, files_per_trigger=1, schema=self.schema)


def late_frames(spark):
    flat = [("a", f"o{m}-{i}", 1, "EUR", at(m)) for i, m in enumerate(sum(LATE, []))]
    frame, sizes = orders(spark, flat), [len(b) for b in LATE]
    first = 0
    for size in sizes:
        yield frame.filter(F.col("offset").between(first, first + size - 1))
        first += size


def counts(df):
    return {r.window_start: r.order_count for r in df.collect()}


def as_enriched(df):
    return enrich.enrichment(df.withColumn("tier", F.lit("FREE")))


def test_strict_rule_in_batch(spark):
    whole = None
    for frame in late_frames(spark):
        whole = frame if whole is None else whole.unionByName(frame)
    for block_rows in (1000, 2):
        kept = windows.drop_late(whole, block_rows=block_rows)
        assert counts(windows.aggregate_windows(as_enriched(kept))) == {at(): 1, at(5): 2, at(10): 3}
        assert windows.late_records(whole, block_rows=block_rows).count() == 5


def test_strict_rule_at_the_boundary(spark):
    frame = orders(
        spark,
        [("a", "early", 1, "EUR", at(4)), ("a", "edge", 1, "EUR", at(5)), ("a", "late", 1, "EUR", at(4))],
    )
    assert rows(windows.late_records(frame), "order_id") == [("late",)]
    assert windows.late_records(frame, grace="1 second").count() == 0


def test_strict_rule_as_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    for frame in late_frames(spark):
        feed.add(frame)
    out = str(tmp_path / "out")
    judged = native.write_rows(stateful.judge(feed.stream()), out)
    run_to_end(judged, str(tmp_path / "cp"), state_partitions=2)
    judged = spark.read.parquet(out)
    kept = judged.filter("not late")
    assert counts(windows.aggregate_windows(as_enriched(kept))) == {at(): 1, at(5): 2, at(10): 3}
    assert judged.filter("late").count() == 5


def test_watermark_is_looser(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", zoned=True)
    for frame in late_frames(spark):
        feed.add(frame)
    totals = native.windowed(as_enriched(feed.stream()))
    out = str(tmp_path / "out")
    run_to_end(native.write_updates(totals, out), str(tmp_path / "cp"))
    found = counts(native.latest_windows(spark, out))
    assert {k.replace(tzinfo=None): v for k, v in found.items()} == {at(): 3, at(5): 2, at(10): 3}


def test_final_windows_appear_once(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", zoned=True)
    for frame in late_frames(spark):
        feed.add(frame)
    out = str(tmp_path / "out")
    totals = native.windowed(as_enriched(feed.stream()))
    run_to_end(native.write_final(totals, out), str(tmp_path / "cp"))
    # the newest window is still open
    assert sorted(r.order_count for r in spark.read.parquet(out).collect()) == [2, 3]


@pytest.mark.parametrize("seed", range(2))
def test_strict_result_does_not_depend_on_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    made = [(rng.choice("abc"), f"o{i}", 1, "EUR", at(0, rng.randrange(1800))) for i in range(60)]
    frame = orders(spark, made).withColumn("partition", F.when(F.col("key") == "a", 0).otherwise(1))
    cuts = sorted(rng.sample(range(1, 60), 4))
    feed = Feed(spark, tmp_path / "in")
    for low, high in zip([0, *cuts], [*cuts, 60]):
        feed.add(frame.filter((F.col("offset") >= low) & (F.col("offset") < high)))
    out = str(tmp_path / "out")
    kept = native.write_rows(stateful.drop_late(feed.stream()), out)
    run_to_end(kept, str(tmp_path / "cp"), state_partitions=2)
    streamed = rows(spark.read.parquet(out), "order_id")
    assert sorted(streamed) == sorted(rows(windows.drop_late(frame), "order_id"))


def random_orders(n, seed=1):
    rng = random.Random(seed)
    keys = ["alice"] * 4 + ["bob", "carol"]
    return [
        (rng.choice(keys), f"o{i}", rng.randrange(500), rng.choice(["EUR", "USD"]), at(0, i * 20))
        for i in range(n)
    ]


PEOPLE = [("alice", "FREE", at()), ("bob", "PRO", at())]


def filled_feed(spark, path, frame, parts=4, zoned=False):
    feed = Feed(spark, path, zoned)
    size = 40 // parts
    for i in range(parts):
        feed.add(frame.filter(F.floor(F.col("offset") / size) == i))
    return feed


def totals_of(feed, told, out):
    """Totals of two streams, orders and profiles."""
    enriched = enrich.drop_unmatched(stateful.enrich_current(feed.stream(), told.stream()))
    return native.write_updates(stateful.totals(enriched), out)


def test_restart_goes_on_without_double_counting(spark, tmp_path):
    frame, history = orders(spark, random_orders(40)), profiles(spark, PEOPLE)
    feed, told = Feed(spark, tmp_path / "in"), Feed(spark, tmp_path / "profiles")
    told.add(history)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for i in range(4):
        feed.add(frame.filter(F.floor(F.col("offset") / 10) == i))
        # every run stops when its input is used up; the next one resumes
        run_to_end(totals_of(feed, told, out), cp, state_partitions=2)
    streamed = native.latest_windows(spark, out)
    whole = windows.orders_per_window(frame, enrich.latest_by_key(history))
    assert sorted(rows(streamed)) == sorted(rows(whole))
    # a new checkpoint starts from the beginning: all profiles with the first orders
    again = str(tmp_path / "again")
    run_to_end(totals_of(feed, told, again), str(tmp_path / "cp2"), state_partitions=2)
    assert sorted(rows(native.latest_windows(spark, again))) == sorted(rows(whole))


def test_profiles_that_arrive_later_count_from_then_on(spark, tmp_path):
    """A profile comes, one changes, an older one comes too late, one is deleted: each holds for
    the orders from its micro-batch on, and a change of tier splits a window."""
    feed, told = Feed(spark, tmp_path / "in"), Feed(spark, tmp_path / "profiles")
    versions = profiles(spark, [
        ("alice", "FREE", at()), ("alice", "GONE", at()), ("bob", "PRO", at()), ("alice", "PRO", at(1)), ("bob", None, at(2)),
    ])
    for part in ([0], [2, 3], [1, 4]):
        told.add(versions.filter(F.col("offset").isin(part)))
    for i in range(4):
        both = [("alice", f"x{i}", 1, "EUR", at(i)), ("bob", f"y{i}", 1, "EUR", at(i)), (None, f"z{i}", 1, "EUR", at(i))]
        feed.add(orders(spark, both).withColumn("offset", F.col("offset") + 10 * i))
    out = str(tmp_path / "rows")
    joined = native.write_rows(stateful.enrich_current(feed.stream(), told.stream()), out)
    run_to_end(joined, str(tmp_path / "cp"), state_partitions=2)
    tier = dict(rows(spark.read.parquet(out), "order_id", "tier"))
    assert [tier[f"x{i}"] for i in range(4)] == ["FREE", "PRO", "PRO", "PRO"]
    assert [tier[f"y{i}"] for i in range(4)] == [None, "PRO", None, None]
    assert [tier[f"z{i}"] for i in range(4)] == [None] * 4
    out = str(tmp_path / "totals")
    run_to_end(totals_of(feed, told, out), str(tmp_path / "cp2"), state_partitions=2)
    found = rows(native.latest_windows(spark, out), "customer_id", "tier", "order_count")
    assert sorted(found) == [("alice", "FREE", 1), ("alice", "PRO", 3), ("bob", "PRO", 1)]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    frame = spark.range(10).withColumn("n", F.col("id") * 2)
    path = str(tmp_path / "out")
    for batch_id in (0, 0, 1, 1, 2, 2, 2):
        write_batch(frame.filter(F.col("id") % 3 == batch_id), path, batch_id)
    assert sorted(rows(read_batches(spark, path), "id")) == [(i,) for i in range(10)]


def test_dead_letters_are_set_aside(spark, tmp_path):
    frame, history = orders(spark, random_orders(40)), profiles(spark, PEOPLE)
    feed = filled_feed(spark, tmp_path / "in", frame)
    out = str(tmp_path / "out")
    run_to_end(batches.dead_letters(feed.stream(), out, lambda: history), str(tmp_path / "cp"))
    rejected = batches.read_dead_letters(spark, out)
    carol = frame.filter("key = 'carol'")
    assert sorted(rows(rejected, "order_id")) == sorted(rows(carol, "order_id"))


def test_repeated_ids_pass_once(spark, tmp_path):
    frame = orders(spark, random_orders(40))
    feed = Feed(spark, tmp_path / "in", zoned=True)
    feed.add(frame.filter("offset < 20"))
    feed.add(frame.filter("offset >= 10"))
    out = str(tmp_path / "out")
    first = native.first_occurrences(feed.stream(), "1 hour")
    run_to_end(first.writeStream.format("parquet").option("path", out), str(tmp_path / "cp"))
    assert sorted(rows(spark.read.parquet(out), "order_id")) == sorted(rows(frame, "order_id"))


def test_pass_through_and_restart_position(spark, tmp_path):
    frame = orders(spark, random_orders(40))
    feed = filled_feed(spark, tmp_path / "in", frame, parts=2)
    query = start(native.pass_through(feed.stream(), "smoke"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert spark.table("smoke").count() == 40


def test_plain_append_sink_sees_only_new_input(spark, tmp_path):
    """At-least-once consumption: progress is stored after the batch is handled."""
    frame = orders(spark, random_orders(40))
    feed = Feed(spark, tmp_path / "in")
    handled = []

    def handle(batch, batch_id):
        handled.append(batch.count())

    for i in range(2):
        feed.add(frame.filter(F.floor(F.col("offset") / 20) == i))
        run_to_end(for_each_batch(feed.stream(), handle), str(tmp_path / "cp"))
    assert handled == [20, 20]


def test_rate_stream_makes_orders(spark, tmp_path):
    made = generate_orders_stream(spark, rows_per_second=50)
    query = start(
        native.pass_through(made, "rated"), str(tmp_path / "cp"), available_now=False, every="1 second"
    )
    try:
        deadline = time.monotonic() + 30
        while spark.table("rated").isEmpty() and time.monotonic() < deadline:
            time.sleep(0.5)
        assert set(rows(spark.table("rated"), "amount_cents")) == {(4242,)}
    finally:
        query.stop()


def test_results_of_an_earlier_query_are_not_mixed_in(spark, tmp_path):
    frame, history = orders(spark, random_orders(40)), profiles(spark, PEOPLE)
    feed = filled_feed(spark, tmp_path / "in", frame)
    out = str(tmp_path / "out")
    run_to_end(batches.dead_letters(feed.stream(), out, lambda: history), str(tmp_path / "cp"))
    before = batches.read_dead_letters(spark, out).count()
    with pytest.raises(Exception, match="earlier query"):
        run_to_end(batches.dead_letters(feed.stream(), out, lambda: history), str(tmp_path / "cp2"))
    assert batches.read_dead_letters(spark, out).count() == before


def test_no_result_is_an_empty_table(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    feed.add(orders(spark, [("alice", "o1", 1, "EUR", at(1))]))
    out, history = str(tmp_path / "out"), profiles(spark, PEOPLE)
    run_to_end(batches.dead_letters(feed.stream(), out, lambda: history), str(tmp_path / "cp"))
    assert batches.read_dead_letters(spark, out).count() == 0
