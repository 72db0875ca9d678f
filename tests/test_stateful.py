"""Streams on keyed state: the same answer for every cutting into batches, and the batch answer."""

import os

import pytest
from pyspark.sql import functions as F

from tallybrook.model import UNIT_AMOUNT_CENTS
from tallybrook.operators import enrich, versioned, windows
from tallybrook.operators.validate import validate_windows
from tallybrook.streaming import native, stateful
from tallybrook.streaming.run import run_to_end
from tests.helpers import at, orders, profiles, rows
from tests.test_streaming import PEOPLE, Feed, random_orders
from tests.test_validate import window_records


def feed_of(spark, path, frame, cuts, order="offset"):
    """One file per batch: the rows up to each cut, then the rest."""
    feed = Feed(spark, path)
    for low, high in zip([0, *cuts], [*cuts, 10**9]):
        feed.add(frame.filter((F.col(order) >= low) & (F.col(order) < high)))
    return feed


def written(spark, df, path, restarts=1):
    """The result of a query, stopped and started again from its checkpoint."""
    for _ in range(restarts):
        run_to_end(native.write_rows(df(), str(path)), str(path) + "-cp", state_partitions=2)
    return spark.read.parquet(str(path))


CUTS = [[], [7, 9, 30], list(range(5, 40, 5))]


@pytest.mark.parametrize("cuts", CUTS)
def test_strict_and_changelog(spark, tmp_path, cuts):
    made = random_orders(40)
    times = [made[i][4] if i % 7 else at(0, max(0, i * 20 - 700)) for i in range(40)]  # some come late
    frame = orders(spark, [(*m[:4], t) for m, t in zip(made, times)])
    feed = feed_of(spark, tmp_path / "in", frame, cuts)
    kept = written(spark, lambda: stateful.drop_late(feed.stream()), tmp_path / "strict")
    assert sorted(rows(kept, "order_id")) == sorted(rows(windows.drop_late(frame), "order_id"))
    current = enrich.latest_by_key(profiles(spark, PEOPLE))

    def enriched(f):
        return enrich.drop_unmatched(enrich.enrich_current(f, current))

    steps = windows.window_changelog(enriched(frame))
    logged = written(spark, lambda: stateful.changelog(enriched(feed.stream())), tmp_path / "log")
    assert sorted(rows(logged.select(*steps.columns))) == sorted(rows(steps))


@pytest.mark.parametrize("cuts", [[], list(range(1, 8))])
def test_totals_drop_records_past_the_retention(spark, tmp_path, cuts):
    minutes = [0, 1, 2, 3, 4, 3 * 1440, 3 * 1440 + 1, 1]
    frame = orders(spark, [("a", f"o{i}", 100, "EUR", at(m)) for i, m in enumerate(minutes)])
    current = enrich.latest_by_key(profiles(spark, [("a", "PRO", at(-5))]))
    feed = feed_of(spark, tmp_path / "in", frame, cuts)
    enriched = enrich.drop_unmatched(enrich.enrich_current(feed.stream(), current))
    out = str(tmp_path / "out")
    run_to_end(native.write_updates(stateful.totals(enriched), out), out + "-cp", state_partitions=2)
    found = native.latest_windows(spark, out)
    assert sorted(rows(found, "order_count", "total_amount_cents")) == [(2, 200), (5, 500)]


@pytest.mark.parametrize("cuts", [[], [1, 2]])
def test_ids_are_remembered_by_record_time(spark, tmp_path, cuts):
    """The same id on day 0 and day 5, another on day 3: forgotten or not, whatever the batches."""
    ids, days = ["o1", "o2", "o1"], [0, 3, 5]
    frame = orders(spark, [("a", o, 1, "EUR", at(1440 * d)) for o, d in zip(ids, days)])
    records = frame.select("key", "partition", "offset", "timestamp", F.struct("order_id", "customer_id").alias("value"))
    feed = feed_of(spark, tmp_path / "in", records, cuts)
    for remember, again in (("1 day", []), ("6 days", ["duplicate order id"])):
        checked = written(spark, lambda: stateful.validated_orders(feed.stream(), remember), tmp_path / remember[:1])
        assert dict(rows(checked, "offset", "violations")) == {0: [], 1: [], 2: again}


@pytest.mark.parametrize("cuts", [[], [2, 3, 5]])
def test_order_and_window_rules(spark, tmp_path, cuts):
    ids = ["o1", "o1", "", "o2", "o1", None, "o2"]
    frame = orders(spark, [("a" if i else "b", o, 1, "EUR", at(i)) for i, o in enumerate(ids)])
    value = F.when(F.col("offset") != 3, F.struct("order_id", F.lit("a").alias("customer_id")))
    records = frame.select("key", "partition", "offset", "timestamp", value.alias("value"))
    feed = feed_of(spark, tmp_path / "in", records, cuts)
    checked = written(spark, lambda: stateful.validated_orders(feed.stream()), tmp_path / "orders")
    again, missing, key = ["duplicate order id"], ["missing order id"], ["key mismatch"]
    assert dict(rows(checked, "offset", "violations")) == {0: key, 1: again, 2: missing, 4: again, 5: missing, 6: []}

    records = window_records(spark)
    feed = feed_of(spark, tmp_path / "windows", records, cuts)
    checked = written(
        spark, lambda: stateful.validated_windows(feed.stream(), UNIT_AMOUNT_CENTS), tmp_path / "checked"
    )
    expected = dict(rows(validate_windows(records), "offset", "violations"))
    assert dict(rows(checked, "offset", "violations")) == expected


@pytest.mark.parametrize("cuts", [[], [8, 21, 33]])
def test_asof_join_of_two_streams(spark, tmp_path, cuts):
    """Versions before and after their orders, out of order, deletions, orders of no customer."""
    made = random_orders(40)
    times = [at(0, (i * 20 + (i * 37) % 90)) for i in range(40)]
    frame = orders(spark, [(*m[:4], t) for m, t in zip(made, times)])
    versions = [
        ("alice", "FREE", at()), ("bob", "PRO", at(2)), ("alice", "PRO", at(5)), ("alice", None, at(8)),
        ("alice", "ENTERPRISE", at(6)), ("bob", None, at(10)), ("alice", "FREE", at(12)), ("bob", "FREE", at(11)),
    ]
    history = profiles(spark, versions)
    # a heartbeat far ahead on both sides gives out the orders that still wait
    beat = orders(spark, [(None, None, 0, None, at(600))])
    late = profiles(spark, [(None, None, at(600))])
    feed = feed_of(spark, tmp_path / "orders", frame, cuts)
    told = feed_of(spark, tmp_path / "profiles", history, [c // 8 + 1 for c in cuts])
    feed.add(beat)
    told.add(late)
    joined = written(spark, lambda: stateful.enrich_asof(feed.stream(), told.stream()), tmp_path / "out")
    batch = versioned.enrich_asof(frame, history)
    assert sorted(rows(joined.select(*batch.columns)), key=str) == sorted(rows(batch), key=str)


def test_restart_goes_on(spark, tmp_path):
    """Input that arrives after the end of a run is taken up by the next with the state kept."""
    frame = orders(spark, [("a", f"o{i}", 1, "EUR", at(m)) for i, m in enumerate([1, 7, 2, 12, 8, 13])])
    feed = Feed(spark, tmp_path / "in")
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for i in range(3):
        feed.add(frame.filter(F.floor(F.col("offset") / 2) == i))
        run_to_end(native.write_rows(stateful.drop_late(feed.stream()), out), cp, state_partitions=2)
    assert sorted(rows(spark.read.parquet(out), "order_id")) == sorted(rows(windows.drop_late(frame), "order_id"))
    assert len(os.listdir(os.path.join(cp, "commits"))) >= 3


def many_customers(spark):
    """Sixty customers, three orders each, and their versions: every second one gets a second, later one."""
    people = [f"c{i}" for i in range(60)]
    bought = [(p, f"o{n}{p}", n + 1, "EUR", at(n * 10 + i % 7)) for n in range(3) for i, p in enumerate(people)]
    versions = [(p, "FREE", at(-5)) for p in people] + [(p, "PRO", at(11)) for p in people[::2]]
    return orders(spark, bought), profiles(spark, versions)


@pytest.mark.parametrize("buckets", [1, 7])
def test_state_has_a_row_per_bucket(spark, tmp_path, buckets):
    """The keys of a bucket share one row of the state and one call, and are told apart in it."""
    frame, history = many_customers(spark)
    feed = feed_of(spark, tmp_path / "in", frame, [50, 70, 130])
    current = enrich.latest_by_key(history)

    def enriched(f):
        return enrich.drop_unmatched(enrich.enrich_current(f, current))

    out = str(tmp_path / "log")
    logged = stateful.changelog(enriched(feed.stream()), "1 day", buckets=buckets)
    query = run_to_end(native.write_rows(logged, out), out + "-cp", state_partitions=2)
    state = [p["numRowsTotal"] for p in query.lastProgress["stateOperators"]]
    assert max(state) <= buckets + 1
    steps = windows.window_changelog(enriched(frame), "1 day")
    assert sorted(rows(spark.read.parquet(out).select(*steps.columns))) == sorted(rows(steps))

    records = frame.select("key", "partition", "offset", "timestamp", F.struct(F.expr("replace(order_id, 'o2', 'o0')").alias("order_id"), "customer_id").alias("value"))
    feed = feed_of(spark, tmp_path / "records", records, [50, 70, 130])
    out = str(tmp_path / "judged")
    judged = stateful.validated_orders(feed.stream(), buckets=buckets)
    query = run_to_end(native.write_rows(judged, out), out + "-cp", state_partitions=2)
    assert max(p["numRowsTotal"] for p in query.lastProgress["stateOperators"]) <= buckets
    broken = spark.read.parquet(out).filter(F.size("violations") > 0)
    assert sorted(rows(broken, "offset")) == [(i,) for i in range(120, 180)]


@pytest.mark.parametrize("buckets", [1, 7])
def test_customers_of_a_bucket_wait_apart(spark, tmp_path, buckets):
    """Some orders of a bucket are due and others go on waiting, over several micro-batches."""
    frame, history = many_customers(spark)
    feed = feed_of(spark, tmp_path / "orders", frame, [50, 70, 130])
    told = feed_of(spark, tmp_path / "profiles", history, [60, 70, 80])
    beats = [(None, at(12)), (None, at(15)), (None, at(600))]
    for nobody, time in beats:
        feed.add(orders(spark, [(nobody, None, 0, None, time)]))
        told.add(profiles(spark, [(nobody, None, time)]))

    def joined():
        return stateful.enrich_asof(feed.stream(), told.stream(), "1 minute", buckets=buckets)

    batch = versioned.enrich_asof(frame, history)
    found = written(spark, joined, tmp_path / "asof")
    assert sorted(rows(found.select(*batch.columns)), key=str) == sorted(rows(batch), key=str)

    current = written(spark, lambda: stateful.enrich_current(feed.stream(), told.stream(), buckets=buckets), tmp_path / "now")
    tiers = dict(rows(current.filter("key is not null"), "order_id", "tier"))
    assert len(tiers) == 180 and {tiers[f"o2c{i}"] for i in range(1, 60, 2)} == {"FREE"}
    assert {tiers[f"o2c{i}"] for i in range(0, 60, 2)} == {"PRO"}
