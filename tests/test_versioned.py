"""As-of and replay joins."""

import random
from datetime import timedelta

import pytest

from tallybrook.operators import enrich, versioned
from tallybrook.sources import testdata as td
from tests.helpers import BASE, at, orders, profiles, rows


def tiers(df):
    return {r.order_id: r.tier for r in df.collect()}


HISTORY = [("k", "FREE", at(10)), ("k", None, at(20)), ("k", "PRO", at(30))]
LOOKUPS = [("k", str(m), 1, "EUR", at(m)) for m in (5, 10, 25, 31)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 0])
def test_deletion_hides_the_older_version(spark, hot_rows):
    out = versioned.enrich_asof(orders(spark, LOOKUPS), profiles(spark, HISTORY), hot_rows)
    assert tiers(out) == {"5": None, "10": "FREE", "25": None, "31": "PRO"}


def stale_orders(spark, minute):
    return orders(spark, [("alice", str(i), 4242, "EUR", at(minute)) for i in range(10)])


def test_stale_orders_before_the_profiles(spark):
    history = profiles(spark, [("alice", "FREE", at(360))])
    stale, fresh = stale_orders(spark, 0), stale_orders(spark, 365)

    def kept(df):
        return enrich.drop_unmatched(df).count()

    assert kept(versioned.enrich_replay(stale, history)) == 0
    assert kept(enrich.enrich_current(stale, enrich.latest_by_key(history))) == 10
    assert kept(versioned.enrich_replay(stale, history, table_first=True)) == 10
    assert kept(versioned.enrich_replay(fresh, history)) == 10


def merged_queues(order_rows, version_rows):
    """Two queues, lowest head timestamp first, profiles first on ties."""
    table, out, o, v = {}, {}, 0, 0
    while o < len(order_rows):
        if v < len(version_rows) and version_rows[v][2] <= order_rows[o][4]:
            key, tier, _ = version_rows[v]
            table[key] = tier
            v += 1
        else:
            out[order_rows[o][1]] = table.get(order_rows[o][0])
            o += 1
    return out


def valid_versions(order_rows, version_rows):
    out = {}
    for key, order_id, _, _, t in order_rows:
        found = [v for v in enumerate(version_rows) if v[1][0] == key and v[1][2] <= t]
        best = max(found, key=lambda v: (v[1][2], v[0]), default=None)
        out[order_id] = best[1][1] if best else None
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_against_brute_force(spark, seed, hot_rows):
    rng = random.Random(seed)
    moment = lambda: BASE + timedelta(seconds=rng.randrange(600))
    # one key holds most of both sides
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c"])
    order_rows = [(key(), f"o{i}", 1, "EUR", moment()) for i in range(120)]
    version_rows = [
        (key(), rng.choice(["FREE", "PRO", "ENTERPRISE", None]), moment()) for _ in range(40)
    ]
    o, h = orders(spark, order_rows), profiles(spark, version_rows)
    options = {"hot_rows": hot_rows, "block_rows": 16}
    assert tiers(versioned.enrich_asof(o, h, **options)) == valid_versions(order_rows, version_rows)
    assert tiers(versioned.enrich_replay(o, h, **options)) == merged_queues(order_rows, version_rows)


def test_cutting_hot_keys_changes_nothing(spark, sf_dir):
    o, h = td.orders(spark, sf_dir), td.profile_history(spark, sf_dir)
    for join in (versioned.enrich_asof, versioned.enrich_replay):
        plain, cut = join(o, h), join(o, h, hot_rows=50, block_rows=64)
        assert plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()


def test_orders_without_key_find_nothing(spark):
    frame = orders(spark, [(None, "n", 1, "EUR", at(40)), ("k", "y", 1, "EUR", at(40))])
    for hot_rows in (1_000_000, 0):
        out = versioned.enrich_asof(frame, profiles(spark, HISTORY), hot_rows)
        assert tiers(out) == {"n": None, "y": "PRO"}


def test_latest_profile_per_key(spark):
    history = profiles(
        spark,
        [("a", "FREE", at(9)), ("b", "PRO", at()), ("a", "PRO", at(1)), ("b", None, at(2))],
    )
    assert rows(enrich.latest_by_key(history), "key", "tier") == [("a", "PRO")]
