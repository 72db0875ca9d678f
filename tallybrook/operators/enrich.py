"""Orders joined with the current customer profile."""

from pyspark.sql import functions as F

from ..model import TIERS
from ..plans.hot_keys import DETECT, HOT_ROWS, find_hot_keys, mark_hot


def latest_by_key(history, key="key", order="offset", deleted="deleted"):
    """Newest row per key; a key whose newest row is a deletion is absent.

    Each map task keeps one row per key before the shuffle, so a key with very
    many versions is no heavier than any other.
    """
    rest = [c for c in history.columns if c != key]
    return (
        history.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*rest), order).alias("_newest"))
        .select(key, "_newest.*")
        .filter(~F.coalesce(F.col(deleted), F.lit(False)))
        .select(*history.columns)
    )


def current_tiers(history):
    """`latest_by_key` with only the columns the enrichment needs."""
    return latest_by_key(history.select("key", "offset", "tier", "deleted")).select("key", "tier")


def allowed_tier(column="tier"):
    return F.col(column).isin(*TIERS)


def enrichment(orders, tier="tier"):
    """The joined record: one order counted once, tier null without a profile."""
    return orders.select(
        "key",
        "order_id",
        "currency",
        F.col(tier).alias("tier"),
        F.lit(1).cast("bigint").alias("order_count"),
        F.col("amount_cents").alias("total_amount_cents"),
        "partition",
        "offset",
        "timestamp",
    )


def join_profiles(orders, profiles, how, hot_rows=HOT_ROWS, hot=DETECT):
    """Join orders with a frame that has at most one row per key.

    Orders of hot keys are joined where they are with the profiles of just those
    keys, at most MAX_HOT_KEYS rows; the rest is left to the planner. (Adaptive
    execution does not split a skewed join next to an aggregate, and profiles
    usually come out of one.) In a stream all orders are left to the planner.
    """
    if hot is DETECT:
        hot = None if orders.isStreaming else find_hot_keys(orders, ["key"], hot_rows)
    if hot is None:
        return orders.join(profiles, "key", how)
    marked = mark_hot(orders, ["key"], hot)
    of_hot_keys = F.broadcast(profiles.join(F.broadcast(hot), "key", "left_semi"))
    split = (
        marked.filter("_hot")
        .join(of_hot_keys, "key", how)
        .unionByName(marked.filter(~F.col("_hot")).join(profiles, "key", how))
    )
    return split.drop("_hot")


def enrich_current(orders, current, hot_rows=HOT_ROWS, hot=DETECT):
    """Orders left-joined with the current profile of their key."""
    profiles = current.select("key", "tier")
    return enrichment(join_profiles(orders, profiles, "left", hot_rows, hot))


def drop_unmatched(enriched):
    """Keep orders that found a profile."""
    return enriched.filter(F.col("tier").isNotNull())


def matched_orders(orders, current, hot_rows=HOT_ROWS, hot=DETECT):
    """Orders whose key has a current profile, with their own columns only."""
    return join_profiles(orders, current.select("key"), "left_semi", hot_rows, hot)


def unmatched_orders(orders, current, hot_rows=HOT_ROWS, hot=DETECT):
    """Orders whose key has no current profile."""
    return join_profiles(orders, current.select("key"), "left_anti", hot_rows, hot)


def with_reason(enriched):
    """Add `reason`: why the order cannot be counted, null where it can."""
    return enriched.withColumn(
        "reason",
        F.when(F.col("key").isNull(), F.lit("missing key"))
        .when(F.col("tier").isNull(), F.lit("no profile"))
        .when(~allowed_tier(), F.lit("unknown tier")),
    )


def split_dead_letter(enriched):
    """(kept, rejected): rejected rows carry the reason they cannot be counted."""
    judged = with_reason(enriched)
    return (
        judged.filter(F.col("reason").isNull()).drop("reason"),
        judged.filter(F.col("reason").isNotNull()),
    )
