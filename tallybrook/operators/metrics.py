"""Queries over metric samples (metric, labels, instance, ts, value).

A series is one (metric, labels, instance). Series are cut into hours, so a task never
holds more than one hour of one series, however much of the table it fills. An hour costs one
small row more, which carries the value before it on. `relative_drop` cuts them into trailing
spans instead; a task holds two of one instance, and every sample is shuffled for both.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..plans.running import Fold, running

SERIES = ["metric", "labels_id", "instance"]
HOUR_MICROS = 3_600_000_000


def with_series(samples):
    """Add `labels_id`, a groupable form of the label map: its entries in key order."""
    return samples.withColumn("labels_id", F.array_sort(F.map_entries("labels")))


def labels_text(labels_id):
    """Readable form of `labels_id`; different labels may read alike, so never group by it."""
    pairs = F.transform(
        labels_id, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))
    )
    return F.array_join(pairs, ",")


def _micros(column):
    epoch = F.lit("1970-01-01 00:00:00")
    return F.timestamp_diff("MICROSECOND", epoch.cast("timestamp_ntz"), F.col(column))


def _hour(column="ts"):
    return F.floor(_micros(column) / F.lit(HOUR_MICROS))


def gauge_by_instance(samples, metric, step="15 seconds"):
    """Last value of a gauge per instance and step."""
    return (
        samples.filter(F.col("metric") == metric)
        .groupBy("instance", F.window("ts", step)["start"].alias("step"))
        .agg(F.max_by("value", "ts").alias("value"))
    )


def select_by_labels(samples, metric, equal=None, matching=None):
    """Samples whose labels equal, or fully match a pattern of, the given values."""
    chosen = samples.filter(F.col("metric") == metric)
    for label, value in (equal or {}).items():
        chosen = chosen.filter(F.col("labels")[label] == value)
    for label, pattern in (matching or {}).items():
        chosen = chosen.filter(F.col("labels")[label].rlike(f"^(?:{pattern})$"))
    return chosen


def latency_p99(samples):
    """99th percentile request time of Produce and Fetch."""
    return select_by_labels(
        samples,
        "kafka_network_requestmetrics_totaltimems",
        equal={"quantile": "0.99"},
        matching={"request": "Produce|Fetch"},
    ).select(F.col("labels")["request"].alias("request"), "instance", "ts", "value")


def counter_rate(samples, metric, width="1 minute"):
    """Cluster-wide increase per second of a counter, per window.

    Each sample adds its increase over the previous sample of its series to its
    own window; after a reset the counter is taken to have started from 0. There
    is no extrapolation to the window edges.
    """
    stepped = running(
        with_series(samples.filter(F.col("metric") == metric)),
        SERIES,
        ["ts"],
        {"previous": Fold("last", F.col("value"))},
        block=_hour(),
        inclusive=False,
    )
    grown = F.when(
        F.col("value") >= F.col("previous"), F.col("value") - F.col("previous")
    ).otherwise(F.col("value"))
    seconds = F.timestamp_diff("SECOND", F.col("w.start"), F.col("w.end"))
    return (
        stepped.filter(F.col("previous").isNotNull())
        .select(F.window("ts", width).alias("w"), grown.alias("increase"))
        .groupBy("w")
        .agg(F.sum("increase").alias("increase"))
        .select(
            F.col("w.start").alias("window_start"),
            (F.col("increase") / seconds).alias("per_second"),
        )
    )


def relative_drop(samples, metric, trailing_seconds=600, below=0.5):
    """Samples of a gauge that fall below a fraction of their trailing mean.

    The mean covers the sample itself and the `trailing_seconds` before it. Blocks are
    as long as this span, so a span is the rest of one block and the beginning of the
    next. Both are running sums, one from either end: no span is read again for each of
    its samples, and as nothing is subtracted, values outside of a span leave no rounding.
    """
    trailing = trailing_seconds * 1_000_000
    width = F.lit(trailing + 1).cast("bigint")  # both ends belong to the span

    def block_start(at):
        return at - F.pmod(at, width)

    # a sample enters the spans of its own block and leaves those of the next
    until = F.col("_at") + F.lit(trailing)
    placed = (
        samples.filter(F.col("metric") == metric)
        .select("instance", "ts", "value", _micros("ts").alias("_at"))
        .withColumn("_own", block_start(F.col("_at")))
        .withColumn("_block", F.explode(F.sequence("_own", block_start(until), width)))
        .withColumn("_enters", F.col("_block") == F.col("_own"))
        .withColumn("_at", F.when(F.col("_enters"), F.col("_at")).otherwise(until))
        .drop("_own")
    )
    # blocks before names: rows are sorted by the first column fastest
    block = Window.partitionBy("_block", "instance")
    upto = Window.unboundedPreceding, Window.currentRow
    so_far = block.orderBy("_at").rangeBetween(*upto)
    still = block.orderBy(F.col("_at").desc()).rangeBetween(*upto)
    leaving = F.when(~F.col("_enters"), F.col("value"))
    sums = (
        placed.withColumn("_sum", F.sum(leaving).over(still))
        .withColumn("_count", F.count(leaving).over(still))
        .filter("_enters")
        .withColumn("_sum", F.sum("value").over(so_far) + F.coalesce("_sum", F.lit(0.0)))
        .withColumn("_count", F.count("value").over(so_far) + F.col("_count"))
    )
    return (
        sums.withColumn("mean", F.col("_sum") / F.col("_count"))
        .select(
            "instance", "ts", "value", (F.col("value") / F.col("mean")).alias("of_mean")
        )
        .filter(F.col("of_mean") < below)
    )


def cluster_sum(samples, metric, staleness="5 minutes"):
    """Sum of a gauge over instances at every time that one was scraped.

    Instances are not scraped at the same moments: a sample holds until the next of its
    instance, but no longer than `staleness`. Only changes are added up along time, so no
    sample is repeated. Of samples of one instance and time the largest counts.
    """
    hold = F.expr(f"interval {staleness}")
    gauge = samples.filter(F.col("metric") == metric).groupBy("instance", "ts")
    gauge = gauge.agg(F.max("value").alias("value"))
    last = {"before": Fold("last", F.struct("ts", "value"))}
    steps = running(gauge, ["instance"], ["ts"], last, block=_hour(), inclusive=False)
    ends = F.col("before.ts") + hold
    holds = F.coalesce(ends > F.col("ts"), F.lit(False))
    one = F.lit(1).cast("bigint")

    def change(at, value, own):
        away = F.when(value != 0, one).otherwise(F.lit(0).cast("bigint"))
        return F.struct(at.alias("ts"), value.alias("change"), away.alias("away"), F.lit(own).alias("own"))

    def less(at, value):
        return change(at, value, 0).withField("change", -value).withField(
            "away", F.when(value != 0, -one).otherwise(F.lit(0).cast("bigint"))
        )

    # a sample takes the place of the one before, at once or when that one has run out
    gone = F.when(F.col("before").isNotNull(), less(F.when(holds, F.col("ts")).otherwise(ends), F.col("before.value")))
    changes = steps.select(F.explode(F.array_compact(F.array(change(F.col("ts"), F.col("value"), 1), gone))).alias("c"))
    newest = gauge.groupBy("instance").agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))
    changes = changes.unionByName(newest.select(less(F.col("ts") + hold, F.col("value")).alias("c"))).select("c.*")
    at_once = changes.groupBy("ts").agg(
        F.sum("change").alias("change"), F.sum("away").alias("away"), F.max("own").alias("own")
    )
    sums = {"value": Fold("sum", F.col("change")), "instances_away": Fold("sum", F.col("away"))}
    # one scope for all times; a literal would gather the hours in the planner's single partition
    scope = F.floor(F.abs(_micros("ts")) / 2**62)
    summed = running(at_once.withColumn("scope", scope), ["scope"], ["ts"], sums, block=_hour())
    # counted, so that rounding leaves no remainder of a sum that is zero
    value = F.when(F.col("instances_away") > 0, F.col("value")).otherwise(F.lit(0.0))
    return summed.filter("own = 1").select("ts", value.alias("value"))


def outage_episodes(samples, metric, staleness="5 minutes"):
    """Times a gauge was away from 0, per instance and for the sum of all.

    An episode runs from the first sample away from 0 to the last one before the
    next 0 (`recovered_at`, null while it lasts). `scope` is instance or cluster; rows
    of the cluster are those of `cluster_sum` and have no instance.
    """
    gauge = samples.filter(F.col("metric") == metric).select("instance", "ts", "value")
    both = gauge.withColumn("scope", F.lit("instance")).unionByName(
        cluster_sum(samples, metric, staleness).withColumn("scope", F.lit("cluster")),
        allowMissingColumns=True,
    )
    # samples between two zeros share the time of the zero before them
    anchored = running(
        both,
        ["scope", "instance"],
        ["ts"],
        {"last_zero": Fold("max", F.when(F.col("value") == 0, F.col("ts")))},
        block=_hour(),
        inclusive=False,
    )
    away = F.col("value") != 0
    return (
        anchored.groupBy("scope", "instance", "last_zero")
        .agg(
            F.min(F.when(away, F.col("ts"))).alias("started_at"),
            F.max(F.when(away, F.col("ts"))).alias("last_seen_at"),
            F.min(F.when(~away, F.col("ts"))).alias("recovered_at"),
            F.max(F.when(away, F.col("value"))).alias("peak"),
            F.count_if(away).alias("samples"),
        )
        .filter(F.col("samples") > 0)
        .drop("last_zero")
    )


def consumer_lag(end_offsets, committed):
    """Lag per group and topic: the largest over partitions and the sum.

    Both inputs are histories; the newest row of a partition counts. A partition
    without an end offset has no lag.
    """
    ends = end_offsets.groupBy("topic", "partition").agg(
        F.max_by("offset", "ts").alias("end_offset")
    )
    reached = committed.groupBy("group", "topic", "partition").agg(
        F.max_by("offset", "ts").alias("committed")
    )
    lag = F.col("end_offset") - F.col("committed")
    return (
        reached.join(ends, ["topic", "partition"], "left")
        .groupBy("group", "topic")
        .agg(F.max(lag).alias("max_lag"), F.sum(lag).alias("total_lag"))
    )
