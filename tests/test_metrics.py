"""Metric names, rates, drops, outages and lag."""

import math
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallybrook.functions.metric_names import normalise_metric_names
from tallybrook.operators import metrics
from tests.helpers import BASE, rows

# attribute, metric name, kind, labels
NAMES = [
    (
        "kafka.server<type=FetcherLag, name=ConsumerLag, clientId=c1, topic=t, partition=3><>Value",
        "kafka_server_fetcherlag_consumerlag",
        "GAUGE",
        {"clientId": "c1", "topic": "t", "partition": "3"},
    ),
    (
        "kafka.server<type=Fetcher, name=Rate, clientId=c1, brokerHost=h, brokerPort=9><>Value",
        "kafka_server_fetcher_rate",
        "GAUGE",
        {"clientId": "c1", "broker": "h:9"},
    ),
    (
        "kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec><>Count",
        "kafka_server_brokertopicmetrics_messagesin_total",
        "COUNTER",
        {},
    ),
    (
        "kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, topic=orders-placed><>Count",
        "kafka_server_brokertopicmetrics_messagesin_total",
        "COUNTER",
        {"topic": "orders-placed"},
    ),
    (
        "kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>99thPercentile",
        "kafka_network_requestmetrics_totaltimems",
        "GAUGE",
        {"request": "Produce", "quantile": "0.99"},
    ),
    (
        "kafka.server<type=Produce, user=u, client-id=c><>byte-rate",
        "kafka_server_quota_byte_rate",
        "GAUGE",
        {"resource": "Produce", "user": "u", "clientId": "c"},
    ),
    (
        "kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions><>Value",
        "kafka_server_replicamanager_underreplicatedpartitions",
        "GAUGE",
        {},
    ),
    (
        "kafka.server<type=KafkaRequestHandlerPool, name=RequestHandlerAvgIdlePercent><>MeanRate",
        "kafka_server_kafkarequesthandlerpool_requesthandleravgidle_percent",
        "GAUGE",
        {},
    ),
    (
        "kafka.coordinator.group<type=GroupMetadataManager, name=NumGroups><>Value",
        "kafka_coordinator_group_groupmetadatamanager_numgroups",
        "GAUGE",
        {},
    ),
    # an empty label value leaves the label out
    (
        "kafka.log<type=Log, name=Size, topic=><>99thPercentile",
        "kafka_log_log_size",
        "GAUGE",
        {"quantile": "0.99"},
    ),
]


@pytest.mark.parametrize("max_names", [1000, 0])
def test_names_and_labels(spark, max_names):
    frame = spark.createDataFrame(
        [(n[0],) for n in NAMES] + [("java.lang<type=Memory><>HeapMemoryUsage",)], "attribute string"
    )
    out = normalise_metric_names(frame, max_names=max_names).collect()
    found = {r.attribute: (r.metric, r.kind, r.labels) for r in out}
    assert found == {n[0]: n[1:] for n in NAMES}


def samples(spark, metric, data, labels="map()"):
    """Rows are (instance, seconds after BASE, value)."""
    frame = spark.createDataFrame(
        [(i, BASE + timedelta(seconds=s), float(v)) for i, s, v in data],
        "instance string, ts timestamp_ntz, value double",
    )
    return frame.select(
        F.lit(metric).alias("metric"),
        F.expr(f"cast({labels} as map<string,string>)").alias("labels"),
        "instance",
        "ts",
        "value",
    )


def test_rate_survives_a_reset(spark):
    data = []
    for broker in range(3):
        for step in range(9):
            value = step * 150 if broker or step < 6 else (step - 6) * 150 + 30
            data.append((f"b{broker}", step * 15, value))
    out = metrics.counter_rate(samples(spark, "m", data), "m").orderBy("window_start").collect()
    # three increases of 150 per broker in the first minute (the first sample has none)
    assert out[0].per_second == pytest.approx(3 * 3 * 150 / 60)
    # four in the second; broker 0 restarts at 30 after its fifth sample
    assert out[1].per_second == pytest.approx((2 * 4 * 150 + 150 + 150 + 30 + 150) / 60)


def test_rate_crosses_days(spark):
    data = [("b", 86400 * d, 10 * d) for d in range(1, 5)]
    out = metrics.counter_rate(samples(spark, "m", data), "m")
    assert sorted(rows(out, "per_second")) == [(10 / 60,)] * 3


URP = [0, 0, 65, 65, 65, 20, 0]


def test_outage_episodes(spark):
    data = [(b, 15 * i, v) for b in ("kafka-1", "kafka-3") for i, v in enumerate(URP)]
    data += [("kafka-2", 0, 0), ("kafka-2", 15, 0)]
    out = metrics.outage_episodes(samples(spark, "m", data), "m").collect()
    when = lambda i: BASE + timedelta(seconds=15 * i)
    assert {r.instance: r.peak for r in out} == {"kafka-1": 65, "kafka-3": 65, None: 130}
    for r in out:
        assert (r.started_at, r.last_seen_at, r.recovered_at) == (when(2), when(5), when(6))
        assert r.samples == 4


def test_cluster_outage_of_unaligned_scrapes(spark):
    data = [(b, 15 * i + late, v) for b, late in (("a", 0), ("b", 3)) for i, v in enumerate(URP)]
    out = metrics.outage_episodes(samples(spark, "m", data), "m").collect()
    assert [r.peak for r in out if r.scope == "cluster"] == [130]


def test_cluster_outage_of_slow_scrapes(spark):
    """Scraped every 60 s, a at 0 and b at 65 all the time: one episode that lasts."""
    data = [("a", 60 * i, 0) for i in range(10)] + [("b", 60 * i + 31, 65) for i in range(10)]
    out = metrics.outage_episodes(samples(spark, "m", data), "m").collect()
    found = [(r.peak, r.started_at, r.recovered_at) for r in out if r.scope == "cluster"]
    assert found == [(65, BASE + timedelta(seconds=31), None)]


def test_cluster_sum_forgets_silent_instances(spark):
    data = [("a", 60 * i, 1) for i in range(10)] + [("b", 30, 5.0), ("b", 450, 7.0)]
    out = metrics.cluster_sum(samples(spark, "m", data), "m")
    found = {int((r.ts - BASE).total_seconds()): r.value for r in out.collect()}
    # b holds for 300 s after 30 and from 450 on
    want = {60 * i: 1 + 5 * (30 <= 60 * i < 330) + 7 * (60 * i >= 450) for i in range(10)} | {30: 6, 450: 8}
    assert found == want


def test_series_of_different_labels_stay_apart(spark):
    frame = spark.createDataFrame(
        [({"a": "1,b=2"},), ({"a": "1", "b": "2"},), ({"a": None},), ({},)], "labels map<string,string>"
    )
    assert metrics.with_series(frame).select("labels_id").distinct().count() == 4


def test_outage_without_end(spark):
    out = metrics.outage_episodes(samples(spark, "m", [("a", 0, 5), ("a", 86400, 7)]), "m")
    found = [r for r in out.collect() if r.instance == "a"]
    assert [(r.peak, r.recovered_at, r.samples) for r in found] == [(7, None, 2)]


def test_relative_drop_sees_across_days(spark):
    # 14 hours after BASE the day changes
    edge = 14 * 3600
    data = [("a", edge - 60 * i, 2.0) for i in range(1, 6)] + [("a", edge + 1, 0.5)]
    out = metrics.relative_drop(samples(spark, "m", data), "m", trailing_seconds=600)
    assert [(r.value, round(r.of_mean, 6)) for r in out.collect()] == [(0.5, round(0.5 / 1.75, 6))]


def test_one_busy_series_is_cut(spark):
    """Every second of three hours, with resets and dips at the edges of the blocks."""
    steps = range(3 * 3600)
    values = [float(i % 3600 * 2 + 1) for i in steps]
    frame = samples(spark, "m", [("a", i, v) for i, v in zip(steps, values)])
    grown = [b - a if b >= a else b for a, b in zip(values, values[1:])]
    want = [sum(grown[max(0, 60 * m - 1) : 60 * m + 59]) / 60 for m in range(180)]
    out = metrics.counter_rate(frame, "m").orderBy("window_start")
    assert rows(out, "per_second") == [(pytest.approx(w),) for w in want]
    low = []
    for i, v in enumerate(values):
        span = values[max(0, i - 600) : i + 1]
        if v / (sum(span) / len(span)) < 0.5:
            low.append((BASE + timedelta(seconds=i), pytest.approx(v / (sum(span) / len(span)))))
    dips = metrics.relative_drop(frame, "m", trailing_seconds=600).orderBy("ts")
    assert rows(dips, "ts", "of_mean") == low and low


@pytest.mark.parametrize("trailing", [0, 1, 7, 600])
def test_relative_drop_on_odd_samples(spark, trailing):
    """Ties, nulls, repeats, an outlier, infinities, times before 1970, both ends of a span."""
    epoch, second = datetime(1970, 1, 1), 1_000_000
    draw = random.Random(4)
    data = [(i, draw.randrange(-2000, 2000) * second, draw.choice([0.1, 0.3, 2.0, None])) for i in ("a", None) for _ in range(800)]
    data += data[:50]
    data += [("a", draw.randrange(-2000, 2000) * second + draw.choice([-1, 0, 1]), 0.7) for _ in range(400)]
    edges = [k * (trailing * second + 1) + d for k in (-2, -1, 0, 1, 2) for d in (-1, 0, 1)]
    data += [("b", t, v) for t in edges for v in (0.25, 3.0)]
    data += [("c", t * second, 1e15 if t == 5 else 1.0 + t % 3) for t in range(40)]
    data += [("d", t * second, {9: math.inf, 20: -math.inf, 30: math.nan}.get(t, 1.0)) for t in range(40)]
    data += [("e", t * second, None) for t in range(5)] + [("f", None, 0.1)]
    frame = spark.createDataFrame(
        [("m", i, None if t is None else epoch + timedelta(microseconds=t), v) for i, t, v in data],
        "metric string, instance string, ts timestamp_ntz, value double",
    )
    want = []
    for i, t, v in data:
        if t is None or v is None:
            continue
        span = [w for j, u, w in data if j == i and w is not None and u is not None and t - trailing * second <= u <= t]
        if v / (sum(span) / len(span)) < 0.5:
            want.append((str(i), t, v, v / (sum(span) / len(span))))
    found = [
        (str(r.instance), (r.ts - epoch) // timedelta(microseconds=1), r.value, r.of_mean)
        for r in metrics.relative_drop(frame, "m", trailing_seconds=trailing).collect()
    ]
    assert sorted(r[:3] for r in found) == sorted(r[:3] for r in want) and want
    assert [r[3] for r in sorted(found)] == pytest.approx([r[3] for r in sorted(want)], rel=1e-12)


def test_trailing_mean_does_not_read_a_span_for_each_sample(spark):
    """A frame that slides is read anew for each row, so its work grows with the square of the samples."""
    frame = samples(spark, "m", [("a", i, 1) for i in range(3)])
    plan = metrics.relative_drop(frame, "m", trailing_seconds=3600)._jdf.queryExecution().executedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\(\w+, ([^,]+), ([^)]+\))\)", plan)
    assert frames and set(frames) == {("unboundedpreceding$()", "currentrow$()")}
    assert plan.count("Exchange hashpartitioning") == 1


def test_gauge_takes_the_last_value_of_a_step(spark):
    out = metrics.gauge_by_instance(samples(spark, "m", [("a", 1, 5), ("a", 9, 7), ("a", 16, 1)]), "m")
    assert sorted(rows(out, "value")) == [(1.0,), (7.0,)]


def test_label_pattern_is_anchored(spark):
    metric = "kafka_network_requestmetrics_totaltimems"
    frame = None
    for request, quantile in (("Fetch", "0.99"), ("FetchFollower", "0.99"), ("Produce", "0.5")):
        one = samples(
            spark, metric, [("a", 0, 1)], f"map('request', '{request}', 'quantile', '{quantile}')"
        )
        frame = one if frame is None else frame.unionByName(one)
    assert rows(metrics.latency_p99(frame), "request") == [("Fetch",)]


def test_consumer_lag(spark):
    columns = "topic string, partition int, offset bigint, ts bigint"
    ends = spark.createDataFrame([("t", 0, 90, 1), ("t", 0, 100, 2), ("t", 1, 50, 1)], columns)
    done = spark.createDataFrame(
        [("g", "t", 0, 60, 1), ("g", "t", 0, 80, 2), ("g", "t", 1, 50, 1), ("g", "t", 2, 5, 1)],
        "group string, " + columns,
    )
    assert rows(metrics.consumer_lag(ends, done)) == [("g", "t", 20, 20)]
