"""The given star-schema tables seen as orders, profiles, records and samples.

`events` plays the order stream and the metric samples, `customer` the profile
history, `part` the schema registry. The tables have no orphans, late rows,
duplicates or broken records, so those are derived here by fixed rules over all
rows.
"""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import ORDERS_TOPIC, PROFILES_TOPIC, UNIT_AMOUNT_CENTS

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
# Given schemas spare a look into the files before every query.
SCHEMAS = {
    "events": EVENTS,
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}
PARTITIONS = 6


def table(spark, sf_dir, name):
    path = os.path.join(sf_dir, f"{name}.parquet")
    if name in SCHEMAS:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def stream_events(spark, folder, files="events.parquet", files_per_trigger=None):
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", files)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def arrival_number():
    """A jittered order of arrival."""
    return F.col("event_id") + (F.col("event_id") * 7919) % 50


HEARTBEAT = "2100-01-01"


def write_heartbeat(spark, sf_dir, folder):
    """An event without a user, far ahead: what waits for time to pass comes out."""
    e = table(spark, sf_dir, "events").filter("false")
    row = spark.range(1).select(
        F.lit(0).cast("bigint").alias("event_id"), F.lit(HEARTBEAT).cast("timestamp_ntz").alias("ts")
    )
    e.unionByName(row, allowMissingColumns=True).coalesce(1).write.parquet(os.path.join(folder, "slice=end"))


def write_window_heartbeat(windows, folder):
    """A window total without a customer, far ahead."""
    spark = windows.sparkSession
    times = [F.lit(HEARTBEAT).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    beat = windows.filter("false").unionByName(spark.range(1).select(*times), allowMissingColumns=True)
    beat.coalesce(1).write.parquet(os.path.join(folder, "slice=end"))


def write_profile_stream(spark, sf_dir, folder):
    """The profile history in the order of its times: one file per round of versions."""
    history = profile_history(spark, sf_dir)
    for i in range(3):
        part = history.filter(F.floor(F.col("offset") / 10_000_000) == i)
        part.coalesce(1).write.parquet(os.path.join(folder, f"slice={i}"))
    return history.schema


def write_profile_heartbeat(spark, sf_dir, folder, name):
    """A version without a customer, far ahead."""
    row = spark.range(1).select(
        F.lit(HEARTBEAT).cast("timestamp_ntz").alias("timestamp"), F.lit(0).cast("bigint").alias("offset")
    )
    beat = profile_history(spark, sf_dir).filter("false").unionByName(row, allowMissingColumns=True)
    beat.coalesce(1).write.parquet(os.path.join(folder, f"slice={name}"))


SLICE_FILE_ROWS = 250_000


def write_slices(spark, sf_dir, folder, numbers, of=8, by=None):
    """`slices` of the events, by event id if nothing else is given."""
    return slices(table(spark, sf_dir, "events"), folder, numbers, F.col("event_id") if by is None else by, of)


def slices(frame, folder, numbers, by, of=8):
    """The slices `numbers` of a frame, cut `of` ways along `by` (a Column), in this order: what a
    stream of files finds one after the other. Every slice has the same number of files, which is
    returned: as many as its smallest slice has rows for, so that none of them is empty."""
    cut = frame.withColumn("_at", by)
    top = cut.agg(F.max("_at")).scalar()
    cut = cut.withColumn("_slice", F.floor(F.col("_at") * of / (top + 1))).drop("_at")
    sizes = dict(cut.groupBy("_slice").count().filter("_slice is not null").collect())  # `of` rows
    files = min(16, max(1, min(sizes.get(i, 0) for i in range(of)) // SLICE_FILE_ROWS))
    for i in numbers:
        part = cut.filter(F.col("_slice") == i).drop("_slice")
        part.repartition(files).write.parquet(os.path.join(folder, f"slice={i}"))
    return files


def as_orders(events, time_type="timestamp_ntz"):
    """One order per event. `arrival` is a jittered arrival number."""
    at = F.col("ts").cast(time_type)
    key = F.col("user_id").cast("string")
    return events.select(
        key.alias("key"),
        F.lit(ORDERS_TOPIC).alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        at.alias("timestamp"),
        F.col("event_id").cast("string").alias("order_id"),
        key.alias("customer_id"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount_cents"),
        F.col("event_type").alias("currency"),
        at.alias("placed_at"),
        arrival_number().alias("arrival"),
    )


def orders(spark, sf_dir):
    return as_orders(table(spark, sf_dir, "events"))


def _segment_tier():
    segment = F.col("c_mktsegment")
    return (
        F.when(segment.isin("AUTOMOBILE", "BUILDING"), F.lit("FREE"))
        .when(segment == "FURNITURE", F.lit("PRO"))
        .when(segment == "HOUSEHOLD", F.lit("ENTERPRISE"))
    )


def _version(when, base, at, tier, deleted):
    c = F.col("c_custkey")
    version = F.struct(
        (c + base).alias("offset"),
        F.lit(at).cast("timestamp_ntz").alias("timestamp"),
        tier.cast("string").alias("tier"),
        F.lit(deleted).alias("deleted"),
    )
    return F.when(when, version)


def profile_history(spark, sf_dir, country=False):
    """Up to three versions per customer: a first tier by market segment (none for
    MACHINERY), an upgrade of every third, a deletion of every seventh.
    `country` adds the nation name."""
    customers = table(spark, sf_dir, "customer")
    c = F.col("c_custkey")
    versions = [
        _version(
            F.col("c_mktsegment") != "MACHINERY", 0, "2023-12-31", _segment_tier(), False
        )
    ]
    upgrade = F.lit("ENTERPRISE")
    versions += [
        _version(c % 3 == 0, 10_000_000, "2024-01-10", upgrade, False),
        _version(c % 7 == 0, 20_000_000, "2024-01-20", F.lit(None), True),
    ]
    rest = []
    if country:
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        customers = customers.join(
            nation, customers["c_nationkey"] == nation["n_nationkey"], "left"
        )
        rest = [F.col("n_name").alias("country")]
    return customers.select(
        c.cast("string").alias("key"),
        F.lit(PROFILES_TOPIC).alias("topic"),
        (c % PARTITIONS).cast("int").alias("partition"),
        *rest,
        F.explode(F.array_compact(F.array(*versions))).alias("v"),
    ).select("key", "topic", "partition", "v.*", *(["country"] if country else []))


def with_repeats(rows):
    """All orders, and some once more: every hundredth at a later offset, another
    hundredth in the next partition at the same offset, another there at a lower one."""
    n = F.col("offset") % 100
    other = ((F.col("partition") + 1) % PARTITIONS).cast("int")
    same = F.struct("partition", "offset")
    copy = (
        F.when(n == 0, F.struct("partition", (F.col("offset") + 1_000_000_000_000).alias("offset")))
        .when(n == 50, F.struct(other.alias("partition"), "offset"))
        .when(n == 75, F.struct(other.alias("partition"), (F.col("offset") - 25).alias("offset")))
    )
    return (
        rows.withColumn("_copy", F.explode(F.array_compact(F.array(same, copy))))
        .withColumn("partition", F.col("_copy.partition"))
        .withColumn("offset", F.col("_copy.offset"))
        .drop("_copy")
    )


def as_order_records(orders_frame):
    """Orders as (key, value) records, some broken: empty ids, keys that differ
    from the customer, repeats, null values."""
    rows = with_repeats(orders_frame)
    n = F.col("offset") % 1_000_000_000_000
    value = F.struct(
        F.when(n % 101 == 0, F.lit("")).otherwise(F.col("order_id")).alias("order_id"),
        F.when(n % 103 == 0, F.lit("nobody")).otherwise(F.col("customer_id")).alias("customer_id"),
        "amount_cents",
        "currency",
    )
    return rows.select(
        "key", "partition", "offset", "timestamp", F.when(n % 97 != 0, value).alias("value")
    )


def orders_without_key(spark, sf_dir):
    """All orders, every fiftieth with a null key."""
    return orders(spark, sf_dir).withColumn(
        "key", F.when(F.col("offset") % 50 != 0, F.col("key"))
    )


def profiles_with_unknown_tier(spark, sf_dir):
    """First versions; customers in debt have a tier outside the allowed set."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "MACHINERY")
    tier = F.when(F.col("c_acctbal") < 0, F.lit("TRIAL")).otherwise(_segment_tier())
    return c.select(F.col("c_custkey").cast("string").alias("key"), tier.alias("tier"))


def unit_orders(orders_frame):
    """The same orders, each of the unit amount."""
    return orders_frame.withColumn("amount_cents", F.lit(UNIT_AMOUNT_CENTS).cast("bigint"))


def break_windows(records):
    """Window records with some broken: wrong totals, a count going back, a foreign
    tier in the value, a window of double width, null values."""
    n = F.col("offset")
    count = F.col("order_count")
    value = F.struct(
        "customer_id",
        F.when(n % 59 == 0, F.lit("OTHER")).otherwise(F.col("tier")).alias("tier"),
        "currency",
        "window_start",
        F.when(n % 61 == 0, F.col("window_end") + F.expr("interval 1 day"))
        .otherwise(F.col("window_end"))
        .alias("window_end"),
        F.when(n % 67 == 0, count - 1).otherwise(count).alias("order_count"),
        F.when(n % 71 == 0, F.col("total_amount_cents") + 1)
        .when(n % 67 == 0, F.col("total_amount_cents") - UNIT_AMOUNT_CENTS)
        .otherwise(F.col("total_amount_cents"))
        .alias("total_amount_cents"),
    )
    key = F.struct("customer_id", "tier", "currency")
    return records.select(
        key.alias("key"), F.when(n % 73 != 0, value).alias("value"), "offset"
    )


def raw_records(spark, sf_dir):
    """Events as raw bytes with a wire prefix; some with a bad magic byte, some too
    short to have a prefix."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    digits = F.concat(
        F.when(n % 89 == 0, F.lit("01")).otherwise(F.lit("00")),
        F.lpad(F.hex(n % 6007), 8, "0"),
        F.hex(F.encode("props", "UTF-8")),
    )
    short = F.lit("000000")
    return e.select(
        n.alias("offset"), F.unhex(F.when(n % 83 == 0, short).otherwise(digits)).alias("value")
    )


def registry_dump(spark, sf_dir):
    """Two schema versions per part. Ids drift apart; some second versions rename,
    drop or add fields."""
    p = F.col("p_partkey")
    v = F.col("version")

    def named(name, default, when=None):
        f = F.struct(F.lit(name).alias("field"), F.lit(default).alias("has_default"))
        return f if when is None else F.when(when, f)

    second = v == 2
    fields = F.array_compact(
        F.array(
            named("orderId", False, ~(second & (p % 5 == 0))),
            named("id", False, second & (p % 5 == 0)),
            named("customerId", False),
            named("amountCents", False, ~(second & (p % 13 == 0))),
            named("currency", True),
            named("placedAt", False),
            named("note", True, second & (p % 7 == 0)),
            named("channel", False, second & (p % 11 == 0)),
        )
    )
    versions = table(spark, sf_dir, "part").select(
        p, F.explode(F.array(F.lit(1), F.lit(2))).alias("version")
    )
    global_id = p * 2 + v
    return versions.select(
        F.concat(F.lit("topic-"), p, F.lit("-value")).alias("subject"),
        v,
        global_id.alias("global_id"),
        (global_id + p % 3).alias("content_id"),
        F.explode(fields).alias("f"),
    ).select("subject", "version", "global_id", "content_id", "f.*")


def _samples(spark, sf_dir, metric, value, labels=None):
    e = table(spark, sf_dir, "events")
    return e.select(
        F.lit(metric).alias("metric"),
        (labels if labels is not None else F.create_map().cast("map<string,string>")).alias(
            "labels"
        ),
        F.concat(F.lit("kafka-"), F.col("user_id") % 3 + 1).alias("instance"),
        "ts",
        value.cast("double").alias("value"),
    )


def message_samples(spark, sf_dir):
    """A counter per instance that starts again at 0 after 5000 events."""
    return _samples(
        spark,
        sf_dir,
        "kafka_server_brokertopicmetrics_messagesin_total",
        F.col("event_id") % 5000,
    )


def underreplicated_samples(spark, sf_dir):
    """A gauge at 0 that stands at 65, then 20, for a while in every 1000 events."""
    n = F.col("event_id") % 1000
    value = F.when(n.between(250, 399), 65).when(n.between(400, 449), 20).otherwise(0)
    return _samples(spark, sf_dir, "kafka_server_replicamanager_underreplicatedpartitions", value)


def idle_samples(spark, sf_dir):
    """A gauge that rests at 2.0 and drops to 0.5 at times."""
    value = F.when(F.col("event_id") % 40 == 0, 0.5).otherwise(2.0)
    return _samples(
        spark,
        sf_dir,
        "kafka_server_kafkarequesthandlerpool_requesthandleravgidle_percent",
        value,
    )


def latency_samples(spark, sf_dir):
    """Request times by quantile and request type."""
    quantiles = F.array(*[F.lit(q) for q in ("0.5", "0.95", "0.99")])
    requests = F.array(*[F.lit(r) for r in ("Produce", "Fetch", "FetchFollower", "Metadata")])
    labels = F.create_map(
        F.lit("quantile"),
        F.element_at(quantiles, (F.col("event_id") % 3 + 1).cast("int")),
        F.lit("request"),
        F.element_at(requests, (F.col("user_id") % 4 + 1).cast("int")),
    )
    return _samples(
        spark, sf_dir, "kafka_network_requestmetrics_totaltimems", F.col("value"), labels
    )


# Bean attributes: $c client, $t topic, $p partition. One or more per rule, and
# two that no rule matches.
BEAN_ATTRIBUTES = (
    "kafka.server<type=FetcherLag, name=Lag, clientId=$c, topic=$t, partition=$p><>Value",
    "kafka.server<type=FetcherStats, name=Age, clientId=$c, brokerHost=h$p, brokerPort=9092><>Value",
    "kafka.coordinator.group<type=GroupMetadataManager, name=NumGroups><>Value",
    "kafka.network<type=RequestMetrics, name=RequestsPerSec, request=Fetch, version=$p><>Count",
    "kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec, topic=$t><>Count",
    "kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec><>Count",
    "kafka.server<type=Produce, user=u$p, client-id=$c><>byte-rate",
    "kafka.server<type=Fetch, client-id=$c><>throttle-time",
    "kafka.server<type=Request, user=u$p><>request-time",
    "kafka.cluster<type=Partition, name=InSyncReplicasCount, topic=$t, partition=$p><>Value",
    "kafka.log<type=LogManager, name=OfflineLogDirs, logDirectory=/data/$p><>Value",
    "kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions><>Value",
    "kafka.network<type=RequestMetrics, name=ErrorCount, request=Fetch, error=E$p><>Count",
    "kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Fetch, stage=s$p><>99thPercentile",
    "kafka.network<type=RequestMetrics, name=LocalTimeMs, request=Produce><>Count",
    "kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>95thPercentile",
    "kafka.log<type=LogFlushStats, name=LogFlushTimeMs><>Count",
    "kafka.log<type=LogFlushStats, name=LogFlushTimeMs><>50thPercentile",
    "kafka.server<type=KafkaRequestHandlerPool, name=RequestHandlerAvgIdlePercent><>MeanRate",
    "kafka.network<type=SocketServer, name=NetworkProcessorAvgIdlePercent><>Value",
    "kafka.network<type=Processor, name=IdlePercent, networkProcessor=$p><>Value",
    "kafka.server<type=app-info, id=$p><>Version",
    "java.lang<type=Memory><>HeapMemoryUsage",
)


def bean_attribute_samples(spark, sf_dir):
    """One raw sample per event: bean attribute and value."""
    e = table(spark, sf_dir, "events")
    n = len(BEAN_ATTRIBUTES)
    name = F.element_at(
        F.array(*[F.lit(a) for a in BEAN_ATTRIBUTES]), (F.col("event_id") % n + 1).cast("int")
    )
    for mark, value in (
        ("$c", F.concat(F.lit("client-"), F.col("user_id") % 100)),
        ("$t", F.col("event_type")),
        ("$p", (F.col("user_id") % PARTITIONS).cast("string")),
    ):
        name = F.replace(name, F.lit(mark), value)
    return e.select(F.col("event_id").alias("sample_id"), name.alias("attribute"))


def end_offsets(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        "ts",
    )


def committed_offsets(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("group-"), F.col("event_id") % 4).alias("group"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        (F.col("event_id") - F.col("user_id") % 100).alias("offset"),
        "ts",
    )


def order_writers(spark, sf_dir):
    """The orders as written by three schema versions: complete, without currency,
    and with the order id under another name."""
    rows = orders(spark, sf_dir).drop("arrival")
    n = F.col("offset") % 3
    return [
        rows.filter(n == 0),
        rows.filter(n == 1).drop("currency"),
        rows.filter(n == 2).withColumnRenamed("order_id", "id"),
    ]


def damaged_windows(windows):
    """Window totals with some rows missing and some changed."""
    c = F.col("customer_id").cast("bigint")
    return windows.filter(c % 50 != 0).withColumn(
        "order_count", F.col("order_count") + F.when(c % 51 == 0, 1).otherwise(0)
    )


