"""One query per operator over the given tables: (spark, folder) -> DataFrame."""

import os

from pyspark.sql import functions as F

from ..functions.clock import is_window_label, window_label
from ..functions.metric_names import normalise_metric_names
from ..functions.wire import split_wire_prefix
from ..model import UNIT_AMOUNT_CENTS
from ..operators import duplicates, enrich, metrics, registry, validate, versioned, windows
from ..plans.hot_keys import find_hot_keys
from ..session import new_folder
from ..sources import testdata as td
from ..sources.generators import as_generated_orders
from ..sources.orders import conform_all, scan_orders
from ..sources.profiles import seed_profiles
from ..streaming import batches, native, reconcile, stateful
from ..streaming.run import run_to_end

DAY = "1 day"
DAY_MS = 86_400_000
JITTERED = ("arrival", "offset")
URP = "kafka_server_replicamanager_underreplicatedpartitions"
IDLE = "kafka_server_kafkarequesthandlerpool_requesthandleravgidle_percent"
MESSAGES = "kafka_server_brokertopicmetrics_messagesin_total"


def _newest_profiles(spark, sf_dir):
    return enrich.current_tiers(td.profile_history(spark, sf_dir))


def _changelog(spark, sf_dir, unit=False):
    orders = td.orders(spark, sf_dir)
    hot = find_hot_keys(orders, ["key"])
    if unit:
        orders = td.unit_orders(orders)
    enriched = enrich.enrich_current(orders, _newest_profiles(spark, sf_dir), hot=hot)
    return windows.window_changelog(enrich.drop_unmatched(enriched), DAY, hot=hot)


def _windows(spark, sf_dir, size):
    return windows.orders_per_window(
        td.orders(spark, sf_dir), _newest_profiles(spark, sf_dir), size
    )


# sources and projections


def q_scan_orders(spark, sf_dir):
    return scan_orders(td.orders(spark, sf_dir))


def q_generated_orders(spark, sf_dir):
    numbered = td.table(spark, sf_dir, "events").select("event_id", "ts")
    orders = as_generated_orders(numbered, "event_id", "ts", random_ids=False)
    return enrich.enrich_current(orders, seed_profiles(spark)).select(
        "key", "order_id", "currency", "tier", "total_amount_cents", "offset", "timestamp"
    )


def q_conform_orders(spark, sf_dir):
    accepted, rejected = conform_all(td.order_writers(spark, sf_dir))
    columns = ["key", "offset", "order_id", "currency", "reason"]
    both = accepted.withColumn("reason", F.lit(None).cast("string")).select(*columns)
    return both.unionByName(rejected.withColumn("order_id", F.lit(None)).select(*columns))


# profile joins


def q_latest_profiles(spark, sf_dir):
    history = td.profile_history(spark, sf_dir, country=True)
    return enrich.latest_by_key(history).select("key", "country", "tier", "offset", "timestamp")


def q_orders_enriched(spark, sf_dir):
    return enrich.enrich_current(td.orders(spark, sf_dir), _newest_profiles(spark, sf_dir))


def q_orders_unmatched(spark, sf_dir):
    unmatched = enrich.unmatched_orders(
        td.orders(spark, sf_dir), _newest_profiles(spark, sf_dir)
    )
    return unmatched.select("key", "order_id", "amount_cents", "offset", "timestamp")


def q_orders_dead_letter(spark, sf_dir):
    enriched = enrich.enrich_current(
        td.orders_without_key(spark, sf_dir), td.profiles_with_unknown_tier(spark, sf_dir)
    )
    _, rejected = enrich.split_dead_letter(enriched)
    return rejected.select("key", "order_id", "tier", "offset", "reason")


def q_enrich_asof(spark, sf_dir):
    return versioned.enrich_asof(td.orders(spark, sf_dir), td.profile_history(spark, sf_dir))


def q_enrich_replay(spark, sf_dir):
    return versioned.enrich_replay(
        td.orders(spark, sf_dir), td.profile_history(spark, sf_dir), queue=JITTERED
    )


def q_enrich_table_first(spark, sf_dir):
    return versioned.enrich_replay(
        td.orders(spark, sf_dir), td.profile_history(spark, sf_dir), table_first=True
    )


# windows


def q_orders_per_window(spark, sf_dir):
    return _windows(spark, sf_dir, "5 minutes")


def q_orders_per_window_1d(spark, sf_dir):
    return _windows(spark, sf_dir, DAY)


def q_orders_per_window_asof(spark, sf_dir):
    matched = enrich.drop_unmatched(q_enrich_asof(spark, sf_dir))
    return windows.aggregate_windows(matched, DAY)


def q_window_changelog(spark, sf_dir):
    return _changelog(spark, sf_dir)


def _kept_and_late(spark, sf_dir):
    return enrich.matched_orders(td.orders(spark, sf_dir), _newest_profiles(spark, sf_dir))


def q_orders_strict_no_grace(spark, sf_dir):
    rows = windows.drop_late(_kept_and_late(spark, sf_dir), arrival=JITTERED)
    return rows.select("key", "partition", "order_id", "amount_cents", "arrival", "timestamp")


def q_late_orders(spark, sf_dir):
    rows = windows.late_records(_kept_and_late(spark, sf_dir), arrival=JITTERED)
    return rows.select("key", "partition", "order_id", "arrival", "window_end", "stream_time")


def q_window_retention(spark, sf_dir):
    return windows.retained(_windows(spark, sf_dir, "5 minutes"), td.orders(spark, sf_dir))


def q_window_string_key(spark, sf_dir):
    labelled = _windows(spark, sf_dir, "5 minutes").withColumn("label", window_label())
    return labelled.select(
        "label", "tier", "currency", "order_count", is_window_label("label").alias("well_formed")
    )


# validation


def q_duplicate_orders(spark, sf_dir):
    rows = duplicates.duplicate_orders(td.with_repeats(td.orders(spark, sf_dir)))
    return rows.select("key", "order_id", "offset", "first_seen")


def _violations_text():
    return F.array_join("violations", ", ").alias("violations")


def q_validate_orders(spark, sf_dir):
    checked = validate.validate_orders(td.as_order_records(td.orders(spark, sf_dir)))
    return checked.select(
        "key", "offset", F.col("value.order_id").alias("order_id"), _violations_text()
    )


def _window_records(spark, sf_dir):
    return td.break_windows(_changelog(spark, sf_dir, unit=True))


def q_validate_windows(spark, sf_dir):
    checked = validate.validate_windows(_window_records(spark, sf_dir), width_ms=DAY_MS)
    return checked.select(
        F.col("key.customer_id").alias("customer_id"),
        "offset",
        F.col("value.order_count").alias("order_count"),
        F.col("value.total_amount_cents").alias("total_amount_cents"),
        _violations_text(),
    )


def q_validation_summary(spark, sf_dir):
    orders = validate.tally(validate.validate_orders(td.as_order_records(td.orders(spark, sf_dir))))
    records = validate.tally(
        validate.validate_windows(_window_records(spark, sf_dir), width_ms=DAY_MS)
    )
    return orders.withColumn("checked", F.lit("orders")).unionByName(
        records.withColumn("checked", F.lit("windows"))
    )


def q_window_value_conflicts(spark, sf_dir):
    return validate.window_value_conflicts(q_window_changelog(spark, sf_dir))


def q_reconcile_windows(spark, sf_dir):
    expected = _windows(spark, sf_dir, DAY)
    found = validate.reconcile_windows(td.damaged_windows(expected), expected)
    return found.fillna(0, ["written_count", "written_cents"])


# registry


def q_wire_prefix(spark, sf_dir):
    split = split_wire_prefix(td.raw_records(spark, sf_dir))
    return split.fillna(-1, ["schema_id"]).select(
        "offset", "magic", "schema_id", F.hex("payload").alias("payload"), "wire_error"
    )


def q_dangling_schema_ids(spark, sf_dir):
    return registry.dangling_schema_ids(
        td.raw_records(spark, sf_dir), td.registry_dump(spark, sf_dir)
    )


def q_ambiguous_schema_ids(spark, sf_dir):
    return registry.ambiguous_schema_ids(
        td.raw_records(spark, sf_dir), td.registry_dump(spark, sf_dir)
    )


def q_schema_compat_diff(spark, sf_dir):
    return registry.schema_compat_diff(td.registry_dump(spark, sf_dir))


# metrics


def q_metric_normalise(spark, sf_dir):
    named = normalise_metric_names(td.bean_attribute_samples(spark, sf_dir))
    return metrics.with_series(named).select(
        "sample_id", "metric", "kind", metrics.labels_text("labels_id").alias("labels")
    )


def q_gauge_latest(spark, sf_dir):
    return metrics.gauge_by_instance(td.underreplicated_samples(spark, sf_dir), URP)


def q_latency_p99(spark, sf_dir):
    return metrics.latency_p99(td.latency_samples(spark, sf_dir))


def q_counter_rate(spark, sf_dir):
    return metrics.counter_rate(td.message_samples(spark, sf_dir), MESSAGES)


def q_relative_drop(spark, sf_dir):
    rows = metrics.relative_drop(td.idle_samples(spark, sf_dir), IDLE, trailing_seconds=3600)
    return rows.withColumn("of_mean", F.round("of_mean", 9))


def q_outage_episodes(spark, sf_dir):
    return metrics.outage_episodes(td.underreplicated_samples(spark, sf_dir), URP)


def q_consumer_lag(spark, sf_dir):
    return metrics.consumer_lag(td.end_offsets(spark, sf_dir), td.committed_offsets(spark, sf_dir))


# streams: run over the whole table to its end, then read the result


def _events_stream(spark, sf_dir):
    return td.stream_events(spark, sf_dir)


def _stream_orders(spark, sf_dir, time_type="timestamp_ntz"):
    return td.as_orders(_events_stream(spark, sf_dir), time_type)


def _run(spark, writer, name):
    folder = new_folder(spark, name)
    run_to_end(writer(folder), os.path.join(folder, "checkpoint"))
    return folder


def _without_zone(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


STATE_ROWS = 500_000  # of the whole input, for one partition of the state
BUCKETS_EACH = 16  # buckets of keys in a partition


def _state_size(rows):
    """Partitions of the state and buckets of its keys, by the rows of the whole input."""
    partitions = max(4, -(-rows // STATE_ROWS))
    return {"state_partitions": partitions}, {"buckets": BUCKETS_EACH * partitions}


def _events_state(spark, sf_dir):
    return _state_size(td.table(spark, sf_dir, "events").count())


def _run_sliced(spark, sf_dir, name, writer, by=None):
    """Eight micro-batches in order, with a stop and a restart from the checkpoint between the
    fourth and the fifth."""
    folder = new_folder(spark, name)
    source = os.path.join(folder, "source")
    size, _ = _events_state(spark, sf_dir)
    for numbers in (range(4), range(4, 8)):
        files = td.write_slices(spark, sf_dir, source, numbers, by=by)
        orders = td.as_orders(td.stream_events(spark, source, "*.parquet", files_per_trigger=files))
        run_to_end(writer(orders, os.path.join(folder, "out")), os.path.join(folder, "checkpoint"), **size)
    return os.path.join(folder, "out")


def _kept_profiles(spark, sf_dir):
    """The newest profiles, written down once: a stream joins them in every micro-batch."""
    folder = new_folder(spark, "newest")
    current = _newest_profiles(spark, sf_dir)
    current.write.parquet(folder)
    return spark.read.schema(current.schema).parquet(folder)


def _matched(orders, current):
    return enrich.drop_unmatched(enrich.enrich_current(orders, current))


def q_stream_orders_per_window(spark, sf_dir):
    current = _kept_profiles(spark, sf_dir)

    def writer(orders, out):
        return native.write_updates(stateful.totals(_matched(orders, current)), out)

    return native.latest_windows(spark, _run_sliced(spark, sf_dir, "totals", writer))


def _watermarked(spark, sf_dir):
    orders = _stream_orders(spark, sf_dir, "timestamp")
    current = _newest_profiles(spark, sf_dir)
    return native.windowed(enrich.drop_unmatched(enrich.enrich_current(orders, current)))


def q_stream_watermark_windows(spark, sf_dir):
    totals = _watermarked(spark, sf_dir)
    folder = _run(
        spark, lambda f: native.write_updates(totals, os.path.join(f, "updates")), "updates"
    )
    rows = native.latest_windows(spark, os.path.join(folder, "updates"))
    return _without_zone(rows, "window_start", "window_end")


def q_stream_final_windows(spark, sf_dir):
    totals = _watermarked(spark, sf_dir)
    folder = _run(spark, lambda f: native.write_final(totals, os.path.join(f, "final")), "final")
    rows = spark.read.parquet(os.path.join(folder, "final")).drop("window_date")
    return _without_zone(rows, "window_start", "window_end")


def q_stream_strict_no_grace(spark, sf_dir):
    current = _kept_profiles(spark, sf_dir)

    def writer(orders, out):
        needed = orders.select("key", "partition", "offset", "order_id", "amount_cents", "arrival", "timestamp")
        matched = enrich.matched_orders(needed, current)
        return native.write_rows(stateful.drop_late(matched, arrival=JITTERED), out)

    rows = spark.read.parquet(_run_sliced(spark, sf_dir, "strict", writer, td.arrival_number()))
    return rows.select("key", "partition", "order_id", "amount_cents", "arrival", "timestamp")


def q_stream_enrich_asof(spark, sf_dir):
    folder = new_folder(spark, "asof")
    source, profiles = os.path.join(folder, "source"), os.path.join(folder, "profiles")
    schema = td.write_profile_stream(spark, sf_dir, profiles)
    out = os.path.join(folder, "out")
    size, buckets = _events_state(spark, sf_dir)
    for numbers in (range(4), range(4, 8)):
        files = td.write_slices(spark, sf_dir, source, numbers)
        # after a restart each stream must be heard of once before time moves on
        td.write_profile_heartbeat(spark, sf_dir, profiles, f"end{numbers[0]}")
        if 7 in numbers:
            td.write_heartbeat(spark, sf_dir, source)
        orders = td.as_orders(td.stream_events(spark, source, "*.parquet", files_per_trigger=files))
        history = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(profiles)
        joined = stateful.enrich_asof(orders, history, **buckets)
        run_to_end(native.write_rows(joined, out), os.path.join(folder, "checkpoint"), **size)
    return spark.read.parquet(out)


def q_stream_window_changelog(spark, sf_dir):
    current = _kept_profiles(spark, sf_dir)
    _, buckets = _events_state(spark, sf_dir)

    def writer(orders, out):
        return native.write_rows(stateful.changelog(_matched(orders, current), DAY, **buckets), out)

    return spark.read.parquet(_run_sliced(spark, sf_dir, "changelog", writer))


def q_stream_enrich_current(spark, sf_dir):
    """Orders in eight micro-batches, with the profiles that have arrived by then."""
    folder = new_folder(spark, "current")
    profiles = os.path.join(folder, "profiles")
    schema = td.write_profile_stream(spark, sf_dir, profiles)
    _, buckets = _events_state(spark, sf_dir)

    def writer(orders, out):
        history = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(profiles)
        return native.write_rows(stateful.enrich_current(orders, history, **buckets), out)

    return spark.read.parquet(_run_sliced(spark, sf_dir, "enriched", writer))


def q_stream_validate_windows(spark, sf_dir):
    folder = new_folder(spark, "records")
    source, out = os.path.join(folder, "source"), os.path.join(folder, "out")
    whole = os.path.join(folder, "whole")
    _window_records(spark, sf_dir).write.parquet(whole)
    records = spark.read.parquet(whole)
    size, buckets = _state_size(records.count())
    for numbers in (range(4), range(4, 8)):
        files = td.slices(records, source, numbers, F.col("offset"))
        stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", files).parquet(source)
        checked = stateful.validated_windows(stream, UNIT_AMOUNT_CENTS, DAY_MS, **buckets)
        run_to_end(native.write_rows(checked, out), os.path.join(folder, "checkpoint"), **size)
    return spark.read.parquet(out).select(
        F.col("key.customer_id").alias("customer_id"),
        "offset",
        F.col("value.order_count").alias("order_count"),
        F.col("value.total_amount_cents").alias("total_amount_cents"),
        _violations_text(),
    )


def q_stream_reconcile_windows(spark, sf_dir):
    """Totals in eight micro-batches by window; a fifth of the customers' are written two days late."""
    folder = new_folder(spark, "reconcile")
    out, sides = os.path.join(folder, "out"), {}
    whole = os.path.join(folder, "whole")
    _windows(spark, sf_dir, DAY).write.parquet(whole)
    expected = spark.read.parquet(whole)
    day = F.datediff("window_start", F.lit(expected.agg(F.min("window_start")).scalar()))
    late = F.when(F.col("customer_id").cast("bigint") % 5 == 0, 2).otherwise(0)
    sides["expected"] = expected, day
    sides["written"] = td.damaged_windows(expected), day + late
    size, _ = _state_size(expected.count())
    for numbers in (range(4), range(4, 8)):
        streams = {}
        for name, (frame, by) in sides.items():
            source = os.path.join(folder, name)
            files = td.slices(frame, source, numbers, by)
            if 7 in numbers:
                td.write_window_heartbeat(frame, source)
            reader = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", files)
            streams[name] = reader.option("pathGlobFilter", "*.parquet").parquet(source)
        found = reconcile.reconcile_windows(**streams, lag="7 days")
        run_to_end(native.write_rows(found, out), os.path.join(folder, "checkpoint"), **size)
    return spark.read.parquet(out).fillna(0, ["written_count", "written_cents"])


def q_stream_validate_orders(spark, sf_dir):
    _, buckets = _events_state(spark, sf_dir)

    def writer(orders, out):
        checked = stateful.validated_orders(td.as_order_records(orders), **buckets)
        return native.write_rows(checked, out)

    checked = spark.read.parquet(_run_sliced(spark, sf_dir, "validated-orders", writer))
    return checked.select(
        "key", "offset", F.col("value.order_id").alias("order_id"), _violations_text()
    )


def q_stream_dedup(spark, sf_dir):
    orders = td.with_repeats(_stream_orders(spark, sf_dir, "timestamp"))
    first = native.first_occurrences(orders, "10 minutes")
    folder = _run(
        spark,
        lambda f: first.writeStream.format("parquet").option("path", os.path.join(f, "first")),
        "dedup",
    )
    rows = spark.read.parquet(os.path.join(folder, "first"))
    return rows.select("key", "order_id", "amount_cents", "currency")


def q_stream_dead_letter(spark, sf_dir):
    def writer(orders, out):
        return batches.dead_letters(orders, out, lambda: td.profile_history(spark, sf_dir))

    rejected = batches.read_dead_letters(spark, _run_sliced(spark, sf_dir, "dead-letter", writer))
    return rejected.select("key", "order_id", "offset", "reason")


def all_queries():
    return {n.removeprefix("q_"): f for n, f in globals().items() if n.startswith("q_")}
