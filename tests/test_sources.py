"""Readers, resolution against the reader schema, shared folder."""

import pytest
from pyspark.sql import functions as F

from tallybrook import session
from tallybrook.operators import enrich
from tallybrook.sources import orders as order_source
from tallybrook.sources import testdata as td
from tallybrook.sources.profiles import seed_profiles
from tests.helpers import at, orders, profiles, rows

TWO = [("a", "o1", 1, "USD", at()), ("b", "o2", 2, None, at(1))]


def test_missing_currency_takes_the_default(spark):
    accepted, rejected = order_source.conform(orders(spark, TWO).drop("currency"))
    assert rows(accepted, "order_id", "currency") == [("o1", "EUR"), ("o2", "EUR")]
    assert rejected.isEmpty()


def test_null_in_a_written_column_stays(spark):
    accepted, _ = order_source.conform(orders(spark, TWO))
    assert rows(accepted, "currency") == [("USD",), (None,)]


def test_missing_required_field_rejects_the_writer(spark):
    renamed = orders(spark, TWO).withColumnRenamed("order_id", "id")
    accepted, rejected = order_source.conform_all([orders(spark, TWO), renamed])
    assert accepted.count() == 2
    assert rows(rejected, "id", "reason") == [
        ("o1", "missing required field: order_id"),
        ("o2", "missing required field: order_id"),
    ]


def test_scan_and_tombstones(spark):
    frame = orders(spark, TWO)
    assert order_source.scan_orders(frame).columns == [
        "key", "order_id", "amount_cents", "currency", "placed_at", "partition", "offset",
    ]
    binary = frame.withColumn("key", F.col("key").cast("binary"))
    assert rows(order_source.scan_orders(binary), "key") == [("a",), ("b",)]
    assert order_source.skip_tombstones(frame, "key", "currency").count() == 1


def test_seed_profiles(spark):
    current = enrich.latest_by_key(seed_profiles(spark))
    assert sorted(rows(current, "key", "country", "tier")) == [
        ("alice", "HU", "FREE"),
        ("bob", "HU", "PRO"),
        ("carol", "FR", "PRO"),
        ("david", "US", "ENTERPRISE"),
    ]


def test_unknown_tiers_are_rejected(spark):
    current = profiles(spark, [("a", "GOLD", at()), ("b", "PRO", at())])
    _, rejected = enrich.split_dead_letter(enrich.enrich_current(orders(spark, TWO), current))
    assert rows(rejected, "order_id", "reason") == [("o1", "unknown tier")]


def test_hot_keys_are_joined_without_a_shuffle(spark):
    frame = orders(spark, [("a", f"o{i}", 1, "EUR", at()) for i in range(30)] + TWO + [(None, "n", 1, "EUR", at())])
    current = enrich.current_tiers(profiles(spark, [("a", "PRO", at()), ("c", "FREE", at())]))
    plain, split = enrich.enrich_current(frame, current), enrich.enrich_current(frame, current, 10)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()
    for keep, kept in ((enrich.matched_orders, 31), (enrich.unmatched_orders, 2)):
        assert keep(frame, current).count() == keep(frame, current, hot_rows=10).count() == kept


class FakeSession:
    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_shared_folder_comes_from_the_session():
    fake = FakeSession(spark_checkpoint_dir="hdfs:///shared/", spark_master="yarn")
    assert session.shared_folder(fake) == "hdfs:///shared"
    assert session.new_folder(fake, "x").startswith("hdfs:///shared/tallybrook/x-")


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        session.shared_folder(FakeSession(spark_master="yarn"))


def test_slices_have_equal_numbers_of_files(spark, tmp_path, monkeypatch):
    """A micro-batch of that many files is a whole slice, in order."""
    monkeypatch.setattr(td, "SLICE_FILE_ROWS", 10)
    frame = spark.range(400).toDF("n")
    source = str(tmp_path / "in")
    files = td.slices(frame, source, range(8), F.col("n"))
    assert files == 5
    stream = spark.readStream.schema("n bigint").option("maxFilesPerTrigger", files).parquet(source)
    batches = []
    query = stream.writeStream.foreachBatch(lambda b, i: batches.append(sorted(r.n for r in b.collect())))
    query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert batches == [list(range(i * 50, i * 50 + 50)) for i in range(8)]
    assert td.slices(frame.filter("n < 399 or n > 1"), str(tmp_path / "few"), range(1), F.when(F.col("n") > 0, 399).otherwise(0)) == 1
