"""Starting streaming queries: identity, position, trigger."""

from contextlib import contextmanager

from pyspark.sql import SparkSession

# Keyed state lives in RocksDB instances of the executors, checkpointed next to the offsets.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state"
    ".RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(values):
    """Session settings for the moment that a query starts; the query keeps them."""
    conf = SparkSession.active().conf
    before = {name: conf.get(name, None) for name in values}
    for name, value in values.items():
        conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)


def start(stream_writer, checkpoint, name=None, available_now=True, every=None, state_partitions=None):
    """Start a query whose progress lives in `checkpoint`.

    A new checkpoint folder starts from the earliest input; the same folder goes on
    where the last run stopped. With `available_now` the query stops by itself when
    the input present at the start is used up. `state_partitions` divides the keyed state of
    a new checkpoint; it holds for the life of the checkpoint.
    """
    writer = stream_writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    values = dict(STATE_STORE)
    if state_partitions:
        values["spark.sql.shuffle.partitions"] = str(state_partitions)
    with _settings(values):
        return writer.start()


def run_to_end(stream_writer, checkpoint, name=None, state_partitions=None):
    query = start(stream_writer, checkpoint, name, state_partitions=state_partitions)
    query.awaitTermination()
    return query


def for_each_batch(df, handle, output_mode="append"):
    return df.writeStream.outputMode(output_mode).foreachBatch(handle)
