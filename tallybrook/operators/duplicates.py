"""Repeated order ids."""

from pyspark.sql import functions as F

from ..plans.hot_keys import HOT_ROWS, MAX_HOT_KEYS, mark_hot
from ..session import new_folder


def named(records, id_column):
    """Records whose id is neither null nor empty."""
    return records.filter(F.col(id_column).isNotNull() & (F.col(id_column) != ""))


def position(records, order="offset"):
    """Total order of records: offsets count within their partition only."""
    return F.struct(*[c for c in ("partition", order) if c in records.columns])


def repeated_ids(records, id_column="order_id", order="offset", seen=None, folder=None):
    """Ids that occur more than once: how often (`occurrences`) and first where.

    `first_at` is the position of the first record, null if the id was seen before these
    records: then every one of them is a repeat. `seen` holds earlier ids and their
    `first_seen`. `folder` is where the result is written (default: a new one).

    Nearly every id is unique, so counting shuffles one narrow row per record. The
    result is small in comparison; it is written to the shared folder once, which
    lets its readers see its size and not count again.
    """
    places = named(records, id_column).select(
        id_column, position(records, order).alias("at"), F.lit(None).cast("bigint").alias("before")
    )
    if seen is not None:
        earlier = F.lit(None).cast(places.schema["at"].dataType)
        places = places.unionAll(seen.select(id_column, earlier, "first_seen"))
    found = (
        places.groupBy(id_column)
        .agg(
            F.count(F.lit(1)).alias("occurrences"),
            F.min("at").alias("at"),
            F.min("before").alias("before"),
        )
        .filter(F.col("occurrences") > 1)
        .select(
            id_column,
            "occurrences",
            F.when(F.col("before").isNull(), F.col("at")).alias("first_at"),
            F.coalesce("before", F.col(f"at.{order}")).alias("first_seen"),
        )
    )
    folder = folder or new_folder(records.sparkSession, "repeated-ids")
    found.write.mode("overwrite").parquet(folder)
    return records.sparkSession.read.schema(found.schema).parquet(folder)


def join_repeated(records, repeated, id_column, how, hot_rows=HOT_ROWS):
    """Join records with `repeated_ids`. Records of the most frequent ids are not
    shuffled: those few ids are broadcast."""
    wanted = repeated.select(id_column, "first_at", "first_seen")
    top = repeated.filter(F.col("occurrences") > hot_rows)
    top = top.orderBy(F.col("occurrences").desc()).limit(MAX_HOT_KEYS)
    rows = top.select(*wanted.columns).collect()  # bounded by the limit
    if not rows:
        return records.join(wanted, id_column, how)
    hot = records.sparkSession.createDataFrame(rows, wanted.schema)
    marked = mark_hot(records, [id_column], hot.select(id_column))
    return (
        marked.filter("_hot")
        .join(F.broadcast(hot), id_column, how)
        .unionByName(marked.filter(~F.col("_hot")).join(wanted, id_column, how))
        .drop("_hot")
    )


def duplicate_orders(records, id_column="order_id", order="offset", hot_rows=HOT_ROWS):
    """Every re-occurrence of an order id, with the position of the first one."""
    repeated = repeated_ids(records, id_column, order)
    joined = join_repeated(records, repeated, id_column, "inner", hot_rows)
    return joined.filter(is_repeat(records, order)).drop("first_at")


def is_repeat(records, order="offset"):
    """Whether a record joined with `repeated_ids` is not the first of its id."""
    later = position(records, order) > F.col("first_at")
    return F.col("first_seen").isNotNull() & F.coalesce(later, F.lit(True))
