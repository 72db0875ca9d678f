"""Finding the few keys that hold too many rows for one task."""

from functools import reduce

from pyspark.sql import functions as F

# A key above HOT_ROWS rows is split. Of N rows at most N / HOT_ROWS keys can be
# above it, and a key that does not make the MAX_HOT_KEYS largest has at most
# N / MAX_HOT_KEYS rows. Keys that are not split take the plain path, which is
# exact for any size, so both numbers steer speed and never the result.
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000

# Default of `hot` parameters: count now. Callers that run several operators over
# the same keys count once with find_hot_keys and pass the result (a frame or None).
DETECT = object()


def find_hot_keys(df, keys, hot_rows=HOT_ROWS):
    """The hot keys of `df` as a small frame, or None when there are none.

    One map-side combined count over the key columns alone. At most MAX_HOT_KEYS
    rows come back, so the frame can be broadcast.
    """
    top = (
        df.select(*keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .orderBy(F.col("_rows").desc())
        .limit(MAX_HOT_KEYS)
        .select(*keys)
    )
    rows = top.collect()  # bounded by the limit above
    if not rows:
        return None
    return df.sparkSession.createDataFrame(rows, top.schema)


def mark_hot(df, keys, hot, flag="_hot"):
    """Add a boolean column telling which rows belong to a hot key."""
    if hot is None:
        return df.withColumn(flag, F.lit(False))
    names = [f"_hot_{k}" for k in keys]
    side = F.broadcast(hot.toDF(*names).withColumn(flag, F.lit(True)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return df.join(side, same, "left").drop(*names).withColumn(flag, F.coalesce(flag, F.lit(False)))
