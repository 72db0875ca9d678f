"""Looking up, for each event, the latest version at or before its time.

Events do not depend on each other, only on versions of the same key. A key of
ordinary size is answered by one window over the union of both sides. A hot key
is cut into cells of (time slice, block of offsets): each cell receives the
versions of its slice plus the one version valid when the slice begins. A cell
holds at most one block of events and, because versions are first reduced to one
per (key, time), at most as many versions as its slice has distinct times.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .hot_keys import HOT_ROWS, find_hot_keys, mark_hot
from .running import BLOCK_ROWS, offset_block

SLICE = "1 minute"


def lookup_asof(
    events,
    versions,
    key,
    time,
    payload,
    version_order="offset",
    event_offset="offset",
    hot_rows=HOT_ROWS,
    block_rows=BLOCK_ROWS,
    slice_width=SLICE,
):
    """Events plus `payload`: the newest version with version time <= event time.

    Both frames have the columns `key` and `time`; `payload` names a struct column
    of `versions` that is never null, so that a deletion hides older versions. At
    equal times a version comes before an event, and among versions of one time
    the highest `version_order` wins. `payload` is null where nothing precedes.
    """
    columns = events.columns
    hot = find_hot_keys(events.select(key).unionAll(versions.select(key)), [key], hot_rows)
    versions = (
        versions.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
        .groupBy(key, time)
        .agg(F.max_by(payload, version_order).alias(payload))
    )
    if hot is None:
        # events without a key match nothing; spread them instead of grouping them
        cell = F.when(F.col(key).isNull(), offset_block(event_offset, block_rows))
        left = events.withColumn("_cell", cell)
        right = versions.withColumn("_cell", F.lit(None).cast("bigint"))
        return _latest(left, right, [key, "_cell"], time, payload, columns)

    # window() would drop rows without a time
    epoch = F.lit("1970-01-01").cast(events.schema[time].dataType)
    slice_of = F.window(F.coalesce(F.col(time), epoch), slice_width)["start"]
    left = (
        mark_hot(events, [key], hot)
        .withColumn("_split", F.col("_hot") | F.col(key).isNull())
        .withColumn("_slice", F.when(F.col("_split"), slice_of))
        .withColumn("_cell", F.when(F.col("_split"), offset_block(event_offset, block_rows)))
    )
    right = (
        mark_hot(versions, [key], hot)
        .withColumn("_slice", F.when(F.col("_hot"), slice_of))
        .withColumn("_cell", F.lit(None).cast("bigint"))
    )
    cold_versions = right.filter(~F.col("_hot"))
    hot_versions = right.filter(F.col("_hot")).drop("_cell")

    cells = left.filter("_hot").select(key, "_slice", "_cell").distinct()
    newest_in_slice = hot_versions.groupBy(key, "_slice").agg(
        F.max_by(payload, time).alias(payload)
    )
    slices = newest_in_slice.unionByName(
        cells.select(key, "_slice").distinct(), allowMissingColumns=True
    )
    slices = slices.groupBy(key, "_slice").agg(F.first(payload, ignorenulls=True).alias(payload))
    before = (
        Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    opening = (
        slices.withColumn(payload, F.last(payload, ignorenulls=True).over(before))
        .filter(F.col(payload).isNotNull())
        .join(cells, [key, "_slice"])
    )
    inside = hot_versions.join(cells, [key, "_slice"])
    right = cold_versions.unionByName(inside).unionByName(opening, allowMissingColumns=True)
    return _latest(left, right, [key, "_slice", "_cell"], time, payload, columns)


def _latest(left, right, group, time, payload, columns):
    both = left.withColumn("_side", F.lit(1)).unionByName(
        right.select(*group, time, payload).withColumn("_side", F.lit(0)),
        allowMissingColumns=True,
    )
    # a missing time sorts first: the version valid when the cell begins
    window = (
        Window.partitionBy(*group)
        .orderBy(F.col(time).asc_nulls_first(), "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    newest = F.last(payload, ignorenulls=True).over(window)
    return (
        both.select(*columns, "_side", F.when(F.col(time).isNotNull(), newest).alias(payload))
        .filter(F.col("_side") == 1)
        .drop("_side")
    )
