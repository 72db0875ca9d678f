"""Column expressions for record clocks and window bounds."""

from pyspark.sql import functions as F

from ..model import WINDOW


def with_window(df, time="timestamp", size=WINDOW):
    """Add `window_start` and `window_end` of the epoch-aligned tumbling window."""
    return df.withColumn("_w", F.window(time, size)).select(*df.columns, *window_bounds("_w"))


def window_bounds(window):
    """Start and end columns of a window column."""
    return (
        F.col(f"{window}.start").alias("window_start"),
        F.col(f"{window}.end").alias("window_end"),
    )


def from_epoch_millis(millis):
    return F.timestamp_millis(millis)


def to_epoch_millis(ts):
    return F.unix_millis(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts)


def millis_between(start, end):
    """Whole milliseconds from `start` to `end`; works with and without time zone."""
    return F.timestamp_diff("MILLISECOND", F.col(start), F.col(end))


def window_label(key="customer_id", start="window_start"):
    """`<customerId>@<ISO start>`, seconds resolution, UTC."""
    return F.concat_ws("@", F.col(key), F.date_format(F.col(start), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


# Fixed value: the accepted form of a window label.
WINDOW_LABEL_FORMAT = r"^[^@]+@\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?Z$"


def is_window_label(column):
    return F.col(column).rlike(WINDOW_LABEL_FORMAT)
