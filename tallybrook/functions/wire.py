"""Column expressions over raw message bytes.

Fixed format: byte 0 is the magic number 0, bytes 1-4 hold the schema id
(big-endian), the rest is the payload.
"""

from pyspark.sql import functions as F

MAGIC = 0
PREFIX_BYTES = 5


def decode_key(column="key"):
    """Key bytes as text; text passes through."""
    return F.col(column).cast("string")


def _unsigned(column, start, length):
    digits = F.hex(F.substring(column, start, length))
    return F.conv(digits, 16, 10).cast("bigint")


def split_wire_prefix(df, column="value"):
    """Add `magic`, `schema_id`, `payload` and `wire_error`.

    `wire_error` is null for a well-formed record, else `short_prefix` or
    `bad_magic`; the other columns are null where they cannot be read.
    """
    long_enough = F.length(column) >= PREFIX_BYTES
    magic = F.when(F.length(column) >= 1, _unsigned(column, 1, 1).cast("int"))
    good = long_enough & (magic == MAGIC)
    return (
        df.withColumn("magic", magic)
        .withColumn("schema_id", F.when(good, _unsigned(column, 2, 4)))
        .withColumn(
            "payload",
            F.when(good, F.substring(F.col(column), F.lit(PREFIX_BYTES + 1), F.length(column))),
        )
        .withColumn(
            "wire_error",
            F.when(F.col(column).isNull(), F.lit(None))
            .when(~long_enough, F.lit("short_prefix"))
            .when(magic != MAGIC, F.lit("bad_magic")),
        )
    )
