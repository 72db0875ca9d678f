"""Audits of schema ids in the data and of schema history.

The registry dump has one row per (subject, version, field).
"""

from pyspark.sql import functions as F

from ..functions.wire import split_wire_prefix
from ..plans.hot_keys import HOT_ROWS, find_hot_keys, mark_hot
from ..plans.running import BLOCK_ROWS, Fold, offset_block, running


def schema_id_counts(records, column="value"):
    """Records per schema id found in the wire prefix."""
    return (
        split_wire_prefix(records.select(column), column)
        .filter(F.col("schema_id").isNotNull())
        .groupBy("schema_id")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def dangling_schema_ids(records, registry, id_column="content_id"):
    """Ids the data refers to and the registry does not have."""
    known = registry.select(F.col(id_column).alias("schema_id")).distinct()
    return schema_id_counts(records).join(known, "schema_id", "left_anti")


def ambiguous_schema_ids(records, registry):
    """Numbers that mean one schema as global id and another as content id: one row per pair of
    subjects that a record with the number may mean, and the number of records that carry it."""
    as_global = (
        registry.filter(F.col("content_id") != F.col("global_id"))
        .select(F.col("global_id").alias("schema_id"), F.col("subject").alias("global_subject"))
        .distinct()
    )
    as_content = registry.select(
        F.col("content_id").alias("schema_id"), F.col("subject").alias("content_subject")
    ).distinct()
    return (
        as_global.join(as_content, "schema_id")
        .join(schema_id_counts(records), "schema_id", "left")
        .select(
            "schema_id",
            "global_subject",
            "content_subject",
            F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
        )
    )


def schema_compat_diff(registry, hot_rows=HOT_ROWS, block_rows=BLOCK_ROWS):
    """Fields that break FULL compatibility between consecutive versions.

    backward: the new version requires a field the old one lacks.
    forward: the old version requires a field the new one lacks.
    """
    versions = registry.select("subject", "version").distinct()
    folds = {"old_version": Fold("max", F.col("version"))}
    hot = find_hot_keys(versions, ["subject"], hot_rows)
    if hot is None:
        steps = running(versions, ["subject"], ["version"], folds, inclusive=False)
    else:
        steps = running(
            mark_hot(versions, ["subject"], hot),
            ["subject"],
            ["version"],
            folds,
            offset_block("version", block_rows),
            split=F.col("_hot"),
            inclusive=False,
        ).drop("_hot")
    # the size of rows out of an explode is underestimated, and one side would be broadcast
    steps = steps.filter(F.col("old_version").isNotNull()).hint("merge")

    fields = registry.select("subject", "version", "field", "has_default")
    new = fields.join(steps, ["subject", "version"]).select(
        "subject", "old_version", "version", "field", F.col("has_default").alias("new_default")
    )
    old = (
        fields.withColumnRenamed("version", "old_version")
        .join(steps, ["subject", "old_version"])
        .select(
            "subject", "old_version", "version", "field", F.col("has_default").alias("old_default")
        )
    )
    sides = (
        new.unionByName(old, allowMissingColumns=True)
        .groupBy("subject", "old_version", "version", "field")
        .agg(
            F.max("new_default").alias("new_default"), F.max("old_default").alias("old_default")
        )
    )
    direction = F.when(
        F.col("old_default").isNull() & ~F.col("new_default"), F.lit("backward")
    ).when(F.col("new_default").isNull() & ~F.col("old_default"), F.lit("forward"))
    return (
        sides.withColumn("direction", direction)
        .filter(F.col("direction").isNotNull())
        .select("subject", "old_version", "version", "field", "direction")
    )
