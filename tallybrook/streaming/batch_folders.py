"""Results of foreachBatch queries: one folder per batch, replaced when the batch runs again."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_folder(path, batch_id):
    return os.path.join(path, f"batch_id={batch_id}")


def finished_batches(spark, path):
    """Numbers of the batches whose folder is complete: the commit of a write leaves a
    `_SUCCESS` file, and a repeated write removes it first."""
    root = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "batch_id=*", "_SUCCESS"))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in files or [])


def schema_folder(path):
    return path.rstrip("/") + "-schema"


def write_batch(df, path, batch_id, partition_by=()):
    """Idempotent sink: the rows of a batch replace those of its earlier attempts.

    Results belong to one checkpoint. A query that starts anew finds the batches of the one
    before it and stops, as both would otherwise be read together."""
    spark = df.sparkSession
    if batch_id == 0:
        if any(n > 0 for n in finished_batches(spark, path)):
            raise ValueError(f"{path} holds results of an earlier query; give the new one its own folder")
        df.filter(F.lit(False)).write.mode("overwrite").parquet(schema_folder(path))
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(batch_folder(path, batch_id))


def read_batches(spark, path):
    """All rows of finished batches written by `write_batch`, with `batch_id`."""
    fields = spark.read.parquet(schema_folder(path)).schema.fields
    schema = T.StructType([*fields, T.StructField("batch_id", T.LongType())])
    folders = [batch_folder(path, n) for n in finished_batches(spark, path)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)
