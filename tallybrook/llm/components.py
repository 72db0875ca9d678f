"""Connected components of links by smallest label, on Spark joins."""

from pyspark.sql import functions as F

from .common import stage

MAX_ROUNDS = 60  # labels jump twice as far every round, so this is never reached


def connected(spark, links):
    """`id`, `label` (smallest id of its component) for every id in `links` (a, b)."""
    edges = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
    edges = stage(spark, edges.select(F.col("e.a").alias("src"), F.col("e.b").alias("dst")).distinct(), "cc-edges")
    labels = stage(spark, edges.select(F.col("src").alias("id")).distinct().withColumn("label", F.col("id")), "cc-0")
    for step in range(MAX_ROUNDS):
        near = edges.join(labels.withColumnRenamed("id", "src"), "src")
        least = near.groupBy(F.col("dst").alias("id")).agg(F.min("label").alias("other"))
        moved = labels.join(least, "id").select("id", F.col("label").alias("old"), F.least("label", "other").alias("label"))
        moved = stage(spark, moved, f"cc-near-{step}")
        jump = moved.select(F.col("id").alias("label"), F.col("label").alias("to"))
        moved = moved.join(jump, "label").select("id", "old", F.least("label", "to").alias("label"))
        moved = stage(spark, moved, f"cc-{step + 1}")
        labels = moved.drop("old")
        if moved.filter("old <> label").isEmpty():
            return labels
    raise RuntimeError("labels did not settle")
