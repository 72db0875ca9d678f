"""Profile history readers and the seed profiles."""

from pyspark.sql import functions as F

from ..model import PROFILES, PROFILES_TOPIC, SEED_PROFILES


def read_profiles(spark, path):
    """History of profile upserts and deletions."""
    return spark.read.schema(PROFILES).parquet(path)


def seed_profiles(spark, seeded_at="2024-01-01 00:00:00"):
    """The four seed profiles as history rows, one record per customer."""
    rows = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(SEED_PROFILES)],
        "offset bigint, customer_id string, country string, tier string",
    )
    return rows.select(
        F.col("customer_id").alias("key"),
        F.lit(PROFILES_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.lit(seeded_at).cast("timestamp").alias("timestamp"),
        "customer_id",
        "country",
        "tier",
        F.lit(False).alias("deleted"),
    )
