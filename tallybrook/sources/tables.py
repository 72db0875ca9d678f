"""Readers of the tables the audits and metric queries work on."""

from ..model import METRIC_SAMPLES, REGISTRY_DUMP


def read_registry_dump(spark, path):
    """One row per (subject, version, field) of the schema registry."""
    return spark.read.schema(REGISTRY_DUMP).parquet(path)


def read_metric_samples(spark, path):
    return spark.read.schema(METRIC_SAMPLES).parquet(path)
