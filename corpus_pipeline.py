"""Corpus pipeline: from documents to packed training sequences, in five stages.

Every stage works on all rows that the stage before it kept. Stages 1 to 4 return the columns
of `documents`; the last returns one row per piece of a packed document. Each result is written
as Parquet and read again before the next stage starts. Null texts fall to the quality rules;
an empty table passes through all stages; extra columns stay until the last one.
"""

import functools

from pyspark.sql import functions as F

from tallybrook.llm import mixing, near_copies, packing, pii, quality
from tallybrook.llm.common import release, staged, table
from tallybrook.llm.common import stage as written

_stages = []  # folders that the stage before wrote for itself


def _step(function):
    """A stage. When it starts, the result of the stage before it is written, so what that one
    staged for itself is deleted: the disk holds the intermediate tables of one stage at a time."""

    @functools.wraps(function)
    def run_step(spark, docs, sf_dir):
        release(spark, [p for p in _stages if p in staged()])
        before = set(staged())
        result = function(spark, docs, sf_dir)
        _stages[:] = [p for p in staged() if p not in before]
        return result

    return run_step


@_step
def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or are outliers of their language and source go."""
    return quality.keep_good_documents(spark, docs)


@_step
def near_copies_stage(spark, docs, sf_dir):
    """One document of each class of near copies stays: the one with the smallest id."""
    return near_copies.keep_one_of_each(spark, docs)


@_step
def private_data(spark, docs, sf_dir):
    """Personal data in the texts is replaced by its kind; `n_chars` follows the text."""
    clean = pii.redact(spark, docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


@_step
def mix_sources(spark, docs, sf_dir):
    """Documents are repeated or left out so that the sources come near their targets."""
    return mixing.mix_documents(spark, docs)


@_step
def pack_sequences(spark, docs, sf_dir):
    """Pieces of the mixed documents and their places in sequences of 2048 ids."""
    _, placed = packing.pack_documents(spark, docs)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality", quality_rules),
    ("near_copies", near_copies_stage),
    ("private_data", private_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The stages hash, sample and tokenise in ways that SQL does not have; tests/llm holds them
# against brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = written(spark, step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
