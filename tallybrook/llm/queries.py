"""One query per corpus operator over its whole table: (spark, folder) -> DataFrame."""

import corpus_pipeline
from pyspark.sql import functions as F

from . import (
    byte_tokens,
    html,
    licenses,
    mixing,
    near_copies,
    neighbours,
    packing,
    pii,
    prefix_trie,
    quality,
    repeats,
    urls,
    whitening,
)
from .common import table


def op1_site_templates(spark, sf_dir):
    return html.extract_main_text(spark, table(spark, sf_dir, "pages"))


def op2_descent_graph(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(spark, vectors, lambda vec_id: vec_id % 20 == 0)


def op3_private_data(spark, sf_dir):
    return pii.digest(pii.find_pii(spark, table(spark, sf_dir, "documents")))


def op4_license_rules(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_pack_windows(spark, sf_dir):
    _, placed = packing.pack_documents(spark, table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "start",
        F.col("length").cast("bigint").alias("length"),
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_mix_sources(spark, sf_dir):
    mixed = mixing.plan_mix(spark, table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_weighted_samples(spark, sf_dir):
    return near_copies.near_copy_classes(spark, table(spark, sf_dir, "documents"))


def op8_link_trust(spark, sf_dir):
    judged = urls.judge_urls(spark, table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_compacted_repeats(spark, sf_dir):
    kept = repeats.remove_repeats(spark, table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_rules(spark, sf_dir):
    judged = quality.judge_documents(spark, table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_prefix_trie(spark, sf_dir):
    turns = prefix_trie.number_turns(spark, table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.prefix_trie(spark, prefix_trie.with_shared_openings(turns))
    return nodes.drop("a", "b")


def op12_whiten_slices(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_byte_tokens(spark, sf_dir):
    return byte_tokens.digest_documents(table(spark, sf_dir, "documents"))


def llm_queries():
    return {
        "op1_site_templates": op1_site_templates,
        "op2_descent_graph": op2_descent_graph,
        "op3_private_data": op3_private_data,
        "op4_license_rules": op4_license_rules,
        "op5_pack_windows": op5_pack_windows,
        "op6_mix_sources": op6_mix_sources,
        "op7_weighted_samples": op7_weighted_samples,
        "op8_link_trust": op8_link_trust,
        "op9_compacted_repeats": op9_compacted_repeats,
        "op10_quality_rules": op10_quality_rules,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_whiten_slices": op12_whiten_slices,
        "op13_byte_tokens": op13_byte_tokens,
        "pipeline": corpus_pipeline.run,
    }


def llm_oracles():
    return {
        "op4_license_rules": licenses.LICENSE_SQL,
        "op6_mix_sources": mixing.MIX_SQL,
        "op11_prefix_trie": prefix_trie.TRIE_SQL,
    }
