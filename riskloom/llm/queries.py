"""The text queries and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import collocations, fingerprint, licences, mixing, neighbours, pieces, prefix_trie, quality_rules, secret_scan, simhash, token_count, toxicity, wrappers


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run  # at the repository's top, beside the package

    return run(spark, sf_dir)


def catalogue() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": fingerprint.query,
        "op2_licences": licences.query,
        "op3_html": wrappers.query,
        "op4_simhash": simhash.query,
        "op5_pieces": pieces.query,
        "op6_toxicity": toxicity.query,
        "op7_token_counts": token_count.query,
        "op8_quality_rules": quality_rules.query,
        "op9_mixing": mixing.query,
        "op10_secrets": secret_scan.query,
        "op11_prefix_trie": prefix_trie.query,
        "op12_collocations": collocations.query,
        "op13_neighbours": neighbours.query,
        "pipeline": pipeline,
    }


def statements() -> dict[str, str]:
    return {
        "op2_licences": licences.sql(),
        "op11_prefix_trie": prefix_trie.sql(),
        "op12_collocations": collocations.sql(),
    }
