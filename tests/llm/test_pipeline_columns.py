"""The pipeline's stages over tables with columns of every name that a stage makes for itself."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

MADE = ("ids", "decoded", "score", "fp", "_copies", "component_id", "size", "spans", "root", "row", "words", "taken")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_clashing_columns(spark, sf_dir, awkward, nothing, name, stage):
    for docs in (awkward, nothing):
        wide = docs.select("doc_id", "text", "lang", "source", "n_chars", *[F.concat(F.lit(m), F.coalesce("doc_id", F.lit(0))).alias(m) for m in MADE])
        found = stage(spark, wide, sf_dir)
        assert found.columns == [*wide.columns, *(["ids_"] if name == "pieces" else [])]
        rows = found.collect()
        assert all(r[m] == f"{m}{r['doc_id'] or 0}" for r in rows for m in MADE)
        assert bool(rows) == (docs is awkward)
