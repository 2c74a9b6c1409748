"""The pipeline's stages one after the other on tables that hold little."""

import pytest
from test_edges import EDGE, documents

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [[], EDGE], ids=["empty", "edge"])
def test_stages_on_edges(spark, rows):
    """Nulls, empty and blank texts, repeated rows, null ids, and further columns named like those that stages add."""
    docs = documents(spark, rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, FOLDER).collect()
        after = spark.createDataFrame(kept, stage(spark, docs, FOLDER).schema)
        assert after.columns == ([*columns, "mix_copy"] if name == "mixing" else columns)
        assert len(kept) <= 3 * len(rows)
        docs = after
