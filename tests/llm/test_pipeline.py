"""The pipeline on the smallest driver tables, stage by stage."""

import os

import pytest

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not there")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = [r[0] for r in docs.select("doc_id").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "stage")
        assert out.columns == docs.columns, name
        kept = [r[0] for r in out.select("doc_id").collect()]
        assert kept and set(kept) <= set(ids)
        if name != "mixing to target weights":
            assert len(kept) == len(set(kept))
        docs, ids = out, kept
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == sorted(ids)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(out, out[1:], strict=False))
