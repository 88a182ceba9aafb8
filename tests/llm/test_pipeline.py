"""The five stages against their operators, one after another, on a small fixture."""

from __future__ import annotations

import hashlib

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from palaver.llm import bpe  # noqa: E402
from palaver.llm.registry import QUERIES, vocabulary  # noqa: E402


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = bpe.Bpe.load(*vocabulary())
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        after = stage(spark, docs, sf_dir).cache()
        counts.append((name, before, after.count()))
        if name != "byte_bpe":
            assert after.columns == docs.columns
        else:
            texts = sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest(), own.encode(r["text"])) for r in docs.collect())
            assert sorted((r["doc_id"], r["decoded_sha256"], bytes(r["ids"])) for r in after.collect()) == texts
        docs = after
    assert counts[0][2] < counts[0][1] and counts[1][2] == counts[1][1] and counts[2][2] < counts[2][1]
    assert docs.count() == corpus_pipeline.run(spark, sf_dir).count()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert "doc_id" in df.columns
