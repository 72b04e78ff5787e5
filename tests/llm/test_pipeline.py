"""The pipeline's stages, each against what its operator says, and odd rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from batchwright.llm import exact_dedup, quality, secrets, simhash
from tests.conftest import SF
from tests.llm.test_dedup import normal
from tests.llm.test_text import whole


def test_stages_in_order(spark, documents):
    docs = documents
    names = []
    for name, stage in corpus_pipeline.STAGES:
        names.append(name)
        before, docs = docs, stage(spark, docs, SF).cache()
        if name != "best_fit_packing":
            assert docs.columns == documents.columns
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "quality_rules":
            assert ids == {r["doc_id"] for r in quality.quality(before).where("kept").collect()}
        elif name == "exact_duplicates":
            assert ids == {r["keep_id"] for r in exact_dedup.exact_dedup(before).collect()}
        elif name == "near_duplicates":
            assert ids == {r["component_id"] for r in simhash.simhash_dedup(before).collect()}
        elif name == "secret_scan":
            want = {r["doc_id"]: secrets.redact(r["text"]) for r in before.collect()}
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
        else:
            used, least = whole(docs.collect(), [(r["doc_id"], r["text"]) for r in before.collect()])
            assert used <= least + 1
    assert names == ["quality_rules", "exact_duplicates", "near_duplicates", "secret_scan", "best_fit_packing"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, odd, empty, name, stage):
    assert stage(spark, empty, SF).count() == 0
    assert stage(spark, odd, SF).count() >= 1


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_clashing_columns_come_back(spark, odd, name, stage):
    """Columns named like the stages' helpers keep their place and values."""
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns
    extra = [c for c in odd.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    assert all(r[c] == c for r in out.collect() for c in extra)


def test_repeated_rows_leave_one(spark, documents):
    twice = documents.unionByName(documents).withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[1:3]:
        got = [normal(r["text"]) for r in stage(spark, twice, SF).collect()]
        assert max(Counter(got).values()) == 1
        assert len(got) == stage(spark, documents, SF).count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
