"""The pipeline's stages on a small table."""

import numpy as np

from pyspark.sql import functions as F

import corpus_pipeline
from hazardmart.llm.bpe_codec import codec
from hazardmart.llm.byte_bpe import default_tokenizer
from hazardmart.llm.common import read
from tests.llm.test_near_dedup import brute_force

SF_DIR = "/root/testdata/sf0.001"


def test_stages_decide_and_keep_the_columns(spark):
    docs = read(spark, SF_DIR, "documents")
    sizes, before = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        after = spark.createDataFrame(stage(spark, before, SF_DIR).collect(), stage(spark, before, SF_DIR).schema)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        if name == "near_duplicates":
            rows = [(row["doc_id"], row["text"]) for row in before.select("doc_id", "text").collect()]
            kept = sorted(key for key, (_, _, stays) in brute_force(rows).items() if stays)
            assert sorted(row["doc_id"] for row in after.select("doc_id").collect()) == kept
        if name == "tokens":
            texts = sorted((row["doc_id"], row["text"]) for row in before.select("doc_id", "text").collect())
            decoded = codec(default_tokenizer()).decode
            assert sorted((row["doc_id"], decoded(row["token_ids"])) for row in after.collect()) == texts
            assert all(row["n_tokens"] * 4 == len(row["token_ids"]) for row in after.collect())
        sizes.append(after.count())
        before = after
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0


def test_run_is_repeatable(spark):
    first, second = (corpus_pipeline.run(spark, SF_DIR) for _ in range(2))
    ids = [sorted(row["doc_id"] for row in frame.collect()) for frame in (first, second)]
    assert ids[0] == ids[1] and len(ids[0]) > 0
    assert np.isfinite(len(ids[0]))


def test_stages_keep_columns_that_bear_inner_names(spark):
    docs = read(spark, SF_DIR, "documents")
    names = [
        "toxicity", "quality", "score", "cumulative", "uniform", "source_rate", "zero", "whole_text", "known_id", "node", "shares_id",
        "several", "n_shingles", "component_id", "kept", "hash", "label", "_text", "_id", "_node",
    ]
    clashing = docs.select("*", *(F.lit(place).alias(name) for place, name in enumerate(names)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, clashing, SF_DIR)
        assert after.columns == clashing.columns, name
        assert all(tuple(row)[-len(names) :] == tuple(range(len(names))) for row in after.collect()), name
        assert sorted(row["doc_id"] for row in after.collect()) == sorted(row["doc_id"] for row in stage(spark, docs, SF_DIR).collect())
    encoded = corpus_pipeline.tokenize(spark, clashing, SF_DIR)
    assert set(names) < set(encoded.columns) and encoded.count() == docs.count()
