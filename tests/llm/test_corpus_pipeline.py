"""run() against the stages by brute force on a small table."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from sitewell.llm import bpe, mixing, near_dup, quality, toxicity

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_run_applies_every_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for stage in (quality.keep, lambda d: toxicity.keep(d, labels), near_dup.keep_one):
        fewer = spark.createDataFrame(stage(docs).collect(), docs.schema)
        assert fewer.columns == docs.columns and 0 < fewer.count() <= docs.count()
        docs = fewer
    times = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixing.taken(docs).collect() if r["size"]}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.ranks(public_tokenizers.path(corpus_pipeline.RANKS)))
    wanted = []
    for r in docs.collect():
        ids = np.array(library.encode_ordinary(r["text"]), dtype="<u4").tobytes()
        row = (r["doc_id"], r["source"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest())
        wanted += [row] * times.get(r["doc_id"], 0)
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(wanted)


def test_stages_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "quality_stage", "toxicity_stage", "near_dup_stage", "mixing_stage", "token_stage"]


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_nulls_and_nothing(spark, edges, nothing, stage):
    for docs in (edges, nothing):
        got = stage(spark, docs, FOLDER)
        rows = got.count()
        assert stage is corpus_pipeline.token_stage or got.columns == docs.columns
        assert rows >= 0 and (rows > 0 or docs is nothing)
