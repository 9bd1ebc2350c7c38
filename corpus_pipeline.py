"""Documents through five of the training-data operators, each stage written and read again.

The result holds one row per document copy of the mix: its ids as little-endian unsigned 32-bit integers,
their number, and the digests of the ids and of the bytes they decode to.

Defined results: documents whose text is null, empty or too short leave by the quality rules. Repeated rows
are copies, of which near-duplicate detection keeps one. Extra columns stay until the tokens are written. An
empty table gives no rows. Null sources are one source of the mix; rows without an id are told apart by their text.
Folders of stages are removed when the next one is written; the last one holds the result.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewell.llm import bpe, mixing, near_dup, quality, toxicity
from sitewell.llm.common import shared_folder, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on what is left, does not hold for toxic."""
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeated(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, decoded again for the digest."""
    path = public_tokenizers.path(RANKS)
    rows = docs.select("doc_id", "source", "text")
    return bpe.encode(rows, path, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_stage), ("toxicity", toxicity_stage), ("near duplicates", near_dup_stage),
          ("source mix", mixing_stage), ("byte-level BPE", token_stage)]

# The classifier, the near-duplicate search and the tokenizer are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:  # what the stage read is not needed again
            remove(spark, f"{folder}/{k - 1}")
    return docs
