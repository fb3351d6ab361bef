"""The corpus pipeline: documents to sampled pieces, in five stages that are each written and read again.

Every stage takes null texts as empty and null ids as they come, texts of any length, tables without rows, and columns of
any names beside doc_id and text; it keeps repeated rows but for the second, which keeps one row of each group. What each does
with ties is said in its operator's module.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gleanspark.checkpoints import with_checkpoints
from gleanspark.llm import decontaminate, sampled_pieces, secret_scan, simhash, toxicity
from gleanspark.llm.queries import PIECES


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the model, fitted to `labels`, predicts to be toxic; without labels of both classes none or all."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that with the least id; texts without words are one group."""
    return simhash.keep_one(docs)


def unseen_by_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a benchmark window occurs; a document without words stays."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; n_chars follows."""
    return secret_scan.redact_secrets(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of the texts, as token ids with scores."""
    return sampled_pieces.sample_pieces(docs, public_tokenizers.path(PIECES))


#: (name, function of the session, the stage's documents and the input folder), in order.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean_language),
    ("simhash", one_of_each),
    ("decontamination", unseen_by_benchmarks),
    ("secrets", without_secrets),
    ("pieces", pieces),
]

#: Learned scores, hashed fingerprints and seeded draws are beyond SQL; a test holds the rows against a plain version.
ORACLE_SQL = None


def _removed(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what lies between them goes to the shared checkpoint folder, and goes away when the next stage has been written."""
    with_checkpoints(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            made = f"{folder}/{i}-{name}"
            docs.write.parquet(made)
            docs = spark.read.parquet(made)
            if last:
                _removed(spark, last)
            last = made
    return docs
