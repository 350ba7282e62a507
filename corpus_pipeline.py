"""From raw documents to token ids: toxic texts out, one of each near-duplicate group, personal data hidden, sources
mixed to target weights, byte-level BPE.

Each stage is a function (spark, docs, sf_dir); what it returns is written and read again as the next one's ``docs``.
All but the last return the columns of ``documents``; the last gives ``doc_id``, ``n_tokens`` and the ``ids``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.llm import bpe, disclosure, mixing, severity, simhash
from daymill.llm.common import stored
from daymill.session import apply_runtime_options


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labelled ones, doesn't reject."""
    model = severity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return severity.keep_clean(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return disclosure.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    # Workers live on through the stages of a run, so they keep less here than by default.
    coded = bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, remembered=200_000, states=80_000)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_dedup),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
    ("byte_level_bpe", tokenise),
]

#: The model, the hashes and the vocabulary are beyond SQL; tests/llm/test_pipeline.py compares the run by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; every stage is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(apply_runtime_options(spark), docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
