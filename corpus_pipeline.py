"""From raw documents to token ids: five stages, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sensorstar.llm.bpe import encode_decode, read_tokenizer
from sensorstar.llm.common import stored, table
from sensorstar.llm.decontaminate import without_contaminated
from sensorstar.llm.minhash import without_near_duplicates
from sensorstar.llm.secret_scan import mask_secrets
from sensorstar.llm.toxicity import fit, without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, does not call toxic."""
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return mask_secrets(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, their digests, and the digest of what they decode to."""
    return encode_decode(docs, read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", hide_secrets),
    ("tokens", to_tokens),
]

# The classifier, the automaton and the encoder are beyond SQL; the tests follow the
# stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
