"""From raw documents to encoded training text: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lectern.llm import bpe, mixing, quality, repeats, simhash
from lectern.llm.common import prepare, stage, store


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language go."""
    return quality.keep_good(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (fingerprints and MinHash of five-word shingles, then similarity 0.8) the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs)


@stage
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that occur earlier are cut out of the texts."""
    return repeats.remove_repeats(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with raked weights of source, language and topic."""
    return mixing.sample(docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, give_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_dedup),
    ("repeated passages", suffix_dedup),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Fingerprints, suffix sorting and byte-pair merges have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's output stored; an empty table gives no rows, a null id or text stays or goes as
    the stages say."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = store(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
