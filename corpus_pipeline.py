"""The corpus pipeline: documents in, token ids out, in five stages that each work on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Nulls in any column pass through every stage: a null text counts as an empty one; a null key is the least where equal
texts compete, and its row stays where near copies go.  Of repeated rows and of ties one row stays in the stages that drop copies, and each is a row like any other
in the rest.  An empty table gives an empty one.  Further columns are carried, whatever their names, but for the last
stage, which returns its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, exact_dedup, mixing, near_copies, toxicity
from ledgerline.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest key stays."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (Jaccard similarity of five-word shingles of 0.8 or more)."""
    return near_copies.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to four times, towards 98 % of the entropy of equal weights; no document is lost."""
    return mixing.mixed(docs, budget=None, target_entropy=0.98, max_repetition=4.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every document of the mixture."""
    rows = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("bpe_encoding", encode),
]

#: A learnt classifier, near-copy links and BPE are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
