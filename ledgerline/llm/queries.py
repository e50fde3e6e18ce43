"""Queries over the operators of this package, with the SQL that states the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, mixing, relative_lz, sharding, simhash, suffix_array, syncmers, token_counts, toxicity
from .common import table


def op1_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=8)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model, limit=4096)


def op6_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relative_lz.parsed(table(spark, sf_dir, "documents"), window=13)
    digest = F.sha2(F.encode("kept", "UTF-8"), 256)
    return rows.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture as large as the corpus, at 98 % of the entropy of equal weights, no source over four times."""
    return mixing.mix(table(spark, sf_dir, "documents"), budget=1.0, target_entropy=0.98, max_repetition=4.0)


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_array.cleaned(table(spark, sf_dir, "documents"), window=400)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_syncmers": op1_syncmers,
    "op2_sharding": op2_sharding,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_token_counts": op5_token_counts,
    "op6_relative_lz": op6_relative_lz,
    "op7_bpe": op7_bpe,
    "op8_mixing": op8_mixing,
    "op9_suffix_array": op9_suffix_array,
    "op10_simhash": op10_simhash,
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_relative_lz": r"""
        WITH lists AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        words AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM lists),
        windows AS (
          SELECT doc_id, j, n, string_agg(word, ' ') OVER (
            PARTITION BY doc_id ORDER BY j ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS win
          FROM words QUALIFY j <= n - 12),
        firsts AS (SELECT win, min(doc_id) AS first FROM windows GROUP BY win),
        gone AS (
          SELECT DISTINCT doc_id, unnest(generate_series(j, j + 12)) AS j
          FROM windows JOIN firsts USING (win) WHERE first < doc_id),
        kept AS (
          SELECT w.doc_id, count(g.j) AS n_removed,
                 coalesce(string_agg(word, ' ' ORDER BY w.j) FILTER (WHERE g.j IS NULL), '') AS text
          FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.j = g.j GROUP BY w.doc_id)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM lists LEFT JOIN kept USING (doc_id)
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
