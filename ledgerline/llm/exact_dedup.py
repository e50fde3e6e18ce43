"""Exact deduplication by composable polynomial fingerprints.

The fingerprint of a byte string is a pair of polynomials modulo two primes below 2**31.  Chunks are hashed on their
own; the fingerprint of a concatenation is `left * base**len(right) + right`, so that the chunks of a huge document can
be hashed in any grouping.  Texts with equal length and fingerprint are then compared chunk by chunk: each distinct
chunk at each place of a group is kept once, and a group with more than one chunk at some place is parted.

Edge cases: a null text equals an empty one; a null key never wins against another key (a group of null keys keeps
null); of wholly repeated rows (same key, same text) one stays; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLAB_BYTES, slabs, staged, texts

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 1_618_033)
#: Bytes of a chunk: products stay below 2**39, so sums over a chunk fit in 64 bits.
CHUNK = 1 << 16


def _powers(base: int, prime: int) -> np.ndarray:
    """base**(CHUNK-1) ... base**0 modulo prime."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < CHUNK:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[CHUNK - 1 :: -1].copy()


_POWERS: list[np.ndarray] = []


def chunk_fingerprint(chunk: bytes) -> tuple[int, int, int]:
    """(length, polynomial, polynomial) of at most CHUNK bytes."""
    if not _POWERS:
        _POWERS.extend(_powers(b, p) for b, p in zip(BASES, PRIMES, strict=True))
    values = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    return (len(chunk), *(int(values @ w[CHUNK - len(chunk) :]) % p for w, p in zip(_POWERS, PRIMES, strict=True)))


def combine(left: tuple[int, int, int], right: tuple[int, int, int]) -> tuple[int, int, int]:
    """The fingerprint of a concatenation: shift the left part by the right part's length and add."""
    n = right[0]
    a, b = ((x * pow(base, n, p) + y) % p for x, y, base, p in zip(left[1:], right[1:], BASES, PRIMES, strict=True))
    return left[0] + n, a, b


def fingerprint(data: bytes) -> tuple[int, int, int]:
    """Fingerprint of a whole document, combined from its chunks pairwise as a tree."""
    parts = [chunk_fingerprint(data[i : i + CHUNK]) for i in range(0, len(data), CHUNK)] or [(0, 0, 0)]
    while len(parts) > 1:
        pairs = [combine(a, b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
        parts = pairs + parts[len(pairs) * 2 :]
    return parts[0]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slabs(batches, "text"):
        data = texts(batch)
        prints = [fingerprint(x) for x in data]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([p[0] for p in prints], pa.int64()),
                pa.array([p[1] << 31 | p[2] for p in prints], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string()),
            ],
            ["doc_id", "n_bytes", "poly", "text_sha256"],
        )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of each text, one slab's worth at a time however long a text is."""
    for batch in slabs(batches, "text"):
        held: list[tuple[int, int, int, bytes]] = []
        columns = (batch.column("n_bytes").to_pylist(), batch.column("poly").to_pylist(), texts(batch))
        for n, poly, data in zip(*columns, strict=True):
            for place, i in enumerate(range(0, max(1, len(data)), CHUNK)):
                held.append((n, poly, place, data[i : i + CHUNK]))
                if len(held) * CHUNK >= SLAB_BYTES * 8:
                    yield _chunk_rows(held)
                    held = []
        yield _chunk_rows(held)


def _chunk_rows(held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = {"n_bytes": pa.int64(), "poly": pa.int64(), "place": pa.int32(), "chunk": pa.binary()}
    arrays = [pa.array([x[i] for x in held], kind) for i, kind in enumerate(kinds.values())]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def compared(docs: DataFrame) -> DataFrame:
    """Groups (n_bytes, poly) with unequal texts, found by comparing their chunks: (n_bytes, poly).

    docs: text, n_bytes, poly of the rows to compare.  Each task passes on a chunk only once, so that a group of very
    many copies stays small.
    """
    chunks = docs.select("n_bytes", "poly", "text").mapInArrow(_chunks, "n_bytes long, poly long, place int, chunk binary")
    distinct = chunks.distinct()
    return (
        distinct.groupBy("n_bytes", "poly", "place").count().where("count > 1").select("n_bytes", "poly").distinct()
    )


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id (largest key of the equal texts), group_size, kept, text_sha256."""
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_bytes long, poly long, text_sha256 string"
    prints = staged(source.mapInArrow(_fingerprints, schema), "exact-prints")
    groups = staged(
        prints.groupBy("n_bytes", "poly")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1"),
        "exact-groups",
    )
    unequal = staged(_unequal(source, prints, groups), "exact-unequal")
    # where a fingerprint stands for several texts, the digest parts them
    wholes = groups.join(unequal, ["n_bytes", "poly"], "left_anti")
    parted = (
        prints.join(unequal, ["n_bytes", "poly"], "left_semi")
        .groupBy("n_bytes", "poly", F.col("text_sha256").alias("sha"))
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    known = staged(
        wholes.withColumn("sha", F.lit(None).cast("string")).unionByName(parted, allowMissingColumns=True),
        "exact-known",
    )
    p, k = prints.alias("p"), known.alias("k")
    same = (
        (F.col("p.n_bytes") == F.col("k.n_bytes"))
        & (F.col("p.poly") == F.col("k.poly"))
        & (F.col("k.sha").isNull() | (F.col("k.sha") == F.col("p.text_sha256")))
    )
    same_row = Window.partitionBy("p.doc_id", "p.text_sha256").orderBy("p.n_bytes")
    return p.join(k, same, "left").select(
        "p.doc_id",
        F.coalesce("k.keep_id", "p.doc_id").alias("keep_id"),
        F.coalesce("k.group_size", F.lit(1)).cast("long").alias("group_size"),
        (
            (F.row_number().over(same_row) == 1)
            & (F.col("k.poly").isNull() | F.col("k.keep_id").eqNullSafe(F.col("p.doc_id")))
        ).alias("kept"),
        "p.text_sha256",
    )


def _unequal(source: DataFrame, prints: DataFrame, groups: DataFrame) -> DataFrame:
    """Fingerprints of groups whose texts differ."""
    members = prints.join(groups, ["n_bytes", "poly"], "left_semi").select("doc_id", "n_bytes", "poly").distinct()
    # a key that stands for several texts may bring in a text of another group: that group is parted needlessly
    rows = source.withColumn("size", F.octet_length(F.coalesce("text", F.lit("")))).join(members, "doc_id")
    return compared(rows.where("size = n_bytes"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    winners = staged(exact_groups(docs, key, text).where("kept").select("doc_id", "text_sha256"), "exact-winners")
    content = F.sha2(F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8"), 256)
    # every row has a row of its group with the largest key; null keys join as the least long
    own = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    rows = docs.select(F.struct("*").alias("d"), own.alias("own"), content.alias("sha"))
    winners = winners.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("own"), F.col("text_sha256").alias("sha"))
    return rows.join(winners, ["own", "sha"]).dropDuplicates(["own", "sha"]).select(columns)
