"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of the document's word shingles.
Distinct fingerprints are looked up in 2**(radius+1) - 1 tables.  Every bit has a vector of radius+1 bits; table v
keeps the bits whose vector has an odd product with v.  Any `radius` differing bits leave some v orthogonal to all of
their vectors, so every pair within the radius agrees in all bits that some table keeps: none is missed.

Small buckets are compared pairwise.  In a large bucket (more than BUCKET distinct fingerprints) links come from
variants instead: each fingerprint with up to radius/2 of the other bits flipped; two fingerprints within an even
radius share a variant, and all that share one are within the radius, so linking them to the least of them is exact and
no list of pairs is made.  Copies count once throughout.  Components come from alternating stars.

Edge cases: a null or empty text has no shingles and the fingerprint zero, linked like any other; fewer words than a
shingle make one shingle of the whole sequence; null keys never name a component that has another key; repeated rows
are copies; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slabs, staged, texts
from .components import components

#: Distinct fingerprints in a bucket that are compared pairwise.
BUCKET = 48
_U = np.uint64
_P1, _P2, _P3 = _U(0x9E3779B185EBCA87), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
_P4, _P5 = _U(0x85EBCA77C2B2AE63), _U(0x27D4EB2F165667C5)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << _U(r)) | (x >> _U(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def _xxh64_same_length(data: np.ndarray, at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """XXH64 of data[i:i+n] for every i in at."""
    full = np.full(len(at), seed, dtype=np.uint64)
    block = data[at[:, None] + np.arange(n)] if n else np.zeros((len(at), 0), np.uint8)
    lanes = np.ascontiguousarray(block[:, : n // 8 * 8]).view("<u8")
    pos = 0
    if n >= 32:
        acc = [full + (_P1 + _P2), full + _P2, full.copy(), full - _P1]
        while pos + 32 <= n:
            for j in range(4):
                acc[j] = _round(acc[j], lanes[:, pos // 8 + j])
            pos += 32
        h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for j in range(4):
            h = (h ^ _round(np.zeros_like(h), acc[j])) * _P1 + _P4
    else:
        h = full + _P5
    h = h + _U(n)
    while pos + 8 <= n:
        h = _rotl(h ^ _round(np.zeros_like(h), lanes[:, pos // 8]), 27) * _P1 + _P4
        pos += 8
    if pos + 4 <= n:
        word = np.ascontiguousarray(block[:, pos : pos + 4]).view("<u4")[:, 0].astype(np.uint64)
        h = _rotl(h ^ (word * _P1), 23) * _P2 + _P3
        pos += 4
    for j in range(pos, n):
        h = _rotl(h ^ (block[:, j].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> _U(33))) * _P2
    h = (h ^ (h >> _U(29))) * _P3
    return h ^ (h >> _U(32))


def xxh64(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of data[starts[i]:ends[i]], all pieces of one length at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    values, sizes = np.frombuffer(data, dtype=np.uint8), ends - starts
    order = np.argsort(sizes, kind="stable")
    lengths, first = np.unique(sizes[order], return_index=True)
    with np.errstate(over="ignore"):
        for n, a, b in zip(lengths, first, [*first[1:], len(order)], strict=True):
            rows = order[a:b]
            if len(rows) < 8 or n > 512:
                out[rows] = [xxhash.xxh64_intdigest(data[starts[i] : ends[i]], seed) for i in rows]
            else:
                out[rows] = _xxh64_same_length(values, starts[rows], int(n), seed)
    return out


def fingerprints(data: list[bytes], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """The SimHash of each text, as unsigned 64-bit integers."""
    lowered = [b" ".join(x.lower().split()) for x in data]
    buffer = b" ".join(lowered)
    lengths = np.array([len(x) for x in lowered], dtype=np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    out = np.zeros(len(data), dtype=np.uint64)
    full = np.nonzero(lengths)[0]
    if not len(full):
        return out
    spaces = np.nonzero(np.frombuffer(buffer, dtype=np.uint8) == 32)[0]
    # words: after the start of a document or a space inside it
    inside = spaces[np.searchsorted(begins[full], spaces, side="right") > 0]
    owner = np.searchsorted(begins[full], inside, side="right") - 1
    keep = inside < begins[full][owner] + lengths[full][owner]
    starts = np.sort(np.concatenate([begins[full], inside[keep] + 1]))
    doc = np.searchsorted(begins[full], starts, side="right") - 1
    n_words = np.bincount(doc, minlength=len(full))
    first = np.cumsum(n_words) - n_words
    doc_end = begins[full] + lengths[full]
    word_end = np.minimum(np.append(starts[1:] - 1, len(buffer)), doc_end[doc])
    place = np.arange(len(starts)) - first[doc]
    heads = np.nonzero((place + shingle <= n_words[doc]) | ((place == 0) & (n_words[doc] < shingle)))[0]
    last = heads + np.minimum(shingle, n_words[doc[heads]]) - 1
    hashes = xxh64(buffer, starts[heads], word_end[last], seed)
    n_heads = np.bincount(doc[heads], minlength=len(full))
    edges = np.cumsum(n_heads) - n_heads
    # bit by bit: all bits of all shingles at once would take 64 times the memory of the hashes
    for j in range(64):
        counts = np.add.reduceat((hashes >> _U(j)) & _U(1), edges).astype(np.int64)
        out[full] |= (2 * counts > n_heads).astype(np.uint64) << _U(j)
    return out


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """The masks of a covering family as signed 64-bit integers."""
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(bits)]
    masks = []
    for v in range(1, 2 ** (radius + 1)):
        mask = sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def links(prints: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within the radius.  prints: distinct longs fp."""
    if radius % 2:
        raise ValueError("the exact way for large buckets needs an even radius")
    masks = covering_masks(radius)
    keyed = prints.select("fp", F.explode(F.from_json(F.lit(str(masks)), "array<bigint>")).alias("mask")).select(
        "fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key")
    )
    sizes = staged(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "bucket-sizes")
    members = staged(keyed.join(sizes, ["mask", "key"]), "buckets")
    small = members.where(F.col("n") <= bucket).groupBy("mask", "key").agg(F.array_sort(F.collect_list("fp")).alias("m"))
    near = small.select("m", F.explode("m").alias("a")).select(
        "a",
        F.explode(
            F.filter("m", lambda x: (x > F.col("a")) & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= radius))
        ).alias("b"),
    )
    flips = [sum(1 << i for i in c) for k in range(radius // 2 + 1) for c in itertools.combinations(range(64), k)]
    flips = [x - (1 << 64) if x >> 63 else x for x in flips]
    variants = (
        members.where(F.col("n") > bucket)
        .select("fp", "mask", "key", F.explode(F.from_json(F.lit(str(flips)), "array<bigint>")).alias("flip"))
        .where(F.col("flip").bitwiseAND(F.col("mask")) == 0)
        .select("fp", "mask", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    )
    # at most 1 + 64 fingerprints (radius 2) share a variant
    stars = variants.groupBy("mask", "variant").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("m"))
    far = stars.where(F.size("m") > 1).select("a", F.explode("m").alias("b")).where("a <> b")
    return near.unionByName(far).distinct()


def near_groups(
    docs: DataFrame, shingle: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text", bucket: int = BUCKET
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least key reachable), tag (checksum)."""

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text"):
            data = texts(batch)
            found = fingerprints(data, shingle).view(np.int64)
            tags = pa.array([zlib.crc32(x) for x in data], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found), tags], ["doc_id", "fp", "tag"])

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = staged(source.mapInArrow(printed, "doc_id long, fp long, tag long"), "simhash")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = components(links(classes.select("fp"), radius, bucket)).select(F.col("node").alias("fp"), "root")
    placed = classes.join(staged(roots, "simhash-roots"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = staged(placed, "simhash-placed")
    names = staged(placed.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-names")
    classes = staged(placed.join(names, "root").select("fp", "component_id"), "simhash-named")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "tag"
    )


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the least key of each group, with all columns; rows without a key stay."""
    gone = near_groups(docs, shingle, radius, key, text).where("doc_id <> component_id").select("doc_id", "tag")
    gone = staged(gone.distinct(), "simhash-gone").select(F.col("doc_id").alias("own"), "tag")
    checksum = F.crc32(F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8"))
    rows = docs.select(F.struct("*").alias("d"), F.col(key).cast("long").alias("own"), checksum.alias("tag"))
    return rows.join(gone, ["own", "tag"], "left_anti").select([F.col(f"d.`{c}`") for c in docs.columns])
