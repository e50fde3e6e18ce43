"""SimHash near-duplicates whose links are confirmed: every pair with a Jaccard similarity of at least 4/5, and none below.

A text is its set of shingles of SHINGLE words (lower-cased, split at white space), as 64-bit hashes.

1. Texts with equal words are one node.
2. Nodes are looked up in the covering tables of their SimHash (see simhash.py): all that share a bucket are compared
   with two nodes of that bucket.  This joins most of each large group without listing its pairs.
3. A SimHash tells little about pairs near 4/5 (about ten of 64 bits differ there, which no covering family of a
   bearable size spans), so the rest comes from prefixes, which miss nothing: with all shingles in one global order, two
   sets of similarity 4/5 or more share one of the first n - ceil(4n/5) + 1 of each.  Pairs that step 2 has joined
   already are left out.  The order puts shingles that are frequent in a sample last, so that few prefixes hold them;
   any order gives the same result.

A pair is compared only if its sizes and bitmaps allow the similarity: a bitmap has the parity of the shingles in each
of BITS parts, and two bitmaps differ in no more bits than the sets do in shingles, so that nothing is lost.  Pairs are
listed by bitmaps of BITS parts, which say little about sets of over 1,000 shingles, and then sifted by those of WIDE
parts.  Each link is confirmed on both sets.  Components come from alternating stars.

Disk: a pair is sent with both bitmaps, or both texts, so pairs go in slices that are staged one after the other, and
staged tables go as soon as nothing reads them.

Edge cases: a text of fewer words than a shingle, or none, has one shingle of its whole sequence; rows without a key
stay; repeated rows are copies; rows with one key and different texts are told apart by a checksum; an empty table gives
an empty result; other columns are kept by `one_of_each`, whatever their names.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import bounded_broadcast, discard, slabs
from .components import components
from .simhash import covering_masks, fingerprints, xxh64

SHINGLE = 5
#: Radius of the covering tables (2**(RADIUS + 1) - 1 of them), and bits of a bitmap.
RADIUS, BITS = 4, 256
#: Bits of the bitmaps by which listed pairs are sifted before their texts are fetched.
WIDE = 2048
#: Pairs sifted at once; and shingles of texts compared at once (about six bytes of text each), or twice what the texts
#: have where that is more: a slice then sends no more than a few times what it reads.
PAIRS, WORDS = 2_000_000, 100_000_000
#: Sets whose bitmaps are counted at once.
SETS = 256
#: One of so many documents is sampled for frequent shingles; found so often there, a shingle is frequent; at most.
SAMPLE, FREQUENT, MOST = 8, 3, 50_000
#: Bytes of text made into shingles at once: words, hashes and sets together take about a hundred times that.
SLAB_BYTES = 500_000
#: Bytes of an Arrow batch of a staged write: a batch is held on both sides at once.
BATCH_BYTES = "8m"
_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63)]
_MIX = _U(0xFF51AFD7ED558CCD)


def staged(df: DataFrame, tag: str) -> DataFrame:
    return common.staged(df, tag, BATCH_BYTES)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _MIX
    return h ^ (h >> _U(29))


def shingles(words: list[list[str]], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text, with repeats, one text after the other; and how many each text has."""
    counts = np.array([len(x) for x in words], dtype=np.int64)
    data = " ".join(itertools.chain.from_iterable(words)).encode()
    spaces = np.nonzero(np.frombuffer(data, dtype=np.uint8) == 32)[0]
    n = int(counts.sum())
    starts, ends = np.concatenate([[0], spaces + 1])[:n], np.append(spaces, len(data))[:n]
    hashes = xxh64(data, starts, ends)
    base = np.cumsum(counts) - counts
    sizes = np.maximum(counts - k + 1, 1)
    first = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint64)
    with np.errstate(over="ignore"):
        if n >= k:
            rolled = np.zeros(n - k + 1, dtype=np.uint64)
            for j in range(k):
                rolled = _mixed(rolled * _ODD[0] + hashes[j : n - k + 1 + j])
            full = np.nonzero(counts >= k)[0]
            text = np.repeat(full, sizes[full])
            at = np.arange(len(text)) - np.repeat(np.cumsum(sizes[full]) - sizes[full], sizes[full])
            out[first[text] + at] = rolled[base[text] + at]
    for i in np.nonzero(counts < k)[0]:
        out[first[i]] = xxhash.xxh64_intdigest(" ".join(words[i]), 1)
    return out, sizes


def sets(texts: list[str], k: int = SHINGLE) -> list[np.ndarray]:
    """The set of each text, ascending."""
    hashes, sizes = shingles([x.lower().split() for x in texts], k)
    return [np.unique(x) for x in np.split(hashes, np.cumsum(sizes)[:-1])] if texts else []


def node_of(words: list[str]) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(words))


def bitmaps(found: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """Parity of the shingles in each of `bits` parts, as bits / 64 signed integers of each set."""
    out = [np.zeros((0, bits // 64), dtype="<i8")]
    for at in range(0, len(found), SETS):
        some = found[at : at + SETS]
        place = (np.concatenate(some) >> _U(64 - bits.bit_length() + 1)).astype(np.int64)
        place += np.repeat(np.arange(len(some)) * bits, [len(x) for x in some])
        odd = (np.bincount(place, minlength=len(some) * bits) & 1).astype(np.uint8)
        out.append(np.packbits(odd.reshape(-1, bits), axis=1, bitorder="little").view("<i8"))
    return np.concatenate(out)


def prefix(found: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles of a set (ascending) of which another set of similarity 4/5 or more has one in its own prefix.

    frequent: hashes in ascending order, rank: their places from the least frequent on.
    """
    n = len(found)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        known = frequent[at] == found
        found = np.concatenate([found[~known], found[known][np.argsort(rank[at[known]])]])
    return found[: n - (4 * n + 4) // 5 + 1]


def enough(overlap: int, a: int, b: int) -> bool:
    """Whether sets of a and b elements with such an overlap have a similarity of 4/5 or more."""
    return 9 * overlap >= 4 * (a + b)


def _texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def allowed(a: str, b: str) -> Column:
    """Whether sizes and bitmaps of two sets, in the aliases a and b, allow a similarity of 4/5."""
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    apart = sum(F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(BITS // 64))
    most = F.least(F.floor((both - apart) / 2), F.col(f"{a}.n"), F.col(f"{b}.n"))
    return 9 * most >= 4 * both


def _slices(pairs: DataFrame, n: int, tag: str, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """step(pairs), with n parts of the pairs staged one after the other."""
    part = F.pmod(F.xxhash64("a", "b"), F.lit(n))
    found = [staged(step(pairs.where(part == i) if n > 1 else pairs), tag) for i in range(n)]
    return functools.reduce(DataFrame.union, found)


def _asked(pairs: DataFrame) -> DataFrame:
    return pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")


def _sifted(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b, n) of the pairs whose sizes and wide bitmaps allow a similarity of 4/5; n: shingles of both sets."""

    def words(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, WIDE // 64)

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("n_a", "n_b"))
            apart = np.bitwise_count(words(batch.column("wide_a")) ^ words(batch.column("wide_b"))).sum(axis=1, dtype=np.int64)
            most = np.minimum((na + nb - apart) // 2, np.minimum(na, nb))
            kept = batch.filter(pa.array(9 * most >= 4 * (na + nb)))
            n = kept.column("n_a").to_numpy(zero_copy_only=False) + kept.column("n_b").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b"), pa.array(n)], ["a", "b", "n"])

    asked = staged(_asked(pairs), "near-met-nodes")
    # what a node has is the same in all of its rows
    wide = rows.select("node", "n", "wide").join(bounded_broadcast(asked), "node", "left_semi")
    wide = staged(wide.groupBy("node").agg(F.first("n").alias("n"), F.first("wide").alias("wide")), "near-wide")
    a, b = (wide.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("wide").alias(f"wide_{x}")) for x in "ab")

    def step(some: DataFrame) -> DataFrame:
        return some.join(a, "a").join(b, "b").mapInArrow(sifted, "a long, b long, n long")

    out = _slices(pairs, max(1, -(-pairs.count() // PAIRS)), "near-sifted", step)
    discard(asked, wide)
    return out


def _confirmed(pairs: DataFrame, source: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose texts have a similarity of 4/5 or more."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text_a", SLAB_BYTES):
            known: dict[int, np.ndarray] = {}
            for key, text in (("a", "text_a"), ("b", "text_b")):
                fresh = dict(zip(batch.column(key).to_pylist(), _texts(batch, text), strict=True))
                fresh = {k: v for k, v in fresh.items() if k not in known}
                known |= zip(fresh, sets(list(fresh.values())), strict=True)
            kept = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = known[a], known[b]
                kept.append(enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    pairs = _sifted(pairs, rows)
    asked = staged(nodes.select("node", "doc_id", "tag", "n").join(_asked(pairs), "node"), "near-asked")
    named = staged(source.join(bounded_broadcast(asked), ["doc_id", "tag"]).select("node", "text"), "near-texts")
    a = named.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = named.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def step(some: DataFrame) -> DataFrame:
        both = some.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(compared, "a long, b long")

    sent, held = (x.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0] for x in (pairs, asked))
    out = _slices(pairs, max(1, -(-sent // max(WORDS, 2 * held))), "near-confirmed", step)
    discard(asked, named)
    return out


def _stars(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes: in each bucket of the covering tables, every node with two of them."""
    masks = covering_masks(RADIUS)
    # in each table other nodes come first and last, so that a group has other hubs in each
    turns = [int(x) for x in np.random.default_rng(20240607).integers(-(1 << 63), 1 << 63, len(masks))]
    tables = F.from_json(
        F.lit(str([{"table": i, "mask": m, "turn": t} for i, (m, t) in enumerate(zip(masks, turns, strict=True))]).replace("'", '"')),
        "array<struct<table: smallint, mask: bigint, turn: bigint>>",
    )
    keyed = nodes.select("node", "fp", F.explode(tables).alias("t")).select(
        F.col("t.table").alias("table"),
        F.col("fp").bitwiseAND(F.col("t.mask")).alias("bucket"),
        F.col("node").bitwiseXOR(F.col("t.turn")).alias("turned"),
        F.col("t.turn").alias("turn"),
    )
    hubs = keyed.groupBy("table", "bucket").agg(F.min("turned").alias("low"), F.max("turned").alias("high"))
    spokes = keyed.join(staged(hubs.where("low <> high"), "near-hubs"), ["table", "bucket"])
    ends = [(F.col(x).bitwiseXOR(F.col("turn")), F.col("turned").bitwiseXOR(F.col("turn"))) for x in ("low", "high")]
    pairs = [spokes.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")) for x, y in ends]
    return pairs[0].union(pairs[1]).where("a < b").distinct()


def _frequent(source: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles found often in a sample, ascending, and their ranks from the least frequent on; at most MOST."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text", SLAB_BYTES):
            for found in sets(_texts(batch)):
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])

    sample = source.where(F.pmod(F.xxhash64("doc_id", "tag"), F.lit(SAMPLE)) == 0).select("text")
    counts = sample.mapInArrow(sampled, "h long").groupBy("h").agg(F.count("*").alias("n"))
    # staged, so that the shuffle of all sampled shingles goes at once
    top = staged(counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "h").limit(MOST), "near-frequent")
    top = top.orderBy(F.desc("n"), "h").select("h")
    hashes = top.toArrow().column("h").to_numpy().astype(np.int64).view(np.uint64)[::-1]
    order = np.argsort(hashes)
    return hashes[order], order


def _candidates(source: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with different roots, among them all of a similarity of 4/5 or more."""
    frequent, rank = _frequent(source)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text", SLAB_BYTES):
            data = _texts(batch)
            heads = [prefix(x, frequent, rank) for x in sets(data)]
            node = np.array([node_of(x.lower().split()) for x in data], dtype=np.uint64).view(np.int64)
            owner = np.repeat(node, [len(x) for x in heads])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(heads).view(np.int64)), pa.array(owner)], ["h", "node"]
            )

    heads = staged(source.select("text").mapInArrow(cut, "h long, node long"), "near-heads")
    # most of the rarest shingles of a text are its own: only those of two nodes go on
    shared = heads.groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    shared = staged(shared.select("h"), "near-shared")
    met = heads.join(shared, "h").distinct()
    about = nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "n", "bits")
    met = staged(met.join(about, "node"), "near-met")
    discard(heads, shared)
    a, b = met.alias("a"), met.alias("b")
    sizes = (4 * F.col("a.n") <= 5 * F.col("b.n")) & (4 * F.col("b.n") <= 5 * F.col("a.n"))
    apart = (F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root"))
    pairs = a.join(b, (F.col("a.h") == F.col("b.h")) & apart & sizes & allowed("a", "b"))
    pairs = staged(pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), "near-pairs")
    discard(met)
    return pairs


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, tag (checksum of the text), component_id (least key reachable) of each row with a key."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text", SLAB_BYTES):
            words = [x.lower().split() for x in _texts(batch)]
            hashes, sizes = shingles(words)
            found = [np.unique(x) for x in np.split(hashes, np.cumsum(sizes)[:-1])]
            bits = bitmaps(found)
            width = bits.shape[1]
            lists = pa.ListArray.from_arrays(np.arange(0, bits.size + 1, width, dtype=np.int32), bits.ravel())
            wide = [x.tobytes() for x in bitmaps(found, WIDE)]
            columns = {
                "node": pa.array(np.array([node_of(x) for x in words], dtype=np.uint64).view(np.int64)),
                "fp": pa.array(fingerprints([" ".join(x).encode() for x in words], SHINGLE).view(np.int64)),
                "n": pa.array([len(x) for x in found], pa.int64()),
                "bits": lists,
                "wide": pa.array(wide, pa.binary()),
            }
            own = [batch.column("doc_id"), batch.column("tag")]
            yield pa.RecordBatch.from_arrays([*own, *columns.values()], ["doc_id", "tag", *columns])

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    checksum = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    source = source.where("doc_id is not null").withColumn("tag", checksum)
    schema = "doc_id long, tag long, node long, fp long, n long, bits array<bigint>, wide binary"
    rows = staged(source.select("doc_id", "tag", "text").mapInArrow(named, schema), "near-rows")
    # one document stands for each node; what else a node has is the same in all of them
    nodes = rows.groupBy("node").agg(
        F.min(F.struct("doc_id", "tag")).alias("r"), *(F.first(x).alias(x) for x in ("fp", "n", "bits"))
    )
    nodes = staged(nodes.select("node", "r.doc_id", "r.tag", "fp", "n", "bits"), "near-nodes")
    stars = staged(_stars(nodes), "near-stars")
    met = stars.alias("p").join(nodes.alias("a"), F.col("p.a") == F.col("a.node"))
    met = met.join(nodes.alias("b"), F.col("p.b") == F.col("b.node")).where(allowed("a", "b")).select("p.a", "p.b")
    first = _confirmed(staged(met, "near-likely"), source, nodes, rows)
    roots = staged(components(first), "near-roots")
    second = _confirmed(_candidates(source, nodes, roots), source, nodes, rows)
    roots = components(first.union(second))
    placed = nodes.join(staged(roots, "near-joined"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = staged(placed.select("node", "root", "doc_id"), "near-placed")
    names = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = staged(placed.join(names, "root").select("node", "component_id"), "near-named")
    return rows.join(placed, "node").select("doc_id", "tag", "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the least key of each group, with all columns; rows without a key stay."""
    gone = near_groups(docs, key, text).where("doc_id <> component_id").select("doc_id", "tag")
    # without a broadcast every row with all its columns would be shuffled to drop a few
    gone = bounded_broadcast(staged(gone.distinct(), "near-gone").select(F.col("doc_id").alias("own"), "tag"))
    checksum = F.crc32(F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8"))
    rows = docs.select(F.struct("*").alias("d"), F.col(key).cast("long").alias("own"), checksum.alias("tag"))
    return rows.join(gone, ["own", "tag"], "left_anti").select([F.col(f"d.`{c}`") for c in docs.columns])
