"""Substring deduplication by relative Lempel-Ziv parsing.

The reference is the corpus itself: every block of WINDOW words is indexed under its earliest occurrence, the least
(key, place).  Each document is parsed into factors greedily: at a place whose block an earlier document holds, a factor
starts at that occurrence and is extended for as long as the next block's occurrence is the next place of the same
document; there the next block is looked up anew, so that blocks across the boundary of two factors are not missed.
Every factor is a run of words of its reference, WINDOW words at least, and its words are duplicates.

The index is small, as only blocks whose anchor (see anchors.py) is found in two documents are in it; no other block can
have an equal.  Runs of neighbouring blocks with one anchor travel as one row, equal runs of a slab as one row for all
their documents.  Blocks are equal if their anchors' hashes and their own, which are independent, are (128 bits together).
An anchor with more than GROUP places is not looked up in one task: its blocks become rows and are grouped by hash.

Edge cases: a null or empty text has no words; a row with a null key is no reference and stays whole; rows with one key
and different texts are told apart by a checksum and are no references for each other; wholly repeated rows get equal
results; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import anchors
from .common import bounded_broadcast, slabs, staged, texts

#: Words of a window, and of the block at its anchor.
WINDOW, BLOCK = 13, 5
#: Blocks that are looked up at once, and places of an anchor that are looked up in one task.
AT_ONCE, GROUP = 500_000, 32_768

#: Packed longs (hashes, docs, tags) and ints: places of each document, and all places in order of the documents.
_RUNS = "anchor long, hashes binary, docs binary, tags binary, counts binary, places binary"
#: n neighbouring blocks of a document, from each of `places` on, that stand in a reference from `at` on.
_STRETCHES = "doc_id long, tag long, places array<int>, n int, reference long, at int"
#: Either a stretch or, of a crowded anchor, a block with the documents of its run and the earliest of them.
_MIXED = (
    "anchor long, h long, step int, docs binary, tags binary, counts binary, places binary, doc long, place long, "
    "stretch struct<doc_id: bigint, tag: bigint, places: array<int>, n: int, reference: bigint, at: int>"
)
_BLOCK_KINDS = {"anchor": pa.int64(), "h": pa.int64(), "step": pa.int32(), "docs": pa.binary(), "tags": pa.binary()}
_BLOCK_KINDS |= {"counts": pa.binary(), "places": pa.binary(), "doc": pa.int64(), "place": pa.int64()}
_STRETCH_KINDS = {"doc_id": pa.int64(), "tag": pa.int64(), "places": pa.list_(pa.int32()), "n": pa.int32()}
_STRETCH_KINDS |= {"reference": pa.int64(), "at": pa.int32()}


def _flat(table: pa.RecordBatch | pa.Table, name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a packed column, and how many each row has."""
    column = table.column(name)
    sizes = pa.compute.binary_length(column).to_numpy().astype(np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).astype(np.int64), sizes


def _packed(rows: list[np.ndarray], kind: type) -> pa.Array:
    return pa.array([np.asarray(x, dtype=kind).tobytes() for x in rows], pa.binary())


class Members:
    """The documents of each run of a table and their places."""

    def __init__(self, table: pa.RecordBatch | pa.Table) -> None:
        self.doc, self.n = _flat(table, "docs", np.int64)
        self.tag, _ = _flat(table, "tags", np.int64)
        self.counts, _ = _flat(table, "counts", np.int32)
        self.places, _ = _flat(table, "places", np.int32)
        self.base = np.cumsum(self.counts) - self.counts
        #: run of each document
        self.owner = np.repeat(np.arange(len(self.n)), self.n)

    def stretches(
        self, member: np.ndarray, step: np.ndarray, n: np.ndarray, reference: np.ndarray, at: np.ndarray
    ) -> pa.RecordBatch:
        counts = self.counts[member]
        row = np.repeat(np.arange(len(member)), counts)
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        places = (self.places[self.base[member][row] + inner] + step[row]).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        columns = {
            "doc_id": pa.array(self.doc[member]),
            "tag": pa.array(self.tag[member]),
            "places": pa.ListArray.from_arrays(offsets, places),
            "n": pa.array(n.astype(np.int32)),
            "reference": pa.array(reference),
            "at": pa.array(at.astype(np.int32)),
        }
        return pa.RecordBatch.from_arrays([*columns.values()], [*columns])


def looked_up(table: pa.Table) -> pa.RecordBatch:
    """Stretches of the documents of some runs, all runs of their anchors being there."""
    hashes, sizes = _flat(table, "hashes", np.int64)
    members, base = Members(table), np.cumsum(sizes) - sizes
    n = sizes[members.owner]
    member = np.repeat(np.arange(len(members.owner)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    run = members.owner[member]
    h, of = hashes[base[run] + step], table.column("anchor").to_numpy()[run]
    mine, where = members.doc[member], members.places[members.base][member] + step
    order = np.lexsort((where, mine, h, of))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])
    least = np.empty(len(h), dtype=np.int64)
    least[order] = order[np.nonzero(new)[0]][np.cumsum(new) - 1]
    known = np.nonzero(mine[least] < mine)[0]
    member, step, reference, at = member[known], step[known], mine[least][known], where[least][known]
    # blocks of a document that go on in one reference
    opens = np.ones(len(known), dtype=bool)
    opens[1:] = (member[1:] != member[:-1]) | (step[1:] != step[:-1] + 1)
    opens[1:] |= (reference[1:] != reference[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.nonzero(opens)[0]
    count = np.diff(np.append(first, len(known)))
    return members.stretches(member[first], step[first], count, reference[first], at[first])


def _lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs in order of their anchors: the stretches of all their documents, and the blocks of crowded anchors."""
    held: list[pa.RecordBatch] = []
    size = 0

    def answered(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = looked_up(table)
        stretch = pa.StructArray.from_arrays(rows.columns, names=[*_STRETCH_KINDS])
        none = [pa.nulls(len(stretch), kind) for kind in _BLOCK_KINDS.values()]
        yield pa.RecordBatch.from_arrays([*none, stretch], [*_BLOCK_KINDS, "stretch"])

    for batch in batches:
        crowded = batch.column("crowded")
        if pa.compute.any(crowded).as_py():
            yield blocks(batch.filter(crowded))
            batch = batch.filter(pa.compute.invert(crowded))
        if not batch.num_rows:
            continue
        held.append(batch)
        size += sum(map(len, batch.column("hashes").to_pylist())) // 8
        if size >= AT_ONCE:
            table = pa.Table.from_batches(held)
            anchor = table.column("anchor").to_numpy()
            # the last anchor may go on
            cut = int(np.nonzero(anchor != anchor[-1])[0][-1]) + 1 if anchor[0] != anchor[-1] else 0
            if cut:
                yield from answered(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), 0
    if held:
        yield from answered(pa.Table.from_batches(held))


def blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row for every block of every run, with its earliest document and place there."""
    hashes, sizes = _flat(batch, "hashes", np.int64)
    members = Members(batch)
    run = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    head = (np.cumsum(members.n) - members.n)[run]
    anchor, *kept = (batch.column(c).take(pa.array(run)) for c in ("anchor", "docs", "tags", "counts", "places"))
    own = [pa.array(members.doc[head]), pa.array(members.places[members.base[head]] + step)]
    columns = [anchor, pa.array(hashes), pa.array(step.astype(np.int32)), *kept, *own]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.nulls(len(run), pa.struct([*_STRETCH_KINDS.items()]))], [*_BLOCK_KINDS, "stretch"]
    )


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All stretches: those known, and those of one block from blocks with their references."""
    for batch in batches:
        is_block = batch.column("stretch").is_null()
        known = batch.filter(pa.compute.invert(is_block)).column("stretch")
        if len(known):
            yield pa.RecordBatch.from_arrays(known.flatten(), [*_STRETCH_KINDS])
        batch = batch.filter(is_block)
        if batch.num_rows:
            members = Members(batch)
            step, reference, at = (anchors.column(batch, c)[members.owner] for c in ("step", "reference", "at"))
            later = np.nonzero(members.doc > reference)[0]
            yield members.stretches(later, step[later], np.ones(len(later)), reference[later], at[later])


def parse(found: list[tuple[int, int, int, int]], window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """Factors (first word, words, reference, first word there) from stretches (place, blocks, reference, at)."""
    factors: list[tuple[int, int, int, int]] = []
    for place, n, reference, at in sorted(set(found)):
        if factors:
            first, words, source, there = factors[-1]
            blocks = words - window + 1
            # a stretch may go on in the next run
            if place == first + blocks and reference == source and at == there + blocks:
                factors[-1] = (first, words + n, source, there)
                continue
        factors.append((place, n + window - 1, reference, at))
    return factors


def parsed(
    docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", group: int = GROUP
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text), factors (first, words, reference, at) of each document."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asker = anchors.Asker(across=True)
        for batch in slabs(batches, "text"):
            symbols, _, counts = anchors.word_symbols(texts(batch))
            runs = anchors.runs(symbols, counts, window, min(BLOCK, window))
            doc, tag = anchors.column(batch, "doc_id"), anchors.column(batch, "tag")
            yield asker.rows(runs.block, doc[runs.text], tag[runs.text], runs.anchor)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text"):
            symbols, others, counts = anchors.word_symbols(texts(batch))
            runs = anchors.marked(anchors.runs(symbols, counts, window, min(BLOCK, window)), batch)
            whole = anchors.rolling(others, window).view(np.int64)
            doc, tag = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
            found: dict[tuple[int, bytes], dict[tuple[int, int], list[int]]] = {}
            start = runs.base[runs.text] + runs.low
            columns = (runs.text, runs.low, runs.block.view(np.int64), start, start + runs.high - runs.low + 1)
            for t, low, block, a, b in zip(*(x.tolist() for x in columns), strict=True):
                found.setdefault((block, whole[a:b].tobytes()), {}).setdefault((doc[t], tag[t]), []).append(low)
            members = [sorted((k, sorted(x)) for k, x in m.items()) for m in found.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block for block, _ in found], pa.int64()),
                    pa.array([h for _, h in found], pa.binary()),
                    _packed([[k[0] for k, _ in m] for m in members], np.int64),
                    _packed([[k[1] for k, _ in m] for m in members], np.int64),
                    _packed([[len(x) for _, x in m] for m in members], np.int32),
                    _packed([[i for _, x in m for i in x] for m in members], np.int32),
                ],
                ["anchor", "hashes", "docs", "tags", "counts", "places"],
            )

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text"):
            total, removed, kept, factors = [], [], [], []
            for x, found in zip(texts(batch), batch.column("found").to_pylist(), strict=True):
                words = np.array(x.split(), dtype=object)
                parts = parse([(p, s["n"], s["reference"], s["at"]) for s in found or [] for p in s["places"]], window)
                keep = np.ones(len(words), dtype=bool)
                for first, n, _, _ in parts:
                    keep[first : first + n] = False
                total.append(len(words))
                removed.append(int(len(words) - keep.sum()))
                kept.append(b" ".join(words[keep].tolist()).decode("utf-8"))
                factors.append([dict(zip(("first", "words", "reference", "at"), f, strict=True)) for f in parts])
            kinds = [("first", pa.int32()), ("words", pa.int32()), ("reference", pa.int64()), ("at", pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(factors, pa.list_(pa.struct(kinds))),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "factors"],
            )

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    dealt = anchors.tagged(source.where("doc_id is not null"))
    said = staged(anchors.found_again(dealt.mapInArrow(sampled, anchors.ASKED), True), "lz-said")
    crowded = staged(said.groupBy("key").count().where(F.col("count") > group).select("key"), "lz-crowded")
    crowded = crowded.select(F.col("key").alias("anchor"), F.lit(True).alias("crowded"))
    # in one plan with the last join, which deals the documents out alike, so that their texts are shuffled once
    runs = dealt.join(anchors.by_document(said), ["doc_id", "tag"]).mapInArrow(indexed, _RUNS)
    runs = runs.join(bounded_broadcast(crowded), "anchor", "left").withColumn("crowded", F.col("crowded").isNotNull())
    salt = F.when(F.col("crowded"), F.xxhash64("docs", "places"))
    rows = runs.repartition("anchor", salt).sortWithinPartitions("anchor").mapInArrow(_lookup, _MIXED)
    # a stretch that is known has a group of its own
    alone = F.when(F.col("h").isNull(), F.struct("stretch.doc_id", F.col("stretch.places")[0]))
    least = F.min(F.struct("doc", "place")).over(Window.partitionBy("anchor", "h", alone))
    rows = rows.withColumn("least", least).drop("anchor", "h", "doc", "place")
    rows = rows.select("*", F.col("least.doc").alias("reference"), F.col("least.place").alias("at")).drop("least")
    found = rows.mapInArrow(_told, _STRETCHES)
    found = found.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("places", "n", "reference", "at")).alias("found"))
    none = F.lit(None).cast("array<struct<places:array<int>,n:int,reference:bigint,at:int>>")
    nameless = source.where("doc_id is null").withColumn("found", none)
    schema = (
        "doc_id long, n_words long, n_removed long, kept string, "
        "factors array<struct<first: int, words: int, reference: bigint, at: int>>"
    )
    known = dealt.join(found, ["doc_id", "tag"], "left").select("doc_id", "text", "found")
    return known.mapInArrow(rewritten, schema).unionByName(nameless.mapInArrow(rewritten, schema))
