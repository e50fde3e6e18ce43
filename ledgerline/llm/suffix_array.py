"""Removal of repeated byte strings by a distributed difference-cover suffix array.

A byte is removed if a string of WINDOW bytes covers it that starts anywhere else too.  Text that cannot repeat is set
aside first (anchors.py): each window has an anchor block, and only windows whose block is found twice are kept, as
contexts: the bytes of all neighbouring windows with one anchor.  Contexts are dealt out by their block, so that all
suffixes that can share WINDOW bytes meet in one place, equal contexts are merged, and each place builds the suffix
array of its distinct contexts by the difference cover modulo 3: sampled triples are sorted and named, names are
recursed on, the remaining suffixes are merged in, and adjacent prefixes of WINDOW bytes are compared.  Windows that
repeat are mapped back to the documents of each context.

A block with more than GROUP distinct contexts (a passage in very many surroundings) is not sorted in one place: its
windows become rows and are counted by hash, which is exact as well and spreads over all tasks.

Edge cases: a null or empty text has no bytes; texts shorter than WINDOW stay whole; a row with a null key stays whole
and repeats nothing; rows with one key and different texts are told apart by a checksum; wholly repeated rows are
copies of each other; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .common import bounded_broadcast, discard, slabs, staged, texts

WINDOW, BLOCK = 400, 101
#: Bytes of contexts that are sorted at once, and distinct contexts of a block that are sorted in one place.
SORTED_BYTES, GROUP = 3_000_000, 8192


def _packed(*columns: np.ndarray) -> np.ndarray:
    """One integer per row that is ordered as the rows are."""
    key = columns[0].astype(np.int64)
    high = int(key.max(initial=0)) + 1
    for column in columns[1:]:
        width = int(column.max(initial=0)) + 1
        if high * width >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            high = int(key.max(initial=0)) + 1
        key = key * width + column
        high *= width
    return key


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of s (positive integers) in ascending order, by the difference cover modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: tuple(s[i:])), dtype=np.int64)
    t = np.concatenate([s.astype(np.int64), np.zeros(3, dtype=np.int64)])
    # a last sampled place past the end keeps the two halves of the sample apart
    first, second, rest = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([first, second])
    triples = _packed(t[sample], t[sample + 1], t[sample + 2])
    distinct, names = np.unique(triples, return_inverse=True)
    order = np.argsort(names) if len(distinct) == len(sample) else suffix_array(names + 1)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = rest[np.argsort(_packed(t[rest], rank[rest + 1]), kind="stable")]
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    m = len(rest)
    keys = _packed(t[np.concatenate([rest, ones])], rank[np.concatenate([rest, ones]) + 1])
    before = np.searchsorted(keys[m:], keys[:m])
    both = np.concatenate([rest, twos])
    keys = _packed(t[both], t[both + 1], rank[both + 2])
    place = np.arange(m) + before + np.searchsorted(keys[m:], keys[:m])
    out = np.empty(n, dtype=np.int64)
    free = np.ones(n, dtype=bool)
    out[place] = rest
    free[place] = False
    out[free] = sampled
    return out


def equal_windows(raw: np.ndarray, a: np.ndarray, b: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs of places whose windows have equal bytes.

    Where the pair one place before is here too, the windows' last bytes tell; other pairs are compared in whole.
    """
    order = np.lexsort((a, b - a))
    a, b = a[order], b[order]
    head = np.ones(len(a), dtype=bool)
    head[1:] = (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
    equal = raw[a + window - 1] == raw[b + window - 1]

    def compare(which: np.ndarray) -> None:
        rows = np.lib.stride_tricks.sliding_window_view(raw, window) if len(which) else None
        for i in range(0, len(which), 4096):
            part = which[i : i + 4096]
            equal[part] = (rows[a[part]] == rows[b[part]]).all(axis=1)

    compare(np.nonzero(head)[0])
    if not equal.all():  # hashes that met by chance
        compare(np.arange(len(a)))
    return a[equal], b[equal]


def repeated(contexts: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each context a flag for every window: whether it starts elsewhere in these contexts too."""
    sizes = np.array([len(x) for x in contexts], dtype=np.int64)
    data = b"\0".join([*contexts, b""])
    raw = np.frombuffer(data, dtype=np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    s = raw.astype(np.int64) + 2
    s[starts + sizes] = 1
    order = suffix_array(s)
    whole = anchors.rolling(anchors._TABLE[raw], window)
    valid = np.zeros(len(s), dtype=bool)
    for a, n in zip(starts, sizes, strict=True):
        valid[a : a + n - window + 1] = True
    order = order[valid[order]]
    same = np.nonzero(whole[order[1:]] == whole[order[:-1]])[0]
    a, b = equal_windows(raw, order[same], order[same + 1], window)
    flags = np.zeros(len(s), dtype=bool)
    flags[a] = True
    flags[b] = True
    return [flags[a : a + n - window + 1] for a, n in zip(starts, sizes, strict=True)]


def spans_of(flags: np.ndarray) -> list[list[int]]:
    """[first, last] of each run of set flags."""
    edges = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.stack([np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0] - 1], axis=1).tolist()


_SPANS = "name binary, spans array<array<int>>"


def _span_rows(found: list[tuple[bytes, np.ndarray]]) -> pa.RecordBatch:
    kept = [(name, spans_of(flags)) for name, flags in found if flags.any()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([n for n, _ in kept], pa.binary()),
            pa.array([x for _, x in kept], pa.list_(pa.list_(pa.int32()))),
        ],
        ["name", "spans"],
    )


def _sorted_places(window: int):  # noqa: ANN202
    """From contexts in order of block and name: the windows that repeat, by context."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[bytes, np.ndarray]] = []
        ready: list[tuple[bytes, bytes, int]] = []
        group: list[list] = []
        block, size = None, 0

        def close() -> None:
            """The contexts of one block are complete."""
            nonlocal size
            if len(group) == 1:
                name, text, n = group[0]
                if n > 1:
                    done.append((name, np.ones(len(text) - window + 1, dtype=bool)))
            else:
                ready.extend(tuple(x) for x in group)
                size += sum(len(x[1]) for x in group)
            group.clear()

        def flush() -> pa.RecordBatch:
            nonlocal size
            if ready:
                for (name, _, n), flags in zip(ready, repeated([x[1] for x in ready], window), strict=True):
                    done.append((name, np.ones_like(flags) if n > 1 else flags))
            rows = _span_rows(done)
            ready.clear()
            done.clear()
            size = 0
            return rows

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "name", "n", "context"))
            for b, name, n, context in zip(*columns, strict=True):
                if b != block:
                    close()
                    block = b
                    if size >= SORTED_BYTES or len(done) >= 10_000:
                        yield flush()
                if group and group[-1][0] == name:
                    group[-1][2] += n
                else:
                    group.append([name, context, n])
        close()
        yield flush()

    return sort


def _windows(window: int):  # noqa: ANN202
    """Every window of the contexts as a row (key, name, place, n)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "context"):
            data = batch.column("context").to_pylist()
            sizes = np.array([len(x) for x in data], dtype=np.int64)
            symbols, _ = anchors.byte_symbols(data)
            n = sizes - window + 1
            row = np.repeat(np.arange(len(data)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            keys = anchors.rolling(symbols, window)[(np.cumsum(sizes) - sizes)[row] + at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)),
                    batch.column("name").take(pa.array(row)),
                    pa.array(at.astype(np.int32)),
                    batch.column("n").take(pa.array(row)),
                ],
                ["key", "name", "place", "n"],
            )

    return split


def cleaned(
    docs: DataFrame, window: int = WINDOW, block: int = BLOCK, group: int = GROUP, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) of each document."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asker = anchors.Asker(across=False)
        for batch in slabs(batches, "text"):
            runs = anchors.runs(*anchors.byte_symbols(texts(batch)), window, block)
            doc, tag = anchors.column(batch, "doc_id"), anchors.column(batch, "tag")
            yield asker.rows(runs.block, doc[runs.text], tag[runs.text], runs.anchor)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text"):
            data, keys, tag = texts(batch), batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
            runs = anchors.marked(anchors.runs(*anchors.byte_symbols(data), window, block), batch)
            found: dict[bytes, tuple[int, bytes, list]] = {}
            columns = (runs.text, runs.low, runs.high, runs.block.view(np.int64))
            for t, low, high, b in zip(*(x.tolist() for x in columns), strict=True):
                context = data[t][low : high + window]
                name = hashlib.blake2b(context, digest_size=16).digest()
                places = found.setdefault(name, (b, context, []))[2]
                places.append({"doc_id": keys[t], "tag": tag[t], "low": low})
            place_type = pa.struct([("doc_id", pa.int64()), ("tag", pa.int64()), ("low", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in found.values()], pa.int64()),
                    pa.array(list(found), pa.binary()),
                    pa.array([len(x) for _, _, x in found.values()], pa.int64()),
                    pa.array([c for _, c, _ in found.values()], pa.binary()),
                    pa.array([x for _, _, x in found.values()], pa.list_(place_type)),
                ],
                ["block", "name", "n", "context", "places"],
            )

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, "text"):
            sizes, removed, n_spans, kept = [], [], [], []
            for x, spans in zip(texts(batch), batch.column("spans").to_pylist(), strict=True):
                parts, at, gone, n = [], 0, 0, 0
                for s in sorted(spans or [], key=lambda s: s["start"]):
                    if s["start"] > at or n == 0:
                        parts.append(x[at : s["start"]])
                        n += 1
                        at = s["start"]
                    gone += max(0, s["end"] - at)
                    at = max(at, s["end"])
                parts.append(x[at:])
                sizes.append(len(x))
                removed.append(gone)
                n_spans.append(n)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(n_spans, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    dealt = anchors.tagged(source.where("doc_id is not null"))
    said = anchors.found_again(dealt.mapInArrow(sampled, anchors.ASKED), False)
    marks = staged(anchors.by_document(said), "sa-marks")
    schema = (
        "block long, name binary, n long, context binary, places array<struct<doc_id: bigint, tag: bigint, low: int>>"
    )
    held = staged(dealt.join(marks, ["doc_id", "tag"]).mapInArrow(contexts, schema), "sa-contexts")
    discard(marks)
    crowded = (
        held.select("block", "name").distinct().groupBy("block").count().where(F.col("count") > group).select("block")
    )
    crowded = bounded_broadcast(staged(crowded, "sa-crowded"))
    rows = held.select("block", "name", "n", "context")
    met = rows.join(crowded, "block", "left_anti").repartition("block").sortWithinPartitions("block", "name")
    spans = met.mapInArrow(_sorted_places(window), _SPANS)
    counted = (
        rows.join(crowded, "block", "left_semi")
        .groupBy("name")
        .agg(F.sum("n").alias("n"), F.max("context").alias("context"))
        .mapInArrow(_windows(window), "key long, name binary, place int, n long")
    )
    often = counted.groupBy("key").agg(F.sum("n").alias("all")).where(F.col("all") > 1)
    one = F.transform(F.array_sort(F.collect_set("place")), lambda x: F.array(x, x))
    others = counted.join(often, "key", "left_semi").groupBy("name").agg(one.alias("spans"))
    spans = staged(spans.unionByName(others), "sa-spans")
    ranges = (
        held.select("name", "places")
        .join(spans, "name")
        .select(F.explode("places").alias("at"), "spans")
        .select("at.doc_id", "at.tag", "at.low", F.explode("spans").alias("span"))
        .groupBy("doc_id", "tag")
        .agg(
            F.collect_list(
                F.struct(
                    (F.col("low") + F.col("span")[0]).alias("start"),
                    (F.col("low") + F.col("span")[1] + window).alias("end"),
                )
            ).alias("spans")
        )
    )
    found = dealt.join(ranges, ["doc_id", "tag"], "left").select("doc_id", "text", "spans")
    none = F.lit(None).cast("array<struct<start:int,end:int>>")
    nameless = source.where("doc_id is null").withColumn("spans", none)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return found.mapInArrow(rewritten, schema).unionByName(nameless.mapInArrow(rewritten, schema))
