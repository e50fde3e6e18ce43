"""Anchors: a sparse choice of places, made from content alone, at which equal windows of texts meet.

Each window of L symbols has one anchor: the leftmost least hash among the first L - BLOCK + 1 blocks of BLOCK symbols
inside it.  Equal windows have equal blocks at equal offsets, so a window whose anchor block is found nowhere else has
no equal, and only the others need a closer look.  This loses nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_TABLE = np.random.default_rng(77003).integers(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64)
#: For a second hash that is independent of the first.
_OTHER_TABLE = np.random.default_rng(91019).integers(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64)
_OTHER_STEP = np.uint64(0xD6E8FEB86659FD93)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOW = np.uint64((1 << 31) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


def byte_symbols(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each byte of all texts, number of bytes of each text)."""
    return _TABLE[np.frombuffer(b"".join(data), dtype=np.uint8)], np.array([len(x) for x in data], dtype=np.int64)


def word_spans(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts joined, starts, ends, words of each text); words are what ASCII white space parts."""
    buffer = np.frombuffer(b"\n".join([*data, b""]), dtype=np.uint8)
    inside = np.concatenate([[False], ~_WHITE[buffer], [False]])
    edges = np.diff(inside.astype(np.int8))
    starts, ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    limits = np.cumsum([len(x) + 1 for x in data])
    return buffer, starts, ends, np.diff(np.searchsorted(starts, limits), prepend=0)


def word_symbols(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word of all texts, another hash of each, number of words of each text)."""
    buffer, starts, ends, counts = word_spans(data)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), counts
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    letters = buffer[np.repeat(starts - first, sizes) + np.arange(sizes.sum())]
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    found = []
    with np.errstate(over="ignore"):
        for table, step in ((_TABLE, _STEP), (_OTHER_TABLE, _OTHER_STEP)):
            powers = np.cumprod(np.full(int(sizes.max()), step, dtype=np.uint64))
            found.append(mix(np.add.reduceat(table[letters] * powers[place], first) + sizes.astype(np.uint64)))
    return *found, counts


def rolling(symbols: np.ndarray, length: int) -> np.ndarray:
    """A hash of symbols[i:i+length] for each i, by doubling."""
    found, have, power, m, step = None, 0, symbols, 1, _STEP
    with np.errstate(over="ignore"):
        while True:
            if length & m:
                if found is None:
                    found, have = power, m
                else:
                    n = len(power) - have
                    found, have = (found[:n] * step + power[have:], have + m) if n > 0 else (power[:0], have + m)
            m *= 2
            if m > length or len(power) < m:
                break
            power, step = power[: -m // 2] * step + power[m // 2 :], step * step
    if have < length:
        return np.zeros(0, np.uint64)
    return mix(found)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of keys[i:i+width] for each i."""
    m = 1
    while m * 2 <= width and len(keys) > m:
        keys, m = np.minimum(keys[:-m], keys[m:]), m * 2
    rest = width - m
    if rest and len(keys) > rest:
        keys = np.minimum(keys[:-rest], keys[rest:])
    return keys


@dataclass
class Runs:
    """Runs of windows with one anchor: text, first and last window, anchor (places in the text), hash of the block."""

    text: np.ndarray
    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    block: np.ndarray
    #: places of the texts' first symbols
    base: np.ndarray

    def __len__(self) -> int:
        return len(self.text)

    def take(self, keep: np.ndarray) -> Runs:
        return Runs(*(x[keep] for x in (self.text, self.low, self.high, self.anchor, self.block)), self.base)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(run, place in the text) of every window."""
        n = self.high - self.low + 1
        run = np.repeat(np.arange(len(self)), n)
        return run, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.low[run]


def runs(symbols: np.ndarray, counts: np.ndarray, window: int, block: int) -> Runs:
    """The runs of all windows of texts laid end to end; counts: symbols of each text."""
    base = np.cumsum(counts) - counts
    none = np.zeros(0, np.int64)
    blocks = rolling(symbols, block)
    places = np.arange(len(blocks), dtype=np.uint64)
    least = sliding_min(((blocks >> np.uint64(32)) << np.uint64(31)) | places, window - block + 1)
    live = np.nonzero(counts >= window)[0]
    if not len(live):
        return Runs(none, none, none, none, np.zeros(0, np.uint64), base)
    n = counts[live] - window + 1
    text = np.repeat(live, n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + base[text]
    anchor = (least[at] & _LOW).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(at)) - 1
    of = base[text[first]]
    return Runs(text[first], at[first] - of, at[last] - of, anchor[first] - of, blocks[anchor[first]], base)


class Asker:
    """Rows (kind, key, doc_id, tag, place) that say or ask which keys are found elsewhere, slab by slab.

    kind 0: found again in this task (across: in another document); kind 2: such a key's one row that other tasks can
    meet; kind 1: a key that is alone so far.  The latest KEPT keys of a task are remembered, so that a key has few rows
    from each task that another must meet, however frequent it is.
    """

    KEPT = 400_000

    def __init__(self, across: bool) -> None:
        self.across = across
        self.keys, self.doc, self.again = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)

    def rows(self, keys: np.ndarray, doc: np.ndarray, tag: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((place, doc, keys))
        keys, doc, tag, place = keys[order], doc[order], tag[order], place[order]
        first = np.ones(len(keys), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        heads = np.nonzero(first)[0]
        tails = np.append(heads[1:], len(keys))[: len(heads)] - 1
        again, said = (doc[heads] != doc[tails]) if self.across else (tails > heads), np.zeros(len(heads), bool)
        if len(self.keys) and len(heads):
            at = np.minimum(np.searchsorted(self.keys, keys[heads]), len(self.keys) - 1)
            seen = self.keys[at] == keys[heads]
            said = seen & self.again[at]
            again = again | said | (seen & ((self.doc[at] != doc[heads]) if self.across else True))
        self._remember(keys[heads], doc[heads], again)
        group = np.cumsum(first) - 1
        for_all, asks = again[group], np.zeros(len(keys), bool)
        asks[heads[again & ~said]] = True
        parts = [(np.zeros(for_all.sum(), np.int8), for_all), (np.full(asks.sum(), 2, np.int8), asks)]
        parts.append((np.ones((~for_all).sum(), np.int8), ~for_all))
        chosen = np.concatenate([np.nonzero(m)[0] for _, m in parts])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([k for k, _ in parts])),
                pa.array(keys[chosen].view(np.int64)),
                pa.array(doc[chosen]),
                pa.array(tag[chosen]),
                pa.array(place[chosen].astype(np.int32)),
            ],
            ["kind", "key", "doc_id", "tag", "place"],
        )

    def _remember(self, keys: np.ndarray, doc: np.ndarray, again: np.ndarray) -> None:
        if len(self.keys) + len(keys) > self.KEPT:
            self.keys, self.doc, self.again = keys, doc, again
            return
        # the new state of a key comes first, so that it is the one kept
        every, at = np.unique(np.concatenate([keys, self.keys]), return_index=True)
        self.keys = every
        self.doc, self.again = np.concatenate([doc, self.doc])[at], np.concatenate([again, self.again])[at]


ASKED = "kind byte, key long, doc_id long, tag long, place int"


def tagged(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with a tag that tells rows with one key apart by their texts; 0 where keys do not repeat."""
    repeats = docs.groupBy("doc_id").count().where("count > 1").limit(1).count()
    checksum = F.coalesce(F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")), F.lit(0))
    return docs.withColumn("tag", checksum if repeats else F.lit(0).cast("long"))


def found_again(rows: DataFrame, across: bool) -> DataFrame:
    """(key, doc_id, tag, place) of the keys that are found elsewhere."""
    # a row whose answer is known has a group of its own
    known = F.when(F.col("kind") == 0, F.struct("doc_id", "place"))
    by_key = Window.partitionBy("key", known)
    if across:
        again = F.min("doc_id").over(by_key) != F.max("doc_id").over(by_key)
    else:
        again = F.count("*").over(by_key) > 1
    said = rows.withColumn("again", again).where("kind = 0 or (kind = 1 and again)")
    return said.select("key", "doc_id", "tag", "place")


def by_document(said: DataFrame) -> DataFrame:
    """(doc_id, tag, places)."""
    return said.groupBy("doc_id", "tag").agg(F.collect_list("place").alias("places"))


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of longs without nulls."""
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def marked(runs_: Runs, batch: pa.RecordBatch) -> Runs:
    """The runs whose anchors stand in the list column `places`."""
    lists = batch.column("places")
    sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    row, place = np.repeat(np.arange(batch.num_rows), sizes), lists.flatten().to_numpy(zero_copy_only=False)
    wide = np.int64(1) << np.int64(40)
    return runs_.take(np.isin(runs_.text * wide + runs_.anchor, row * wide + place))
