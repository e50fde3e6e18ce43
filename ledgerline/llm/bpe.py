"""BPE encoding and decoding by tree concatenation.

Encoding works on the pieces that the tokenizer's own pre-tokenizer parts; a piece is encoded by the library once per
worker and remembered.  A long piece without any split is halved down to leaves, the leaves are encoded on their own
(left ones without the end-of-word mark), and halves are joined bottom up: a window around the join is encoded again,
growing on both sides until its first token is the left side's token there and its last one the right side's.  Each
pair of neighbours in the result then stands in some valid encoding, which makes a BPE encoding of the whole valid.

Texts with characters outside the Latin blocks, for which the pre-tokenizer's Unicode tables could differ from Python's,
go to the library whole, as do their parts around special tokens.

Edge cases: a null text is empty and has no ids; repeated rows are encoded each; an empty table gives an empty result;
null keys and other columns are carried where `encode_documents` keeps them.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slabs

#: Pieces that a worker remembers, and characters from which a piece is encoded as a tree.
REMEMBERED, LONG = 120_000, 256
LEAF = 64
_PLAIN = regex.compile("[\t\n\r\x20-\x7e¡-ɏ]*")


class Codec:
    """Encodes and decodes as the tokenizers library does for one file, without truncation or padding."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        model, steps = spec["model"], (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        kinds = [(x["type"], x.get("pattern", {}).get("Regex"), x.get("behavior"), x.get("invert")) for x in steps]
        normal = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        #: Whether this tokenizer parts text in the way that the fast path knows.
        self.parted = (
            len(kinds) == 2
            and kinds[0][0] == "Split"
            and kinds[0][2:] == ("Removed", True)
            and kinds[1][0] == "ByteLevel"
            and normal == ["NFC", "Replace", "Lowercase"]
            and spec["decoder"] is None
        )
        self.piece = regex.compile(kinds[0][1]) if self.parted else None
        added = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
        #: By whether the piece's end is the word's end.
        self.models = {}
        for suffix in (True, False):
            mark = {"end_of_word_suffix": model["end_of_word_suffix"]} if suffix and model["end_of_word_suffix"] else {}
            tokenizer = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, **mark))
            tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.models[suffix] = tokenizer
        self.known: dict[str, tuple[bytes, str]] = {}

    def part(self, text: str, end: bool) -> tuple[list[int], list[int]]:
        """Ids of a part of one piece and the characters of each; end: the piece ends here."""
        found = self.models[end].encode(text, add_special_tokens=False)
        ends = [b for _, b in found.offsets]
        return found.ids, [b - a for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def tree(self, text: str, end: bool = True) -> tuple[list[int], list[int]]:
        """Ids and widths of a long piece (ASCII, so that a character is a byte), by halves."""
        if len(text) <= LEAF:
            return self.part(text, end)
        half = len(text) // 2
        (left, lw), (right, rw) = self.tree(text[:half], False), self.tree(text[half:], end)
        m = 2
        while True:
            a, b = min(m, len(left)), min(m, len(right))
            lo, hi = half - sum(lw[len(lw) - a :]), half + sum(rw[:b])
            ids, widths = self.part(text[lo:hi], end and hi == len(text))
            agree_left = a == len(left) or (ids[0] == left[-a] and widths[0] == lw[-a])
            agree_right = b == len(right) or (ids[-1] == right[b - 1] and widths[-1] == rw[b - 1])
            if agree_left and agree_right:
                return left[: len(left) - a] + ids + right[b:], lw[: len(lw) - a] + widths + rw[b:]
            m *= 2

    def learn(self, pieces: set[str]) -> None:
        new = [x for x in pieces if x not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(pieces)
        short = [x for x in new if len(x) <= LONG or not x.isascii()]
        for piece, found in zip(short, self.models[True].encode_batch(short, add_special_tokens=False), strict=True):
            self.known[piece] = np.array(found.ids, dtype="<u4").tobytes(), " ".join(found.tokens)
        for piece in new:
            if len(piece) > LONG and piece.isascii():
                ids = self.tree(piece)[0]
                tokens = " ".join(map(self.library.id_to_token, ids))
                self.known[piece] = np.array(ids, dtype="<u4").tobytes(), tokens

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the decoded text."""
        if not (self.parted and _PLAIN.fullmatch(text)):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes(), self.library.decode(ids, skip_special_tokens=False)
        parts = self.special.split(text) if self.special else [text]
        ids, tokens = [], []
        for i, part in enumerate(parts):
            if i % 2:
                ids.append(np.array([self.library.token_to_id(part)], dtype="<u4").tobytes())
                tokens.append(part)
            elif part:
                pieces = self.piece.findall(unicodedata.normalize("NFC", part).lower())
                self.learn(set(pieces))
                found = list(map(self.known.__getitem__, pieces))
                ids += [x for x, _ in found]
                tokens += [x for _, x in found]
        return b"".join(ids), " ".join(tokens)


@functools.lru_cache(maxsize=1)
def codec_of(path: str) -> Codec:
    """The worker's codec, kept from task to task."""
    return Codec(path)


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (binary, little-endian 32-bit), decoded."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in slabs(batches, "text"):
            found = [codec.encode(x or "") for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(ids) // 4 for ids, _ in found], pa.int64()),
                    pa.array([ids for ids, _ in found], pa.binary()),
                    pa.array([decoded for _, decoded in found], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(encoded, "doc_id long, n_tokens long, ids binary, decoded string")


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256; digests are taken where texts are encoded."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in slabs(batches, "text"):
            n, of_ids, of_text = [], [], []
            for x in batch.column("text").to_pylist():
                ids, decoded = codec.encode(x or "")
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(digested, schema)
