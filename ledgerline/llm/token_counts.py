"""Token counts of whole documents by overlap resynchronisation.

A huge document is encoded as overlapping chunks.  Each encoding yields the offsets of its *stable boundaries* with the
tokens before them.  A boundary between two characters is stable if no piece of the vocabulary holds the two as
neighbours (read from the model when it is loaded), so that no merge ever crosses it, whatever stands around: before
spaces, and between words and punctuation.  Two chunks are spliced at the first stable boundary that both report inside the overlap; if
there is none, the left chunk is extended, twice as far each time, up to the whole document.

Text between stable boundaries is encoded by the library once per worker and remembered.

Edge cases: a null text is empty and has no tokens; repeated rows are counted each; an empty table gives an empty
result; a null key is carried; other columns are not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slabs

CHUNK, OVERLAP = 32_768, 512
#: Segments that a worker remembers.
REMEMBERED = 400_000
_SPACE = "▁"


class Counter:
    """Counts as sentencepiece does for one model, with no begin or end tokens."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(self.library.vocab_size())
        special = (self.library.is_control, self.library.is_unknown, self.library.is_byte)
        pieces = [self.library.id_to_piece(i) for i in ids if not any(f(i) for f in special)]
        pairs = {(a, b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
        #: Whether spaces part the text; otherwise whole texts go to the library.
        self.parted = not any(b == _SPACE != a for a, b in pairs) and self.library.encode("a  b", out_type=str)[0] == "▁a"
        known = {x for p in pieces for x in p}
        odd = re.escape("".join(sorted(x for x in known if re.match(r"[^\W\d_]", x) and not x.isalpha())))
        letter = f"(?![{odd}])[^\\W\\d_]" if odd else r"[^\W\d_]"
        words = not any(_SPACE not in (a, b) and a.isalpha() != b.isalpha() for a, b in pairs)
        self.segment = re.compile(f" *(?:{letter})+| *(?:(?!{letter})[^ ])+| +" if words else " *[^ ]+| +")
        self.newline = len(self.library.encode("\n"))
        self.known: dict[str, int] = {}

    def learn(self, segments: set[str]) -> None:
        """Remember the counts of segments."""
        new = [x for x in segments if x not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(segments)
        # the library adds a space mark in front: it stands for a segment's first space, or else is parted by a newline
        asked = [x[1:] if x[0] == " " else "\n" + x for x in new]
        for segment, ids in zip(new, self.library.encode(asked, num_threads=1), strict=True):
            self.known[segment] = len(ids) - (0 if segment[0] == " " else self.newline)
        if " " in segments:
            # the library adds no space mark to an empty text
            self.known[" "] = len(self.library.encode("a ")) - len(self.library.encode("a"))

    def boundaries(self, chunk: str) -> tuple[list[int], list[int]]:
        """Offsets of the stable boundaries in a chunk that starts with a space mark, and the tokens before each."""
        segments = self.segment.findall(chunk)
        self.learn(set(segments))
        offsets, tokens, at, n = [], [], 0, 0
        for segment in segments:
            offsets.append(at)
            tokens.append(n)
            at += len(segment)
            n += self.known[segment]
        return [*offsets, at], [*tokens, n]

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        if not text:
            return 0
        if not self.parted:
            return len(self.library.encode(text))
        whole = " " + text.replace(_SPACE, " ")
        if len(whole) <= chunk + overlap:
            segments = self.segment.findall(whole)
            self.learn(set(segments))
            return sum(map(self.known.__getitem__, segments))
        start, total, step = 0, 0, chunk
        offsets, tokens = self.boundaries(whole[:chunk])
        while True:
            end = start + offsets[-1]
            if end >= len(whole):
                return total + tokens[-1]
            # the next chunk begins in this one; its own first boundary is not one of the document's
            begin = max(start + 1, end - overlap)
            other, others = self.boundaries(whole[begin : begin + chunk])
            mine = {start + x: n for x, n in zip(offsets[:-1], tokens[:-1], strict=True) if start + x > begin}
            common = next((i for i, x in enumerate(other[:-1]) if i and begin + x in mine), None)
            if common is None:
                step *= 2
                offsets, tokens = self.boundaries(whole[start : start + step])
                continue
            total += mine[begin + other[common]]
            cut = other[common]
            start, step = begin + cut, chunk
            offsets = [x - cut for x in other[common:]]
            tokens = [n - others[common] for n in others[common:]]


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model)
        for batch in slabs(batches, "text"):
            found = [counter.count(x or "") for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    source = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("long").alias("n_bytes"),
    )
    rows = source.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
